"""Figure ↔ image matching.

Rules (all our restatement of the pipeline's behaviour):

* M1 image map: image members (regular files whose lower-cased name ends in an
  image extension) keyed by lower-cased basename.  When two members share a
  key, the key sits at the position of the *first* and resolves to the *last*.
* M2 ``base`` = last path component of ``graphic_ref``; ``stem`` = base without
  its final suffix (a leading-only or trailing dot keeps it).
* M3 candidates, in order: ``lower(base)``, then ``lower(stem + ext)`` for each
  image extension.
* M4 exact: the first candidate present in the map.
* M5 loose (only when M4 finds nothing): the first key, in map order, that
  *contains* ``stem``.  The stem is not lower-cased, the keys are, so a stem
  with capitals never matches loosely; an empty stem matches the first key.
  ``strict=True`` switches M5 off.
* M6 no hit ⇒ the figure is dropped.

Two equivalent forms:

* :func:`match_hit` / :func:`match_packages` — higher-order functions inside
  one row that already holds a package's member list (the unpack output).  No
  join and no shuffle: a package is one file, one row.
* :func:`match_images` — relational form for separate figure and member
  tables: the members of an article become one array and join its figures
  on the article, one shuffle per side; the rule is then the in-row one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figpairs.functions.text import IMAGE_EXTS, basename, is_image_name, stem


# ---------------------------------------------------------------------------
# Expressions shared by both forms
# ---------------------------------------------------------------------------
def ref_base(ref) -> Column:
    return basename(ref)


def candidates(base: Column, st: Column) -> Column:
    """M3: ``[lower(base)] + [lower(stem + e) for e in IMAGE_EXTS]``."""
    return F.concat(F.array(F.lower(base)), F.array(*[F.lower(F.concat(st, F.lit(e))) for e in IMAGE_EXTS]))


def with_ref_parts(figs: DataFrame, ref_col: str = "graphic_ref") -> DataFrame:
    b = ref_base(F.col(ref_col))
    return figs.withColumn("ref_base", b).withColumn("ref_stem", stem(F.col("ref_base"))).withColumn(
        "candidates", candidates(F.col("ref_base"), F.col("ref_stem"))
    )


def member_key(name) -> Column:
    return F.lower(basename(name))


# ---------------------------------------------------------------------------
# In-row form (package rows)
# ---------------------------------------------------------------------------
def image_map_array(members: Column) -> Column:
    """M1 over a ``members`` array: image entries as ``struct(pos, k)`` in tar order."""
    imgs = F.filter(members, lambda m: F.coalesce(m["isfile"], F.lit(True)) & is_image_name(m["name"]))
    return F.transform(imgs, lambda m: F.struct(m["pos"].alias("pos"), member_key(m["name"]).alias("k")))


def match_hit(imap: Column, ref: Column, strict: bool = False) -> Column:
    """Matched member position (``INT``) for one ``graphic_ref`` against an image map array, or NULL."""
    base = ref_base(ref)
    st = stem(base)
    keys = F.transform(imap, lambda m: m["k"])
    exact = F.get(F.filter(candidates(base, st), lambda c: F.array_contains(keys, c)), 0)
    hit = exact if strict else F.coalesce(exact, F.get(F.filter(keys, lambda k: k.contains(st)), 0))
    # The key resolves to its last member.
    return F.array_max(F.transform(F.filter(imap, lambda m: m["k"] == hit), lambda m: m["pos"]))


def match_packages(df: DataFrame, figures_col: str = "figures", members_col: str = "members", strict: bool = False) -> DataFrame:
    """Add ``member_pos`` to every figure of each package row (no shuffle)."""
    imap = image_map_array(F.col(members_col))
    return df.withColumn(
        figures_col,
        F.transform(F.col(figures_col), lambda f: f.withField("member_pos", match_hit(imap, f["graphic_ref"], strict))),
    )


# ---------------------------------------------------------------------------
# Relational form (separate tables)
# ---------------------------------------------------------------------------
def image_map(members: DataFrame, keys=("article_id",)) -> DataFrame:
    """One row per (article, key): ``first_pos`` (map order) and ``member_pos`` (last wins).

    A partial aggregation — each map task pre-combines before the shuffle, so a
    package with many duplicate names does not load one reducer.
    """
    keys = list(keys)
    isfile = F.col("isfile") if "isfile" in members.columns else F.lit(True)
    m = members.filter(isfile & is_image_name("name")).select(*keys, "pos", member_key("name").alias("key"))
    return m.groupBy(*keys, "key").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("member_pos"))


def match_images(figs: DataFrame, members: DataFrame, keys=("article_id",), fig_key: str = "fig_pos",
                 ref_col: str = "graphic_ref", strict: bool = False, how: str = "inner") -> DataFrame:
    """Match figures to image members; adds ``member_key``, ``member_pos``, ``match_kind``.

    ``figs`` needs ``keys``, ``fig_key`` (unique within the article) and
    ``ref_col``; ``members`` needs ``keys``, ``pos``, ``name`` (and optionally
    ``isfile``).  ``how="left"`` keeps unmatched figures with NULLs.

    An article's image members are gathered into one array (as many as its
    package holds), which meets the article's figures in one join: a shuffle per
    side.  The rest is the in-row rule, so a figure that has an exact hit costs
    no loose search.
    """
    keys = list(keys)
    isfile = F.col("isfile") if "isfile" in members.columns else F.lit(True)
    m = members.filter(isfile & is_image_name("name")).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", member_key("name").alias("k")))).alias("_images"))
    base = ref_base(F.col(ref_col))
    st = stem(base)
    names = F.transform("_images", lambda x: x["k"])
    exact = F.get(F.filter(candidates(base, st), lambda c: F.array_contains(names, c)), 0)
    loose = F.lit(None).cast("string") if strict else F.get(F.filter(names, lambda k: k.contains(st)), 0)

    def resolved(hit: Column) -> Column:
        key = F.coalesce(hit["exact"], hit["loose"])
        # The key resolves to its last member.
        pos = F.array_max(F.transform(F.filter("_images", lambda x: x["k"] == key), lambda x: x["pos"]))
        kind = F.when(hit["exact"].isNotNull(), "exact").when(hit["loose"].isNotNull(), "loose")
        return F.struct(key.alias("member_key"), pos.alias("member_pos"), kind.alias("match_kind"))

    # The result passes through a generator: a condition on it over both sides'
    # columns stays above the join (pushed below, it would not resolve there).
    hits = F.transform(F.array(F.struct(exact.alias("exact"), loose.alias("loose"))), resolved)
    out = figs.join(m, keys, "left" if how == "left" else "inner").select(*figs.columns, F.inline(hits))
    return out if how == "left" else out.filter(F.col("member_pos").isNotNull())
