"""Pair records, resume and first-success dedupe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figpairs.functions.text import IMAGE_PATH_FORMAT, PAIR_ID_FORMAT, nonempty_or, py_strip
from figpairs.schemas import PAIR_FIELDS
from figpairs.sources.ids import KEY, IdIndex, id_key


def usable(caption_col: str = "fig_caption", ref_col: str = "graphic_ref") -> Column:
    """F8: caption non-empty after a Unicode strip, and ``graphic_ref`` non-empty.

    A NULL caption counts as absent (the source would have written the text
    ``"None"``; we do not reproduce that).
    """
    cap = py_strip(F.col(caption_col))
    return F.coalesce(cap != "", F.lit(False)) & F.coalesce(F.col(ref_col) != "", F.lit(False))


def usable_figures(figs: DataFrame, caption_col: str = "fig_caption", ref_col: str = "graphic_ref") -> DataFrame:
    return figs.filter(usable(caption_col, ref_col)).withColumn("caption", py_strip(F.col(caption_col)))


def article_id_expr(first_value: Column, fallback: Column) -> Column:
    """the first figure's id, else the catalogue's (empty counts as missing)."""
    return nonempty_or(first_value, fallback)


def pair_id(pmid_col: str = "pmid", fig_id_col: str = "fig_id") -> Column:
    """``pmid + '_' + fig_id`` (a missing fig_id is the empty string)."""
    return F.format_string(PAIR_ID_FORMAT, F.coalesce(F.col(pmid_col), F.lit("")), F.coalesce(F.col(fig_id_col), F.lit("")))


def image_path(pmcid_col: str = "pmcid", fig_id_col: str = "fig_id") -> Column:
    """``<pmc>/<pmc>_fig-<fig_id>.jpg``; always ``.jpg``."""
    pmc = F.coalesce(F.col(pmcid_col), F.lit(""))
    fid = F.coalesce(F.col(fig_id_col), F.lit(""))
    path = F.format_string(IMAGE_PATH_FORMAT, pmc, pmc, fid)
    # an empty pmcid leaves no leading folder (``Path('') / name`` is ``name``)
    return F.when(pmc == "", F.regexp_replace(path, "^/", "")).otherwise(path)


def to_pair_records(df: DataFrame, keep=(), key_on: str = "pmid") -> DataFrame:
    """the five contract columns in order (``caption`` already stripped),
    plus any ``keep`` columns after them.

    ``key_on="pmid"`` (default) builds ``pair_id`` as ``pmid_figid`` like the
    source, where articles without a pmid collide on ids such as ``_F1``;
    ``key_on="pmcid"`` keys on the always-present article id instead.
    """
    out = df.withColumn("pair_id", pair_id(key_on, "fig_id")).withColumn("image", image_path("pmcid", "fig_id"))
    return out.select(*PAIR_FIELDS, *keep)


def resume_anti(pairs: DataFrame, existing: DataFrame | IdIndex, scope=()) -> DataFrame:
    """Drop pairs whose ``pair_id`` (within the same scope) already exists.

    With an index (:func:`figpairs.sources.ids.sync_ids`) the prior side is not
    shuffled: the distinct new ids are dealt out into the index's buckets, and
    the pairs lose those that are found there.
    """
    if isinstance(existing, IdIndex):
        keyed = pairs.withColumn(KEY, id_key(scope))
        asked = keyed.select(KEY).distinct().repartition(existing.buckets, KEY)
        # inner, as a semi join would be pushed below the repartition and the prior side be shuffled
        known = asked.join(existing.ids, KEY).select(KEY)
        return keyed.join(known, KEY, "left_anti").select(*pairs.columns)
    on = list(scope) + ["pair_id"]
    return pairs.join(existing.select(*on), on, "left_anti")


def dedupe_first(pairs: DataFrame, scope=(), order=("line_no", "fig_pos"), key: str = "pair_id") -> DataFrame:
    """Keep the first row per (scope, key) in ``order``.

    ``min_by`` over a struct of the order columns is a declarative aggregate,
    so Spark combines on the map side before the shuffle: a key that holds a
    third of all rows still arrives at its reducer as one row per map task.
    Deterministic, unlike ``dropDuplicates``.
    """
    grp = list(scope) + [key]
    cols = [c for c in pairs.columns if c not in grp]
    first = F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")
    return pairs.groupBy(*grp).agg(first).select(*grp, "_r.*").select(*pairs.columns)


def build_pair_rows(pairs: DataFrame, existing: DataFrame | IdIndex | None = None, scope=(), resume: bool = True,
                    order=("line_no", "fig_pos")) -> DataFrame:
    """J4 then W1, both only when ``resume`` is on (with it off nothing is removed)."""
    if not resume:
        return pairs
    if existing is not None:
        pairs = resume_anti(pairs, existing, scope)
    return dedupe_first(pairs, scope, order)


def to_pairs(matched: DataFrame, existing: DataFrame | IdIndex | None = None, scope=("split",), resume: bool = True,
             order=("line_no", "fig_pos"), key_on: str = "pmid") -> DataFrame:
    """Matched figure rows → pair records with resume and first-success dedupe
    (F10, F11, F13, J4, W1).  ``matched`` carries the figure, its resolved
    ``pmid``/``pmcid``, ``caption`` and the order and scope columns."""
    keep = [c for c in (*scope, *order) if c in matched.columns]
    rows = to_pair_records(matched, keep=tuple(dict.fromkeys(keep)), key_on=key_on)
    return build_pair_rows(rows, existing=existing, scope=scope, resume=resume, order=order)


def append_prior(prior: DataFrame, new: DataFrame) -> DataFrame:
    """The output file after an append run — prior rows then new rows."""
    return prior.unionByName(new)


def filter_allowlist(articles: DataFrame, allow: DataFrame, key: str = "pmcid", allow_key: str | None = None) -> DataFrame:
    """Keep articles whose id is on the allow-list (left semi)."""
    a = allow.select(F.col(allow_key or key).alias(key)).filter(F.col(key).isNotNull())
    return articles.join(a, key, "left_semi")


def pair_id_collisions(pairs: DataFrame, article_key: str = "pmcid") -> DataFrame:
    """Ids shared by more than one article (e.g. ``_F1`` from empty pmids)."""
    return (
        pairs.groupBy("pair_id")
        .agg(F.countDistinct(article_key).alias("n_articles"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_articles") > 1)
    )
