"""Fetch planning.

Downloading itself is not done here; what the pipeline decides about fetching
is data: the package URL pair, the size guard, what is still pending, and
which location resolved.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.functions.text import PACKAGE_EXT, basename, with_ext

# ---------------------------------------------------------------------------
# Public open-access package locations, primary then fallback.
PRIMARY_BASE = "https://pmc-oa-opendata.s3.amazonaws.com/"
FALLBACK_BASE = "https://ftp.ncbi.nlm.nih.gov/pub/pmc/"
MB = 1024 * 1024
# ---------------------------------------------------------------------------


def package_urls(cat: DataFrame, ext: str = PACKAGE_EXT, primary: str = PRIMARY_BASE, fallback: str = FALLBACK_BASE) -> DataFrame:
    """``rel_path`` (extension appended unless present, case-sensitive)
    and the primary and fallback URLs."""
    rel = with_ext("path", ext)
    return cat.withColumn("rel_path", rel).withColumn("primary_url", F.concat(F.lit(primary), rel)).withColumn(
        "fallback_url", F.concat(F.lit(fallback), rel)
    )


def size_guard(df: DataFrame, max_mb: int | None, size_col: str = "size") -> DataFrame:
    """drop a package only when its size is known and above ``max_mb`` MiB.

    Unknown size passes; ``max_mb=None`` disables the guard.  With a
    ``binaryFile`` scan filter ``length`` this way before touching ``content``.
    """
    if max_mb is None:
        return df
    s = F.col(size_col)
    return df.filter(s.isNull() | (s <= F.lit(int(max_mb)) * F.lit(MB)))


def too_large(size_col: str = "size", max_mb: int | None = None):
    if max_mb is None:
        return F.lit(False)
    s = F.col(size_col)
    return F.coalesce(s > F.lit(int(max_mb)) * F.lit(MB), F.lit(False))


def size_required(df: DataFrame, size_col: str = "size") -> DataFrame:
    """the download path's rule — an unknown size means skip."""
    return df.filter(F.col(size_col).isNotNull())


def package_file_name(pmcid_col: str = "pmcid", ext: str = PACKAGE_EXT):
    return F.concat(F.col(pmcid_col), F.lit(ext))


def pending_fetch(cat: DataFrame, landed: DataFrame, ext: str = PACKAGE_EXT) -> DataFrame:
    """Catalogue rows whose ``<pmcid><ext>`` is not yet landed (left anti)."""
    want = cat.withColumn("file_name", package_file_name("pmcid", ext))
    have = landed.select(basename("file_name").alias("file_name") if "file_name" in landed.columns else basename("path").alias("file_name"))
    return want.join(have, "file_name", "left_anti")


def resolve_fallback(cat: DataFrame, primary_has: DataFrame, fallback_has: DataFrame, ext: str = PACKAGE_EXT,
                     primary: str = PRIMARY_BASE, fallback: str = FALLBACK_BASE) -> DataFrame:
    """The first location that has the package, else a fetch failure.

    ``primary_has`` / ``fallback_has`` list the relative paths available at each
    location (column ``rel_path``).  Two left joins and a ``coalesce``.
    """
    urls = package_urls(cat, ext, primary, fallback)
    p = primary_has.select("rel_path", F.lit(True).alias("_p")).distinct()
    f = fallback_has.select("rel_path", F.lit(True).alias("_f")).distinct()
    out = urls.join(p, "rel_path", "left").join(f, "rel_path", "left")
    src = F.when(F.col("_p"), F.col("primary_url")).when(F.col("_f"), F.col("fallback_url"))
    status = F.when(F.col("_p"), "primary").when(F.col("_f"), "fallback").otherwise("fetch_failed")
    return out.withColumn("resolved_url", src).withColumn("fetch_status", status).drop("_p", "_f")


def package_key(path_col: str = "path", ext: str = PACKAGE_EXT):
    """``pmcid`` of a package file: its file name without the extension."""
    return F.regexp_replace(basename(path_col), re.escape(ext) + "$", "")


def join_packages(cat: DataFrame, packages: DataFrame, ext: str = PACKAGE_EXT, how: str = "inner") -> DataFrame:
    """Catalogue entry ↔ its package, on ``pmcid`` (package file named ``<pmcid><ext>``).

    Use it on package listings or the unpacked index — never on rows that still
    carry ``content``.  The package file path is returned as ``package_path``.

    The catalogue side is broadcast only when its measured row count allows;
    otherwise a sort-merge join on ``pmcid`` with AQE.
    """
    pk = packages.withColumn("pmcid", package_key("path", ext)).withColumnRenamed("path", "package_path")
    return pk.join(cat, "pmcid", how)


def plan_fetch(cat: DataFrame, landed: DataFrame | None = None, sizes: DataFrame | None = None, max_mb: int | None = None,
               require_size: bool = False, ext: str = PACKAGE_EXT) -> DataFrame:
    """Fetch plan per catalogue entry: URLs (F2/F3), what is not landed yet (J3),
    and the size rules — unknown sizes pass (F4) unless ``require_size`` (F5).

    ``sizes`` has ``pmcid, size``; ``landed`` is a listing with ``path``.
    """
    plan = package_urls(cat, ext)
    if landed is not None:
        plan = pending_fetch(plan, landed, ext)
    if sizes is not None:
        plan = plan.join(sizes.select("pmcid", "size"), "pmcid", "left")
        if require_size:
            plan = size_required(plan)
        plan = size_guard(plan, max_mb)
    return plan
