"""Catalogue and list sources.

A catalogue is a tab-separated text file with one header line: ``path, title,
pmcid, pmid, code``.  It is read with the ``text`` source, not ``csv`` — the
list has no quoting and ragged rows must be seen, not repaired.

Line numbers follow file order.  ``line_no`` is 0 for the header and 1.. for
data lines, i.e. the position among data lines, which is what the subset limit
and sharding count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from figpairs.functions.text import PACKAGE_EXT, basename, py_strip, split_tabs
from figpairs.plans.joins import join_checked
from figpairs.schemas import CATALOGUE_FIELDS


def with_line_numbers(scan: DataFrame, name: str = "line_no", start: int = 0) -> DataFrame:
    """Number the rows of a file scan in file order, per file, without a global sort.

    A parquet scan knows each row's place (``_metadata.row_index``).  For other
    sources the scan is checkpointed once with each row's file split and place
    in its task, so that counting and numbering see the same splits whatever
    happens to the cluster in between: each split's row count (one tiny row,
    partially aggregated on the map side) gives its offset in the file, which is
    joined back.  No row of the scan is shuffled.  A row whose split has no offset
    ends the job.

    Output adds ``file_path`` and ``name``; the first row of each file gets ``start``.
    """
    path = F.col("_metadata.file_path").alias("file_path")
    try:
        return scan.select("*", path, (F.col("_metadata.row_index") + F.lit(start)).alias(name))
    except AnalysisException:  # not a parquet scan
        pass
    from figpairs.session import checkpoint_dir

    checkpoint_dir(scan.sparkSession)
    src = scan.select("*", path, F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_mid"))
    src = src.checkpoint(eager=True)
    blocks = src.groupBy("file_path", "_blk").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file_path").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file_path", "_blk", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    out = join_checked(src, offsets, ["file_path", "_blk"], how="left")
    base = F.coalesce("_base", F.raise_error(F.concat(F.lit("no offset for a split of "), F.col("file_path"))).cast("long"))
    out = out.withColumn(name, base + F.col("_mid") - F.col("_first") + F.lit(start))
    return out.drop("_blk", "_mid", "_first", "_base")


def with_ordinal(df: DataFrame, order, name: str = "ordinal", start: int = 0) -> DataFrame:
    """Dense 0-based position of every row in ``order``, without a single-partition window.

    The rows are range-sorted (a distributed sort) and checkpointed to the shared
    folder so both passes see the same partitions; then each partition's row
    count (one tiny row per partition) gives its offset, which is joined back and
    added to the row's place inside its partition.
    """
    from figpairs.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    src = df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_mid"))
    src = src.checkpoint(eager=True)
    parts = src.groupBy("_part").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    out = join_checked(src, offsets, ["_part"])
    out = out.withColumn(name, F.col("_base") + F.col("_mid") - F.col("_first") + F.lit(start))
    return out.drop("_part", "_mid", "_first", "_base")


def read_lines(spark: SparkSession, path, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Text lines with ``file_path`` and ``line_no`` (header = 0)."""
    r = spark.read.format("text")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return with_line_numbers(r.load(path))


def header(lines: DataFrame) -> DataFrame:
    """The header line of each file (``line_no = 0``)."""
    return lines.filter(F.col("line_no") == 0).select(*(["file_path"] if "file_path" in lines.columns else []), F.col("value").alias("header"))


def data_lines(lines: DataFrame, subset: int | None = None) -> DataFrame:
    """Drop the header; F1: keep the first ``subset`` raw lines (0/None = all).

    Malformed lines use up the budget, so this runs before any field check.
    """
    out = lines.filter(F.col("line_no") >= 1)
    if subset:
        out = out.filter(F.col("line_no") <= F.lit(int(subset)))
    return out


def _fields(parts) -> list:
    return [F.get(parts, i).alias(f) for i, f in enumerate(CATALOGUE_FIELDS)]


def parse_catalogue(lines: DataFrame, on_malformed: str = "skip", subset: int | None = None, keep_value: bool = False) -> DataFrame:
    """Catalogue rows from numbered lines.

    ``on_malformed``:
      * ``"skip"`` (S1) — split the line as is on tabs; keep rows with exactly 5
        fields (trailing empty fields count), drop the rest silently.
      * ``"fail"`` (S2) — strip Unicode whitespace from both ends first (an
        empty last field therefore disappears), then require exactly 5 fields;
        the first violating row aborts the job.
      * ``"at_least_five"`` (S3) — keep rows with 5 or more fields; the raw line
        is kept in ``value``.
    """
    data = data_lines(lines, subset)
    keep = [c for c in data.columns if c != "value"]
    if on_malformed == "fail":
        parts = split_tabs(py_strip("value"))
        n = F.size(parts)
        checked = F.when(n != 5, F.raise_error(F.format_string("catalogue line %d has %d fields, expected 5", F.col("line_no"), n))).otherwise(parts)
        out = data.select(*keep, "value", checked.alias("_p"))
    else:
        out = data.select(*keep, "value", split_tabs("value").alias("_p"))
        out = out.filter(F.size("_p") == 5) if on_malformed == "skip" else out.filter(F.size("_p") >= 5)
    cols = keep + _fields(F.col("_p")) + (["value"] if keep_value or on_malformed == "at_least_five" else [])
    return out.select(*cols)


def catalogue_violations(lines: DataFrame, subset: int | None = None) -> DataFrame:
    """S2 report: data lines that would abort a fail-fast read, with their field count."""
    n = F.size(split_tabs(py_strip("value")))
    return data_lines(lines, subset).select("line_no", n.alias("n_fields")).filter(F.col("n_fields") != 5)


def read_catalogue(spark: SparkSession, path, on_malformed: str = "skip", subset: int | None = None) -> DataFrame:
    return parse_catalogue(read_lines(spark, path), on_malformed, subset)


def number_lists(lines: DataFrame, name: str = "list_idx", start: int = 1) -> DataFrame:
    """Number list files in sorted path order, from ``start``.

    The dense rank is taken over the distinct paths only (one row per file,
    bounded by the directory listing) and joined back, so no row-level global
    window is formed.
    """
    paths = lines.select("file_path").distinct()
    ranked = paths.select("file_path", (F.dense_rank().over(Window.orderBy("file_path")) + F.lit(start - 1)).alias(name))
    return join_checked(lines, ranked, ["file_path"])


def read_shard_lists(spark: SparkSession, shard_dir: str, glob: str = "*.txt", on_malformed: str = "skip", subset: int | None = None) -> DataFrame:
    """All shard lists of a directory as one catalogue with ``shard_idx`` 1.. in sorted path order."""
    lines = number_lists(read_lines(spark, shard_dir, glob=glob), "shard_idx")
    return parse_catalogue(lines, on_malformed, subset)


def existing_pair_ids(prior: DataFrame, distinct: bool = True, scope_cols: tuple = ()) -> DataFrame:
    """``pair_id`` values of prior pair JSONL lines (a ``value`` text column).

    Malformed JSON, non-object lines and empty or missing ids are ignored.
    """
    parsed = prior.select(*scope_cols, F.from_json("value", "pair_id string").getField("pair_id").alias("pair_id"))
    out = parsed.filter(F.col("pair_id").isNotNull() & (F.col("pair_id") != ""))
    return out.distinct() if distinct else out


def read_existing_pair_ids(spark: SparkSession, path, distinct: bool = True) -> DataFrame:
    return existing_pair_ids(spark.read.text(path), distinct)


def list_landed(spark: SparkSession, folder: str, ext: str = PACKAGE_EXT, recursive: bool = True) -> DataFrame:
    """Packages already on disk — a listing only, ``content`` is never read."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ext}")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(folder).select("path", "length", "modificationTime")
    return df.withColumn("file_name", basename("path"))
