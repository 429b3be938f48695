"""URL filters: a sort-merge range join of urls and nested prefix rules.

Host labels are reversed, each followed by a dot, so that a host and all its
subdomains share a prefix: ``m.example.net`` becomes ``net.example.m.``.  A
rule's key is its reversed host and its path; the urls it fits are then the
keys of one interval ``[key, key + highest character)``.  A url asks at each
of its host suffixes (``net.``, ``net.example.``, ``net.example.m.``, each
with the url's path), because a rule on a host may name a path on all
subdomains.

Prefix intervals either nest or are disjoint.  So the rules around any point
of the sorted key line are a stack: those of the last rule that began at or
before the point, which are that rule and the rules it is nested in.  Each
rule carries its stack; a sweep over rules and questions in key order hands
the last rule's stack to each question, and of that stack those rules remain
whose interval holds the question.

Questions are dealt out by ranges of (key, hash of the url), so that neither
a hot host nor a hot suffix makes a large range, and each range starts with
the stack that holds at its lower bound.  Only built-in DataFrame functions
are used.

Defined results:
* a url that is null or has no ``://``: host and path empty; no rule fits;
* an empty rule list: every url gets the default verdict;
* repeated pages are judged alike, each keeping its row; a null page id stays;
* rules with equal host and path: a block wins over an allow; a rule without
  a host, or whose path does not begin with ``/``, fits nothing;
* the longest rule (host and path) wins, of equally long ones the longer host;
* other columns of the pages do not take part and are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from figpairs.llm.common import ascii_lower, stored


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _rules(rules: DataFrame) -> DataFrame:
    """key, host, path, verdict, and the stack: this rule and those around it, innermost first."""
    r = rules.select(
        ascii_lower(F.coalesce(F.col("host"), F.lit(""))).alias("host"),
        F.coalesce(F.col("path"), F.lit("")).alias("path"),
        F.col("verdict"),
    ).where((F.col("host") != "") & ((F.col("path") == "") | F.startswith(F.col("path"), F.lit("/"))))
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" > "allow"
    r = r.withColumn("key", F.concat(reversed_host(F.col("host")), F.col("path")))
    frame = F.struct(
        (F.length("host") + F.length("path")).alias("n"), F.length("host").alias("hn"),
        F.col("key"), F.concat("host", "path").alias("rule"), "verdict",
    ).alias("frame")
    # The rules around a rule have its key's proper prefixes as keys.
    prefixes = r.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        "key", F.expr("substring(key, 1, n)").alias("around"))
    around = r.select(F.col("key").alias("around"), frame)
    return prefixes.join(around, "around").groupBy("key").agg(
        F.sort_array(F.collect_list("frame"), asc=False).alias("stack"))


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id",
                 default: str = "allow", ranges: int | None = None) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule (null if none fits) and verdict.

    ``rules`` has host, path and verdict ('allow' or 'block').  ``ranges``:
    how many key ranges the sweep is dealt out to (default: the session's
    shuffle partitions).
    """
    spark = pages.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = pages.select(F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__url"))
    host, path = split_url(F.col("__url"))
    p = p.select("__id", host.alias("__host"), path.alias("__path"))

    urls = p.select("__host", "__path").where(F.col("__host") != "").distinct()
    labels = F.reverse(F.split("__host", r"\."))
    asked = urls.select(
        "__host", "__path",
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                              lambda k: F.concat(F.array_join(F.slice(labels, F.lit(1), k), "."), F.lit("."), F.col("__path")))
                  ).alias("key"))
    dealt = asked.repartitionByRange(n, F.col("key"), F.xxhash64("__host", "__path"))
    dealt = stored(dealt.withColumn("range", F.spark_partition_id()), "url-ranges")

    # One row per range (as many as there are partitions), in key order.
    bounds = dealt.groupBy("range").agg(F.min("key").alias("low"))
    lows = bounds.agg(F.lit(1).alias("one"), F.sort_array(F.collect_list(F.struct("low", "range"))).alias("lows"))
    # one row, an entry per range, goes to all rules
    placed = _rules(rules).withColumn("one", F.lit(1)).join(F.broadcast(lows), "one").select(
        "key", "stack",
        # the last range that begins before the rule; a rule before all of them goes to the first
        F.greatest(F.expr("size(filter(lows, x -> x.low < key))"), F.lit(1)).alias("place"), "lows")
    placed = placed.where(F.size("lows") > 0).select("key", "stack", F.expr("get(lows, place - 1).range").alias("range"), "place")
    # What a range starts with: the last rule of the ranges before it.
    order = Window.orderBy("low", "range")
    heads = (bounds.withColumn("place", F.row_number().over(order))
             .join(placed.groupBy(F.col("place")).agg(F.max(F.struct("key", "stack")).alias("last")), "place", "left")
             .withColumn("stack", F.last("last", ignorenulls=True).over(
                 Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))["stack"])
             .where("stack is not null"))
    none = F.lit(None).cast("string")
    events = (heads.select("range", F.lit("").alias("key"), F.lit(0).alias("kind"), "stack", none.alias("__host"), none.alias("__path"))
              .unionByName(placed.select("range", "key", F.lit(1).alias("kind"), "stack", none.alias("__host"), none.alias("__path")))
              .unionByName(dealt.select("range", "key", F.lit(2).alias("kind"), F.expr("cast(null as array<struct<n:int,hn:int,key:string,rule:string,verdict:string>>)").alias("stack"),
                                        "__host", "__path")))
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fit = (events.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 2")
           .withColumn("fit", F.expr("get(filter(stack, s -> startswith(key, s.key)), 0)"))
           .where("fit is not null")
           .groupBy("__host", "__path").agg(F.max("fit").alias("fit")))
    return p.join(fit, ["__host", "__path"], "left").select(
        F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), F.lit(default)).alias("verdict"))
