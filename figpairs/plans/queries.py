"""Registered queries: one per operator, each with a DuckDB oracle.

Every query reads the driver tables through the proxy views in
:mod:`figpairs.plans.proxies` and runs the library's operator on the whole
table.  :mod:`figpairs.plans.oracles` holds the equivalent DuckDB SQL; column
names match exactly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from figpairs.functions.text import split_tabs
from figpairs.operators import fetch, figures, images, match, pairs, report, split
from figpairs.plans import sinks
from figpairs.plans.joins import ensure_parallelism
from figpairs.plans.pipeline import build_pairs
from figpairs.plans.proxies import proxy, table
from figpairs.session import checkpoint_dir, scratch_path
from figpairs.sources import archive, catalogue, ids, stream

# Parameters of the proxy runs (chosen for the proxy scale, fixed across rounds).
SUBSET = 100          # F1: the demo subset size
MAX_MB = 1            # F4/F5: size limit in MiB
SHARD = 100           # W3: lines per shard on the proxy catalogue
PAIR_SHARD = 10       # K4/U3: lines per shard where pairs are written

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"  # ASCII strip set for the oracle


# ---------------------------------------------------------------------------
# Shared building blocks (Spark)
# ---------------------------------------------------------------------------
def _spread(df: DataFrame) -> DataFrame:
    """Spread small source rows over the cluster before a Python-heavy stage.

    A small table scans as one split, which would put every archive or XML
    document in one task; the rows moved here are the fixture's source rows,
    never archive bytes, and only when the input is narrower than the cluster."""
    return ensure_parallelism(df, max(df.sparkSession.sparkContext.defaultParallelism, 1) * 2)


def _cat(spark, sf) -> DataFrame:
    return catalogue.parse_catalogue(proxy(spark, sf, "raw_list"), "skip")


def _usable(spark, sf) -> DataFrame:
    return pairs.usable_figures(proxy(spark, sf, "figures"))


def _matched(spark, sf, strict=False, how="inner") -> DataFrame:
    return match.match_images(_usable(spark, sf), proxy(spark, sf, "members"), strict=strict, how=how)


def _pair_rows(spark, sf) -> DataFrame:
    m = _matched(spark, sf)
    return pairs.to_pair_records(m, keep=("article_id", "fig_pos", "member_pos"))


def _xml_docs(spark, sf) -> DataFrame:
    """One article XML per conversation row; every text line becomes a figure.
    Every ninth document is cut short (a parse failure)."""
    c = _spread(table(spark, sf, "conversations"))
    esc = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    figs = F.transform(
        F.split(F.col("text"), "\n", -1),
        lambda line, i: F.concat(
            F.lit('<fig id="F'), F.col("turn").cast("string"), F.lit("-"), i.cast("string"), F.lit('"><label>Figure&nbsp;'),
            i.cast("string"), F.lit("</label><caption><title>T"), i.cast("string"), F.lit("</title><p>"), esc(line),
            F.lit('</p></caption><graphic xlink:href="g'), F.col("turn").cast("string"), F.lit("-"), i.cast("string"), F.lit('"/></fig>'),
        ),
    )
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta>'
              '<article-id pub-id-type="pmid">'), (F.col("conv_id") + 100000).cast("string"),
        F.lit('</article-id><article-id pub-id-type="pmc">'), F.col("conv_id").cast("string"), F.lit("</article-id></article-meta></front><body>"),
    )
    broken = ((F.col("conv_id") + F.col("turn")) % 9) == 4
    tail = F.when(broken, F.lit("<p>")).otherwise(F.lit("</body></article>"))
    xml = F.encode(F.concat(head, F.array_join(figs, ""), tail), "UTF-8")
    path = F.format_string("/data/PMC%d/PMC%d-%d.nxml", F.col("conv_id"), F.col("conv_id"), F.col("turn"))
    return c.select("conv_id", "turn", path.alias("path"), xml.alias("xml"))


def _parsed(spark, sf) -> DataFrame:
    return figures.extract_figures(_xml_docs(spark, sf))


def _dedupe_pairs(spark, sf) -> DataFrame:
    rows = _pair_rows(spark, sf).withColumn("line_no", F.col("article_id") + 1)
    return pairs.dedupe_first(rows, order=("line_no", "fig_pos")).drop("line_no")


def _split_pairs(spark, sf) -> DataFrame:
    """Pairs carrying their article's split (from the catalogue) — the run scope."""
    cat = split.assign_split(_cat(spark, sf)).select("pmcid", "split", "line_no")
    rows = _pair_rows(spark, sf).join(cat, "pmcid")
    return pairs.dedupe_first(rows, scope=("split",), order=("line_no", "fig_pos"))


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
def q_list_skip_malformed(spark, sf):
    return _cat(spark, sf)


def q_list_failfast_violations(spark, sf):
    return catalogue.catalogue_violations(proxy(spark, sf, "raw_list")).select("line_no", F.col("n_fields").cast("bigint").alias("n_fields"))


def q_list_at_least_five(spark, sf):
    return catalogue.parse_catalogue(proxy(spark, sf, "raw_list"), "at_least_five").select("line_no", "pmcid", "value")


def q_subset_limit(spark, sf):
    return catalogue.parse_catalogue(proxy(spark, sf, "raw_list"), "skip", subset=SUBSET)


def q_package_urls(spark, sf):
    return fetch.package_urls(_cat(spark, sf)).select("line_no", "rel_path", "primary_url", "fallback_url")


def _sized(spark, sf):
    return _cat(spark, sf).join(proxy(spark, sf, "package_sizes"), "pmcid", "left")


def q_size_guard(spark, sf):
    return fetch.size_guard(_sized(spark, sf), MAX_MB).select("line_no", "pmcid", "size")


def q_size_required(spark, sf):
    return fetch.size_required(_sized(spark, sf)).select("line_no", "pmcid", "size")


def q_pending_fetch(spark, sf):
    return fetch.pending_fetch(_cat(spark, sf), proxy(spark, sf, "landed")).select("line_no", "pmcid", "file_name")


def q_resolve_fallback(spark, sf):
    r = fetch.resolve_fallback(_cat(spark, sf), proxy(spark, sf, "primary_has"), proxy(spark, sf, "fallback_has"))
    return r.select("line_no", "rel_path", "resolved_url", "fetch_status")


def q_list_package_join(spark, sf):
    j = fetch.join_packages(_cat(spark, sf), proxy(spark, sf, "landed"))
    return j.select("line_no", "pmcid", "package_path")


def q_split_assign(spark, sf):
    return split.assign_split(_cat(spark, sf), keep_bucket=True).select("line_no", "pmcid", F.col("bucket").cast("bigint").alias("bucket"), "split")


def q_split_counts(spark, sf):
    return split.assign_split(_cat(spark, sf)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_split_is_partition(spark, sf):
    """The written split files hold the list's lines, each as often as the list does."""
    rows = split.assign_split(catalogue.parse_catalogue(proxy(spark, sf, "raw_list"), "at_least_five"))
    path = _roundtrip_dir(spark, "split-parts")
    sinks.write_lists(sinks.split_list_key(rows), path, "path\ttitle\tpmcid\tpmid\tcode", key="list")
    back = catalogue.data_lines(catalogue.read_lines(spark, path, glob="*.txt", recursive=True))
    both = rows.select("value", F.lit(1).alias("n")).unionByName(back.select("value", F.lit(-1).alias("n"))).groupBy("value").agg(F.sum("n").alias("n"))
    sums = both.agg(F.sum(F.greatest("n", F.lit(0))).alias("missing"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("extra"))
    return sums.select(F.explode(F.create_map(F.lit("missing"), "missing", F.lit("extra"), "extra")).alias("check", "n"))


def q_shard_assign(spark, sf):
    return split.assign_shard(proxy(spark, sf, "raw_list"), SHARD).select("line_no", F.col("shard_idx").cast("bigint").alias("shard_idx"))


def q_shard_sizes(spark, sf):
    s = split.assign_shard(proxy(spark, sf, "raw_list"), SHARD)
    return s.groupBy(F.col("shard_idx").cast("bigint").alias("shard_idx")).agg(F.count(F.lit(1)).alias("n_rows"))


def q_shard_scan_numbering(spark, sf):
    lines = split.assign_shard(proxy(spark, sf, "raw_list"), SHARD, prefix="train")
    lines = lines.withColumn("file_path", F.concat(F.lit("lists/"), F.col("shard_name"), F.lit(".txt")))
    n = catalogue.number_lists(lines, "list_no")
    return n.groupBy("file_path", F.col("list_no").cast("bigint").alias("list_no")).agg(F.count(F.lit(1)).alias("n_lines"))


def q_line_numbers(spark, sf):
    scan = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id")
    return catalogue.with_line_numbers(scan).select("doc_id", "line_no")


def _prior_lines(spark, sf):
    f = proxy(spark, sf, "figures").withColumn("pair_id", pairs.pair_id("pmid", "fig_id"))
    a = F.col("article_id") % 3
    value = (
        F.when(a == 0, F.to_json(F.struct("pair_id", F.col("fig_caption").alias("caption"))))
        .when((a == 1) & (F.col("fig_pos") == 0), F.concat(F.lit('{"pair_id": "'), F.col("pair_id")))
        .when((a == 2) & (F.col("fig_pos") == 0), F.lit('{"pair_id": ""}'))
        .when((a == 2) & (F.col("fig_pos") == 1), F.lit('{"image": "x.jpg"}'))
    )
    return f.select(value.alias("value")).filter(F.col("value").isNotNull())


def q_resume_existing_ids(spark, sf):
    return catalogue.existing_pair_ids(_prior_lines(spark, sf))


def q_resume_anti(spark, sf):
    u = _usable(spark, sf).withColumn("pair_id", pairs.pair_id("pmid", "fig_id"))
    existing = catalogue.existing_pair_ids(_prior_lines(spark, sf), distinct=False)
    return pairs.resume_anti(u, existing).select("article_id", "fig_pos", "pair_id")


def q_resume_indexed(spark, sf):
    """Prior output published in two rounds of batches, indexed after each; what is left of the new pairs."""
    u = _usable(spark, sf).withColumn("pair_id", pairs.pair_id("pmid", "fig_id"))
    prior = catalogue.existing_pair_ids(_prior_lines(spark, sf), distinct=False)
    prior = prior.withColumn("batch", F.concat(F.lit("run-"), F.pmod(F.xxhash64("pair_id"), F.lit(3)).cast("string")))
    out, index = _roundtrip_dir(spark, "indexed"), None
    for later in (False, True):
        prior.where((F.col("batch") == "run-2") == F.lit(later)).write.mode("append").partitionBy("batch").json(f"{out}/pairs")
        index = ids.sync_ids(spark, out, scope=(), buckets=8)
    return (u if index is None else pairs.resume_anti(u, index)).select("article_id", "fig_pos", "pair_id")


def q_allowlist_semi(spark, sf):
    train = split.assign_split(_cat(spark, sf)).filter(F.col("split") == "train")
    return pairs.filter_allowlist(proxy(spark, sf, "figures"), train, "pmcid").select("article_id", "fig_pos", "pmcid")


def q_usable_figures(spark, sf):
    return _usable(spark, sf).select("article_id", "fig_pos", "caption")


def q_article_ids(spark, sf):
    f = proxy(spark, sf, "figures")
    first = f.groupBy("article_id", "pmcid").agg(F.min_by("pmid", "fig_pos").alias("first_pmid"))
    cat = _cat(spark, sf).select("pmcid", F.col("pmid").alias("cat_pmid"))
    j = first.join(cat, "pmcid", "left")
    return j.select("article_id", "pmcid", pairs.article_id_expr(F.col("first_pmid"), F.col("cat_pmid")).alias("pmid"))


def q_pair_records(spark, sf):
    return _pair_rows(spark, sf).drop("member_pos")


def q_parse_figures(spark, sf):
    p = figures.flatten_figures(figures.parsed_ok(_parsed(spark, sf)))
    return p.select("conv_id", "turn", F.col("fig_pos").cast("bigint").alias("fig_pos"), "fig_id", "fig_label", "fig_caption", "graphic_ref", "pmid", "pmc")


def q_parse_error_report(spark, sf):
    p = _parsed(spark, sf).filter(F.col("parse_error").isNotNull())
    return p.groupBy(F.regexp_extract("parse_error", r"^[a-z_]+", 0).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def q_articles_seen(spark, sf):
    return report.articles_seen(_parsed(spark, sf))


def q_article_records(spark, sf):
    art = figures.to_articles(figures.parsed_ok(_parsed(spark, sf)))
    return art.select("pmid", "pmc", "location", F.size("figures").cast("bigint").alias("n_figures"), F.posexplode("figures").alias("fig_idx", "fig")).select(
        "pmid", "pmc", "location", "n_figures", F.col("fig_idx").cast("bigint").alias("fig_idx"), "fig.fig_caption", "fig.fig_id", "fig.fig_label", "fig.graphic_ref", "fig.pair_id"
    )


def _landed_files(spark, sf, name="package_rows", where="true", root=None) -> str:
    """Packages of a proxy, written as ``.tar.gz`` files; the folder."""
    root = root or _roundtrip_dir(spark, "landing")
    rows = _spread(proxy(spark, sf, name).where(where))
    cut = "corrupt" if "corrupt" in rows.columns else "false"
    packed = archive.pack_rows(rows.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), F.expr(cut).alias("corrupt"), "names", "contents"))
    packed = packed.withColumn("content", F.when(F.col("corrupt"), F.substring("content", 1, 20)).otherwise(F.col("content")))
    archive.land_files(packed, root).count()
    return root


def _package_list(spark, sf) -> DataFrame:
    return split.assign_split(proxy(spark, sf, "package_rows").select("line_no", "pmcid", "pmid"))


def q_lazy_bytes(spark, sf):
    """Bytes of the images that the index names, read from the archives as streams."""
    idx = stream.stream_parse(stream.balanced(stream.list_packages(spark, _landed_files(spark, sf))))
    wanted = idx.select("path", F.inline("members")).where("fmt is not null").select("path", F.col("pos").alias("member_pos"))
    return archive.read_members(wanted).select(fetch.package_key("path").alias("pmcid"), F.col("member_pos").cast("bigint").alias("member_pos"),
                                               F.length("content").cast("bigint").alias("n_bytes"), F.md5("content").alias("md5"))


def q_build_decoded(spark, sf):
    """Images are decoded before their pairs are written; an id whose first image is cut takes its next one."""
    from figpairs.plans.pipeline import write_build
    from figpairs.plans.publish import verify_images

    out = _roundtrip_dir(spark, "decoded")
    b = build_pairs(_package_list(spark, sf), stream.list_packages(spark, _landed_files(spark, sf, "package_images")))
    write_build(verify_images(b, out + "/staging"), out)
    image = spark.read.parquet(f"{out}/images").select("split", "pair_id", F.length("content").cast("bigint").alias("n_bytes"))
    return spark.read.json(f"{out}/pairs").join(image, ["split", "pair_id"]).select("image", "caption", "pmid", "pmcid", "pair_id", "split", "n_bytes")


def q_stream_landings(spark, sf):
    """Two landings, later articles first, in small batches; what is published is what one run over all gives."""
    from figpairs.streaming.incremental import start_incremental

    out = _roundtrip_dir(spark, "stream")
    for part in ("turn >= 3", "turn < 3"):
        _landed_files(spark, sf, where=part, root=out + "/landing")
        start_incremental(spark, out + "/landing", _package_list(spark, sf), out, out + "/checkpoint", max_files_per_trigger=1000).awaitTermination()
    return spark.read.json(f"{out}/pairs").select("image", "caption", "pmid", "pmcid", "pair_id", "split")


def q_first_xml_unpacked(spark, sf):
    """X4 through the unpack: of two articles in a package the first in archive order is parsed."""
    idx = stream.stream_parse(stream.balanced(stream.list_packages(spark, _landed_files(spark, sf, "two_articles"))))
    return idx.select(fetch.package_key("path").alias("pmcid"), F.size("figures").cast("bigint").alias("n_figures"), F.col("figures")[0]["fig_id"].alias("fig_id"),
                      F.size(F.filter("members", lambda m: F.lower(m["name"]).endswith(".nxml"))).cast("bigint").alias("n_articles"))


def q_inline_refs_guard(spark, sf):
    """articles with inline references, on which the strict mode aborts."""
    c = table(spark, sf, "conversations")
    ref = F.struct(F.col("text").alias("text"), F.lit(None).cast("string").alias("section"), F.col("role").alias("reference_id"))
    fig = F.struct(F.col("turn").alias("fig_pos"), F.when(F.col("turn") % 4 == 3, F.array_repeat(ref, 2)).alias("fig_refs"))
    articles = c.groupBy("conv_id").agg(F.collect_list(fig).alias("figures"))
    lenient = figures.normalise_inline_refs(articles).select("conv_id", F.size("figures").cast("bigint").alias("n_figures"))
    return figures.inline_ref_violations(articles).select("conv_id", F.col("n_refs").cast("bigint").alias("n_refs")).join(lenient, "conv_id")


def q_first_xml(spark, sf):
    m = proxy(spark, sf, "members").filter(F.lower("name").endswith(".nxml"))
    first = m.groupBy("article_id").agg(F.min_by(F.struct("pos", "name"), "pos").alias("x"))
    return first.select("article_id", F.col("x.pos").alias("xml_pos"), F.col("x.name").alias("xml_name"))


def q_member_filter(spark, sf):
    from figpairs.functions.text import is_image_name

    return proxy(spark, sf, "members").filter(is_image_name("name")).select("article_id", "pos", "name")


def q_image_map(spark, sf):
    return match.image_map(proxy(spark, sf, "members")).select("article_id", "key", "first_pos", "member_pos")


def q_ref_basename_stem(spark, sf):
    f = match.with_ref_parts(proxy(spark, sf, "figures").filter(F.col("graphic_ref").isNotNull()))
    return f.select("article_id", "fig_pos", "ref_base", "ref_stem")


def q_candidate_names(spark, sf):
    f = match.with_ref_parts(proxy(spark, sf, "figures").filter(F.col("graphic_ref").isNotNull()))
    return f.select("article_id", "fig_pos", F.posexplode("candidates").alias("rank", "candidate")).select(
        "article_id", "fig_pos", F.col("rank").cast("bigint").alias("rank"), "candidate"
    )


def q_match_exact(spark, sf):
    return _matched(spark, sf, strict=True).select("article_id", "fig_pos", "member_key", "member_pos")


def q_match_loose(spark, sf):
    return _matched(spark, sf).filter(F.col("match_kind") == "loose").select("article_id", "fig_pos", "member_key", "member_pos")


def q_match_all(spark, sf):
    return _matched(spark, sf).select("article_id", "fig_pos", "member_key", "member_pos", "match_kind")


def q_match_join_form(spark, sf):
    """The in-row form over one row per article, which equals the join form of ``match_all``."""
    members = proxy(spark, sf, "members").groupBy("article_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "name", F.lit(True).alias("isfile")))).alias("members"))
    figs = _usable(spark, sf).groupBy("article_id").agg(F.collect_list(F.struct("fig_pos", "graphic_ref")).alias("figures"))
    rows = match.match_packages(figs.join(members, "article_id")).select("article_id", F.inline("figures"))
    return rows.filter(F.col("member_pos").isNotNull()).select("article_id", "fig_pos", "member_pos")


def q_unmatched_figures(spark, sf):
    m = _matched(spark, sf, how="left")
    return m.filter(F.col("member_pos").isNull()).select("article_id", "fig_pos")


def q_dedupe_first(spark, sf):
    return _dedupe_pairs(spark, sf).select("pair_id", "article_id", "fig_pos", "image", "caption")


def q_dedupe_first_lineitem(spark, sf):
    li = ensure_parallelism(table(spark, sf, "lineitem")).withColumn("pair_id", F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")
    d = pairs.dedupe_first(li.select("l_returnflag", "pair_id", *order), scope=("l_returnflag",), order=order)
    return d.select("l_returnflag", "pair_id", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def q_pair_id_collisions(spark, sf):
    return pairs.pair_id_collisions(_pair_rows(spark, sf), "pmcid")


def _entries(spark, sf):
    """Per catalogue entry: split, size, landed, usable figures and pairs written."""
    cat = split.assign_split(_cat(spark, sf))
    sizes = proxy(spark, sf, "package_sizes")
    landed = proxy(spark, sf, "landed").select(fetch.package_key("path").alias("pmcid"))
    # what is known of an article, in one aggregation and one join
    facts = None
    for rows, own in ((sizes, "size"), (landed, "landed"), (_usable(spark, sf), "n_usable"), (_split_pairs(spark, sf), "n_pairs")):
        one = rows.select("pmcid", *((F.col("size") if c == own == "size" else F.lit(1 if c == own else None)).cast("long").alias(c)
                                     for c in ("size", "landed", "n_usable", "n_pairs")))
        facts = one if facts is None else facts.unionByName(one)
    facts = facts.groupBy("pmcid").agg(F.max("size").alias("size"), F.max("landed").alias("landed"), F.sum("n_usable").alias("n_usable"), F.sum("n_pairs").alias("n_pairs"))
    e = cat.join(facts, "pmcid", "left")
    reason = report.skip_reason(
        too_large=fetch.too_large("size", MAX_MB),
        fetch_failed=F.col("landed").isNull(),
        no_figures=F.col("n_usable").isNull(),
        n_pairs=F.col("n_pairs"),
    )
    return e.withColumn("reason", reason)


def q_skip_reasons(spark, sf):
    return report.skip_counts(_entries(spark, sf))


def q_run_summary(spark, sf):
    e = _entries(spark, sf).withColumn("n_pairs", F.when(F.col("reason") == "ok", F.col("n_pairs")).otherwise(F.lit(0)))
    return report.run_summary(e, scope=("split",))


def q_shard_status(spark, sf):
    s = split.assign_shard(proxy(spark, sf, "raw_list"), SHARD)
    bad = F.size(split_tabs(F.regexp_replace("value", r"^[\t\n\x0b\x0c\r ]+|[\t\n\x0b\x0c\r ]+$", ""))) != 5
    st = s.groupBy("shard_idx").agg((F.count_if(bad) == 0).alias("ok"))
    return report.shard_status(st)


def q_line_count(spark, sf):
    return report.line_count(proxy(spark, sf, "raw_list"))


def q_append_resume_on(spark, sf):
    rows = _pair_rows(spark, sf).withColumn("line_no", F.col("article_id") + 1)
    prior = rows.filter(F.col("article_id") % 3 == 0)
    new = pairs.build_pair_rows(rows, existing=prior, resume=True)
    return pairs.append_prior(prior, new).select("pair_id", "article_id", "fig_pos")


def q_append_resume_off(spark, sf):
    rows = _pair_rows(spark, sf).withColumn("line_no", F.col("article_id") + 1)
    prior = rows.filter(F.col("article_id") % 3 == 0)
    new = pairs.build_pair_rows(rows, existing=prior, resume=False)
    return pairs.append_prior(prior, new).select("pair_id", "article_id", "fig_pos")


def _content(spark, sf):
    return _spread(proxy(spark, sf, "members_content"))


def q_image_sniff(spark, sf):
    return _content(spark, sf).select("article_id", "pos", images.sniff_expr("content").alias("format"))


def q_image_manifest(spark, sf):
    p = _pair_rows(spark, sf)
    c = _content(spark, sf).select("article_id", F.col("pos").alias("member_pos"), F.col("name").alias("member_name"), "content")
    return images.image_manifest(p.join(c, ["article_id", "member_pos"]), keep=("article_id", "fig_pos"))


def _packed(spark, sf):
    return archive.pack_each(_content(spark, sf), "name", "content")


def q_unpack_packages(spark, sf):
    src = _content(spark, sf).select(F.format_string("%d-%d-%s.tar.gz", "article_id", "pos", F.md5("content")).alias("file"), "name", "content")
    root = _roundtrip_dir(spark, "unpack")
    archive.land_files(archive.pack_each(src, "name", "content").select("file", "package"), root, "file", "package").count()
    u = stream.stream_members(stream.balanced(stream.list_packages(spark, root)))
    part = [F.regexp_extract("path", r"([0-9]+)-([0-9]+)-([0-9a-f]+)[.]tar[.]gz$", k) for k in (1, 2, 3)]
    return u.select(part[0].cast("bigint").alias("article_id"), part[1].cast("bigint").alias("src_pos"), F.col("pos").cast("bigint").alias("member_pos"), "name",
                    F.length("content").cast("bigint").alias("n_bytes"), (F.md5("content") == part[2]).alias("same_bytes"))


def q_bad_archive_report(spark, sf):
    p = _packed(spark, sf)
    corrupt = ((F.col("article_id") + F.col("pos")) % 6) == 5
    p = p.withColumn("package", F.when(corrupt, F.substring("package", 1, 20)).otherwise(F.col("package")))
    idx = archive.unpack_index(p.select("article_id", "pos", F.col("package").alias("content")))
    return idx.groupBy(F.coalesce("error", F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def _roundtrip_dir(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_pairs_json_roundtrip(spark, sf):
    d = _dedupe_pairs(spark, sf).withColumn("split", F.lit("all"))
    path = _roundtrip_dir(spark, "pairs")
    sinks.write_pairs(d, path, scope=("split",), mode="overwrite")
    return spark.read.json(path).select("image", "caption", "pmid", "pmcid", "pair_id")


def q_pairs_by_split(spark, sf):
    d = _split_pairs(spark, sf)
    path = _roundtrip_dir(spark, "pairs-by-split")
    sinks.write_pairs(d, path, scope=("split",), mode="overwrite")
    back = spark.read.json(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_pairs_by_shard(spark, sf):
    cat = split.assign_shard(_cat(spark, sf), PAIR_SHARD).select("pmcid", "shard_idx")
    d = pairs.dedupe_first(_pair_rows(spark, sf).withColumn("line_no", F.col("article_id") + 1).join(cat, "pmcid"), scope=("shard_idx",))
    path = _roundtrip_dir(spark, "pairs-by-shard")
    sinks.write_pairs(d, path, scope=("shard_idx",), mode="overwrite")
    back = spark.read.json(path)
    return back.groupBy(F.col("shard_idx").cast("bigint").alias("shard_idx")).agg(F.count(F.lit(1)).alias("n"))


def q_articles_json_roundtrip(spark, sf):
    art = figures.to_articles(figures.parsed_ok(_parsed(spark, sf)))
    path = _roundtrip_dir(spark, "articles")
    sinks.write_articles(art, path)
    from figpairs.schemas import ARTICLE

    back = spark.read.schema(ARTICLE).json(path)
    return back.select("pmid", "pmc", "location", F.size("figures").cast("bigint").alias("n_figures"))


def q_split_files(spark, sf):
    cat = split.assign_split(catalogue.parse_catalogue(proxy(spark, sf, "raw_list"), "at_least_five"))
    cat = sinks.split_list_key(cat)
    path = _roundtrip_dir(spark, "split-lists")
    sinks.write_lists(cat, path, "path\ttitle\tpmcid\tpmid\tcode", key="list")
    back = spark.read.text(path)
    return back.groupBy("list").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("value").startswith("path\t")).alias("n_headers"))


def q_shard_files(spark, sf):
    s = split.assign_shard(proxy(spark, sf, "raw_list"), SHARD, prefix="train")
    path = _roundtrip_dir(spark, "shard-lists")
    head = "path\ttitle\tpmcid\tpmid\tcode"
    sinks.write_lists(s, path, head, key="shard_name")
    back = catalogue.read_lines(spark, path, glob="*.txt", recursive=True)
    name = F.regexp_extract("file_path", r"shard_name=([^/]+)/", 1).alias("shard_name")
    return back.groupBy(name).agg(F.count(F.lit(1)).alias("n_lines"), F.count_if((F.col("line_no") == 0) & (F.col("value") == head)).alias("n_headers"))


def q_catalogue_file_scan(spark, sf):
    """The catalogue cut into list files, read back and numbered per file."""
    s = split.assign_shard(proxy(spark, sf, "raw_list"), SHARD, prefix="train")
    path = _roundtrip_dir(spark, "file-scan")
    sinks.write_lists(s, path, "path\ttitle\tpmcid\tpmid\tcode", key="shard_name")
    back = catalogue.data_lines(catalogue.read_lines(spark, path, glob="*.txt", recursive=True))
    return back.select(F.regexp_extract("file_path", r"shard_name=([^/]+)/", 1).alias("shard_name"), F.col("line_no").cast("bigint").alias("line_no"), "value")


def q_split_order(spark, sf):
    """Written split lists keep input order — out-of-order neighbours per list file."""
    cat = sinks.split_list_key(split.assign_split(catalogue.parse_catalogue(proxy(spark, sf, "raw_list"), "at_least_five")))
    path = _roundtrip_dir(spark, "split-order")
    sinks.write_lists(cat.withColumn("value", F.concat_ws("\t", F.col("line_no").cast("string"), "value")), path, "H", key="list")
    back = catalogue.read_lines(spark, path, glob="*.txt", recursive=True).filter(F.col("line_no") > 0)
    back = back.withColumn("src", F.split("value", "\t").getItem(0).cast("bigint"))
    w = Window.partitionBy("file_path").orderBy("line_no")
    back = back.withColumn("prev", F.lag("src").over(w))
    name = F.regexp_extract("file_path", r"list=([^/]+)/", 1).alias("list")
    return back.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prev") >= F.col("src")).alias("n_out_of_order"))


def q_shard_union(spark, sf):
    """The shard outputs read back together are the train pair set."""
    cat = split.assign_shard(_cat(spark, sf), PAIR_SHARD).select("pmcid", "shard_idx")
    d = pairs.dedupe_first(_pair_rows(spark, sf).withColumn("line_no", F.col("article_id") + 1).join(cat, "pmcid"), scope=("shard_idx",))
    path = _roundtrip_dir(spark, "shard-union")
    sinks.write_pairs(d, path, scope=("shard_idx",), mode="overwrite")
    return spark.read.json(path).select("pair_id", "image", "caption", F.col("shard_idx").cast("bigint").alias("shard_idx"))


def q_packed_shards(spark, sf):
    """K7: train pairs packed into tar shards of ``SHARD`` samples, in (line, figure) order."""
    d = _split_pairs(spark, sf).filter(F.col("split") == "train")
    c = _content(spark, sf).select("article_id", F.col("pos").alias("member_pos"), "content")
    d = catalogue.with_ordinal(d.join(c, ["article_id", "member_pos"]), ["line_no", "fig_pos"])
    d = d.withColumn("shard_idx", F.expr(f"ordinal div {SHARD}"))
    out = _roundtrip_dir(spark, "packed")
    sinks.pack_shards(d, out, "train")
    m = sinks.packed_members(spark, out)
    record = F.col("name").endswith(".json")
    return m.select("shard", "name", F.when(~record, F.col("n_bytes")).alias("n_bytes"), F.when(~record, F.col("md5")).alias("md5"))


def _landed_packages(spark, sf) -> DataFrame:
    """Real ``.tar.gz`` packages, one per conversation row, written once to the
    checkpoint folder (the fixture's "landing" area)."""
    checkpoint_dir(spark)
    rows = _spread(proxy(spark, sf, "package_rows"))
    packed = archive.pack_rows(rows.select("path", "corrupt", "names", "contents"))
    packed = packed.withColumn("content", F.when(F.col("corrupt"), F.substring("content", 1, 20)).otherwise(F.col("content")))
    return packed.select("path", F.length("content").cast("long").alias("length"), "content").checkpoint(eager=True)


def q_landed_listing(spark, sf):
    """S10 + J3: land every third-but-one package as a file, list the folder without
    reading content, and plan what is still pending."""
    root = _roundtrip_dir(spark, "landing")
    rows = proxy(spark, sf, "package_rows").filter(((F.col("conv_id") + F.col("turn")) % 3) != 1)
    packed = archive.pack_rows(rows.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "names", "contents"))
    archive.land_files(packed, root).count()
    landed = catalogue.list_landed(spark, root)
    cat = proxy(spark, sf, "package_rows").select("line_no", "pmcid")
    pending = fetch.pending_fetch(cat, landed).select("pmcid", F.lit("pending").alias("state"))
    have = landed.select(fetch.package_key("path").alias("pmcid"), F.lit("landed").alias("state"))
    return have.unionByName(pending)


def q_xml_scan(spark, sf):
    """Article XML files landed in a folder tree, found by a recursive
    ``*.nxml`` scan and parsed (X1-X3)."""
    root = _roundtrip_dir(spark, "xml-tree")
    docs = _xml_docs(spark, sf).select(F.format_string("PMC%d/PMC%d-%d.nxml", "conv_id", "conv_id", "turn").alias("name"), F.col("xml").alias("content"))
    archive.land_files(docs, root).count()
    parsed = figures.extract_figures(archive.scan_xml(spark, root))
    ids = r"PMC(\d+)-(\d+)\.nxml$"
    return parsed.select(
        F.regexp_extract("path", ids, 1).cast("bigint").alias("conv_id"),
        F.regexp_extract("path", ids, 2).cast("bigint").alias("turn"),
        F.col("parse_error").isNull().alias("parsed"),
        F.size("figures").cast("bigint").alias("n_figures"),
    )


def _png_batches(out_schema):
    import struct
    import zlib

    import pyarrow as pa

    def png(w: int, h: int, shade: int) -> bytes:
        def chunk(t, d):
            return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)

        raw = b"".join(b"\x00" + bytes([shade, 255 - shade, 0]) * w for _ in range(h))
        return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))

    def fn(batches):
        for b in batches:
            d = b.to_pydict()
            out = []
            for w, h, shade, cut in zip(d["w"], d["h"], d["shade"], d["cut"]):
                data = png(w, h, shade)
                out.append(data[: len(data) // 2] if cut else data)
            yield pa.RecordBatch.from_arrays([b.column("name"), pa.array(out, type=pa.binary())], schema=out_schema)

    return fn


def q_image_valid(spark, sf):
    """I1 on landed files: small PNGs per conversation row (every seventh cut in
    half) decoded by Spark's image source; undecodable files are dropped."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    root = _roundtrip_dir(spark, "images")
    c = _spread(table(spark, sf, "conversations")).select(
        F.format_string("PMC%d/g%d.png", "conv_id", "turn").alias("name"),
        (F.col("turn") + 1).cast("int").alias("w"), (F.col("conv_id") % 5 + 1).cast("int").alias("h"),
        (F.length("text") % 256).cast("int").alias("shade"), (((F.col("conv_id") + F.col("turn")) % 7) == 3).alias("cut"))
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())])
    files = c.mapInArrow(_png_batches(to_arrow_schema(schema)), schema)
    archive.land_files(files, root).count()
    imgs = images.read_images(spark, root, glob="*.png")
    ids = r"PMC(\d+)/g(\d+)\.png$"
    return imgs.select(
        F.regexp_extract("origin", ids, 1).cast("bigint").alias("conv_id"),
        F.regexp_extract("origin", ids, 2).cast("bigint").alias("turn"),
        F.col("width").cast("bigint").alias("width"), F.col("height").cast("bigint").alias("height"),
    )


def _package_build(spark, sf):
    cat = split.assign_split(proxy(spark, sf, "package_rows").select("line_no", "pmcid", "pmid"))
    return build_pairs(cat, _landed_packages(spark, sf))


def q_build_from_packages(spark, sf):
    """End to end over real archives: unpack → parse XML → in-row match →
    decodable → first-success dedupe per split → pair records."""
    return _package_build(spark, sf).pairs.select("image", "caption", "pmid", "pmcid", "pair_id", "split")


def q_build_from_packages_skips(spark, sf):
    return report.skip_counts(_package_build(spark, sf).entries)


def q_written_report(spark, sf):
    """G1/G2 of a build as written: entries per list and reason, read back, and over all lists (``*``) as observed during the write."""
    from figpairs.plans.pipeline import write_build

    packages = _landed_packages(spark, sf)
    cat = split.assign_split(proxy(spark, sf, "package_rows").select("line_no", "pmcid", "pmid"))
    # every seventeenth line names a package that has not landed
    cat = cat.withColumn("pmcid", F.when(F.col("line_no") % 17 == 3, F.concat("pmcid", F.lit("-x"))).otherwise(F.col("pmcid")))
    done = write_build(build_pairs(cat, packages), _roundtrip_dir(spark, "reported"), packages=packages, entries=True)
    lists = done.entries.groupBy("split", "reason").agg(F.count("*").alias("n"), F.sum("n_pairs").cast("bigint").alias("n_pairs"))
    rows = [("*", k, n, done.counts["pairs"] if k == "ok" else 0) for k, n in done.counts.items() if n and k not in ("entries", "pairs")]
    return lists.unionByName(spark.createDataFrame(rows, "split string, reason string, n bigint, n_pairs bigint"))


def q_resume_after_partial_write(spark, sf):
    """A first run publishes half the packages, a second resumes from what was written; the pairs are read back."""
    from figpairs.plans.pipeline import write_build
    from figpairs.streaming.incremental import existing_pairs

    cat = split.assign_split(proxy(spark, sf, "package_rows").select("line_no", "pmcid", "pmid"))
    packages = _landed_packages(spark, sf)
    out = _roundtrip_dir(spark, "resumed")
    half = packages.filter(F.pmod(F.xxhash64("path"), F.lit(2)) == 0)
    write_build(build_pairs(cat, half), out, packages=half)
    write_build(build_pairs(cat, packages, existing=existing_pairs(spark, out)), out, packages=packages)
    return spark.read.json(f"{out}/pairs").select("split", "pair_id")


def q_build_from_shard_lists(spark, sf):
    """The package lines as list files of ``SHARD`` lines, numbered from 1 in each; counts per list."""
    from figpairs.plans.pipeline import build_pairs as build

    line = F.col("line_no") - 1
    rows = proxy(spark, sf, "package_rows").select("line_no", "pmcid", "pmid")
    cat = rows.select(F.expr(f"(line_no - 1) div {SHARD * 100}").cast("int").alias("shard_idx"), F.format_string("lists/%09d.txt", F.expr(f"(line_no - 1) div {SHARD * 100}")).alias("file_path"),
                      (line % (SHARD * 100) + 1).alias("line_no"), "pmcid", "pmid")
    b = build(cat, _landed_packages(spark, sf), scope=("shard_idx",))
    return report.run_summary(b.entries, scope=("shard_idx",)).select(F.col("shard_idx").cast("bigint").alias("shard_idx"), "n_written", "n_skipped", "n_entries")


def q_shard_report(spark, sf):
    """Status, list path and message of every shard of a build in which some packages are damaged."""
    line = F.col("line_no") - 1
    rows = proxy(spark, sf, "package_rows").select("line_no", "pmcid", "pmid")
    cat = rows.select(F.expr("(line_no - 1) div 1000").cast("int").alias("shard_idx"), F.format_string("lists/%09d.txt", F.expr("(line_no - 1) div 1000")).alias("file_path"),
                      (line % 1000 + 1).alias("line_no"), "pmcid", "pmid")
    b = build_pairs(cat, stream.list_packages(spark, _landed_files(spark, sf)), scope=("shard_idx",))
    st = report.shard_status_rows(b.entries, path_col="file_path")
    return st.select(F.col("shard_idx").cast("bigint").alias("shard_idx"), "shard_path", "ok", "msg")


def q_build_pairs(spark, sf):
    """Flagship: catalogue → split → figures → usable → match → resume → first-success dedupe → pair records."""
    cat = split.assign_split(_cat(spark, sf)).select("pmcid", "split", "line_no")
    checkpoint_dir(spark)
    # The matched rows feed both the prior-output fixture and the build: write
    # them once to the shared checkpoint folder instead of matching twice.
    rows = _pair_rows(spark, sf).join(cat, "pmcid").checkpoint(eager=True)
    prior = rows.filter(F.col("article_id") % 3 == 0).select("split", "pair_id")
    out = pairs.build_pair_rows(rows, existing=prior, scope=("split",), resume=True)
    return out.select("image", "caption", "pmid", "pmcid", "pair_id", "split")


QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
