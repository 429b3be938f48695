"""Catalogue scan, line numbers, split and shard rules."""

import os

import pytest
from pyspark.sql import functions as F

from figpairs.operators import split
from figpairs.plans import sinks
from figpairs.sources import catalogue
from tests import model


def write(path, text, mode="w"):
    with open(path, mode, newline="") as f:
        f.write(text)
    return path


def test_line_numbers_across_many_splits(spark, tmpdir_fresh):
    # ~25k lines cut into many file splits; numbering must equal file order.
    p = os.path.join(tmpdir_fresh, "big.txt")
    write(p, "".join(f"row{i}\n" for i in range(25_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = catalogue.read_lines(spark, p)
        assert df.rdd.getNumPartitions() > 5
        rows = df.select("line_no", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.line_no, r.value) for r in rows) == [(i, f"row{i}") for i in range(25_000)]


def test_line_numbers_per_file(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "lists")
    os.makedirs(d)
    write(os.path.join(d, "a.txt"), "h\nx\ny\n")
    write(os.path.join(d, "b.txt"), "h\r\nz\r\n\r\nlast-no-newline")
    got = sorted((os.path.basename(r.file_path), r.line_no, r.value) for r in catalogue.read_lines(spark, d, glob="*.txt").collect())
    assert got == [("a.txt", 0, "h"), ("a.txt", 1, "x"), ("a.txt", 2, "y"),
                   ("b.txt", 0, "h"), ("b.txt", 1, "z"), ("b.txt", 2, ""), ("b.txt", 3, "last-no-newline")]


def test_catalogue_modes(spark, tmpdir_fresh):
    p = write(os.path.join(tmpdir_fresh, "l.txt"),
              "path\ttitle\tpmcid\tpmid\tcode\n"
              "a\tb\tPMC1\t1\tc\n"        # good
              "a\tb\tPMC2\t2\n"           # 4 fields
              "a\tb\tPMC3\t3\tc\td\n"     # 6 fields
              "a\tb\tPMC4\t4\t\n"         # empty trailing field: 5 in skip mode, 4 after strip
              "\n")                       # blank
    lines = catalogue.read_lines(spark, p)
    skip = [r.pmcid for r in catalogue.parse_catalogue(lines, "skip").orderBy("line_no").collect()]
    assert skip == ["PMC1", "PMC4"]
    five = [r.pmcid for r in catalogue.parse_catalogue(lines, "at_least_five").orderBy("line_no").collect()]
    assert five == ["PMC1", "PMC3", "PMC4"]
    viol = [(r.line_no, r.n_fields) for r in catalogue.catalogue_violations(lines).orderBy("line_no").collect()]
    assert viol == [(2, 4), (3, 6), (4, 4), (5, 1)]
    with pytest.raises(Exception):
        catalogue.parse_catalogue(lines, "fail").collect()
    # subset counts raw lines, malformed ones included
    sub = [r.pmcid for r in catalogue.parse_catalogue(lines, "skip", subset=3).collect()]
    assert sub == ["PMC1"]


def test_header_only_and_empty(spark, tmpdir_fresh):
    p = write(os.path.join(tmpdir_fresh, "h.txt"), "path\ttitle\tpmcid\tpmid\tcode\n")
    assert catalogue.read_catalogue(spark, p).count() == 0
    assert catalogue.header(catalogue.read_lines(spark, p)).first().header.startswith("path")


def test_md5_bucket_matches_hashlib(spark):
    keys = [f"PMC{i}" for i in range(1000)] + ["", "é", "PMC 1"]
    df = spark.createDataFrame([(k,) for k in keys], "pmcid string")
    got = {r.pmcid: (r.bucket, r.split) for r in split.assign_split(df, keep_bucket=True).collect()}
    for k in keys:
        assert got[k] == (model.bucket(k), model.split_of(k))


@pytest.mark.parametrize("size", [0, 1, 3, 10, 11])
def test_shard_sizes(spark, size):
    df = spark.range(1, 11).select(F.col("id").alias("line_no"))
    got = [r.shard_idx for r in split.assign_shard(df, size).orderBy("line_no").collect()]
    n = max(size, 1)
    assert got == [(i - 1) // n for i in range(1, 11)]


def test_list_files_repeat_header(spark, tmpdir_fresh):
    df = spark.range(1, 251).select(F.col("id").alias("line_no"), F.format_string("row%d", "id").alias("value"))
    df = split.assign_shard(df, 100, prefix="train")
    out = os.path.join(tmpdir_fresh, "shards")
    sinks.write_lists(df, out, "H", key="shard_name")
    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(out) for f in fs if f.endswith(".txt"))
    assert len(files) == 3
    for f in files:
        rows = open(f).read().splitlines()
        assert rows[0] == "H"
        nums = [int(x[3:]) for x in rows[1:]]
        assert nums == sorted(nums)
    assert sum(len(open(f).read().splitlines()) - 1 for f in files) == 250


def test_split_is_partition(spark):
    df = spark.range(1, 2001).select(F.col("id").alias("line_no"), F.format_string("PMC%d", "id").alias("pmcid"))
    res = {r.check: r.n for r in split.split_partition_check(split.assign_split(df)).collect()}
    assert res == {"missing": 0, "extra": 0}


def test_line_numbers_plan_has_no_single_partition_window(spark, tmpdir_fresh):
    p = write(os.path.join(tmpdir_fresh, "x.txt"), "".join(f"{i}\n" for i in range(100)))
    plan = catalogue.read_lines(spark, p)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_split_then_shard_end_to_end(spark, tmpdir_fresh):
    from figpairs.plans.pipeline import shard_catalogue, split_catalogue

    src = os.path.join(tmpdir_fresh, "list.txt")
    body = "".join(f"p/{i}\tT\tPMC{i}\t{i}\tc\n" if i % 50 else f"bad line {i}\n" for i in range(1, 1201))
    write(src, "path\ttitle\tpmcid\tpmid\tcode\n" + body)
    out = os.path.join(tmpdir_fresh, "splits")
    split_catalogue(spark, src, out)
    per = {}
    for dp, _, fs in os.walk(out):
        for f in fs:
            if f.endswith(".txt"):
                rows = open(os.path.join(dp, f)).read().splitlines()
                assert rows[0].startswith("path\t")
                per[os.path.basename(dp)] = rows[1:]
    exp = {}
    for i in range(1, 1201):
        if i % 50:
            exp.setdefault("list=" + model.split_of(f"PMC{i}") + "-00000", []).append(f"p/{i}\tT\tPMC{i}\t{i}\tc")
    assert per == exp
    train_file = [os.path.join(dp, f) for dp, _, fs in os.walk(out) for f in fs if f.endswith(".txt") and "train" in dp][0]
    shards = os.path.join(tmpdir_fresh, "shards")
    shard_catalogue(spark, train_file, shards, prefix="train", shard_size=100)
    names = sorted(d for d in os.listdir(shards) if d.startswith("shard_name="))
    n_train = len(exp["list=train-00000"])
    assert len(names) == (n_train + 99) // 100
    assert names[0] == "shard_name=train_shard-00000"


def test_with_ordinal_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    rows = catalogue.with_ordinal(df.repartition(5), ["k"]).collect()
    assert sorted((r.ordinal, r.k) for r in rows) == [(i, i) for i in range(5000)]


def test_dedupe_first_invariant_under_repartition(spark):
    from figpairs.operators import pairs

    rows = [(f"k{i % 37}", i % 5, i, 1000 - i) for i in range(2000)]
    df = spark.createDataFrame(rows, "pair_id string, scope int, line_no long, payload long").withColumn("fig_pos", F.lit(0))
    expect = {(r.scope, r.pair_id): r.line_no for r in pairs.dedupe_first(df, scope=("scope",)).collect()}
    for n in (1, 3, 17):
        got = {(r.scope, r.pair_id): r.line_no for r in pairs.dedupe_first(df.repartition(n), scope=("scope",)).collect()}
        assert got == expect
    # the first row in order wins
    best = {}
    for pid, sc, ln, _ in rows:
        best.setdefault((sc, pid), ln)
    assert expect == best


def test_shard_catalogue_spans_block_files(spark, tmpdir_fresh):
    from figpairs.plans.pipeline import shard_catalogue

    d = os.path.join(tmpdir_fresh, "blocks")
    for b, rng in (("list=train-00000", range(1, 151)), ("list=train-00001", range(151, 251))):
        os.makedirs(os.path.join(d, b))
        write(os.path.join(d, b, "part-0.txt"), "H\n" + "".join(f"r{i}\n" for i in rng))
    out = os.path.join(tmpdir_fresh, "shards")
    rows = shard_catalogue(spark, d, out, prefix="t", shard_size=100)
    got = {r.value: r.shard_idx for r in rows.collect()}
    assert got == {f"r{i}": (i - 1) // 100 for i in range(1, 251)}
    assert sorted(x for x in os.listdir(out) if x.startswith("shard_name=")) == ["shard_name=t_shard-00000", "shard_name=t_shard-00001", "shard_name=t_shard-00002"]


def test_read_shard_lists_numbers_files_from_one(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "shards_train")
    os.makedirs(d)
    write(os.path.join(d, "list_shard-00001.txt"), "H\np\tt\tPMC3\t3\tc\n")
    write(os.path.join(d, "list_shard-00000.txt"), "H\np\tt\tPMC1\t1\tc\np\tt\tPMC2\t2\tc\n")
    write(os.path.join(d, "notes.md"), "ignored\n")
    got = sorted((r.shard_idx, r.line_no, r.pmcid) for r in catalogue.read_shard_lists(spark, d).collect())
    assert got == [(1, 1, "PMC1"), (1, 2, "PMC2"), (2, 1, "PMC3")]


def test_article_ids_from_first_figure(spark):
    from figpairs.operators.figures import with_article_ids

    df = spark.createDataFrame(
        [("PMC1", "1", [("", "9"), ("7", "8")]), ("PMC2", "2", [("5", None)]), ("PMC3", "3", [])],
        "pmcid string, pmid string, figures array<struct<pmid:string,pmc:string>>")
    got = {r.pmcid: r.pmid for r in with_article_ids(df).collect()}
    # first figure only: empty or missing ids fall back to the catalogue's
    assert got == {"9": "1", "PMC2": "5", "PMC3": "3"}
