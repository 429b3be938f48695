"""Landed listing, XML scan → article records, image decode, inline references."""

import os

import pytest
from pyspark.sql import functions as F

from figpairs.operators import fetch, figures, images
from figpairs.plans.pipeline import build_articles
from figpairs.sources import catalogue
from tests import model


def test_list_landed_and_pending(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "landed", "x")
    os.makedirs(d)
    for n in ("PMC1.tar.gz", "PMC3.tar.gz", "notes.txt"):
        open(os.path.join(d, n), "wb").write(b"x" * 10)
    landed = catalogue.list_landed(spark, os.path.join(tmpdir_fresh, "landed"))
    assert sorted(r.file_name for r in landed.collect()) == ["PMC1.tar.gz", "PMC3.tar.gz"]
    assert "content" not in landed.columns
    cat = spark.createDataFrame([(1, "PMC1"), (2, "PMC2"), (3, "PMC3")], "line_no long, pmcid string")
    assert [r.pmcid for r in fetch.pending_fetch(cat, landed).collect()] == ["PMC2"]


def test_build_articles_from_xml_tree(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "extracted")
    os.makedirs(os.path.join(root, "PMC1"))
    os.makedirs(os.path.join(root, "PMC2"))
    open(os.path.join(root, "PMC1", "a.nxml"), "wb").write(model.article_xml("11", "1", [("F1", "Figure 1", "<p>cap</p>", "img1"), ("F2", "Figure 2", "<p>c2</p>", None)]))
    open(os.path.join(root, "PMC2", "b.nxml"), "wb").write(b"<broken")
    arts = build_articles(spark, root).collect()
    assert len(arts) == 1
    a = arts[0]
    assert (a.pmid, a.pmc) == ("11", "1") and a.location.endswith("/PMC1")
    assert [(f.fig_id, f.graphic_ref.endswith("/PMC1/img1.jpg"), f.pair_id) for f in a.figures] == [("F1", True, "11_F1"), ("F2", False, "11_F2")]
    assert a.figures[1].graphic_ref == ""


def test_read_images_decodes_png(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "imgs")
    os.makedirs(d)
    open(os.path.join(d, "ok.png"), "wb").write(model.png_bytes(3, 2))
    open(os.path.join(d, "bad.png"), "wb").write(b"\x89PNG\r\n\x1a\nbroken")
    rows = images.read_images(spark, d).collect()
    assert [(os.path.basename(r.origin), r.width, r.height) for r in rows] == [("ok.png", 3, 2)]


def test_sniff_expr_matches_python(spark):
    blobs = [model.png_bytes(), b"\xff\xd8\xff\xe0x", b"II*\x00", b"MM\x00*", b"GIF89a", b"BMxx", b"RIFF\x00\x00\x00\x00WEBPxx", b"junk", b""]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blobs)], "i int, b binary")
    got = {r.i: r.f for r in df.select("i", images.sniff_expr("b").alias("f")).collect()}
    assert got == {i: images.sniff_format(b[:64]) for i, b in enumerate(blobs)}


def test_inline_refs_guard(spark):
    df = spark.createDataFrame([(1, [(0, "1", "1", "F1", "L", "c", "g", [("t", "s", "r")])])],
                               "id int, figures array<struct<fig_pos:int,pmid:string,pmc:string,fig_id:string,fig_label:string,fig_caption:string,graphic_ref:string,fig_refs:array<struct<text:string,section:string,reference_id:string>>>>")
    lenient = figures.normalise_inline_refs(df)
    assert "fig_refs" not in lenient.select(F.inline("figures")).columns
    with pytest.raises(Exception):
        figures.normalise_inline_refs(df, strict=True).collect()


def test_survey_api_entry_points(spark, tmpdir_fresh):
    from figpairs.operators import pairs, report
    from figpairs.operators.fetch import plan_fetch
    from figpairs.sources import archive
    from tests.test_pipeline import write_fixture

    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    parsed = archive.read_packages(spark, pk)
    assert {"members", "figures", "parse_error", "error"} <= set(parsed.columns)
    assert archive.read_packages(spark, pk, want="members").filter("error is null").count() > 10
    cat = catalogue.read_catalogue(spark, cat_path)
    sizes = spark.createDataFrame([("PMC1", 10), ("PMC2", None), ("PMC3", 5 * 1024 * 1024)], "pmcid string, size long")
    plan = plan_fetch(cat, sizes=sizes, max_mb=1)
    assert {r.pmcid for r in plan.collect()} == {r.pmcid for r in cat.collect()} - {"PMC3"}
    strict = plan_fetch(cat, sizes=sizes, max_mb=1, require_size=True)
    assert {r.pmcid for r in strict.collect()} == {"PMC1"}
    rows = spark.createDataFrame([("11", "PMC1", "F1", "c", 1, 0, "train"), ("11", "PMC1", "F1", "c2", 2, 0, "train")],
                                 "pmid string, pmcid string, fig_id string, caption string, line_no long, fig_pos long, split string")
    out = pairs.to_pairs(rows).collect()
    assert [(r.pair_id, r.caption) for r in out] == [("11_F1", "c")]
    ent = spark.createDataFrame([(0, "ok"), (0, "bad_archive"), (1, "no_pair_written")], "shard_idx int, reason string")
    r = report.shard_report(ent).first()
    assert (r.n_ok, r.n_fail, r.n_total) == (1, 1, 2)


def test_join_checked_counts_rows(spark):
    from figpairs.plans.joins import join_checked

    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("pad", F.lit("x" * 1000))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in plan(join_checked(big, small, "k"))
        assert "BroadcastHashJoin" not in plan(join_checked(big, small, "k", max_rows=5))
        assert join_checked(big, small, "k", max_rows=5).count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_tasks_list_and_read_the_xml_tree(spark, tmp_path, monkeypatch):
    """The rows of Spark's own scan, and no file of it in the driver's listing."""
    from figpairs.sources import archive

    for k in range(70):
        (tmp_path / f"PMC{k % 40}").mkdir(exist_ok=True)
        (tmp_path / f"PMC{k % 40}" / f"{k}.nxml").write_bytes(b"<article>%d</article>" % k)
    (tmp_path / "PMC1" / "other.xml").write_bytes(b"x")
    want = {(r.path, bytes(r.xml)) for r in archive.scan_xml(spark, str(tmp_path), "*.[n]xml").collect()}
    got = archive.scan_xml(spark, str(tmp_path))
    assert len(want) == 70 and {(r.path, bytes(r.xml)) for r in got.collect()} == want
    assert not any("PMC" in f for f in got.inputFiles())


def test_small_images_share_tasks(spark, tmp_path):
    """Files of a folder tree are decoded wherever they lie, and not in a task per few of them."""
    for k in range(200):
        (tmp_path / f"PMC{k % 50}").mkdir(exist_ok=True)
        (tmp_path / f"PMC{k % 50}" / f"g{k}.png").write_bytes(model.png_bytes(k % 5 + 1, 2) if k % 7 else b"cut")
    (tmp_path / "PMC1" / "g.gif").write_bytes(model.png_bytes(9, 9))
    got = images.read_images(spark, str(tmp_path), glob="*.png")
    by_path = images.read_images(spark, str(tmp_path / "*" / "*.png"))
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(tuple(r) for r in by_path.collect()) and len(rows) == sum(1 for k in range(200) if k % 7)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        assert got.select("*").rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
