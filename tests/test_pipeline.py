"""End-to-end: packages on disk → build_pairs, checked against the Python model."""

import os

from pyspark.sql import functions as F

from figpairs.operators import split
from figpairs.operators.figures import parse_figures_xml
from figpairs.plans.pipeline import build_pairs, write_build
from figpairs.sources import archive, catalogue
from figpairs.streaming.incremental import existing_pairs
from tests import model

JPG = b"\xff\xd8\xff\xe0" + b"jpegdata" * 4
PNG = model.png_bytes()
BAD = b"not an image at all"


def cap(t):
    return f"<title>{t}</title><p>text {t}</p>"


def make_packages():
    P = {}
    P["PMC1"] = model.targz([
        ("PMC1/a.nxml", model.article_xml("11", "1", [("F1", "Fig 1", cap("one"), "pmc1-f1"), ("F2", "Fig 2", cap("two"), "sub/Fig2.png"), ("F3", "Fig 3", "", "x3")])),
        ("PMC1/pmc1-f1.jpg", JPG), ("PMC1/fig2.PNG", PNG), ("PMC1/x3.jpg", JPG)])
    P["PMC2"] = model.targz([
        ("PMC2/a/img.jpg", BAD), ("PMC2/b/img.jpg", JPG),
        ("PMC2/p.nxml", model.article_xml("22", "2", [("F1", "L", cap("dup names"), "img")]))])
    P["PMC3"] = model.targz([("PMC3/img.jpg", JPG)])
    P["PMC4"] = model.targz([("PMC4/p.nxml", b"<article><fig id='F1'>"), ("PMC4/img.jpg", JPG)])
    P["PMC5"] = b"\x1f\x8b\x08broken-gzip"
    P["PMC6"] = model.targz([("PMC6/p.nxml", model.article_xml(None, "6", [("F1", "L", cap("six"), "g6")])), ("PMC6/g6.jpg", JPG)])
    P["PMC7"] = model.targz([("PMC7/p.nxml", model.article_xml(None, "7", [("F1", "L", cap("seven"), "g7")])), ("PMC7/g7.png", PNG)])
    P["PMC8"] = model.targz([("PMC8/p.nxml", model.article_xml("88", "8", [("F1", "L", cap("loose"), "fig8"), ("F2", "L", cap("caps"), "Fig8")])),
                             ("PMC8/pmc8_fig8_large.jpg", JPG)])
    P["PMC10"] = model.targz([("PMC10/p.nxml", model.article_xml("1010", "10", [("F1", "L", cap("first bad"), "bad"), ("F1", "L", cap("second good"), "good")])),
                              ("PMC10/bad.jpg", BAD), ("PMC10/good.jpg", JPG), ("PMC10/dir.jpg", None)])
    P["PMC11"] = model.targz([("PMC11/p.nxml", model.article_xml("1111", "11", [("F1", "L", "<p>ent&nbsp;ity</p>", "h")], extra="")), ("PMC11/h.tif", b"II*\x00tiffdata")])
    return P


def write_fixture(root):
    pk = os.path.join(root, "landing")
    os.makedirs(pk)
    P = make_packages()
    for k, v in P.items():
        with open(os.path.join(pk, f"{k}.tar.gz"), "wb") as f:
            f.write(v)
    lines = ["path\ttitle\tpmcid\tpmid\tcode"]
    entries = []
    for i, k in enumerate(["PMC1", "PMC2", "PMC3", "PMC4", "PMC5", "PMC6", "PMC7", "PMC8", "PMC9", "PMC10", "PMC11"], start=1):
        pmid = "" if k in ("PMC6", "PMC7") else str(1000 + i)
        lines.append(f"oa/{k}\tT{i}\t{k}\t{pmid}\tCC")
        entries.append({"line_no": i + (1 if i > 4 else 0), "pmcid": k, "pmid": pmid})
    lines.insert(5, "only\tfour\tfields\there")  # malformed line consumes a line number
    cat_path = os.path.join(root, "list.txt")
    with open(cat_path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return pk, cat_path, P, entries


def test_build_pairs_matches_model(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    assert [r.line_no for r in cat.orderBy("line_no").collect()] == [e["line_no"] for e in entries]
    for e in entries:
        e["split"] = model.split_of(e["pmcid"])
    b = build_pairs(cat, archive.scan_packages(spark, pk))
    got = sorted(tuple(r) for r in b.pairs.select("image", "caption", "pmid", "pmcid", "pair_id", "split").collect())
    exp = sorted(tuple(d.values()) for d in model.build_model(entries, P, parse_figures_xml))
    assert got == exp
    reasons = {r.pmcid: r.reason for r in b.entries.collect()}
    assert reasons["PMC3"] == "no_xml"
    assert reasons["PMC4"] == "parse_error"
    assert reasons["PMC5"] == "bad_archive"
    assert reasons["PMC9"] == "fetch_failed"
    assert reasons["PMC1"] == "ok"


def test_resume_second_run_adds_nothing(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    out = os.path.join(tmpdir_fresh, "out")
    b = build_pairs(cat, archive.scan_packages(spark, pk))
    n1 = b.pairs.count()
    write_build(b, out)
    again = build_pairs(cat, archive.scan_packages(spark, pk), existing=existing_pairs(spark, out))
    assert again.pairs.count() == 0
    written = spark.read.json(os.path.join(out, "pairs"))
    assert written.count() == n1
    imgs = spark.read.parquet(os.path.join(out, "images"))
    assert imgs.count() == n1
    assert imgs.filter(F.length("content") > 0).count() == n1


def test_resume_off_keeps_duplicates(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    on = build_pairs(cat, archive.scan_packages(spark, pk)).pairs.count()
    off = build_pairs(cat, archive.scan_packages(spark, pk), resume=False).pairs.count()
    assert off >= on


def test_size_guard_marks_too_large(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    b = build_pairs(cat, archive.scan_packages(spark, pk), max_mb=0)
    reasons = {r.pmcid: r.reason for r in b.entries.collect()}
    assert reasons["PMC1"] == "too_large"
    assert b.pairs.count() == 0


def test_build_plan_keeps_bytes_out_of_shuffles(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    b = build_pairs(cat, archive.scan_packages(spark, pk))
    plan = b.pairs._jdf.queryExecution().executedPlan().toString()
    # The index is checkpointed without bytes: nothing above it reads `content`
    # and no Python runs after the checkpoint.
    assert "content" not in plan
    assert "MapInArrow" not in plan and "PythonUDF" not in plan

    assert "content" not in b.index.columns


def test_key_on_pmcid_and_normalized_ids(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    b = build_pairs(cat, archive.scan_packages(spark, pk), key_on="pmcid", normalize_ids=True)
    got = {r.pair_id: r.pmcid for r in b.pairs.collect()}
    # without a pmid, PMC6 and PMC7 no longer collide on "_F1"
    assert "PMC6_F1" in got and "PMC7_F1" in got
    assert all(v.startswith("PMC") for v in got.values())


def test_write_packed_shards(spark, tmpdir_fresh):
    import io
    import json
    import tarfile

    from figpairs.plans.pipeline import write_packed_shards

    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    b = build_pairs(cat, archive.scan_packages(spark, pk))
    n = b.pairs.filter(F.col("split") == "train").count()
    out = os.path.join(tmpdir_fresh, "wds")
    st = write_packed_shards(b, out, "train", shard_size=2).collect()
    assert sum(r.n_samples for r in st) == n and max(r.n_samples for r in st) <= 2
    seen = []
    for r in sorted(st, key=lambda r: r.shard):
        with tarfile.open(r.path) as t:
            names = t.getnames()
            assert len(names) == 3 * r.n_samples
            for nm in names:
                if nm.endswith(".json"):
                    seen.append(json.loads(t.extractfile(nm).read())["pair_id"])
    expected = [x.pair_id for x in b.pairs.filter(F.col("split") == "train").orderBy("line_no", "fig_pos").collect()]
    assert seen == expected


def test_pairs_written_in_list_order(spark, tmpdir_fresh):
    import glob
    import json

    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    b = build_pairs(cat, archive.scan_packages(spark, pk))
    out = os.path.join(tmpdir_fresh, "ordered")
    write_build(b, out)
    expected = [r.pair_id for r in b.pairs.filter(F.col("split") == "train").orderBy("line_no", "fig_pos").collect()]
    files = sorted(glob.glob(os.path.join(out, "pairs", "split=train", "batch=*", "part-*.json")))
    got = [json.loads(line)["pair_id"] for f in files for line in open(f)]
    assert got == expected


def test_written_image_bytes_equal_source_members(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    out = os.path.join(tmpdir_fresh, "out")
    write_build(build_pairs(cat, archive.scan_packages(spark, pk)), out)
    got = {r.pair_id: bytes(r.content) for r in spark.read.parquet(os.path.join(out, "images")).collect()}
    assert got["11_F1"] == JPG and got["11_F2"] == PNG          # two members of one package
    assert got["22_F1"] == JPG                                  # last of two equal basenames
    assert got["1010_F1"] == JPG                                # second occurrence, first undecodable


def test_spark_side_member_read_equals_task_side(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    b = build_pairs(cat, archive.scan_packages(spark, pk))
    wanted = b.pairs.select("pair_id", "package_path", "member_pos")
    task_side = {r.pair_id: bytes(r.content) for r in archive.read_members(wanted, "package_path", "member_pos").collect()}
    spark_side = {r.pair_id: bytes(r.content) for r in archive.read_members_from(wanted, archive.scan_packages(spark, pk), "package_path").collect()}
    assert task_side == spark_side and len(task_side) == b.pairs.count()
