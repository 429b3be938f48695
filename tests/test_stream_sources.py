"""Archives as open streams: equal rows, balance by bytes, bounded memory, the data source, the pull parser."""

import io
import os
import random
import subprocess
import sys
import tarfile
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from figpairs.operators.figures import parse_figures_xml
from figpairs.plans.pipeline import build_pairs
from figpairs.sources import archive, catalogue, stream
from figpairs.operators import split
from tests import model
from tests.test_pipeline import JPG, cap, write_fixture

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df):
    return sorted((r.path.rsplit("/", 1)[-1], r.length, r.members, r.has_xml, r.figures, r.parse_error, r.error) for r in df.collect())


def test_streams_equal_cells(spark, tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    listing = stream.list_packages(spark, pk)
    cells = archive.scan_packages(spark, pk).select("path", "length", "content")
    got, want = rows(stream.stream_parse(listing)), rows(archive.unpack_and_parse(cells))
    assert [r[0] for r in got] == [r[0] for r in want] and len(got) == len(P)
    for g, w in zip(got, want):
        assert g[2] == w[2] and bool(g[3]) == bool(w[3]) and (g[4] or []) == (w[4] or []) and g[5:] == w[5:]
    cat = split.assign_split(catalogue.read_catalogue(spark, cat_path))
    a, b = (sorted(tuple(r) for r in build_pairs(cat, p).pairs.drop("package_path").collect()) for p in (listing, archive.scan_packages(spark, pk)))
    assert a == b and a
    m = stream.stream_members(listing.where("path like '%PMC1.tar.gz'"), piece_bytes=10).groupBy("pos", "name", "size").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", F.hex("content").alias("h")))), lambda x: x["h"]), "").alias("h")).collect()
    want = archive.unpack_members(cells.where("path like '%PMC1.tar.gz'")).select("pos", "name", "size", F.hex("content").alias("h")).collect()
    assert sorted(map(tuple, m)) == sorted(map(tuple, want))


def test_damage_anywhere_is_counted(spark, tmp_path):
    whole = model.targz([("A/a.nxml", model.article_xml("1", "1", [("F1", "L", cap("x"), "g")])), ("A/g.jpg", JPG + bytes(range(256)) * 40)])
    (tmp_path / "ok.tar.gz").write_bytes(whole)
    for at in range(5, len(whole), 7):
        bad = bytearray(whole)
        bad[at] ^= 0xFF
        (tmp_path / f"bad{at}.tar.gz").write_bytes(bytes(bad))
    for cut in range(1, len(whole), 40):
        (tmp_path / f"cut{cut}.tar.gz").write_bytes(whole[:cut])
    listing = stream.list_packages(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: r.error for r in stream.stream_parse(listing).collect()}
    assert got["ok.tar.gz"] is None and set(got.values()) <= {None, "bad_archive"}
    assert all(e == "bad_archive" for n, e in got.items() if n.startswith("cut"))
    assert stream.stream_members(listing).select("path").distinct().count() == len(got)


def test_a_failed_read_of_the_storage_ends_the_job(spark):
    for path in ("/nowhere/p.tar.gz", "s3a://bucket/p.tar.gz"):
        listing = spark.createDataFrame([(path, 5)], "path string, length long")
        with pytest.raises(Exception, match="StorageError"):
            stream.stream_parse(listing).collect()


def test_tasks_are_balanced_by_bytes(spark):
    rnd = random.Random(4)
    sizes = [rnd.randint(1, 4000) for _ in range(3000)] + [None, 0]
    total = sum(x or 0 for x in sizes)
    sizes += [total, 100_000, 100_000]  # one archive holds half of all bytes
    listing = spark.createDataFrame([(f"/p/{rnd.random()}.tar.gz", x) for x in sizes], "path string, length long").cache()
    dealt = stream.balanced(listing, 100_000).withColumn("part", F.spark_partition_id())
    by = {}
    for r in dealt.collect():
        by.setdefault(r.part, []).append(r.length or 0)
    assert sorted(x for v in by.values() for x in v) == sorted(x or 0 for x in sizes)
    assert [v for v in by.values() if total in v] == [[total]]
    assert all(len(v) == 1 for v in by.values() if max(v) >= 100_000)
    assert max(sum(v) for v in by.values() if max(v) < 100_000) < 200_000
    assert len(by) <= 3 * total // 100_000 + 70
    assert stream.balanced(listing.limit(0)).count() == 0


MEMORY = """
import sys, io, resource, tarfile
sys.path.insert(0, {repo!r})
from figpairs.sources import stream
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
with stream.open_stream({path!r}) as f:
    n = sum(len(p[5] or b"") for p in stream.pieces(f))
with stream.open_stream({path!r}) as f:
    members, seen, figs, perr, err = stream.index_and_parse(f)
print(n, len(members), len(figs), perr, err, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""


class Article(io.RawIOBase):
    """An article of ``size`` bytes with a figure in front and one behind."""

    def __init__(self, size):
        body = b"<p>" + b"word &eacute; " * 2000 + b"</p>"
        self.head = b'<article><fig id="A"><caption><p>a</p></caption></fig><body>'
        self.tail = b'</body><fig id="B"><caption><p>b</p></caption></fig></article>'
        self.body, self.times = body, size // len(body)
        self.size = len(self.head) + self.times * len(body) + len(self.tail)

    def chunks(self):
        yield self.head
        for _ in range(self.times):
            yield self.body
        yield self.tail

    def readable(self):
        return True

    def readinto(self, b):
        if not hasattr(self, "it"):
            self.it, self.left = self.chunks(), b""
        while not self.left:
            try:
                self.left = next(self.it)
            except StopIteration:
                return 0
        n = min(len(b), len(self.left))
        b[:n], self.left = self.left[:n], self.left[n:]
        return n


def test_memory_does_not_follow_the_archive(tmp_path):
    """An archive of 400 MB (a member of 300 MB and an article of 100 MB) in about 100 MB."""
    path = str(tmp_path / "large.tar.gz")
    block = random.Random(1).randbytes(1 << 20)

    class Image(Article):
        def chunks(self):
            return iter([block] * 300)

    with tarfile.open(path, "w:gz", compresslevel=0) as tar:
        for name, body, size in (("A/big.jpg", Image(0), 300 << 20), ("A/a.nxml", art := Article(100 << 20), art.size)):
            info = tarfile.TarInfo(name)
            info.size = size
            tar.addfile(info, io.BufferedReader(body))
    out = subprocess.run([sys.executable, "-c", MEMORY.format(repo=REPO, path=path)], capture_output=True, text=True, timeout=300)
    assert out.stdout, out.stderr[-2000:]
    n, members, figs, perr, err, mb = out.stdout.split()
    assert int(n) == (300 << 20) + art.size and (members, figs, perr, err) == ("2", "2", "None", "None")
    assert int(mb) < 110


def test_data_source(spark, tmpdir_fresh):
    pk, *_ = write_fixture(tmpdir_fresh)
    spark.dataSource.register(stream.PackageSource)
    read = spark.read.format("packages").option("targetBytes", 400)
    got = rows(read.load(pk))
    assert [r[0] for r in got] == [r[0] for r in rows(stream.stream_parse(stream.list_packages(spark, pk)))]
    assert [r[2:] for r in got] == [r[2:] for r in rows(stream.stream_parse(stream.list_packages(spark, pk)))]
    members = read.option("want", "members").load(pk)
    assert members.where("error is null").count() == stream.stream_members(stream.list_packages(spark, pk)).where("error is null").count() > 5
    assert members.rdd.getNumPartitions() > 3


def by_tree(data):
    """The parser's contract, from a whole tree."""
    try:
        root = ET.fromstring(data)
    except ET.ParseError:
        return None
    local = lambda x: x.rsplit("}", 1)[-1]
    ids = {}
    for el in root.iter():
        if local(el.tag) == "article-id" and el.get("pub-id-type") in ("pmid", "pmc"):
            ids.setdefault(el.get("pub-id-type"), el.text or "")
    out = []
    for el in root.iter():
        if local(el.tag) == "fig":
            label = next(("".join(c.itertext()) for c in el if local(c.tag) == "label"), None)
            c = next((c for c in el if local(c.tag) == "caption"), None)
            caption = None if c is None else " ".join("".join(k.itertext()) for k in c) if len(c) else c.text or ""
            ref = next((v for g in el if local(g.tag) == "graphic" for k, v in g.attrib.items() if local(k) == "href"), None)
            out.append((len(out), ids.get("pmid"), ids.get("pmc"), el.get("id"), label, caption, ref))
    return out


def test_pull_parser_equals_a_tree():
    rnd = random.Random(9)
    names = ["fig", "fig", "label", "caption", "graphic", "p", "article-id", "x:fig"]

    def element(depth):
        n = rnd.choice(names)
        attrs = {"fig": f' id="F{rnd.randint(0, 9)}"', "article-id": f' pub-id-type="{rnd.choice(["pmid", "pmc", "doi"])}"',
                 "graphic": rnd.choice(['', ' x:href="r"', ' href="s" x:href="r"'])}.get(n, "")
        inner = "".join(rnd.choice([element(depth + 1) if depth < 6 else "", f"t{rnd.randint(0, 99)} ", ""]) for _ in range(rnd.randint(0, 5)))
        return f"<{n}{attrs}>{inner}</{n}>"

    found = 0
    for _ in range(600):
        data = ('<article xmlns:x="urn:x">' + "".join(element(0) for _ in range(4)) + "</article>").encode()
        if rnd.random() < 0.1:
            data = data[:rnd.randint(0, len(data))]
        want = by_tree(data)
        for way in (data, io.BytesIO(data)):
            figs, error = parse_figures_xml(way)
            assert (error is not None) == (want is None)
            if want is not None:
                assert [tuple(f.values())[:-1] for f in figs] == want
                found += len(want)
    assert found > 2000


def test_tasks_list_what_spark_lists(spark, tmp_path, monkeypatch):
    """The same paths and lengths as Spark's listing, which the driver would hold, without it."""
    names = ["a.tar.gz", "b/c.tar.gz", "b/d/e f%20.tar.gz", "b/d/ü.tar.gz", "_x/f.tar.gz", ".y/g.tar.gz", "k=1/_z=2/h.tar.gz", "_i.tar.gz", ".j.tar.gz", "k.tar", "l.TAR.GZ"]
    for k, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * k)
    want = sorted(tuple(r) for r in archive.scan_packages(spark, str(tmp_path)).select("path", "length").collect())
    small = sorted(tuple(r) for r in archive.scan_packages(spark, str(tmp_path), max_mb=0).select("path", "length").collect())
    file_list = sorted(tuple(r) for r in archive.scan_packages(spark, str(tmp_path / "a.tar.gz")).select("path", "length").collect())
    one = sorted(tuple(r) for r in stream.list_packages(spark, str(tmp_path / "a.tar.gz")).collect())
    assert one == file_list
    monkeypatch.setattr(archive, "scan_packages", None)
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        assert sorted(tuple(r) for r in stream.list_packages(spark, path).collect()) == want
    assert sorted(tuple(r) for r in stream.list_packages(spark, str(tmp_path), max_mb=0).collect()) == small
    assert stream.list_packages(spark, str(tmp_path), ext=".none").count() == 0


def test_small_archives_are_dealt_out_by_their_number(spark):
    listing = spark.range(3000).selectExpr("concat('/p/', id, '.tar.gz') path", "200L length")
    by = [r["count"] for r in stream.balanced(listing).groupBy(F.spark_partition_id()).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert sum(by) == 3000 and max(by) <= 3000 // min(cores, 100) + 1
