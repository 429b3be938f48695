"""Registered queries: oracles, the pipeline against its stages in plain Python, and an entry without this package."""

import json
import os
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from figpairs.llm.queries import ORACLE, QUERIES, tokenizer_path
from tests.llm.test_long_matches import brute as long_matches
from tests.llm.test_near_dup import expected as components
from tests.llm.test_quality_rules import base
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, res.fetchall())[0]


def test_all_queries_are_registered():
    got = E.queries()
    assert set(QUERIES) | {"pipeline"} <= set(got)
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))


def test_near_duplicates(spark, texts):
    want = components(texts, 2)
    got = QUERIES["op1_near_duplicates"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(texts)


def test_long_matches(spark, texts):
    want = long_matches(texts, 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op6_long_matches"](spark, SF).collect()} == want


def test_token_files(spark, texts):
    from tokenizers import Tokenizer

    tok, at, want = Tokenizer.from_file(tokenizer_path()), 0, {}
    for i, t in texts:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op4_token_files"](spark, SF).collect()} == want


def test_pipeline_stages(spark, con, texts, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, text = docs.columns, dict(texts)
    kept, ids = {}, None
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "token_files":
            assert docs.columns == columns
            ids = [r.doc_id for r in docs.select("doc_id").collect()]
            kept[name] = sorted(ids)
    counts = {i: base(t) for i, t in texts}
    assert kept["quality_rules"] == [i for i, c in counts.items() if c[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    groups = components([(i, text[i]) for i in kept["quality_rules"]], 5)
    assert kept["near_duplicates"] == [i for i in kept["quality_rules"] if groups[i] == i]
    items = [t for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    assert kept["decontamination"] == [i for i in kept["near_duplicates"] if not any(t in text[i] for t in items)]
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and max(map(kept["mixing"].count, kept["mixing"])) <= 2
    sizes = {i: len(text[i].encode().split()) for i in kept["decontamination"]}
    assert abs(sum(sizes[i] for i in kept["mixing"]) / (1.5 * sum(sizes.values())) - 1) < 0.2
    rows = sorted(docs.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == kept["mixing"]
    again = sorted(E.queries()["pipeline"](spark, SF).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in again] == [tuple(r) for r in rows]


def test_pipeline_mixing_against_the_oracle(spark, tmp_path):
    """The mixing stage's copies are those of op10's oracle over the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        if name == "mixing":
            break
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    own = duckdb.connect()
    own.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/decontamination/*.parquet')")
    want = {i: n for i, n in own.execute(f"SELECT doc_id, copies FROM ({ORACLE['op10_mixing']})").fetchall() if n}
    got = {r.doc_id: r["count"] for r in stage(spark, docs, SF).groupBy("doc_id").count().collect()}
    assert got == want and 2 in want.values()


def test_entry_without_this_package(tmp_path):
    """As after deleting the package and the pipeline: the rest still imports."""
    code = ("import sys, json; sys.modules['corpus_pipeline'] = None; sys.modules['figpairs.llm'] = None\n"
            "import __spark_entry__ as E; print(json.dumps(sorted(E.queries())))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    names = json.loads(out.strip().splitlines()[-1])
    assert "build_pairs" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
