"""Queries with Python stages run when the driver imports the entry module by
path from another working directory (workers never import the package)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
n = E.queries()["parse_figures"](spark, "/root/testdata/sf0.001").count()
m = E.entry(spark).count()
print("RESULT", n, m)
spark.stop()
"""


def test_python_stages_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="figpairs-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    _, n, m = line[0].split()
    assert int(n) > 0 and int(m) >= 0


def test_uses_the_sessions_checkpoint_dir():
    ck = tempfile.mkdtemp(prefix="figpairs-shared-ckpt-")
    script = f"""
import os, sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {ck!r}).getOrCreate())
import __spark_entry__ as E
n = E.queries()["catalogue_file_scan"](spark, "/root/testdata/sf0.001").count()
used = spark.sparkContext.getCheckpointDir() or ""
files = sum(len(f) for _, _, f in os.walk({ck!r}))
print("RESULT", n, used.startswith("file:" + {ck!r}) or used.startswith({ck!r}), files > 0)
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", script], cwd=tempfile.mkdtemp(), capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    n, in_session_dir, written = line[0].split()[1:]
    assert int(n) > 0 and in_session_dir == written == "True"
