"""python -m figpairs: split, then build from landed packages."""

import json
import os
import subprocess
import sys

from tests.test_pipeline import write_fixture

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    out = subprocess.run([sys.executable, "-m", "figpairs", "--master", "local[2]", *args], cwd=REPO,
                         capture_output=True, text=True, timeout=600)
    lines = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert lines, out.stderr[-2000:]
    return json.loads(lines[-1])


def test_cli_split_and_build(tmpdir_fresh):
    pk, cat_path, P, entries = write_fixture(tmpdir_fresh)
    counts = run("split", "--input", cat_path, "--out_dir", os.path.join(tmpdir_fresh, "lists"))
    assert sum(counts.values()) == 11  # the 4-field line is dropped
    build = ("build", "--list", cat_path, "--packages", pk, "--out_root")
    assert sum(run(*build, os.path.join(tmpdir_fresh, "decoded")).values()) == 2  # the fixture's JPEGs are only signatures
    summary = run(*build, os.path.join(tmpdir_fresh, "out"), "--no_decode")
    assert sum(summary.values()) == 7
    again = run(*build, os.path.join(tmpdir_fresh, "out"), "--no_decode")
    assert sum(again.values()) == 0  # resume: nothing new
    # the same with the published ids in a bucketed table, which a new process finds again
    assert [sum(run(*build, os.path.join(tmpdir_fresh, "indexed"), "--no_decode", "--id_index").values()) for _ in range(3)] == [7, 0, 0]
