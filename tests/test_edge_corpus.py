"""Remaining hand-made edge inputs (FIXTURES §D)."""

import os

from figpairs.operators import fetch, match, pairs
from figpairs.sources import catalogue
from tests import model


def test_empty_catalogue_file(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "empty.txt")
    open(p, "w").close()
    assert catalogue.read_catalogue(spark, p).count() == 0
    assert catalogue.catalogue_violations(catalogue.read_lines(spark, p)).count() == 0


def test_size_exactly_at_limit_and_unknown(spark):
    mb = 1024 * 1024
    df = spark.createDataFrame([("a", mb), ("b", mb + 1), ("c", None), ("d", 0)], "pmcid string, size long")
    assert sorted(r.pmcid for r in fetch.size_guard(df, 1).collect()) == ["a", "c", "d"]
    assert sorted(r.pmcid for r in fetch.size_required(df).collect()) == ["a", "b", "d"]


def _match(spark, members, refs, strict=False):
    figs = spark.createDataFrame([(1, i, r) for i, r in enumerate(refs)], "article_id long, fig_pos long, graphic_ref string")
    mems = spark.createDataFrame([(1, p, n) for p, n in enumerate(members)], "article_id long, pos int, name string")
    rows = match.match_images(figs, mems, strict=strict).collect()
    imap = model.image_map([(p, n, True) for p, n in enumerate(members)])
    exp = {i: model.match(imap, r, strict) for i, r in enumerate(refs)}
    assert {r.fig_pos: r.member_pos for r in rows} == {k: v for k, v in exp.items() if v is not None}
    return {r.fig_pos: (r.member_key, r.match_kind) for r in rows}


def test_sibling_fallback_and_empty_stem(spark):
    # `fig.1` has stem `fig`, so the candidate `fig.jpg` hits exactly: the figure
    # takes a sibling's image (the documented consequence of the stem rule)
    assert _match(spark, ["P/fig.jpg", "P/other.png"], ["fig.1"])[0] == ("fig.jpg", "exact")
    # no candidate and no key containing the stem: unmatched
    assert _match(spark, ["P/fig.jpg"], ["plot.1"]) == {}
    # a ref whose name has no stem ("dir/." → name "dir", stem "dir") and a truly
    # empty stem (".") both follow the model
    _match(spark, ["P/zz.png", "P/dir_a.jpg"], ["dir/.", "."])


def test_same_pair_id_in_two_shards_is_kept_in_both(spark):
    rows = [("11_F1", 1, 0, 1), ("11_F1", 2, 0, 2), ("11_F1", 3, 0, 1)]
    df = spark.createDataFrame(rows, "pair_id string, line_no long, fig_pos long, shard_idx long")
    got = sorted((r.shard_idx, r.line_no) for r in pairs.dedupe_first(df, scope=("shard_idx",)).collect())
    assert got == [(1, 1), (2, 2)]
    assert pairs.dedupe_first(df).count() == 1
