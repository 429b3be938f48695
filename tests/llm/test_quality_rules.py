from collections import Counter

from figpairs.llm.quality_rules import kept_documents, quality_rules, without_frequent_lines
from tests.llm.conftest import documents


def words(t):
    return (t or "").encode().split()


def base(text):
    t, w = text or "", words(text)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) for j in range(3) if grams[tuple(w[k:k + 3])] > 1}
    n_chars = sum(len(x.decode()) for x in w)
    return len(w), n_chars, sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_counts_on_edge_rows(docs, no_docs):
    rows = {(r.doc_id, r.text) for r in docs.collect()}
    text = dict(rows)
    got = quality_rules(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        want = base(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)
    assert quality_rules(no_docs).count() == 0


def letters(k):
    return chr(97 + k // 10) + chr(97 + k % 10)


def shared_lines(n):
    """n documents of one host share a line of 60 words; for one it is nearly all it has."""
    line = " ".join(f"menu{k}" for k in range(60))
    rows = [(k, line + "\n" + " ".join(f"own{letters(k)}_{letters(j)}" for j in range(80 if k else 5)), "en", "host") for k in range(n)]
    rows += [(1000 + k, " ".join(f"else{letters(k)}_{letters(j)}" for j in range(80)), "en", "host") for k in range(30)]
    rows += [(2000 + k, "Menu0 " + line[6:].replace("menu59", "MENU59"), "en", None) for k in range(40)]  # copies on a null host
    return rows


def test_frequent_lines_deplete_documents(spark):
    df = documents(spark, shared_lines(25))
    got = {r.doc_id: r for r in quality_rules(df, max_share=0.3).collect()}
    assert got[0].frequent_words == 60 and not got[0].kept and not got[0].base_failed
    assert all(got[k].frequent_words == 60 and got[k].kept for k in range(1, 25))
    assert all(got[1000 + k].frequent_words == 0 and got[1000 + k].kept for k in range(30))
    # one distinct text on the null host: copies alone are no boilerplate
    assert all(got[2000 + k].frequent_words == 0 and got[2000 + k].kept for k in range(40))
    few = {r.doc_id: r for r in quality_rules(df, max_share=0.3, min_docs=26).collect()}
    assert all(r.frequent_words == 0 for r in few.values())


def test_lines_are_taken_out(spark):
    df = documents(spark, shared_lines(25))
    out = {r.doc_id: r.text for r in without_frequent_lines(df, max_share=0.3).collect()}
    assert out[3] == " ".join(f"own{letters(3)}_{letters(j)}" for j in range(80))
    assert out[1003] == " ".join(f"else{letters(3)}_{letters(j)}" for j in range(80))
    assert without_frequent_lines(df, max_share=0.3).columns == df.columns


def test_stage_drops_rejected_rows(docs, spark):
    out = kept_documents(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in out.select("doc_id").collect()) == [(False, 0), (False, 1), (False, 2), (False, 7), (False, 7)]
