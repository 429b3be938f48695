"""Language identification of spans in mixed-language text.

Learning: over all training rows, per language, counts of letter trigrams (with
word ends) and of whole words, both hashed into one table of ``SLOTS`` slots,
and of the scripts that words begin with.  The table's size is fixed by SLOTS
and the number of languages, so it may go to every executor.

Prediction: a word's script, found from code-point ranges, narrows its
candidate languages to those that use the script; each candidate gets the
word's log probability; a Viterbi search over the document's words, with a
penalty for each switch of language, labels spans.  The document's language is
the one that labels most letters, its score that language's share of letters.

Texts are split at white space; words are scored once per Python worker and
looked up after that.  The Viterbi steps run over many documents at once.

Defined results:
* null texts, and texts without a letter: ``und`` and score 0, no spans;
* rows without a language are not learned from; with no row to learn from
  every prediction is ``und``;
* equally many letters in two languages: the first by code point;
* repeated rows get equal results; very long texts are read whole;
* other columns of the documents do not take part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import WordTable, joined_by_bytes, worker_cache

SLOTS = 1 << 17
BATCH_BYTES = 16 << 20
# First code points of ranges, each with the script that letters
# from there on (to the next range) belong to.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Syriac"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1780, "Khmer"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0xAC00, "Hangul"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF21, "Latin"),
    (0xFF66, "Kana"), (0x20000, "Han"),
]
SCRIPT_STARTS = np.array([s for s, _ in SCRIPTS])
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
SCRIPT_OF = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])
MIN_SCRIPT_SHARE = 0.005
FAR = -1e4  # for a language that does not use a word's script


def letters_of(word: bytes) -> str:
    w = word.decode().lower()
    return w if w.isalpha() else "".join(filter(str.isalpha, w))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots of all features, index of each feature's word, script of each word) of non-empty words."""
    joined = "\0".join(words)
    cp = np.frombuffer(("\0" + joined + "\0").encode("utf-32-le"), "<u4").astype(np.uint64)
    at = np.flatnonzero(cp)
    word = np.cumsum(cp == 0)[at] - 1
    mix = np.uint64(0x9E3779B97F4A7C15)
    tri = ((cp[at - 1] * np.uint64(0x1F123BB5) + cp[at]) * np.uint64(0x5851F42D4C957F2D) + cp[at + 1]) * mix
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, int)
    inside = (np.arange(len(at)) - first[word]).astype(np.uint64) if len(word) else np.zeros(0, np.uint64)
    spread = (cp[at] + np.uint64(1)) * mix ^ (inside * np.uint64(0xD6E8FEB86659FD93))
    spread = (spread ^ (spread >> np.uint64(31))) * mix
    whole = np.add.reduceat(spread, first) if len(first) else np.zeros(0, np.uint64)
    whole = (whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    shift = np.uint64(64 - 17)
    script = SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, cp[at[first]].astype(np.int64), side="right") - 1] if len(first) else np.zeros(0, int)
    return (np.concatenate([tri >> shift, whole >> shift]).astype(np.int64), np.concatenate([word, np.arange(len(first))]), script)


def learn(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model: languages, log probabilities [SLOTS, languages], scripts each language uses."""
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        held: dict[str, np.ndarray] = {}

        def flush():
            for lang, n in sorted(held.items()):
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
                                                 ["lang", "slot", "n"])
            held.clear()

        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1)
            for lang in sorted(set(langs)):
                mine = [t.as_py() for t, own in zip(texts, langs) if own == lang]
                for at in range(0, len(mine), 256):
                    tally: dict[bytes, int] = {}
                    for t in mine[at:at + 256]:
                        for w in t.encode().split():
                            tally[w] = tally.get(w, 0) + 1
                    pairs = [(x, n) for w, n in tally.items() if (x := letters_of(w))]
                    if not pairs:
                        continue
                    times = np.array([n for _, n in pairs])
                    slots, word, script = features([x for x, _ in pairs])
                    n = held.setdefault(lang, np.zeros(SLOTS + len(SCRIPT_NAMES), np.int64))
                    n[:SLOTS] += np.bincount(slots, weights=times[word], minlength=SLOTS).astype(np.int64)
                    n[SLOTS:] += np.bincount(script, weights=times, minlength=len(SCRIPT_NAMES)).astype(np.int64)
            if len(held) > 32:
                yield from flush()
        yield from flush()

    counts = rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((SLOTS + len(SCRIPT_NAMES), len(langs)))
    if len(langs):
        table[counts["slot"].to_numpy(), np.searchsorted(langs, counts["lang"].to_numpy().astype(str))] = counts["n"].to_numpy()
    seen, scripts = table[:SLOTS], table[SLOTS:]
    logp = np.log((seen + 0.5) / (seen.sum(0) + 0.5 * SLOTS)).astype(np.float32)
    return {"langs": langs, "logp": logp, "uses": scripts >= np.maximum(MIN_SCRIPT_SHARE * scripts.sum(0), 1)}


def word_scores(model: dict, words: list[bytes]) -> np.ndarray:
    """[words, languages + 1]: log probability per language, then the number of letters."""
    n_lang = len(model["langs"])
    out = np.zeros((len(words), n_lang + 1), np.float32)
    plain = [letters_of(w) for w in words]
    have = np.array([k for k, p in enumerate(plain) if p], dtype=np.int64)
    for at in range(0, len(have), 20_000):
        part = have[at:at + 20_000]
        slots, word, script = features([plain[k] for k in part])
        order = np.argsort(word, kind="stable")
        sums = np.add.reduceat(model["logp"][slots[order]], np.searchsorted(word[order], np.arange(len(part))), axis=0)
        uses = model["uses"][script]
        # a script that no language uses says nothing: all languages stay, alike
        out[part, :n_lang] = np.where(uses, sums, np.where(uses.any(1, keepdims=True), FAR, 0))
        out[part, n_lang] = [len(plain[k]) for k in part]
    return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; ``scores`` [words of all documents, languages], documents one after another."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    start, length = starts[order], lengths[order]
    n_steps = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(n_steps), side="left")  # documents longer than t
    kind = np.min_scalar_type(-max(scores.shape[1], 1))  # holds -1 and every language's number
    came, v, last = [], None, np.zeros(len(length), kind)
    rows = np.arange(len(length))
    for t in range(n_steps):
        k = live[t]
        s = scores[start[:k] + t]
        if t == 0:
            v = s.copy()
            continue
        if k < len(v):
            last[k:len(v)] = v[k:].argmax(1)
            v = v[:k]
        best = v.argmax(1)
        jump = v[rows[:k], best] - penalty
        stay = v >= jump[:, None]
        came.append(np.where(stay, -1, best[:, None]).astype(kind))
        v = np.maximum(v, jump[:, None]) + s
    if n_steps:
        last[:len(v)] = v.argmax(1)
    label = np.zeros(len(scores), kind)
    now = last.astype(np.int64)
    for t in range(n_steps - 1, -1, -1):
        k = live[t]
        label[start[:k] + t] = now[:k]
        if t:
            back = came[t - 1][rows[:k], now[:k]]
            now[:k] = np.where(back >= 0, back, now[:k])
    return label


def language_spans(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", penalty: float = 8.0) -> DataFrame:
    """Per row: id, lang_pred, score and spans (first word, words, lang) in text order."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)
    key = f"lang:{id(shared)}:{shared.id if hasattr(shared, 'id') else ''}:{spark.sparkContext.applicationId}"

    def run(batches):
        m = shared.value
        n_lang = len(m["langs"])
        held = worker_cache("language")
        if held.get("key") != key:
            held.clear()
            held.update(key=key, words=WordTable(lambda ws: word_scores(m, ws), n_lang + 1))
        words = held["words"]
        kinds = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))
        for part in joined_by_bytes(batches, 1, BATCH_BYTES, 1024):
            if part.num_rows:
                texts = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                index = words.lookup(texts) if n_lang else [np.zeros(0, np.int64) for _ in texts]
                rows = words.rows[np.concatenate(index)] if index else np.zeros((0, n_lang + 1), np.float32)
                length = np.array([len(i) for i in index], np.int64)
                # words without a letter take no part in the search
                spoken = rows[:, n_lang] > 0
                doc = np.repeat(np.arange(len(length)), length)
                length_spoken = np.bincount(doc[spoken], minlength=len(length))
                label = np.full(len(rows), -1, np.int64)
                label[spoken] = viterbi(rows[spoken, :n_lang], length_spoken, penalty)
                letters = np.zeros((len(length), max(n_lang, 1)))
                np.add.at(letters, (doc[spoken], label[spoken]), rows[spoken, n_lang])
                total, best = letters.sum(1), letters.argmax(1)
                pred = [m["langs"][k] if t else "und" for k, t in zip(best, total)]
                score = np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)
                spans, end = [], 0
                for n in length.tolist():
                    own, end = label[end:end + n], end + n
                    voiced = np.flatnonzero(own >= 0)
                    if not len(voiced):
                        spans.append([])
                        continue
                    heads = voiced[np.concatenate([[True], own[voiced[1:]] != own[voiced[:-1]]])]
                    tails = np.append(heads[1:], n)
                    spans.append([{"first": int(h), "words": int(e - h), "lang": m["langs"][own[h]]} for h, e in zip(heads, tails)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kinds)],
                    ["id", "lang_pred", "score", "spans"])

    out = d.mapInArrow(run, f"id {id_type}, lang_pred string, score double, spans array<struct<first:long,words:long,lang:string>>")
    return out.withColumnRenamed("id", id_col)
