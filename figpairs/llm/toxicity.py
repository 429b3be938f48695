"""Toxicity: a support vector machine with a gap-weighted subsequence string kernel.

The kernel of two words sums, over all triples of characters that occur in
order in both (word ends count as characters, at most ``SPAN`` apart), the
product of their weights ``DECAY ** length spanned``; it is divided by a factor
of each word's length.  So ``idi-ot`` and ``idxiot`` still share most of
``idiot``'s triples.  Characters other than letters and digits are dropped, and
runs of three or more single characters ("i d i o t") are read as the words
that their best pieces make.

Learning: a bounded sample of labelled rows (``sample`` of each class, in the
order of the md5 of their ids) is split into sentences.  A label belongs to a
whole document: all sentences of clean documents are negative, but of a toxic
one only some are positive, so one sentence stands for each (multiple-instance
learning, the positive set of a maximal-margin machine over bags).  It is the
one that holds the document's most telling word, by a lower bound of the word's
odds between toxic and clean sentences; that word is its witness.  Words that
merely come along in toxic documents lose to the insult beside them and are not
learned.  Words as telling as half of the witnesses, to a factor e, are witnesses
too, else an insult that seldom comes alone would be a negative one.  Equal
sentences count once, else copied documents would make any word of theirs
telling.  A witness weighs by the root of the number of its sentences.

Nystrom landmarks, half of them witnesses, half clean words, map words into a
space where a linear support vector machine is trained; clean words that it
takes for toxic join its negatives and landmarks and it is trained again, a few
times over.  As the kernel is a dot product of triple weights, the machine's
function of a word is one table of triple weights; triples are hashed into
``SLOTS`` slots, which bounds what goes to the executors.

A sentence's score is its worst word's.  A document's score, 0 to 1, comes from
its three worst words and its length by a logistic fit on the sample's
documents: clean documents hold a word that looks like an insult now and then,
the more so the longer they are, but seldom several.

Defined results:
* null and empty texts score as a text without any telling word;
* with no toxic or no clean row to learn from, all scores are 0;
* repeated rows get equal scores; very long texts are read whole;
* labels that are null or name no document are not learned from; a document
  with several labels is toxic if any of them is;
* other columns of both tables do not take part.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import WordTable, worker_cache

SPAN = 5
DECAY = 0.6
BITS = 18
SLOTS = 1 << BITS
OFFSETS = [(a, b) for b in range(2, SPAN + 1) for a in range(1, b)]
SENTENCE = re.compile(rb"[.!?\n]+")
SINGLE = -1e9  # score of a one-character word: it counts only as part of a run


def plain(word: bytes) -> str:
    w = word.decode().lower()
    return w if w.isalnum() else "".join(filter(str.isalnum, w))


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, weight, word index) of all triples of all words, the weights divided by the word's norm."""
    cp = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.flatnonzero(cp == 0)
    after = np.searchsorted(ends, np.arange(len(cp)), side="right")
    stop = ends[np.minimum(after, len(ends) - 1)]
    pos = np.arange(len(cp))
    slots, weights, owner = [], [], []
    for a, b in OFFSETS:
        i = pos[(pos + b <= stop) & (after < len(ends))]
        h = ((cp[i] * np.uint64(0x1F123BB5) + cp[i + a]) * np.uint64(0x5851F42D4C957F2D) + cp[i + b]) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        slots.append((h >> np.uint64(64 - BITS)).astype(np.int64))
        weights.append(np.full(len(i), DECAY ** (b + 1)))
        owner.append(after[i] - 1)
    slot, weight, word = np.concatenate(slots), np.concatenate(weights), np.concatenate(owner)
    norm = np.sqrt(np.maximum(np.bincount(word, weight * weight, minlength=len(words)), 1e-12))
    return slot, weight / norm[word], word


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """[words, landmarks]"""
    s, w, k = triples(landmarks)
    held = np.unique(s)  # the landmarks' slots; the last row stands for all others
    table = np.zeros((len(held) + 1, len(landmarks)), np.float32)
    np.add.at(table, (np.searchsorted(held, s), k), w)
    out = np.zeros((len(words), len(landmarks)))
    for at in range(0, len(words), 250):
        part = words[at:at + 250]
        s, w, k = triples(part)
        row = np.searchsorted(held, s)
        row[held[np.minimum(row, len(held) - 1)] != s] = len(held)
        order = np.argsort(k, kind="stable")
        out[at:at + len(part)] = np.add.reduceat(table[row[order]] * w[order][:, None], np.searchsorted(k[order], np.arange(len(part))), axis=0)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """L2-regularised squared hinge loss by Newton steps; the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        xs, cs = x[inside], (cost * weight[inside])[:, None]
        new = np.linalg.solve(ridge + xs.T @ (cs * xs), xs.T @ (cs[:, 0] * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def beyond_chance(hits: int, n: int, share: float) -> float:
    """Probability of ``hits`` or more of ``n`` at random."""
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
            for k in range(hits, n + 1)]
    return min(1.0, sum(map(math.exp, logs)))


def telling_odds(pos: int, neg: int) -> float:
    """Lower bound (two standard errors) of the logarithm of a word's odds between toxic and clean sentences."""
    return math.log((pos + 0.5) / (neg + 0.5)) - 2 * math.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic fit of 0/1 labels on the columns of ``x`` (the last is 1), with smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge, x.T @ (t - p) - ridge @ a)
        a += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return a


def fit(texts: list[bytes], toxic: np.ndarray, landmarks: int = 256, clean_words: int = 4000, mining: int = 3) -> dict | None:
    """The model from labelled texts; None if a class is missing."""
    n_pos, n_neg = int(toxic.sum()), int((~toxic).sum())
    if not n_pos or not n_neg:
        return None
    in_pos: dict[str, int] = {}
    in_neg: dict[str, int] = {}
    sizes = [0, 0]
    met: dict[int, bool] = {}  # by hash, distinct sentences and whether all their documents are toxic: copied documents count once
    for text, bad in zip(texts, toxic):
        for part in SENTENCE.split(text):
            met[hash(part)] = met.get(hash(part), True) and bool(bad)

    def distinct_sentences():
        """(words, toxic) of each distinct sentence."""
        left = set(met)
        for text in texts:
            for part in SENTENCE.split(text):
                if hash(part) in left:
                    left.remove(hash(part))
                    yield {p for w in part.split() if len(p := plain(w)) > 1}, met[hash(part)]

    for words, bad in distinct_sentences():
        tally = in_pos if bad else in_neg
        sizes[int(bad)] += len(words)
        for w in words:
            tally[w] = tally.get(w, 0) + 1
    share = min(max(sizes[1] / max(sum(sizes), 1), 1e-6), 1 - 1e-6)
    chance = 1e-3 / math.sqrt(len(in_pos) + 1)
    telling = {w for w, n in in_pos.items()
               if n >= 2 and n / (n + in_neg.get(w, 0)) >= (1 + share) / 2 and beyond_chance(n, n + in_neg.get(w, 0), share) < chance}
    odds = {w: telling_odds(in_pos[w], in_neg.get(w, 0)) for w in telling}
    elected: dict[str, set[int]] = {}  # by witness, the distinct sentences that stand for toxic documents
    for text, bad in zip(texts, toxic):
        best = None
        for part in SENTENCE.split(text) if bad else ():
            if met[hash(part)]:
                for w in {p for w in part.split() if len(p := plain(w)) > 1} & telling:
                    if best is None or (odds[w], w) > best[:2]:
                        best = odds[w], w, hash(part)
        if best:
            elected.setdefault(best[1], set()).add(best[2])
    if not elected:
        return None
    witness = {w: len(e) for w, e in elected.items() if len(e) > in_neg.get(w, 0)}
    # words that seldom come alone are elected seldom: those about as telling as half of the elections' words stand too
    enough = float(np.median([odds[w] for w, e in elected.items() for _ in e])) - 1
    witness.update({w: in_pos[w] for w in telling if odds[w] >= enough})
    if not witness:
        return None
    positives = sorted(witness, key=lambda w: (-witness[w], w))
    often = sorted(in_neg, key=lambda w: (-in_neg[w], w))
    often = [w for w in often if w not in witness]
    step = max(1, len(often) // clean_words)
    negatives = often[:1000] + often[1000::step][:clean_words]
    clean = [w for w in in_neg if w not in witness]
    half = landmarks // 2
    model = {}
    for round_ in range(mining + 1):
        marks = positives[:half] + negatives[:half // 2] + negatives[half // 2::max(1, len(negatives) // (half - half // 2))][:half - half // 2]
        k = kernel(marks, marks)
        value, vector = np.linalg.eigh((k + k.T) / 2)
        good = value > 1e-6
        to_space = vector[:, good] / np.sqrt(value[good])
        words = positives + negatives
        y = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
        stands = np.sqrt([witness[w] for w in positives])
        weight = np.concatenate([0.5 * stands / stands.sum(), np.full(len(negatives), 0.5 / len(negatives))]) * len(y)
        w = linear_svm(kernel(words, marks) @ to_space, y, weight)
        table = np.zeros(SLOTS)
        s, t, owner = triples(marks)
        np.add.at(table, s, t * (to_space @ w[:-1])[owner])
        model.update(table=table.astype(np.float32), bias=float(w[-1]))
        # clean words that the machine takes for toxic become its next negatives, first in the list
        wrong = np.concatenate([plain_scores(model, clean[at:at + 4_000]) for at in range(0, len(clean), 4_000)] or [np.zeros(0)])
        listed = set(negatives)
        hard = [clean[j] for j in np.argsort(-wrong, kind="stable")[:clean_words] if wrong[j] > -0.7 and clean[j] not in listed]
        if not hard:
            break
        negatives = hard + negatives
    model["logistic"] = logistic(document_features(model, texts), toxic.astype(int))
    return model


def plain_scores(model: dict, words: list[str]) -> np.ndarray:
    s, w, k = triples(words)
    return np.bincount(k, model["table"][s] * w, minlength=len(words)) + model["bias"]


def word_scores(model: dict, words: list[bytes]) -> np.ndarray:
    out = np.full((len(words), 1), model["bias"], np.float32)
    p = [plain(w) for w in words]
    for at in range(0, len(words), 4_000):
        part = p[at:at + 4_000]
        out[at:at + len(part), 0] = np.where([len(x) == 1 for x in part], SINGLE, np.where([len(x) == 0 for x in part], SINGLE / 2, plain_scores(model, part)))
    return out


def spelt_scores(model: dict, letters: str) -> np.ndarray:
    """Scores of the words spelt out by a run of single letters: the best pieces of 3 to 12 letters that do not overlap."""
    pieces = [(at, n) for n in range(3, 13) for at in range(len(letters) - n + 1)]
    f = plain_scores(model, [letters[at:at + n] for at, n in pieces])
    taken, out = np.zeros(len(letters), bool), []
    for k in np.argsort(-f, kind="stable"):
        at, n = pieces[k]
        if not taken[at:at + n].any():
            taken[at:at + n] = True
            out.append(f[k])
    return np.array(out)


def document_features(model: dict, texts: list[bytes], table: WordTable | None = None) -> np.ndarray:
    """Per text: the scores of its three worst words, the logarithm of its length, 1."""
    table = table or WordTable(lambda ws: word_scores(model, ws), 1)
    out = np.full((len(texts), 5), -2.0)
    out[:, 4] = 1
    for at in range(0, len(texts), 256):
        split = [t.split() for t in texts[at:at + 256]]
        for k, (words, index) in enumerate(zip(split, table.lookup(split))):
            f = table.rows[index, 0]
            single = np.flatnonzero(f == np.float32(SINGLE))
            if len(single) > 2:
                run = np.split(single, np.flatnonzero(np.diff(single) > 1) + 1)
                f = np.concatenate([f, *(spelt_scores(model, "".join(plain(words[j]) for j in r)) for r in run if len(r) > 2)])
            worst = -np.sort(-(np.partition(f, len(f) - 3)[-3:] if len(f) > 3 else f))
            out[at + k, :len(worst)] = np.clip(worst, -2, 1.5)
            out[at + k, 3] = np.log1p(len(f))
    return out


def scores(model: dict, features: np.ndarray) -> np.ndarray:
    # summed row by row: a matrix product may round equal rows differently by their place
    return 1 / (1 + np.exp(-np.clip((features * model["logistic"]).sum(1), -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, train: Column, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> dict | None:
    """Fit on at most ``sample`` toxic and 4 * ``sample`` clean labelled rows for which ``train``, a condition on the id, holds."""
    known = (labels.where(train).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).where("__id is not null and __y is not null")
             .groupBy("__id").agg(F.max("__y").alias("__y")))
    texts = docs.where(train).select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).where("__text is not null")
    order = [F.md5(F.col("__id").cast("string").cast("binary")), F.col("__id")]

    def drawn(y: int, n: int) -> DataFrame:
        return known.where(F.col("__y") == y).orderBy(*order).limit(n)

    picked = drawn(1, sample).unionByName(drawn(0, 4 * sample))
    rows = texts.join(F.broadcast(picked), "__id").select("__id", "__text", "__y").toPandas()  # at most 5 * sample ids
    rows = rows.sort_values(["__id", "__text"]).drop_duplicates()
    return fit([t.encode() for t in rows["__text"]], rows["__y"].to_numpy().astype(int) == 1)


def toxicity(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return d.select(F.col("id").alias(id_col), F.lit(0.0).alias("score"))
    id_type = d.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)
    key = f"{spark.sparkContext.applicationId}:{id(shared)}"

    def run(batches):
        m = shared.value
        held = worker_cache("toxicity")
        if held.get("key") != key:
            held.clear()
            held.update(key=key, words=WordTable(lambda ws: word_scores(m, ws), 1))
        for b in batches:
            score = scores(m, document_features(m, [(t or "").encode() for t in b.column(1).to_pylist()], held["words"]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], ["id", "score"])

    return d.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)
