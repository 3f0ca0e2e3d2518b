"""Operators that SQL cannot express, recomputed in plain Python."""

import collections
import math
import zlib

import numpy as np
import xxhash

from sourceloom.llm import fingerprints as fp, language_model as lm
from sourceloom.llm.fingerprints import fingerprint_edits, hashes_of, likeness, places
from sourceloom.llm.kernels import mixed
from sourceloom.llm.language_model import hmm_scores
from pyspark.sql import functions as F

def selected(text):
    """(place, kept bits of the hash) of the winnowed grams, rightmost of equals."""
    if not text:
        return []
    grams = [xxhash.xxh64_intdigest(text[i:i + fp.K].encode(), 42) for i in range(max(len(text) - fp.K + 1, 1))]
    top = [(g & ((1 << 63) - 1)) >> fp.PLACE_BITS for g in grams]
    out = []
    for i in range(max(len(top) - fp.W + 1, 1)):
        best = min(range(i, min(i + fp.W, len(top))), key=lambda j: (top[j], -j))
        if not out or out[-1][0] != best:
            out.append((best, top[best]))
    return out


def test_winnowing_brute_force(spark):
    emoji = "\U0001F600\U0001F680ab\U00010348 "
    texts = {1: "the quick brown fox jumps over the lazy dog " * 5, 2: emoji * 30, 3: "a" * 300, 4: "", 5: "short", 6: "ab" * 100 + emoji * 4, 7: "x" * 16,
             9: emoji * 30 + "tail of the text that goes on for some while and ends", 10: "日本語" * 40, 11: emoji * 30}
    ids = sorted(texts)
    edits = {a: texts[a][:len(texts[a]) - len(texts[a]) // 4] + texts[b][:len(texts[a]) // 4] for a, b in zip(ids, ids[1:] + ids[:1])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    near = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    rows = fingerprint_edits(docs).select("doc_id", "edited", *(f(F.col(c)).alias(f"{c}_{n}") for c in ("own", "edit") for n, f in (("at", places), ("h", hashes_of))),
                                          likeness(hashes_of(F.col("own")), hashes_of(F.col("edit"))).alias("near_edited"),
                                          likeness(hashes_of(F.col("own")), hashes_of(F.col("following"))).alias("near_next")).collect()
    assert len(rows) == len(texts)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    for r in rows:
        own, edit = selected(texts[r.doc_id]), selected(edits[r.doc_id])
        assert r.edited == edits[r.doc_id]
        assert list(zip(r.own_at, r.own_h)) == own and list(zip(r.edit_at, r.edit_h)) == edit, r.doc_id
        bits = lambda s: {h for _, h in s}
        assert math.isclose(r.near_edited, near(bits(own), bits(edit))) and math.isclose(r.near_next, near(bits(own), bits(selected(texts[following[r.doc_id]]))))


def test_fingerprints_of_repeated_ids_do_not_follow_row_order(spark):
    rows = [(1, "one " * 20), (2, "two " * 20), (2, "zwei " * 20), (2, "deux " * 20), (3, "three " * 20), (None, "none " * 9), (None, "null " * 9)]
    made = [sorted(map(repr, fingerprint_edits(spark.createDataFrame(r, "doc_id bigint, text string").repartition(2)).collect())) for r in (rows, rows[::-1])]
    assert made[0] == made[1]


def test_hmm_scores_brute_force(spark, monkeypatch):
    """Baum-Welch and the forward recursion in plain loops, with words beyond the table."""
    monkeypatch.setattr(lm, "TABLE_WORDS", 6)
    texts = {i: t for i, t in enumerate(["a b a c", "b a b", "c c d e f g", "", "x a b", "a b c d e f g h", "b b b a", "d d a new", "e f", "zzz a qqq zzz"])}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    assert any(out.values())
    tokens = {i: [*t.split(), None] for i, t in texts.items()}
    count = collections.Counter(w for i in texts if not out[i] for w in tokens[i])
    n, v = sum(count.values()), len(count)
    by_hash = {w: int(lm.END) if w is None else int(lm.Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).hash[0]) for w in {w for t in tokens.values() for w in t}}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    table = sorted(count, key=lambda w: (-count[w], signed(by_hash[w])))[:6]
    rank = {w: k for k, w in enumerate(table)}
    rest = n - sum(count[w] for w in table) + v - len(table) + 1
    share = np.array([count[w] + 1.0 for w in table] + [rest])
    share /= share.sum()
    states = lm.STATES
    tilt = mixed(np.arange(states * 7, dtype=np.uint64) + np.uint64(1)).reshape(states, 7) / 2.0 ** 64
    emit = share * (0.1 + 2 * tilt ** 2)
    emit /= emit.sum(1, keepdims=True)
    start, move = np.full(states, 1 / states), np.full((states, states), 0.1 / states) + np.eye(states) * 0.9
    ranks = {i: [rank.get(w, 6) for w in t] for i, t in tokens.items()}

    def forward(seq):
        alpha = [start * emit[:, seq[0]]]
        for o in seq[1:]:
            alpha.append(alpha[-1] @ move * emit[:, o])
        return alpha

    for _ in range(lm.ROUNDS):
        first, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((states, 7))
        for i, seq in ranks.items():
            if out[i]:
                continue
            alpha, beta = forward(seq), [np.ones(states)]
            total = alpha[-1].sum()
            for o in seq[:0:-1]:
                beta.insert(0, move @ (emit[:, o] * beta[0]))
            for t, o in enumerate(seq):
                gamma = alpha[t] * beta[t] / total
                emits[:, o] += gamma
                if t == 0:
                    first += gamma
                if t + 1 < len(seq):
                    moves += np.outer(alpha[t], emit[:, seq[t + 1]] * beta[t + 1]) * move / total
        start, move = (first + 0.1) / (first + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True)
        mass = emits.sum(1, keepdims=True)
        emit = (emits + lm.ALIKE * mass / mass.sum()) / (emits.sum(0) + lm.ALIKE) * share
        emit /= emit.sum(1, keepdims=True)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    for r in hmm_scores(docs).collect():
        want = math.log10(forward(ranks[r.doc_id])[-1].sum()) + sum(math.log10((count[w] + 1) / rest) for w in tokens[r.doc_id] if w not in rank)
        assert math.isclose(r.score, want, rel_tol=1e-6), (r.doc_id, r.score, want)
        assert r.n_known == sum(count[w] > 0 for w in tokens[r.doc_id])
