"""LM scoring against plain loops over the same weights, and its counts against a Counter."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from lodestrata.llm import maxent_lm as M

DOCS = "doc_id long, text string, _id string, _score int, ids int, found int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in enumerate(texts)], DOCS)


def corpus(rng, n=180):
    """The next word depends on the last one; some words are rare."""
    words = [f"w{i}" for i in range(120)] + ["É", "naïve", "ÉTÉ", "b\u00a0c", "NOW"]
    texts = []
    for _ in range(n):
        at, out = rng.randrange(len(words)), []
        for _ in range(rng.randint(0, 120)):
            at = (at * 7 + rng.randrange(4)) % len(words)
            out.append(words[at] if rng.random() < 0.5 else f"r{rng.randrange(90_000)}")
        texts.append(rng.choice([" ", "\n"]).join(out))
    return [*texts, None, "", " \n ", "long " * 30_000, "x" * 300_000]


def hash_of(word):
    return xxhash.xxh3_64_intdigest(word)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def kind_of(word):
    return (word[-1] * 251 + (word[-2] if len(word) > 1 else 0) * 7_919 >> 3) % M.TAIL


def plain_score(words, w, rank, counts, mass):
    """Sum of log10 P, one token at a time."""

    def leaf(x):
        own = rank.get(x, M.OWN)
        return own if own < M.OWN else (M.HEADS + kind_of(x)) * M.LEAVES + hash_of(x) % M.LEAVES

    def bucket(x):
        r = rank.get(x, M.OFTEN)
        return r if r < M.OFTEN else M.OFTEN + (hash_of(x) >> 20) % (M.BUCKETS - M.OFTEN - 1)

    total, start = 0.0, M.BUCKETS - 1
    for k, x in enumerate(words):
        one = bucket(words[k - 1]) if k else start
        skip = bucket(words[k - 2]) if k > 1 else start
        kind, at = divmod(leaf(x), M.LEAVES)
        z = w["one"][one] + w["skip"][skip] + w["pair"][(one * 40_503 + skip * 69_069 >> 3) % M.PAIRS] + w["class"][0]
        y = w["near"][(one * 1_291 + kind * 52_711 >> 2) % M.NEAR] + w["leaf"][kind]
        for line, i in ((z, kind), (y, at)):
            e = np.exp(line.astype(np.float64))
            total += math.log10(e[i] / e.sum())
        if leaf(x) >= M.OWN:
            total += math.log10((counts[x] + 0.5) / mass[leaf(x)])
    return total


@pytest.mark.parametrize("hot", [1 << 17, 50])
def test_lm_scores(spark, monkeypatch, hot):
    monkeypatch.setattr(M, "HOT", hot)
    kept, trained = [], M.trained
    monkeypatch.setattr(M, "trained", lambda *a: kept.append(trained(*a)) or kept[-1])
    texts = corpus(random.Random(1))
    rows = {r._id: r for r in M.lm_scores(frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in rows}
    counts = Counter(w for i, t in enumerate(texts) if not held[i] for w in M.tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert v > M.OWN  # so some words share leaves
    # levels of equal counts are taken whole, as long as they fit
    ordered = sorted(counts, key=lambda x: (-counts[x], signed(hash_of(x))))
    least = min(c for c in counts.values() if sum(k >= c for k in counts.values()) <= hot)
    rank = {x: k for k, x in enumerate(ordered) if counts[x] >= least}
    mass = Counter()
    for x in ordered:
        if rank.get(x, M.OWN) >= M.OWN:
            mass[(M.HEADS + kind_of(x)) * M.LEAVES + hash_of(x) % M.LEAVES] += counts[x] + 0.5
    mass = {k: mass[k] + 0.5 for k in range(M.CLASSES * M.LEAVES)}
    for i, t in enumerate(texts):
        w = M.tokens(t)
        assert (rows[i]._held_out, rows[i]._n_tokens, rows[i]._train_tokens, rows[i]._n_known) == (held[i], len(w), n, sum(counts[x] > 0 for x in w))
        assert rows[i]._base_score == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        if len(w) < 1000:
            assert rows[i]._score == pytest.approx(plain_score(w, kept[0], rank, counts, mass), rel=1e-4)
    out = [rows[i] for i in rows if held[i]]
    assert sum(r._score for r in out) > sum(r._base_score for r in out)


def test_steps_against_loops():
    rng = np.random.default_rng(4)
    w = {n: rng.normal(size=(k, 64)).astype(np.float32) * 0.1 for n, k in M._TABLES.items()}
    leaf, bucket = rng.integers(0, 4096, 300).astype(np.uint16), rng.integers(0, 60, 300).astype(np.uint16)
    starts = np.array([0, 90, 91, 92, 200])
    learner = M.Learner(w, {n: np.zeros(len(x), np.float32) for n, x in w.items()})
    learner.learn(leaf, bucket, starts)
    sums = {n: np.zeros(x.shape) for n, x in w.items()}
    for k in range(300):
        begin = starts[starts <= k].max()
        one = int(bucket[k - 1]) if k > begin else M.BUCKETS - 1
        skip = int(bucket[k - 2]) if k > begin + 1 else M.BUCKETS - 1
        kind, at = divmod(int(leaf[k]), 64)
        rows = {"one": one, "skip": skip, "pair": (one * 40_503 + skip * 69_069 >> 3) % M.PAIRS, "class": 0}
        words = {"near": (one * 1_291 + kind * 52_711 >> 2) % M.NEAR, "leaf": kind}
        for own, right in ((rows, kind), (words, at)):
            e = np.exp(sum(w[n][r].astype(np.float64) for n, r in own.items()))
            g = e / e.sum()
            g[right] -= 1
            for n, r in own.items():
                sums[n][r] += g
    for n, x in w.items():
        squares = (sums[n] ** 2).sum(axis=1, keepdims=True)
        assert np.allclose(learner.w[n], x - M.STEP * sums[n] / np.sqrt(squares + 1), atol=1e-4), n


def test_probabilities_add_up():
    rng = np.random.default_rng(3)
    w = {n: rng.normal(size=(k, 64)).astype(np.float32) for n, k in M._TABLES.items()}
    leaf, n = np.arange(4096, dtype=np.uint16), 4096
    history = np.tile(np.array([7, 9], np.uint16), n)
    flat = np.zeros(3 * n, np.uint16)  # two words of history before each leaf
    flat[0::3], flat[1::3], flat[2::3] = 7, 9, leaf
    buckets = np.zeros(3 * n, np.uint16)
    buckets[0::3], buckets[1::3] = history[0::2], history[1::2]
    got = M.Scorer(w)(flat, buckets, np.arange(0, 3 * n, 3))
    assert (10 ** got[2::3]).sum() == pytest.approx(1, abs=1e-4)


def test_lm_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None)], "doc_id long, text string")
    assert len(M.lm_scores(docs).collect()) == 3
    assert M.lm_scores(docs.limit(0)).count() == 0
    held = spark.createDataFrame([(4, "a b")], "doc_id long, text string")
    assert zlib.crc32(b"4") % 5 != 1
    none = M.lm_scores(held, modulus=1, held_out=0).collect()  # nothing to learn from
    assert none[0]._base_score == 0 and none[0]._train_tokens == 0 and none[0]._n_known == 0 and none[0]._score < 0
