"""LM scoring, nearest neighbours, byte BPE and fingerprints against brute force; the pipeline end to end."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lodestrata.llm import ann as A
from lodestrata.llm import byte_bpe as B
from lodestrata.llm import fingerprints as G


def corpus(rng, n=80):
    words = [f"w{i}" for i in range(120)] + ["É", "naïve", "ÉTÉ", "b c", "NOW"]
    texts = []
    for _ in range(n):
        at, out = rng.randrange(len(words)), []
        for _ in range(rng.randint(0, 120)):
            at = (at * 7 + rng.randrange(4)) % len(words)  # the next word depends on this one
            out.append(words[at])
        texts.append(rng.choice([" ", "\n"]).join(out))
    return texts + [None, "", " \n "]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _id string")


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 16)) + 3 * rng.normal(size=(8, 16))[rng.integers(0, 8, 1200)]
    x[700] = x[600] = x[650]  # ties
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0]), (5200, [None] * 16), (None, [1.0] * 16)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in sorted(A.nearest_neighbours(vectors).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    assert sorted(got) == list(range(0, 1200, 50))
    for q, found in got.items():
        assert len(found) == 5 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        near = u @ u[q]
        near[q] = -9
        for v, s in found:
            assert s == pytest.approx(near[v], abs=1e-12)
        hit += len({v for v, _ in found} & set(np.argsort(-near, kind="stable")[:5].tolist()))
    assert hit >= 0.9 * 5 * len(got)
    assert [v for v, _ in got[600]][:2] == [650, 700]
    assert A.nearest_neighbours(vectors.limit(0)).count() == 0
    few = A.nearest_neighbours(vectors.where("vec_id < 3")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_traversal_is_by_summed_distance():
    rng = np.random.default_rng(7)
    a, b, n = rng.random(9), rng.random(7), rng.integers(0, 3, (9, 7))
    got = list(A.traverse(a, b, n))
    sums = [a[i] + b[j] for i, j, _ in got]
    assert sums == sorted(sums) and {(i, j) for i, j, _ in got} == {(i, j) for i in range(9) for j in range(7) if n[i, j]} and got[-1][2] == n.sum()


def test_byte_bpe(spark):
    import public_tokenizers as P
    import tiktoken

    ranks = B.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    texts = corpus(random.Random(9), 20) + ["it's  12\n\n x \t", "a\x1cb \x1c  x", "z" * 300 + " " + "ab" * 700 + " é 　漢字🙂", "ａ́ ²½ _x_"]
    rows = {r.doc_id: r for r in B.encode(frame(spark, texts), ranks, P.PATTERN).collect()}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, t in enumerate(texts):
        assert np.frombuffer(rows[i]._ids, "<u4").tolist() == own.encode_ordinary(t or "")
        assert bytes(rows[i]._decoded) == (t or "").encode() == B.decode_ids(rows[i]._ids, ranks)
    assert rows[0]._id == "x"
    assert B.encode(frame(spark, texts).limit(0), ranks, P.PATTERN).count() == 0
    for few in (["once"], [None], ["", None]):
        assert [bytes(r._decoded) for r in B.encode(frame(spark, few), ranks, P.PATTERN).collect()] == [(t or "").encode() for t in few]


def pieces(text):
    return set(re.findall("[^\n]{1,%d}" % G.LONG, text))


def test_fingerprints(spark):
    rng = random.Random(11)
    texts = ["\n".join(" ".join(f"w{rng.randint(0, 9**5)}" for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 30))) for _ in range(60)] + [None, "", "é" * 500, "same", "same", "ab " * 4000]
    rng.shuffle(texts)
    ids = sorted(rng.sample(range(5_000_000), len(texts)))
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, _row int").repartition(5)
    rows = {r.doc_id: r for r in G.document_fingerprints(docs).collect()}
    plain = [t or "" for t in texts]
    prints = defaultdict(set)
    for k, i in enumerate(ids):
        t, nxt = plain[k], plain[(k + 1) % len(plain)]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        r = rows[i]
        assert (r._n_chars, r._edited, r.text, r._row) == (len(t), edited, texts[k], 1)
        for near, other in ((r._near_edited, edited), (r._near_next, nxt)):
            a, b = pieces(t), pieces(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        prints[t].add(r._fingerprint)
    assert all(len(v) == 1 for v in prints.values()) and len({next(iter(v)) for v in prints.values()}) == len(prints)


def test_fingerprints_of_many_paragraphs(spark):
    """Thousands of different lines, some in common: exact, and in time in proportion."""
    lines = [f"line {i} {i * 7919 % 10007}" for i in range(30_000)]
    texts = ["\n".join(lines[a:b]) for a, b in ((0, 20_000), (5_000, 25_000), (10_000, 11_500), (10_000, 30_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in G.document_fingerprints(docs).collect()}
    for k, t in enumerate(texts):
        nxt = texts[(k + 1) % 4]
        for near, other in ((rows[k]._near_edited, t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]), (rows[k]._near_next, nxt)):
            a, b = pieces(t), pieces(other)
            assert near == pytest.approx(len(a & b) / len(a | b))


def test_fingerprint_edges(spark):
    wide = spark.createDataFrame([(1, "x", 1, 2, 3), (2, "y", 4, 5, 6)], "doc_id long, text string, _edited int, _row int, _n_chars int")
    names = ("a", "b", "c", "d", "e", "f")
    assert G.document_fingerprints(wide, names=names).columns == [*wide.columns, *names]
    assert sorted((r._edited, r._row, r._n_chars, r.a) for r in G.document_fingerprints(wide, names=names).collect()) == [(1, 2, 3, 1), (4, 5, 6, 1)]
    one = spark.createDataFrame([(3, "abcd")], "doc_id long, text string")
    r = G.document_fingerprints(one).first()
    assert r._edited == "abca" and r._near_next == 1.0
    rows = spark.createDataFrame([(None, "xyzw"), (2, "abcd"), (2, "abcd")], "doc_id long, text string")
    assert sorted(r._edited for r in G.document_fingerprints(rows).collect()) == ["abca", "abcx", "xyza"]
    assert G.document_fingerprints(one.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(13)
    shared = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randint(0, 9**6)}" for _ in range(80)) + (" " + shared if i % 9 == 0 else "") for i in range(300)]
    texts[7] = texts[3]
    junk = [" ".join(f"w{rng.randint(0, 9**6)}!!" for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts + junk)], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 300), 0) for i in range(360)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = docs
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, at, str(tmp_path))
        assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
    left = {r.doc_id: r.text for r in at.collect()}
    assert set(left) == set(range(300)) - {7}
    assert sum(shared in t for t in left.values()) == 1
    rows = C.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(left)
    assert hashlib.sha256(left[0].encode()).hexdigest() == hashlib.sha256(texts[0].encode()).hexdigest()
