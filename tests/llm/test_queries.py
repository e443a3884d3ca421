"""Each contract query over small tables: names, digests and brute force."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from lodestrata.llm import packing as K
from lodestrata.llm import quality as Q
from lodestrata.llm.queries import QUERIES

COLUMNS = {
    "op1_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2_simhash_near_dedup": "doc_id fingerprint component_id",
    "op3_nearest_neighbours": "query_id rank vec_id score",
    "op4_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op6_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op7_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op8_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_quality_classifier": "doc_id held_out score predicted",
    "op10_url_filters": "page_id host path rule verdict",
}


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root, rng = str(tmp_path_factory.mktemp("sf")), random.Random(5)
    line = "a line that repeats in many documents, long enough"
    texts = ["\n".join([" ".join(f"w{rng.randint(0, 400)}" for _ in range(30)), line if i % 2 else "short"]) for i in range(24)] + [None, "", "É naïve 漢字 🙂 x"]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)] + [(200, None), (250, [0.0] * 8), (300, [math.nan] * 8), (350, [1e200] * 8), (400, [-1e-200] + [1e-300] * 7)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").write.parquet(f"{root}/embeddings.parquet")
    urls = ["http://WWW.Example.com/en/a?q", "https://example.com/en/", "x://a.net/fr/b#c", "http://net/es", None, "none", "http://" + "a." * 500 + "com/" + "p" * 5000]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{root}/pages.parquet")
    return root, texts, vectors, urls


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, tables, name):
    df = QUERIES[name](spark, tables[0])
    assert df.columns == COLUMNS[name].split()
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in df.columns if c in ("n_tokens", "n_known", "train_tokens", "n_lines", "n_dropped", "n_words", "n_removed", "n_chars", "query_id", "vec_id", "start", "length", "ids_crc32", "sequence_id", "offset"))
    assert all(kinds[c] == "int" for c in df.columns if c in ("rank", "piece", "predicted"))


def rows_of(spark, tables, name):
    return QUERIES[name](spark, tables[0]).collect()


def test_bpe_digests(spark, tables):
    import public_tokenizers as P
    import tiktoken

    from lodestrata.llm.byte_bpe import read_ranks

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in rows_of(spark, tables, "op4_byte_bpe"):
        text = tables[1][r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text))


def test_simhash_digits(spark, tables):
    for r in rows_of(spark, tables, "op2_simhash_near_dedup"):
        w = (tables[1][r.doc_id] or "").encode().lower().split()
        parts = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        ones = [sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) for b in range(64)]
        assert r.fingerprint == f"{sum(1 << b for b in range(64) if 2 * ones[b] > len(parts)):016x}"


def test_neighbours_against_brute_force(spark, tables):
    ids = np.array([i for i, v in tables[2] if v and np.isfinite(v).all() and np.any(v)])
    x = np.array([v for i, v in tables[2] if i in set(ids.tolist())])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    got = {}
    for r in rows_of(spark, tables, "op3_nearest_neighbours"):
        assert math.isfinite(r.score)
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 50 == 0}
    hits = 0
    for q, rows in got.items():
        near = x @ x[ids.tolist().index(q)]
        best = sorted((-s, i) for s, i in zip(near.tolist(), ids.tolist(), strict=True) if i != q)[:5]
        assert [r[0] for r in sorted(rows)] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in best} & {r[1] for r in rows})
        assert all(s == pytest.approx(near[ids.tolist().index(i)], abs=1e-9) for _, i, s in rows)
    assert hits >= 0.9 * 5 * len(got)


def test_fingerprint_digests(spark, tables):
    texts = [t or "" for t in tables[1]]
    for r in rows_of(spark, tables, "op7_document_fingerprints"):
        t, nxt = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        q = len(t) // 4
        assert r.edited_sha256 == sha(t[: len(t) - q] + nxt[:q]) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_packing_digests(spark, tables):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    used = {}
    for r in rows_of(spark, tables, "op8_best_fit_packing"):
        ids = [*tokenizer.encode(tables[1][r.doc_id] or "", add_special_tokens=False).ids, 1]
        part = ids[r.start : r.start + 4096]
        assert (r.piece, r.length, r.ids_crc32) == (r.start // 4096, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_url_verdicts(spark, tables):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows_of(spark, tables, "op10_url_filters")}
    assert got[0] == ("www.example.com", "/en/a", "www.example.com/en/", "allow") and got[1] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[2] == ("a.net", "/fr/b", "net/fr/", "block") and got[3] == ("net", "/es", None, "allow") and got[4] == got[5] == ("", "", None, "allow")
    assert got[6][2] == "com/" and len(got[6][1]) == 5001


def fewest(sizes, capacity):
    """By trying all: the least number of bins, over subsets."""
    n = len(sizes)
    best = {0: (0, 0)}  # items used: bins closed, load of the last
    for mask in range(1, 1 << n):
        found = (n + 1, 0)
        for i in range(n):
            if mask >> i & 1:
                bins, load = best[mask ^ 1 << i]
                found = min(found, (bins, load + sizes[i]) if bins and load + sizes[i] <= capacity else (bins + 1, sizes[i]))
        best[mask] = found
    return best[(1 << n) - 1][0]


def test_packing_of_small_sets_is_exact():
    rng = random.Random(3)
    for seed in range(60):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 9))]
        bins = K.evolved(sizes, 100, seed)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and max(K.loads_of(sizes, bins)) <= 100
        assert len(bins) == fewest(sizes, 100)


def test_evolution_beats_best_fit_on_tight_sizes():
    rng, sizes = random.Random(4), []
    for _ in range(100):  # triples that fill a sequence
        a, b = rng.randint(1000, 1800), rng.randint(1000, 1500)
        sizes += [a, b, 4096 - a - b]
    alone = K.best_fit(sizes, sorted(range(300), key=lambda i: -sizes[i]), 4096)
    assert len(K.evolved(sizes, 4096, 1)) < len(alone) - 3


def test_other_tokenizer_files_use_the_tokenizer(tmp_path):
    import json

    import public_tokenizers as P
    from tokenizers import Tokenizer

    settings = json.load(open(P.path("word_bpe_49k.json"), encoding="utf-8"))
    assert K.by_words(settings)
    settings["normalizer"]["normalizers"] = settings["normalizer"]["normalizers"][:2]  # without lower case
    path = str(tmp_path / "other.json")
    json.dump(settings, open(path, "w", encoding="utf-8"))
    assert not K.by_words(settings)
    text = "Some Words, AND 123 more"
    assert np.frombuffer(K.encoder(path).document(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_ftrl_against_a_dense_loop():
    rng = random.Random(6)
    docs = [(" ".join(rng.choice(["good", "fine", "text", "junk!!", "x1"]) for _ in range(rng.randint(0, 12))), rng.randint(0, 1)) for _ in range(25)]
    z, n = {}, {}
    alpha, beta, l1, l2 = 0.5, 1.0, 1e-4, 1e-4

    def weight(i):
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(3):
        for text, y in docs:
            f = Q.features(text).tolist()
            x = {i: np.float32(f.count(i) * Q.SCALE / len(f)) for i in set(f)} | {2**Q.BITS: np.float32(1)}
            p = 1 / (1 + math.exp(-sum(weight(i) * float(v) for i, v in x.items())))
            for i, v in x.items():
                w, g = weight(i), (p - y) * float(v)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * w
                n[i] = n.get(i, 0.0) + g * g
    got = Q.ftrl([(Q.sparse(Q.features(t)), y) for t, y in docs])
    assert np.count_nonzero(got) <= len(z)
    assert all(got[i] == pytest.approx(weight(i), abs=1e-5) for i in z)


def test_quality_names_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "a " * 50_000, 7, 8), (1, "a " * 50_000, 7, 8), (2, None, 7, 8)], "doc_id long, text string, _score int, _predicted int")
    labels = spark.createDataFrame([(2, 1), (None, 1), (1, None)], "doc_id long, quality int")
    out = Q.quality_scores(docs, labels)
    assert out.columns == [*docs.columns, "__score", "__predicted"]
    rows = out.collect()
    assert {(r._score, r._predicted) for r in rows} == {(7, 8)} and len({r["__score"] for r in rows if r.doc_id == 1}) == 1
