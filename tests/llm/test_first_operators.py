"""Line and substring dedup, SimHash, packing, quality and URL filters against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lodestrata.llm import line_dedup as L
from lodestrata.llm import packing as K
from lodestrata.llm import quality as Q
from lodestrata.llm import simhash as S
from lodestrata.llm import substring_dedup as D
from lodestrata.llm import url_filters as U

DOCS = "doc_id long, text string, _id string, _drop int"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "x", 1) for i, t in enumerate(texts)], DOCS)


def corpus(rng, n=60):
    words = [f"w{i}" for i in range(400)] + ["É", "naïve", "ÉTÉ", "b\u00a0c"]
    passages = [" ".join(rng.choices(words, k=rng.randint(15, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 50))) for _ in range(rng.randint(1, 4))]
        parts += rng.sample(passages, rng.randint(0, 3))
        rng.shuffle(parts)
        texts.append(rng.choice(["\n", " ", "\t"]).join(parts))
    return texts + [None, "", " \n ", texts[0], texts[0], "w1 " * 300]


def brute_lines(docs, least=40, many=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(ASCII)
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    gone = {k: max(v) for k, v in held.items() if len(k) >= least and len(v) >= many}
    return {i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in docs}


def test_line_dedup(spark):
    rng = random.Random(3)
    line = ["Ärger mit der ZEILE, die sich oft wiederholt und lang ist", "x" * 39, "y" * 40, "ärger MIT der zeile, die sich oft wiederholt und lang ist"]
    texts = ["\n".join(rng.choices(line + ["a", "", "  " + line[2] + "\t", line[0].lower()], k=rng.randint(0, 7))) for _ in range(40)] + [None, ""]
    got = {r.doc_id: r.text or "" for r in L.line_dedup(frame(spark, texts)).collect()}
    assert got == brute_lines(list(enumerate(texts)))


def test_line_dedup_edges(spark):
    x = "z" * 50
    docs = spark.createDataFrame([(1, x), (1, x), (2, x), (3, x), (4, x), (None, x)], "doc_id long, text string")
    assert {r.text for r in L.line_dedup(docs).collect()} == {x}  # four documents only
    more = docs.union(spark.createDataFrame([(5, x)], "doc_id long, text string"))
    got = sorted((r.doc_id or 0, r.text) for r in L.line_dedup(more).collect())
    assert got == [(0, x), (1, ""), (1, ""), (2, ""), (3, ""), (4, ""), (5, x)]
    assert L.line_dedup(docs.limit(0)).count() == 0


def brute_windows(docs, size=20):
    seen, out = {}, {}
    rows = sorted(docs)
    for i, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - size + 1):
            seen.setdefault(tuple(w[s : s + size]), (i, s))
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s : s + size])] != (i, s):
                gone |= set(range(s, s + size))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    texts = corpus(random.Random(seed))
    rows = D.substring_dedup(frame(spark, texts).repartition(3), count=True).collect()
    want = brute_windows([(i, t or "") for i, t in enumerate(texts)])
    assert {r.doc_id: (r._n_words, r._n_removed, r.text or "") for r in rows} == want
    assert rows[0]._id == "x"


def test_substring_dedup_edges(spark):
    a = " ".join(f"a{i}" for i in range(25))
    docs = spark.createDataFrame([(1, a), (1, a), (None, a), (2, a + " b")], "doc_id long, text string")
    got = sorted((r.doc_id or 9, r._n_removed) for r in D.substring_dedup(docs, count=True).collect())
    assert got == [(1, 0), (1, 0), (2, 25), (9, 25)]
    assert D.substring_dedup(docs.limit(0)).count() == 0


def test_cover_is_a_difference_cover():
    assert {(a - b) % D.PERIOD for a in D.COVER for b in D.COVER} == set(range(D.PERIOD))


def test_masks_cover_every_pair():
    rng = random.Random(5)
    masks = S.masks(3)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not diff & m for m in masks)


def brute_fingerprint(text):
    import xxhash

    w = (text or "").translate(ASCII).encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=3):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_components(spark):
    texts = corpus(random.Random(7)) + ["one two", "One two", "ONE"]
    got = {r._id: (r._fp & (1 << 64) - 1, r._component) for r in S.simhash_components(frame(spark, texts).drop("_id", "_drop")).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == fps
    assert [got[i][1] for i in range(len(texts))] == brute_components(fps)


def test_links_of_chains_and_dense_groups(spark):
    rng = random.Random(11)
    fps = [rng.getrandbits(64)]
    for _ in range(120):
        base = rng.choice(fps)
        fps.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    for _ in range(60):
        fps.append(rng.getrandbits(64))
    fps = list(dict.fromkeys(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "_fp long")
    for heavy in (20_000, 3):
        roots = {r._node: r._root for r in S.components(S.links(nodes, heavy=heavy)).collect()}
        groups, want = defaultdict(set), defaultdict(set)
        for x, c in zip(signed, brute_components(fps), strict=True):
            want[c].add(x)
            groups[roots.get(x, x)].add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_forest_by_flips_equals_blocks():
    rng = random.Random(13)
    fps = np.array(list({rng.getrandbits(14) for _ in range(5000)}), np.uint64)
    free = (1 << 14) - 1
    many = S.forest(fps, 2, free)
    assert len(many) == len(fps) - len(set(brute_labels(fps, many)))
    a = S._Union(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 2).tolist():
            a.join(i, i + 1 + j)
    assert len({a.find(i) for i in range(len(fps))}) == len(fps) - len(many)


def brute_labels(fps, links):
    at = {int(x): i for i, x in enumerate(fps)}
    u = S._Union(len(fps))
    for a, b in links:
        u.join(at[a], at[b])
    return [u.find(i) for i in range(len(fps))]


def test_near_dedup_keeps_one_of_each_group(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "A b c d"), (3, "other words here now"), (None, "a b c d"), (4, None), (5, "")], "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in S.near_dedup(docs).collect()) == [0, 1, 3, 4]
    assert S.near_dedup(docs.limit(0)).count() == 0


TOKENIZER = "word_bpe_49k.json"


def test_packing(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    texts = corpus(random.Random(17)) + ["it's 'sabc O'Clock ΑΣ İx \x1c a\x85b 漢字 e\u0301", "w5 " * 9000]
    rows = K.pack_documents(frame(spark, texts).drop("_id", "_drop"), P.path(TOKENIZER)).collect()
    t = Tokenizer.from_file(P.path(TOKENIZER))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r._id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // 4096)))
        for r in parts:
            own = ids[r.start : r.start + r.length]
            assert r.start == 4096 * r.piece and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        assert sum(r.length for r in parts) == len(ids)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by_seq) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_packing_in_rounds(spark):
    rng = random.Random(19)
    parts = spark.createDataFrame([(i, 0, 0, min(4096, int(rng.lognormvariate(6, 1.3)) + 1), 0) for i in range(9000)], "_id long, piece int, start long, length long, ids_crc32 long")
    rows = K.packed(parts).collect()
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert sorted(r._id for r in rows) == list(range(9000))
    assert all(sum(n for _, n in v) <= 4096 for v in by_seq.values())
    assert len(by_seq) <= 1.005 * sum(r.length for r in rows) / 4096 + 1
    assert K.packed(parts.limit(0)).count() == 0


def test_quality(spark):
    rng = random.Random(23)
    texts = [" ".join(f"w{rng.randint(0, 200)}" + ("" if i % 3 else "!!") for _ in range(rng.randint(3, 60))) for i in range(600)] + [None, ""]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = Q.quality_scores(docs, labels).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.doc_id < 600]
    assert len(rows) == 602 and len(held) > 100
    assert np.mean([r._predicted == int(bool(r.doc_id % 3)) for r in held]) > 0.95
    assert len({r._score for r in rows if r.doc_id >= 600}) == 1
    assert {r._score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.quality_scores(docs.limit(0), labels).count() == 0


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    host = host.translate(ASCII)
    fits = [(len(h) + len(p), len(h), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2] + best[3], best[4] if best else "allow"


def test_url_filters(spark):
    rng = random.Random(29)
    hosts = ["com", "Example.com", "www.example.com", "a.www.example.com", "xexample.com", "net", "b.net", "example.com.net", "com.", ".com", "", "example.com:80", "exämple.com"]
    paths = ["", "/", "/en/", "/en", "/es/x?y", "/fr/#z", "?q=/en/", "#/en/", "/EN/"]
    urls = [rng.choice(["http://", "HTTPS://", "", "x://y://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(400)] + [None, "", "no scheme", "://"]
    pages = spark.createDataFrame([(i, u, "html", 1) for i, u in enumerate(urls)], "page_id long, url string, _host string, _row int")
    for rules in (U.RULES, (*U.RULES, ("example.com", "/", "block"), ("example.com", "/en/x", "block"), ("www.example.com", "/", "allow"), ("com", "/en/", "block")), ()):
        got = {r[0]: tuple(r[4:]) for r in U.url_filter(pages, rules).collect()}
        assert got == {i: brute_url(u, rules) for i, u in enumerate(urls)}
    assert U.url_filter(pages.limit(0)).count() == 0
