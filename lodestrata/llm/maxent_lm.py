"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

log P(text) is the sum over its tokens of log P(class | history) + log P(leaf |
class, history) + log P(word | leaf). There are CLASSES classes of LEAVES leaves.
The most frequent HEADS * LEAVES words have leaves of their own, by rank. All
other words, seen or not, share the leaves of the other classes: the class by a
hash of their last two bytes, the leaf by a hash of the whole word, and the word
there by its smoothed relative frequency, with one share for all that was never
seen. So the class and leaf factors are learned for every word, and the
probabilities of all words and of an unseen one in each shared leaf add up to
one for any history.

Features are hashed rows of weights: for the class the bias, the previous word
(n-gram), the one before it (skip) and both (n-gram); for the leaf the bias and
the previous word with the class (n-gram).

Texts become numbers once: a batch of documents is one row of a table, with the
64-bit hashes of its distinct words and a number for each token. Counts of all
words come from one shuffle of batches' counts. Training reads that table in
ROUNDS rounds, each with a share of all training documents: every task takes
AdaGrad steps (one step size a row) on its own copy of the weights; the changes are
averaged over the tasks, each row weighted by the tokens that used it, and the
squares that set the step sizes are summed and kept. There are as many tasks as
cores, so what they send grows with the cluster and not with the data; the
weights' size is fixed. Scoring is by sparse numpy batches: gathers of
exponentiated rows. Counts of rare words come to their batches by a join, never
a broadcast.

Defined results: a null or empty text is its end token alone. A row without an
id has crc32 remainder 0, so it is training text. Rows that repeat count and
are scored each. Words of equal count are ranked by hash. Texts and words may be
of any length. Without training text the base is 0 and the model gives each
shared leaf the same share. An empty table gives an empty one. Other columns of
the input, whatever their names, aren't returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, ship, tidy, written

CLASSES, LEAVES, HEADS = 64, 64, 48
OWN, TAIL = HEADS * LEAVES, CLASSES - HEADS
#: rows of weights: of a previous word (the first OFTEN ranks have their own), of a pair, of a previous word with a class
BUCKETS, OFTEN, PAIRS, NEAR = 8192, 4096, 16384, 16384
ROUNDS, STEP, STEP_TOKENS = 4, 1.0, 4096
#: weights stay within this, so that products of their exponentials are finite
MOST = 18.0
#: words whose counts are broadcast: the most frequent, and no more than this
HOT = 1 << 17
#: characters of a batch of documents; rows of a block of weights
BATCH, BLOCK = 16_000_000, 512
END = b"\n"
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_TABLES = {"one": BUCKETS, "skip": BUCKETS, "pair": PAIRS, "near": NEAR, "leaf": CLASSES, "class": 1}
_WIDE = 64
_ONES = np.ones(_WIDE, np.float32)


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, and one end."""
    out = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    out.append(END)
    return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k


def _kinds(words: list[bytes]) -> np.ndarray:
    """A number below TAIL from the last two bytes of each word."""
    flat = np.frombuffer(b"\0\0" + b"".join(words), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes) + 1
    before = np.where(sizes > 1, flat[end - 1], 0)
    return ((flat[end] * 251 + before * 7_919 >> 3) % TAIL).astype(np.uint8)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, round, text) as one row for some BATCH characters of documents."""
    numbers, codes, ids, rounds, size = _Numbers(), [], [], [], 0
    for b in batches:
        begin = 0
        for at in range(b.num_rows):
            words = tokens(b.column(2)[at].as_py())
            codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            size += 6 * len(words)
            if size >= BATCH or at + 1 == b.num_rows:
                ids.append(b.column(0).slice(begin, at + 1 - begin))
                rounds.append(b.column(1).slice(begin, at + 1 - begin))
                begin = at + 1
            if size >= BATCH:
                yield _row(numbers, codes, ids, rounds)
                numbers, codes, ids, rounds, size = _Numbers(), [], [], [], 0
    if codes:
        yield _row(numbers, codes, ids, rounds)


def _row(numbers: _Numbers, codes: list[np.ndarray], ids: list[pa.Array], rounds: list[pa.Array]) -> pa.RecordBatch:
    import xxhash

    whole, round_of = pa.concat_arrays(ids), pa.concat_arrays(rounds).to_numpy(zero_copy_only=False).astype(np.int8)
    sizes, flat = np.fromiter(map(len, codes), np.uint32, len(codes)), np.concatenate(codes)
    train = np.bincount(flat[np.repeat(round_of >= 0, sizes)], minlength=len(numbers)).astype(np.uint32)
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    packed = [pa.array([x.tobytes()], pa.binary()) for x in (round_of, sizes, words, _kinds(list(numbers)), flat, train)]
    own = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
    return pa.RecordBatch.from_arrays([own, *packed], ["ids", "rounds", "sizes", "words", "kinds", "codes", "train"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, kind and n of the training tokens of each batch of documents."""
    for b in batches:
        for words, kinds, train in zip(*(b.column(k) for k in range(3)), strict=True):
            n = np.frombuffer(train.as_py(), np.uint32)
            seen = np.flatnonzero(n)
            cols = (np.frombuffer(words.as_py(), np.int64)[seen], np.frombuffer(kinds.as_py(), np.uint8)[seen].astype(np.int32), n[seen].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["word", "kind", "n"])


def word_counts(coded: DataFrame) -> DataFrame:
    """word (64-bit hash), kind and n over all training tokens."""
    rows = coded.select("words", "kinds", "train").mapInArrow(tidy(_counted), "word long, kind int, n long")
    return rows.groupBy("word").agg(F.first("kind").alias("kind"), F.sum("n").alias("n"))


class Vocabulary:
    """The most frequent words, sorted by hash, with their ranks and counts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        by = np.lexsort((words, -counts))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        order = np.argsort(words)
        self.words, self.ranks, self.counts = words[order], rank[order], counts[order]

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks, -1 for words that aren't here, and counts."""
        if not len(self.words):
            return np.full(len(words), -1), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        here = self.words[at] == words
        return np.where(here, self.ranks[at], -1), np.where(here, self.counts[at], 0)


def _places(words: np.ndarray, kinds: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaf (its class in the upper bits) and bucket as a history of each word."""
    own = (ranks >= 0) & (ranks < OWN)
    h = words.view(np.uint64)
    shared = (HEADS + kinds.astype(np.int64)) * LEAVES + (h % np.uint64(LEAVES)).astype(np.int64)
    often = (ranks >= 0) & (ranks < OFTEN)
    hashed = OFTEN + (h >> np.uint64(20)) % np.uint64(BUCKETS - OFTEN - 1)
    return np.where(own, ranks, shared).astype(np.uint16), np.where(often, ranks, hashed.astype(np.int64)).astype(np.uint16)


def _features(leaf: np.ndarray, bucket: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of weights for each token; bucket BUCKETS - 1 stands before a text."""
    one, skip = np.full(len(bucket), BUCKETS - 1, np.uint16), np.full(len(bucket), BUCKETS - 1, np.uint16)
    one[1:] = bucket[:-1]
    one[starts] = BUCKETS - 1
    skip[2:] = bucket[:-2]
    skip[starts] = BUCKETS - 1
    after = starts + 1
    skip[after[after < len(bucket)]] = BUCKETS - 1
    kind, wide = leaf >> 6, one.astype(np.int64)
    pair = ((wide * 40_503 + skip.astype(np.int64) * 69_069 >> 3) % PAIRS).astype(np.uint16)
    near = ((wide * 1_291 + kind.astype(np.int64) * 52_711 >> 2) % NEAR).astype(np.uint16)
    return {"one": one, "skip": skip, "pair": pair, "near": near, "leaf": kind}


def _unigram(mass: np.ndarray) -> dict[str, np.ndarray]:
    """Weights of the smoothed frequencies, mass of each leaf, where training starts."""
    w = {n: np.zeros((k, _WIDE), np.float32) for n, k in _TABLES.items()}
    by_class = mass.reshape(CLASSES, LEAVES)
    w["class"][0] = np.maximum(np.log(by_class.sum(axis=1) / mass.sum()), -MOST)
    w["leaf"][:] = np.maximum(np.log(by_class / by_class.sum(axis=1, keepdims=True)), -MOST)
    return w


class Learner:
    """Weights, what they were at the start, squares of the gradients' rows, and tokens by row."""

    def __init__(self, weights: dict[str, np.ndarray], squares: dict[str, np.ndarray]):
        self.start, self.squares_before = weights, squares
        self.w = {n: x.copy() for n, x in weights.items()}
        self.squares = {n: x.copy() for n, x in squares.items()}
        self.used = {n: np.zeros(len(x), np.float32) for n, x in weights.items()}

    def _update(self, name: str, rows: np.ndarray, g: np.ndarray) -> None:
        order = np.argsort(rows, kind="stable")
        line = rows[order]
        cuts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
        # as complex numbers two weights are added at a time
        at, total = line[cuts], np.add.reduceat(g[order].view(np.complex64), cuts, axis=0).view(np.float32)
        self._step(name, at, total, np.diff(cuts, append=len(rows)))

    def _step(self, name: str, at: np.ndarray, total: np.ndarray, used: np.ndarray | int) -> None:
        self.used[name][at] += used
        now = self.squares[name][at] + np.einsum("ij,ij->i", total, total)
        self.squares[name][at] = now
        total *= (-STEP / np.sqrt(now + 1.0))[:, None]
        self.w[name][at] += total

    def learn(self, leaf: np.ndarray, bucket: np.ndarray, starts: np.ndarray) -> None:
        """Steps over the tokens of some documents."""
        f, w = _features(leaf, bucket, starts), self.w
        for a in range(0, len(leaf), STEP_TOKENS):
            part = {n: x[a : a + STEP_TOKENS] for n, x in f.items()}
            kind, word = part["leaf"], leaf[a : a + STEP_TOKENS] & 63
            each = np.arange(len(kind))
            z = w["one"][part["one"]]
            z += w["skip"][part["skip"]]
            z += w["pair"][part["pair"]]
            z += w["class"][0]
            y = w["near"][part["near"]]
            y += w["leaf"][kind]
            for x, right in ((z, kind), (y, word)):
                np.exp(x, out=x)
                x *= (1 / (x @ _ONES))[:, None]
                x[each, right] -= 1
            for name in ("one", "skip", "pair"):
                self._update(name, part[name], z)
            self._step("class", np.zeros(1, np.int64), (np.ones(len(z), np.float32) @ z)[None], len(z))
            self._update("near", part["near"], y)
            self._update("leaf", kind, y)
        for x in w.values():
            np.clip(x, -MOST, MOST, out=x)

    def changes(self) -> Iterator[tuple[str, bytes, bytes, bytes]]:
        """Blocks of rows: tokens, squares added, and changes times tokens, for the rows that were used."""
        for n, x in self.w.items():
            for a in range(0, len(x), BLOCK):
                s = slice(a, a + BLOCK)
                if self.used[n][s].any():
                    change = (x[s] - self.start[n][s]).astype("<f2")
                    yield f"{n}:{a}", self.used[n][s].tobytes(), (self.squares[n][s] - self.squares_before[n][s]).tobytes(), change.tobytes()


def _documents(sizes: np.ndarray, chosen: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the chosen documents, some 100,000 at a time, and where each document starts."""
    ends = np.cumsum(sizes)
    cuts = [0, *np.unique(np.searchsorted(ends, np.arange(100_000, ends[-1], 100_000)) + 1).tolist(), len(sizes)]
    for a, z in pairwise(cuts):
        own, base = sizes[a:z], ends[a] - sizes[a] if a < z else 0
        if not chosen[a:z].any():
            continue
        part = codes[base : ends[z - 1]][np.repeat(chosen[a:z], own)]
        kept = own[chosen[a:z]]
        yield part, np.cumsum(kept) - kept


def trained(coded: DataFrame, vocabulary, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """weights after ROUNDS rounds over the training documents."""
    sc = coded.sparkSession.sparkContext
    squares = {n: np.zeros(len(x), np.float32) for n, x in weights.items()}
    for number in range(ROUNDS):
        start = sc.broadcast((weights, squares))

        def learn(batches: Iterator[pa.RecordBatch], start=start, number=number) -> Iterator[pa.RecordBatch]:
            learner = Learner(*start.value)
            for b in batches:
                for rounds, sizes, words, kinds, codes in zip(*(b.column(k) for k in range(5)), strict=True):
                    chosen = np.frombuffer(rounds.as_py(), np.int8) == number
                    if not chosen.any():
                        continue
                    hashes = np.frombuffer(words.as_py(), np.int64)
                    leaf, bucket = _places(hashes, np.frombuffer(kinds.as_py(), np.uint8), vocabulary.value.look_up(hashes)[0])
                    for part, starts in _documents(np.frombuffer(sizes.as_py(), np.uint32).astype(np.int64), chosen, np.frombuffer(codes.as_py(), np.uint32)):
                        learner.learn(leaf[part], bucket[part], starts)
            cols = list(zip(*learner.changes(), strict=True))
            for k in range(0, len(cols[0]) if cols else 0, 16):
                rows = [pa.array(c[k : k + 16], t) for c, t in zip(cols, (pa.string(), *[pa.binary()] * 3), strict=True)]
                yield pa.RecordBatch.from_arrays(rows, ["block", "used", "squares", "change"])

        def mean(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            used = added = total = 0
            for b in batches:
                for u, q, c in zip(*(b.column(k) for k in (1, 2, 3)), strict=True):
                    n = np.frombuffer(u.as_py(), np.float32)
                    change = np.frombuffer(c.as_py(), "<f2").reshape(len(n), _WIDE).astype(np.float64)
                    used, added, total = used + n.astype(np.float64), added + np.frombuffer(q.as_py(), np.float32), total + change * n[:, None]
            out = (total / np.maximum(used, 1)[:, None]).astype("<f4")
            cols = [pa.array([key[0].as_py()]), pa.array([out.tobytes()], pa.binary()), pa.array([np.asarray(added, "<f4").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["block", "change", "squares"])

        rows = coded.select("rounds", "sizes", "words", "kinds", "codes").coalesce(max(1, sc.defaultParallelism))
        blocks = rows.mapInArrow(tidy(learn), "block string, used binary, squares binary, change binary").groupBy("block")
        weights, squares = {n: x.copy() for n, x in weights.items()}, {n: x.copy() for n, x in squares.items()}
        for r in blocks.applyInArrow(mean, "block string, change binary, squares binary").collect():  # as many blocks as the weights have
            name, at = r.block.split(":")
            change = np.frombuffer(r.change, "<f4").reshape(-1, _WIDE)
            s = slice(int(at), int(at) + len(change))
            weights[name][s] += change
            squares[name][s] += np.frombuffer(r.squares, "<f4")
        start.destroy()
    return weights


class Scorer:
    """log10 probabilities from exponentiated weights."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.e = {n: np.exp(x) for n, x in weights.items()}

    def __call__(self, leaf: np.ndarray, bucket: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each token, that of its leaf, by class and history."""
        f, e, out = _features(leaf, bucket, starts), self.e, np.empty(len(leaf))
        for a in range(0, len(leaf), STEP_TOKENS):
            part = {n: x[a : a + STEP_TOKENS] for n, x in f.items()}
            kind, word = part["leaf"], leaf[a : a + STEP_TOKENS] & 63
            each = np.arange(len(kind))
            z = e["one"][part["one"]]
            z *= e["skip"][part["skip"]]
            z *= e["pair"][part["pair"]]
            z *= e["class"][0]
            y = e["near"][part["near"]]
            y *= e["leaf"][kind]
            p = (z[each, kind] / (z @ _ONES)).astype(np.float64) * (y[each, word] / (y @ _ONES))
            out[a : a + STEP_TOKENS] = np.log10(p)
        return out


def _level() -> str:
    """SQL: a word's level by its count n; exact below 1,024, and of bounded number."""
    return "if(n < 1024, n, 384 + cast(floor(log2(n) * 64) as bigint))"


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Words and counts of all levels down to one, at most HOT words; that level."""
    levels = sorted(((r.level, r["count"]) for r in counts.groupBy(F.expr(_level()).alias("level")).count().collect()), reverse=True)  # bounded
    least, size = (levels[0][0] + 1 if levels else 1), 0
    for level, n in levels:
        if size + n > HOT:
            break
        least, size = level, size + n
    rows = counts.where(f"{_level()} >= {least}").select("word", "n").toArrow()  # at most HOT
    return rows.column("word").to_numpy().astype(np.int64), rows.column("n").to_numpy().astype(np.int64), least


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, held_out: int = 1) -> DataFrame:
    """_id, _held_out, _n_tokens, _n_known, _train_tokens, _base_score and _score of each row."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    ship(spark)
    share = F.when(remainder(F.col(id_col), modulus) == held_out, -1).otherwise(F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(ROUNDS)))
    idk = docs.schema[id_col].dataType.simpleString()
    schema = f"ids array<{idk}>, rounds binary, sizes binary, words binary, kinds binary, codes binary, train binary"
    rows = docs.select(F.col(id_col).alias("_id"), share.cast("int").alias("_round"), F.col(text_col).alias("_text")).mapInArrow(tidy(_coded), schema)
    # written once, so a batch keeps its number whatever is lost later
    coded = written(rows.withColumn("_batch", F.monotonically_increasing_id()), "tokens")
    counts = written(word_counts(coded), "counts")
    words, of, least = _most_frequent(counts)
    vocabulary = sc.broadcast(Vocabulary(words, of))
    first = np.sort(words[np.lexsort((words, -of))[:OWN]])
    own = sc.broadcast(first)
    mass = np.full(CLASSES * LEAVES, 1e-6)
    mass[: len(first)] = np.sort(of)[::-1][: len(first)] + 0.5
    mass[OWN:] = 0.5

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(CLASSES * LEAVES, np.int64), np.zeros(CLASSES * LEAVES, np.int64)
        total = distinct = 0
        for b in batches:
            word, kind, c = (b.column(k).to_numpy() for k in range(3))
            total, distinct = total + int(c.sum()), distinct + len(c)
            rest = ~np.isin(word, own.value)
            at = _places(word[rest], kind[rest], np.full(int(rest.sum()), -1))[0].astype(np.int64)
            np.add.at(n, at, c[rest])
            v += np.bincount(at, minlength=len(v))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(n)), -1)), pa.array(np.append(n, total)), pa.array(np.append(v, distinct))], ["leaf", "n", "v"])

    sums = counts.select("word", "kind", "n").mapInArrow(tidy(leaves), "leaf long, n long, v long").groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    n = v = 0
    for r in sums.where("v > 0").collect():  # at most a row a leaf
        if r.leaf < 0:
            n, v = r.n, r.v
        else:
            mass[r.leaf] = r.n + 0.5 * (r.v + 1)
    weights = sc.broadcast(trained(coded, vocabulary, _unigram(mass)))
    base, log_mass = float(np.log10(n + 0.5 * (v + 1))), np.log10(mass)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for batch, own_words in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                hashes = np.frombuffer(own_words.as_py(), np.int64)
                at = np.flatnonzero(vocabulary.value.look_up(hashes)[0] < 0)
                cols = [pa.array(np.full(len(at), batch)), pa.array(at.astype(np.int32)), pa.array(hashes[at])]
                yield pa.RecordBatch.from_arrays(cols, ["_batch", "at", "word"])

    asked = coded.select("_batch", "words").mapInArrow(tidy(rare), "_batch long, at int, word long")
    known = counts.where(f"{_level()} < {least}").select("word", "n")
    found = asked.join(known, "word").groupBy("_batch").agg(F.collect_list(F.struct("at", "n")).alias("found"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights.value)
        for b in batches:
            for k in range(b.num_rows):
                ids = b.column(0)[k].values
                rounds, sizes, hashes, kinds, codes = (np.frombuffer(b.column(j)[k].as_py(), t) for j, t in ((1, "i1"), (2, "<u4"), (3, "<i8"), (4, "u1"), (5, "<u4")))
                ranks, c = vocabulary.value.look_up(hashes)
                more = b.column(6)[k]
                if more.is_valid and len(more.values):
                    c = c.copy()
                    c[more.values.field(0).to_numpy()] = more.values.field(1).to_numpy()
                leaf, bucket = _places(hashes, kinds, ranks)
                unigram, in_leaf, seen = np.log10(c + 0.5), np.zeros(len(c)), (c > 0).astype(np.int64)
                shared = leaf >= OWN
                in_leaf[shared] = unigram[shared] - log_mass[leaf[shared]]
                done = 0
                for part, starts in _documents(sizes.astype(np.int64), np.ones(len(sizes), bool), codes):
                    model = np.add.reduceat(scorer(leaf[part], bucket[part], starts) + in_leaf[part], starts)
                    many, s = np.diff(starts, append=len(part)), slice(done, done + len(starts))
                    cols = [
                        ids.slice(done, len(starts)), pa.array(rounds[s] < 0), pa.array(many.astype(np.int64)), pa.array(np.add.reduceat(seen[part], starts)),
                        pa.array(np.add.reduceat(unigram[part], starts) - many * base), pa.array(model),
                    ]
                    done += len(starts)
                    yield pa.RecordBatch.from_arrays(cols, ["_id", "_held_out", "_n_tokens", "_n_known", "_base_score", "_score"])

    whole = coded.join(found, "_batch", "left").select("ids", "rounds", "sizes", "words", "kinds", "codes", "found")
    out = whole.mapInArrow(tidy(score), f"_id {idk}, _held_out boolean, _n_tokens long, _n_known long, _base_score double, _score double")
    return out.select("_id", "_held_out", "_n_tokens", "_n_known", F.lit(n).cast("long").alias("_train_tokens"), "_base_score", "_score")
