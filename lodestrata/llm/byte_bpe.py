"""Byte-level BPE: encoding and decoding by a rank file.

Documents are cut by the vocabulary's pattern in Arrow batches. Each batch
becomes one row: the distinct pieces that are no token themselves and are new to
the task, as arrays of the ids of their bytes, and each document as numbers of pieces.
Both Arrow steps number a task's pieces alike, up to KEPT, and then begin anew, so
rows are small and a piece is merged about once a task. Merging is
Spark's: a higher-order function folds ranked merges over each distinct piece.
The rank map is one literal, from the ids of two neighbours to the id, which is
the rank, of both together (row displacement: the entry for (l, r) is at
start[l] + r and names l). The fold's state has a number for each part: the rank
of its pair with the next part, and its own id below that; so the least number is
the next merge, and its first place the leftmost. A second Arrow step looks the
numbers up and concatenates ids; decoding concatenates the ids' byte strings.

Nothing is shuffled: the pieces of a batch are merged where it was read. Pieces
that are frequent in a few of the table's partitions (SAMPLE documents at most,
from PARTS partitions) are merged once (at most HOT of them, so they may be
broadcast) and left out of the batches; that saves work and changes no result.
Pieces over LONG bytes, for which the fold would take quadratic time, are merged
with a heap, by the same ranks.

Defined results: null and empty texts have no ids. Rows that repeat, and ids of
documents that are null, are rows like others. Extra columns pass through,
whatever their names; the names of the new ones are given by the caller. An
empty table gives an empty one.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, tidy

SAMPLE, PARTS, HOT, LONG = 6_000, 16, 1 << 17, 256
#: characters of a batch of documents; pieces that a task remembers
BATCH, KEPT = 2_000_000, 400_000
#: bits of an id
BITS = 20
_ID, _NONE = (1 << BITS) - 1, 1 << (2 * BITS + 1)
#: rows of the merge table up to this size are tried at so many random places at a time
SMALL = 400


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and their ranks (ids), from a file of lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_table(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """start and entries: for ids l and r that merge, entries[start[l] + r] is l (upper bits) and the id of both."""
    if max(ranks.values()) > _ID:
        raise ValueError(f"ids of over {BITS} bits")
    follow: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                follow.setdefault(left, []).append((right, rank))
    n, total = max(ranks.values()) + 1, sum(map(len, follow.values()))
    room = 3 * total + 1024
    used, entries, start = np.zeros(room + n, bool), np.full(room + n, _NONE, np.int64), [0] * n
    rng = np.random.default_rng(5)
    for left, own in sorted(follow.items(), key=lambda x: (-len(x[1]), x[0])):
        at = np.array([r for r, _ in own])
        tried, done = (rng.integers(0, room, SMALL) if len(at) <= SMALL else np.arange(1024)), False
        while not done:
            fits = np.flatnonzero(~used[tried[:, None] + at].any(axis=1))
            if done := len(fits) > 0:
                begin = start[left] = int(tried[fits[0]])
            elif len(at) <= SMALL:
                tried = rng.integers(0, room, SMALL)
            else:  # first fit; past room there is always one
                tried = tried + 1024
                grown = max(0, int(tried[-1]) + n + 1 - len(used))
                used, entries = np.append(used, np.zeros(grown, bool)), np.append(entries, np.full(grown, _NONE, np.int64))
        used[begin + at] = True
        entries[begin + at] = left << BITS | np.array([r for _, r in own], np.int64)
    return start, entries.tolist()


def rank_literal(ranks: dict[bytes, int]) -> str:
    """SQL for the literal of merge_table."""
    start, entries = merge_table(ranks)
    return f"from_json('{json.dumps({'s': start, 'e': entries}, separators=(',', ':'))}', 'struct<s:array<int>,e:array<bigint>>')"


def fold_merges(piece: str) -> str:
    """SQL: the ids of a piece (an array of its bytes' ids), with the literal bound to m."""

    def part(left: str, right: str) -> str:
        """The rank of left and right, then left. An entry of another left id, or none, gives a rank beyond all."""
        entry = f"get(m.e, get(m.s, cast({left} as int)) + cast({right} as int))"
        return f"(shiftleft(coalesce({entry} ^ shiftleft({left}, {BITS}), {_NONE}L), {BITS}) | {left})"

    start = f"transform({piece}, (x, i) -> {part('cast(x as bigint)', f'get({piece}, i + 1)')})"
    # the part at a and the one after it become one; the pairs with its neighbours get new ranks
    merged = f"shiftright(get(u, a - 1), {BITS})"
    left, right = part(f"(get(u, a - 2) & {_ID}L)", merged), part(merged, f"(get(u, a + 1) & {_ID}L)")
    after = f"flatten(array(slice(u, 1, greatest(a - 2, 0)), if(a > 1, array({left}, {right}), array({right})), slice(u, a + 2, size(u))))"
    # aggregate over one value binds it without the copy that transform makes of a result
    step = f"aggregate(array(cast(array_position(t, array_min(t)) as int)), t, (u, a) -> if(get(u, a - 1) >= {1 << 2 * BITS}L, u, {after}))"
    fold = f"aggregate(sequence(2, greatest(2, size({piece}) - 1)), {start}, (t, i) -> {step}, t -> transform(t, x -> cast(x & {_ID}L as int)))"
    return f"if(size({piece}) = 0, cast(array() as array<int>), {fold})"


def merged_lists(lists: str, literal: str) -> str:
    """SQL: the ids of each piece of a list."""
    return f"element_at(transform(array({literal}), m -> transform({lists}, b -> {fold_merges('b')})), 1)"


def heap_merges(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long piece, in n log n."""
    n = len(piece)
    end, prev, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def push(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, j, end[j]))

    heap: list[tuple[int, int, int, int]] = []
    for i in range(n - 1):
        push(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if live[i] and live[j] and end[i] == j and end[j] == k:
            end[i], live[j] = k, False
            if k < n:
                prev[k] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if live[i]]


class _Bytes:
    """Pieces as arrays of the ids of their bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def lists(self, pieces: list[bytes]) -> pa.ListArray:
        ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(self.ids[np.frombuffer(b"".join(pieces), np.uint8)]))


class Flat:
    """Lists of numbers, one after another: values and where each list starts."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __add__(self, other: Flat) -> Flat:
        return Flat(np.concatenate((self.values, other.values)), np.concatenate((self.sizes, other.sizes)))

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of lists at, concatenated; where each ends."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0)
        places += np.repeat(self.starts[at] - ends + sizes, sizes)
        return self.values[places], ends


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that end at these bytes."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _utf8(text: str | None) -> str:
    return text or ""


def _hot(docs: DataFrame, text_col: str, pattern: str, ranks: dict[bytes, int], literal: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Frequent pieces that are no token; their ids, concatenated; the numbers of these."""
    texts = docs.select(text_col)
    parts = texts.rdd.getNumPartitions()
    every, most, known = -(-parts // PARTS) if parts else 1, -(-SAMPLE // PARTS), docs.sparkSession.sparkContext.broadcast(ranks)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut, c, n, pieces = regex.compile(pattern).findall, Counter(), 0, _Bytes(known.value)
        if TaskContext.get().partitionId() % every:
            return  # a partition that is left out isn't read
        for b in batches:
            if n < most:
                c.update(p for t in b.column(0).slice(0, most - n) for p in cut(_utf8(t.as_py())))
                n += b.num_rows
        rare = [(p.encode(), k) for p, k in c.items()]
        rare = [x for x in rare if x[0] not in known.value and len(x[0]) <= LONG]
        own = [p for p, _ in rare]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pieces.lists(own), pa.array([k for _, k in rare], pa.int64())], ["piece", "b", "n"])

    top = texts.mapInArrow(tidy(counts), "piece binary, b array<int>, n long").groupBy("piece").agg(F.first("b").alias("b"), F.sum("n").alias("n"))
    top = top.where("n > 1").orderBy(F.desc("n"), "piece").limit(HOT).select("piece", "b").repartition(max(1, HOT >> 13))
    ids = f"element_at(transform(array({literal}), m -> {fold_merges('b')}), 1)"
    rows = top.select("piece", F.expr(ids).alias("ids")).toArrow()  # at most HOT, in packed form
    lists = rows.column("ids").combine_chunks()
    known.destroy()
    return rows.column("piece").to_pylist(), lists.flatten().to_numpy().astype("<u4"), lists.value_lengths().to_numpy().astype(np.int64)


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", ids: str = "_ids", decoded: str | None = "_decoded"
) -> DataFrame:
    """docs' other columns, then ids (binary, little-endian unsigned 32 bits) and, where named, decoded (their bytes)."""
    spark = docs.sparkSession
    ship(spark)
    literal = rank_literal(ranks)
    words, values, sizes = _hot(docs, text_col, pattern, ranks, literal)
    known, hot, flat = (spark.sparkContext.broadcast(x) for x in (ranks, words, (values, sizes)))
    kept = [c for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(c) for c in kept]) if kept else F.struct(F.lit(0).alias("_none"))
    keyed = docs.select(row.alias("_row"), F.col(text_col).alias("_text"))
    kind = keyed.schema["_row"].dataType

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut, pieces, tokens = regex.compile(pattern).findall, _Bytes(known.value), max(known.value.values()) + 1
        base = tokens + len(hot.value)
        first = {p.decode(): tokens + i for i, p in enumerate(hot.value)}

        class Numbers(dict):
            """A token's id; beyond all ids a frequent piece's number; beyond these a new one."""

            def __missing__(self, piece: str) -> int:
                k = known.value.get(raw := piece.encode())
                if k is None and (k := first.get(piece)) is None:
                    k = base + before + len(fresh)
                    fresh.append(raw)
                self[piece] = k
                return k

        numbers, fresh, before, again = Numbers(), [], 0, False
        for b in batches:
            at = 0
            while at < b.num_rows:
                if again := before > KEPT:
                    numbers.clear()
                    before = 0
                fresh.clear()
                codes, ends, size, begin = [], [], 0, at
                while at < b.num_rows and size < BATCH:
                    text = _utf8(b.column(1)[at].as_py())
                    found = cut(text)
                    codes.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                    ends.append(len(found))
                    size += len(text)
                    at += 1
                before += len(fresh)
                long = [(i, heap_merges(p, known.value)) for i, p in enumerate(fresh) if len(p) > LONG]
                for i, _ in long:
                    fresh[i] = b""
                rows = pa.ListArray.from_arrays(pa.array([0, at - begin], pa.int32()), b.column(0).slice(begin, at - begin))
                rare = pa.ListArray.from_arrays(pa.array([0, len(fresh)], pa.int32()), pieces.lists(fresh))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows, pa.array([np.concatenate(codes).tobytes()], pa.binary()), pa.array([np.array(ends, np.uint32).tobytes()], pa.binary()), rare,
                        pa.array([long], pa.list_(pa.struct([("i", pa.int32()), ("ids", pa.list_(pa.int32()))]))), pa.array([again]),
                    ],
                    ["rows", "codes", "ends", "pieces", "long", "again"],
                )

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = max(known.value.values()) + 1
        texts = [b""] * tokens
        for p, r in known.value.items():
            texts[r] = p
        bytes_of = Flat(np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, tokens))
        base = Flat(np.arange(tokens, dtype="<u4"), np.ones(tokens, np.int64)) + Flat(*flat.value)
        all_ids = base
        for b in batches:
            for k in range(b.num_rows):
                if b.column(5)[k].as_py():
                    all_ids = base
                lists = b.column(3)[k].values
                own, many = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), lists.value_lengths().to_numpy(zero_copy_only=False).copy()
                if long := {x["i"]: np.array(x["ids"], "<u4") for x in b.column(4)[k].as_py()}:
                    cuts = np.cumsum(many)[:-1]
                    own = np.concatenate([long.get(i, x) for i, x in enumerate(np.split(own, cuts))])
                    many[list(long)] = [len(x) for x in long.values()]
                all_ids += Flat(own, many)
                codes = np.frombuffer(b.column(1)[k].as_py(), np.uint32)
                cuts = np.concatenate(([0], np.cumsum(np.frombuffer(b.column(2)[k].as_py(), np.uint32).astype(np.int64))))
                rows, a = b.column(0)[k].values, 0
                while a < len(rows):
                    # documents of 200,000 pieces or so, one at least
                    z = max(a + 1, min(a + 256, int(np.searchsorted(cuts, cuts[a] + 200_000, "right")) - 1))
                    out, ends = all_ids.take(codes[cuts[a] : cuts[z]])
                    stops = np.concatenate(([0], ends))[cuts[a + 1 : z + 1] - cuts[a]]
                    cols = [rows.slice(a, z - a), _binaries(out, 4 * stops)]
                    if decoded:
                        text, where = bytes_of.take(out)
                        cols.append(_binaries(text, np.concatenate(([0], where))[stops]))
                    yield pa.RecordBatch.from_arrays(cols, ["_row", "_ids", "_decoded"][: len(cols)])
                    a = z

    batched = keyed.mapInArrow(
        tidy(cut_rows), f"rows array<{kind.simpleString()}>, codes binary, ends binary, pieces array<array<int>>, long array<struct<i:int,ids:array<int>>>, again boolean"
    )
    merged = batched.select("rows", "codes", "ends", F.expr(merged_lists("pieces", literal)).alias("ids"), "long", "again")
    done = merged.mapInArrow(tidy(looked_up), f"_row {kind.simpleString()}, _ids binary" + ", _decoded binary" * bool(decoded))
    fields = [F.col("_row").getField(c).alias(c) for c in kept]
    return done.select(*fields, F.col("_ids").alias(ids), *([F.col("_decoded").alias(decoded)] if decoded else []))


def decode_ids(ids: bytes, ranks: dict[bytes, int]) -> bytes:
    """The bytes that a sequence of ids stands for."""
    back = {r: p for p, r in ranks.items()}
    return b"".join(back[i] for i in np.frombuffer(ids, "<u4").tolist())
