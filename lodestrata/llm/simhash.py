"""SimHash near-dedup by covering locality-sensitive hashing.

Each of the 64 bit positions gets a non-zero vector phi of r + 1 bits, evenly
dealt. For each non-zero vector v there is a table whose mask keeps the
positions i with <phi(i), v> = 1. The r or fewer positions in which two
fingerprints differ span at most r dimensions, so some v is orthogonal to them
all, and in its table the two have the same masked key: no pair within the
radius is missed.

Equal fingerprints are one node. Tables' keys held by one node are dropped by a
count before any list is made; keys of more than HEAVY nodes are divided again,
until none has more: of r + 1 blocks of the bits that the mask drops, two nodes
within r bits agree in at least one. Within a list, links are checked bit for bit; a list passes on
a spanning forest of its links, never all pairs, and takes the cheaper of two
exact ways: comparing blocks, or looking up each node's neighbours.

Components come from alternating large-star and small-star steps over tables
in the shared folder, so nothing is collected.

Defined results: null and empty texts have fingerprint zero, as texts of white
space do, and are linked like any other. A row without an id belongs to its
fingerprint's component and never names it, unless no row of it has one (null).
Repeated rows get the same component. Texts may be of any length. An empty table
gives an empty one. Other columns of the input, whatever their names, aren't
returned by simhash_components and pass through near_dedup.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, ship, tidy, written

HEAVY, SALTS = 20_000, 256


def masks(radius: int = 3, bits: int = 64) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    n = 2 ** (radius + 1) - 1
    phi = [i % n + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (phi[i] & v).bit_count() & 1) for v in range(1, n + 1)]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[: n - shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    ones, m = np.zeros(64, np.int64), n - shingle + 1
    for k in range(0, m, 1 << 16):
        part = [digest(joined[a:b], 42) for a, b in zip(starts[k : k + (1 << 16)], stops[k : k + (1 << 16)], strict=True)]
        h = np.array(part, dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.packbits(ones * 2 > m, bitorder="little").view("<u8"))[0])


_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """_id and _fp (signed 64 bits) of each row."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["_id", "_fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(rows), f"_id {kind}, _fp long")


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def forest(fps: np.ndarray, radius: int, free: int) -> list[tuple[int, int]]:
    """Spanning forest of the links in a list of distinct fingerprints that agree outside the bits of free."""
    n, tree, links = len(fps), _Union(len(fps)), []
    bits = [np.uint64(1 << i) for i in range(64) if free >> i & 1]
    flips = np.array([np.bitwise_or.reduce(c) for k in range(1, radius + 1) for c in combinations(bits, k)], np.uint64) if n > 2000 else ()
    if n <= 2000 or n < len(flips):
        for i in range(n - 1):
            near = np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= radius
            links += [(i, i + 1 + j) for j in np.flatnonzero(near).tolist() if tree.join(i, i + 1 + j)]
    else:
        order = np.argsort(fps)
        line = fps[order]
        for f in flips:
            other = line ^ f
            at = np.minimum(np.searchsorted(line, other), n - 1)
            hit = np.flatnonzero((line[at] == other) & (at > np.arange(n)))
            links += [(a, b) for a, b in zip(order[hit].tolist(), order[at[hit]].tolist(), strict=True) if tree.join(a, b)]
    return [(int(fps[a]), int(fps[b])) for a, b in links]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def divided(mask: int, radius: int) -> list[int]:
    """mask with one of radius + 1 blocks of the bits that it drops: two nodes within radius bits agree in one of them at least."""
    free = [b for b in range(64) if not mask >> b & 1]
    return sorted({mask | sum(1 << b for b in free[k :: radius + 1]) for k in range(radius + 1)} - {mask})


def links(nodes: DataFrame, radius: int = 3, heavy: int = HEAVY) -> DataFrame:
    """Links (_a, _b) between distinct fingerprints _fp: a spanning forest of each key's list."""
    spark = nodes.sparkSession
    ship(spark)
    heavy = max(heavy, 2**radius)  # with radius free bits there are no more nodes, and no more blocks to divide by
    now, found = masks(radius), None
    keyed = nodes.select("_fp", F.explode(F.array(*[F.lit(_signed(m)) for m in now])).alias("_m"))
    while True:
        keyed = keyed.select("_fp", "_m", F.col("_fp").bitwiseAND(F.col("_m")).alias("_k"))
        sizes = written(keyed.groupBy("_m", "_k").agg(F.count("*").alias("_n")).where("_n > 1"), "keys")
        lists = keyed.join(sizes.where(F.col("_n") <= heavy), ["_m", "_k"]).groupBy("_m", "_k").agg(F.collect_set("_fp").alias("_fps"))
        own = _forests(lists.where(F.size("_fps") > 1), radius)
        found = own if found is None else found.union(own)
        crowded = sizes.where(F.col("_n") > heavy)
        if crowded.isEmpty():
            return found.distinct()
        parts = F.create_map(*[x for m in now for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(d)) for d in divided(m, radius)]))])
        again = keyed.join(crowded, ["_m", "_k"]).select("_fp", F.explode(parts[F.col("_m")]).alias("_m")).distinct()
        keyed, now = written(again, "crowded"), sorted({d for m in now for d in divided(m, radius)})


def _forests(lists: DataFrame, radius: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int]] = []
            for t, fps in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                out += forest(np.array(fps.values.to_numpy(), np.int64).view(np.uint64), radius, ~(t % (1 << 64)) & (1 << 64) - 1)
            ends = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["_a", "_b"])

    return lists.select("_m", "_fps").mapInArrow(tidy(rows), "_a long, _b long")


def rooted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ends of edges, and the smallest that each reaches: roots go to smaller roots until no edge joins two, so their number halves at least each time."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b, up = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while (up[a] != up[b]).any():
        x, y = up[a], up[b]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up != (above := up[up])).any():
            up = above
    return nodes, nodes[up]


def _rooted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    if parts:
        nodes, roots = rooted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        for k in range(0, len(nodes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + 100_000]), pa.array(roots[k : k + 100_000])], ["_node", "_root"])


def components(edges: DataFrame, few: int = 0) -> DataFrame:
    """_node and _root, the smallest node that it reaches, for each node with an edge (_a, _b longs).

    At most few edges are counted first and go to one task, which spares the
    driver the plans of all steps; more take the steps.
    """
    now = written(edges.select(F.greatest("_a", "_b").alias("_u"), F.least("_a", "_b").alias("_v")).where("_u > _v").distinct(), "edges")
    if few and now.limit(few + 1).count() <= few:
        ship(now.sparkSession)
        found = written(now.coalesce(1).mapInArrow(tidy(_rooted_rows), "_node long, _root long"), "roots")
        dropped(now)
        return found
    seen = None
    while True:
        # large star: each larger neighbour of a node goes to the smallest of its neighbours and itself
        both = now.union(now.select("_v", "_u"))
        low = both.groupBy("_u").agg(F.min("_v").alias("_m"))
        large = both.join(low, "_u").where("_v > _u").select(F.col("_v").alias("_u"), F.least("_m", "_u").alias("_v")).distinct()
        # small star: each smaller neighbour, and the node, go to the smallest
        least = large.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = large.join(least, "_u")
        small = small.select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).where("_u > _v").union(least.select("_u", F.col("_m").alias("_v"))).distinct()
        after = written(small, "edges")
        sign = after.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)")), F.lit(0))).first()
        dropped(now)
        now = after
        if sign == seen:
            return now.select(F.col("_u").alias("_node"), F.col("_v").alias("_root")).union(
                now.select(F.col("_v").alias("_node"), F.col("_v").alias("_root")).distinct()
            )
        seen = sign


def simhash_components(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _fp and _component (smallest id reachable over links of at most radius bits) of each row."""
    marks = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return grouped(marks, lambda nodes: links(nodes.select("_fp"), radius)).select("_id", "_fp", "_component")


def grouped(marks: DataFrame, linked: Callable[[DataFrame], DataFrame], few: int = 0) -> DataFrame:
    """marks (_id, _fp) with _component: the smallest id that linked's links between distinct _fp reach.

    Copies share an _fp, so rows are grouped and joined by (_fp, _salt), a part of
    them; a name goes only to the parts that its _fp has, SALTS at most.
    """
    salted = marks.select("_id", "_fp", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_salt"))
    parts = salted.groupBy("_fp", "_salt").agg(F.min("_id").alias("_first"))
    nodes = parts.groupBy("_fp").agg(F.min("_first").alias("_first"))
    roots = components(linked(nodes), few)
    led = nodes.join(roots, nodes["_fp"] == roots["_node"], "left").select("_fp", "_first", F.coalesce("_root", "_fp").alias("_root"))
    names = led.groupBy("_root").agg(F.min("_first").alias("_component"))
    spread = parts.select("_fp", "_salt").join(led.join(names, "_root").select("_fp", "_component"), "_fp")
    return salted.join(spread, ["_fp", "_salt"])


def near_dedup(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the document of the smallest id of each component.

    Rows that repeat an id stay or go together; rows without an id stay.
    """
    groups = simhash_components(docs, radius, shingle, id_col, text_col).where(F.col("_id").isNotNull())
    lost = groups.groupBy("_id").agg(F.max(F.col("_id") == F.col("_component")).alias("_led")).where("not _led")
    return docs.join(lost, docs[id_col] == lost["_id"], "left_anti")
