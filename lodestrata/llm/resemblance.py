"""Near-dedup by resemblance: the Jaccard index of the sets of word shingles, on top of SimHash's covering tables.

SimHash's guarantee ends at few bits, which only nearly identical texts keep to;
so candidates come from two sides. The covering tables (simhash.links) give all
pairs whose fingerprints over the sets differ in RADIUS bits or fewer. MinHash
gives the rest: ROWS minima make a key, BANDS keys a document; two documents of
similarity s share no key with probability (1 - s ** ROWS) ** BANDS, which is
1.3e-7 at 0.8 and less above.

Equal sets are one node. The nodes of a key, and of a fingerprint, make a chain;
what chains and tables connect is a group, and no candidate pair is in two groups.
Each node's set goes once to its group's task, which compares sets exactly by an
inverted index and passes on a spanning forest of the links, never pairs. A group
of more than NODES nodes or SHINGLES shingles is cut into blocks by hash, and
each pair of blocks is a task, so a task's size is bounded and no link is lost.

Defined results: a text of fewer words than a shingle is one shingle; texts
without words are equal to each other. Ids are treated as in simhash. Sets are of
48-bit digests. Texts may be of any length; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, ship, tidy, written
from .simhash import _LOWER, components, grouped
from .simhash import links as covering_links

BANDS, ROWS, RADIUS = 40, 5, 3
#: a task's nodes and shingles, twice over: it gets two blocks at most
NODES, SHINGLES = 4_000, 2_000_000
#: as many edges are grouped by one task; more take steps over tables
EDGES = 2_000_000
_KEPT = np.uint64((1 << 48) - 1)
_RNG = np.random.default_rng(8)
_TIMES = _RNG.integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct digests of a text's shingles."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    own = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(own)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    if n <= words:
        return np.array([digest(joined)], np.uint64) & _KEPT
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[: n - words])).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)) & _KEPT)


def packed(found: np.ndarray) -> bytes:
    """Six bytes a digest."""
    return np.ascontiguousarray(found.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def fingerprint(found: np.ndarray) -> int:
    """SimHash of a set, signed: bits that over half of its digests have, spread to 64 bits."""
    if not len(found):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(found), 1 << 16):
        spread = found[k : k + (1 << 16)] * np.uint64(0x9E3779B97F4A7C15)
        spread ^= spread >> np.uint64(32)
        ones += np.unpackbits(spread.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view("<i8")[0])


def keys(found: np.ndarray) -> list[int]:
    """A signed key for each band; none without shingles."""
    import xxhash

    if not len(found):
        return []
    least, low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32), (found >> np.uint64(16)).astype(np.uint32)
    for k in range(0, len(low), 2048):
        np.minimum(least, (_TIMES * low[k : k + 2048] + _PLUS).min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], np.uint64).view(np.int64).tolist()


def sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """_id, _fp (of the set), _sim, _n, _set and _keys of each row."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [shingles(t.as_py(), words) for t in part.column(1)]
                own = [packed(s) for s in found]
                fps = np.array([xxhash.xxh64_intdigest(s) for s in own], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(fps), pa.array([fingerprint(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int32()),
                        pa.array(own, pa.binary()), pa.array([keys(s) for s in found], pa.list_(pa.int64())),
                    ],
                    ["_id", "_fp", "_sim", "_n", "_set", "_keys"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(rows), f"_id {kind}, _fp long, _sim long, _n int, _set binary, _keys array<long>")


def _chained(rows: DataFrame, key: str) -> DataFrame:
    """Each node (_fp) of a key with the next one."""
    w = Window.partitionBy(key).orderBy("_fp")
    return rows.select(F.col("_fp").alias("_a"), F.lead("_fp").over(w).alias("_b")).where("_b is not null")


def candidates(marks: DataFrame, nodes: DataFrame, radius: int) -> DataFrame:
    """Pairs (_a, _b) of nodes that connect all that share a key or have near fingerprints. Each kind is a table: one plan of all takes much of a driver."""
    keyed = marks.groupBy("_fp").agg(F.first("_keys").alias("_keys")).select("_fp", F.explode("_keys").alias("_k"))
    by_key = written(_chained(keyed, "_k").distinct(), "pairs")
    by_sim = written(_chained(nodes.where("_n > 0").select("_fp", "_sim"), "_sim"), "pairs")
    lead = written(nodes.where("_n > 0").groupBy("_sim").agg(F.min("_fp").alias("_fp")), "leads")
    near = written(covering_links(lead.select(F.col("_sim").alias("_fp")), radius), "near")
    one, other = (lead.select(F.col("_sim").alias(f"_s{k}"), F.col("_fp").alias(f"_{k}")) for k in "ab")
    near = near.withColumnsRenamed({"_a": "_sa", "_b": "_sb"}).join(one, "_sa").join(other, "_sb").select("_a", "_b")
    return by_key.union(by_sim).union(near)


def forest(fps: np.ndarray, found: list[np.ndarray], similarity: float, half: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links between sets; with half, of those between its two sides."""
    n, sizes = len(fps), np.array([len(s) for s in found])
    flat, owner = np.concatenate(found), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    line, owner = flat[order], owner[order]
    begin = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    many = np.diff(begin, append=len(line))
    starts_of = np.empty(len(flat), np.int64)
    starts_of[order] = np.repeat(begin, many)
    many_of = np.empty(len(flat), np.int64)
    many_of[order] = np.repeat(many, many)
    ends = np.cumsum(sizes)
    up, left, links = np.arange(n), n, []

    for i in range(n):
        own = slice(ends[i] - sizes[i], ends[i])
        shared = many_of[own] > 1
        at, size = starts_of[own][shared], many_of[own][shared]
        total = np.cumsum(size)
        if not len(total):
            continue
        places = np.arange(total[-1]) + np.repeat(at - total + size, size)
        common = np.bincount(owner[places], minlength=n)
        near = common / (sizes + sizes[i] - common) >= similarity
        near &= up != up[i]
        if half is not None:
            near &= half != half[i]
        for j in np.flatnonzero(near).tolist():
            if up[i] != up[j]:
                links.append((int(fps[i]), int(fps[j])))
                up[up == up[j]] = up[i]
                left -= 1
        if left == 1:
            break
    return links


def links(marks: DataFrame, similarity: float, radius: int = RADIUS) -> DataFrame:
    """Links (_a, _b) between distinct sets that join all of at least this similarity, directly or by others."""
    nodes = written(marks.groupBy("_fp").agg(F.first("_n").alias("_n"), F.first("_sim").alias("_sim")), "nodes")
    groups = components(candidates(marks, nodes, radius), EDGES)
    sized = written(groups.join(nodes.select(F.col("_fp").alias("_node"), "_n"), "_node"), "sized")
    sizes = sized.groupBy("_root").agg(F.count("*").alias("_many"), F.sum("_n").alias("_all"))
    cut = F.greatest(F.ceil(F.col("_many") / NODES), F.ceil(F.col("_all") / SHINGLES)).cast("int")
    # one block: a task of its own; else every pair of blocks of half that size is one
    blocks = sizes.select("_root", F.when(cut > 1, 2 * cut).otherwise(1).alias("_cut"))
    member = sized.join(blocks, "_root").withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_cut")).cast("int"))
    member = written(member, "members")
    one = marks.select("_fp", "_set").join(member.select(F.col("_node").alias("_fp")), "_fp", "left_semi").groupBy("_fp").agg(F.first("_set").alias("_set"))
    shipped = member.join(one, F.col("_node") == F.col("_fp")).select(
        "_root", "_fp", "_set", "_block", F.explode(F.sequence(F.lit(0), F.col("_cut") - 1)).alias("_other")
    )
    pair = [F.least("_block", "_other").alias("_x"), F.greatest("_block", "_other").alias("_y")]

    def linked(key: tuple, table: pa.Table) -> pa.Table:
        x, y = key[1].as_py(), key[2].as_py()
        fps, block = table.column("_fp").to_numpy(), table.column("_block").to_numpy()
        found = [unpacked(s.as_py()) for s in table.column("_set")]
        out = forest(fps, found, similarity, None if x == y else block) if len(fps) > 1 and sum(map(len, found)) else []
        ends = np.array(out, np.int64).reshape(-1, 2)
        return pa.table([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["_a", "_b"])

    dealt = shipped.select("_root", *pair, "_fp", "_set", "_block")
    return dealt.groupBy("_root", "_x", "_y").applyInArrow(linked, "_a long, _b long").distinct()


def resemblance_dedup(docs: DataFrame, similarity: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the document of the smallest id of each component of links of at least this similarity.

    Rows that repeat an id stay or go together; rows without an id stay.
    """
    marks = written(sets(docs, id_col, text_col, words), "shingles")
    groups = grouped(marks, lambda nodes: links(marks, similarity), EDGES).where(F.col("_id").isNotNull())
    lost = written(groups.groupBy("_id").agg(F.max(F.col("_id") == F.col("_component")).alias("_led")).where("not _led").select("_id"), "lost")
    dropped(marks)
    return docs.join(lost, docs[id_col] == lost["_id"], "left_anti")
