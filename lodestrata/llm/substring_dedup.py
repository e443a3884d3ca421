"""Exact substring dedup with difference-cover anchors.

Positions i of a document with i mod 13 in {0, 1, 3, 9} carry an anchor: a hash
of the next 8 words. The set is a difference cover, so for any two positions
there is one offset under 13 at which both carry anchors; as 12 + 8 = 20, two
equal windows of 20 words always share an aligned anchor. So only 4 of 13
windows are hashed for the whole corpus. Anchors that occur once are dropped;
windows around the others are extended to their full length, by 96 bits of hash
over all words, and all but the earliest are removed.

Hashes travel packed, byte by byte: a batch of documents gives one row for each slice of the
hash range, not a row for each anchor. A batch passes on each hash once, so a
passage in a third of all documents costs its slice one entry from a batch; the
batch's other occurrences are known to repeat at once and go to their own
documents. Texts move once (both joins by document read the same exchange), and
nothing is collected.

Order is by id, then start. Defined results: null and empty texts have no
windows. Null ids come after all others. Rows that repeat in full count as one
document and get the same result; other rows that share an id are ordered by a
hash (32 bits) of their texts. Texts of fewer words than a window are never cut. Other
columns pass through unchanged. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, cache_of, free_name, partitions, ship, tidy

PERIOD, COVER = 13, (0, 1, 3, 9)
#: hashes are dealt to slices by their upper bits
UPPER = 24
#: bytes of input, as the plan estimates them, for a slice; there are never fewer slices than shuffle partitions
SLICE_BYTES = 32_000_000
OWNER = "substring_dedup"


class _Words(dict):
    """Word (bytes) to a 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(cache_of(_WORDS).__getitem__, words), np.uint64, len(words))


def _windows(h: np.ndarray, at: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Polynomial hashes, modulo 2^64, of the windows that start at at."""
    out, f = np.zeros(len(at), np.uint64), np.uint64(factor)
    for k in range(size):
        out = out * f + h[at + k]
    return out ^ out >> np.uint64(31)


_ONE, _TWO = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_ROW = "_slice int, _kind int, _owners binary, _hash binary, _more binary, _ref binary"


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _planes(a: np.ndarray) -> bytes:
    """An array's bytes, all first ones first: shuffle compression then squeezes what sorted or small numbers share."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def _unplaned(b: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(wide, -1).T).view(kind).ravel()


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["_slice", "_kind", "_owners", "_hash", "_more", "_ref"])


def _emit(ids: np.ndarray, tags: np.ndarray, owner: np.ndarray, pos: np.ndarray, h: np.ndarray, more: np.ndarray, slices: int, earliest: bool) -> Iterator[tuple]:
    """Rows for one batch of documents (ids, tags) and its entries (owner, pos, h, more).

    Kind 0: entries to be compared, one for each hash, the earliest. Kind 1: what
    the batch itself knows to repeat: with earliest the later ones, else all.
    """
    by_doc = np.lexsort((tags, ids))
    place = np.empty(len(ids), np.int64)
    place[by_doc] = np.arange(len(ids))
    ids, tags, owner = ids[by_doc], tags[by_doc], place[owner]
    # rows that repeat in full are one document
    same = np.concatenate(([False], (ids[1:] == ids[:-1]) & (tags[1:] == tags[:-1])))
    fresh = ~same[owner]
    owner, pos, h, more = owner[fresh], pos[fresh], h[fresh], more[fresh]
    order = np.lexsort((pos, owner, more, h))
    owner, pos, h, more = owner[order], pos[order], h[order], more[order]
    head = np.concatenate(([True], (h[1:] != h[:-1]) | (more[1:] != more[:-1]))) if len(h) else np.empty(0, bool)
    several = ~head if earliest else ~(head & np.concatenate((head[1:], [True])))
    if several.any():
        yield from _known(ids, tags, owner[several], pos[several], slices)
    owner, pos, h, more = owner[head], pos[head], h[head], more[head]
    part = (h >> np.uint64(64 - UPPER)).astype(np.int64) * slices >> UPPER
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))).tolist() + [len(part)] if len(part) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        used, local = np.unique(owner[a:b], return_inverse=True)
        owners = np.concatenate((np.diff(ids[used], prepend=0), tags[used])).astype("<i8")
        ref = np.concatenate((local, pos[a:b])).astype("<u4")
        yield int(part[a]), 0, _planes(owners), _planes(h[a:b].astype("<u8")), _planes(more[a:b].astype("<u4")), _planes(ref)


def _known(ids: np.ndarray, tags: np.ndarray, owner: np.ndarray, pos: np.ndarray, slices: int) -> Iterator[tuple]:
    order = np.argsort(owner, kind="stable")
    owner, pos = owner[order], pos[order]
    cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))).tolist() + [len(owner)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        k = owner[a]
        # by id and tag: copies of a text share a tag
        yield int((int(ids[k]) * 40_503 ^ int(tags[k])) & 0x7FFFFFFF) % slices, 1, np.array([ids[k], tags[k]], "<i8").tobytes(), b"", b"", pos[a:b].astype("<u4").tobytes()


def _batches(batches: Iterator[pa.RecordBatch], chars: int = 16_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, list, list]]:
    """Ids, tags, texts and marked positions, many documents at a time."""
    held, size = ([], [], [], []), 0
    for b in batches:
        for i, t, text, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist() if b.num_columns > 3 else [None] * b.num_rows, strict=True):
            for c, x in zip(held, (i, t, text.as_py(), marks), strict=True):
                c.append(x)
            size += len(held[2][-1] or "")
            if size > chars:
                yield np.array(held[0], np.int64), np.array(held[1], np.int64), held[2], held[3]
                held, size = ([], [], [], []), 0
    if held[0]:
        yield np.array(held[0], np.int64), np.array(held[1], np.int64), held[2], held[3]


def _dealt(i: np.ndarray, t: np.ndarray, pos: np.ndarray, slices: int) -> Iterator[pa.RecordBatch]:
    """Places as one row for each slice of documents, whatever their number."""
    part = ((i * 40_503 ^ t) & 0x7FFFFFFF) % slices
    order = np.lexsort((pos, t, i, part))
    part, i, t, pos = part[order], i[order], t[order], pos[order]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))).tolist() + [len(part)]
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        head = np.flatnonzero(np.concatenate(([True], (i[a + 1 : b] != i[a : b - 1]) | (t[a + 1 : b] != t[a : b - 1]))))
        own = np.concatenate((np.diff(i[a:b][head], prepend=0), t[a:b][head], np.diff(head, append=b - a))).astype("<i8")
        rows.append((int(part[a]), _planes(own), _planes(pos[a:b].astype("<u4"))))
    s, o, r = zip(*rows, strict=True)
    yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(o, pa.binary()), pa.array(r, pa.binary())], ["_slice", "_owners", "_ref"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_id, _tag and _marks (packed positions) of each document of one task's slices."""
    i, t, pos = [], [], []
    for b in batches:
        for owners, refs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            own = _unplaned(owners, "<i8").reshape(3, -1)
            i.append(np.repeat(np.cumsum(own[0]), own[2]))
            t.append(np.repeat(own[1], own[2]))
            pos.append(_unplaned(refs, "<u4"))
    if not i:
        return
    i, t, pos = map(np.concatenate, (i, t, pos))
    order = np.lexsort((pos, t, i))
    i, t, pos = i[order], t[order], pos[order].astype("<u4")
    cuts = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (t[1:] != t[:-1])))).tolist() + [len(i)]
    for k in range(0, len(cuts) - 1, 2_000):
        some = cuts[k : k + 2_001]
        rows = [(int(i[a]), int(t[a]), pos[a:b].tobytes()) for a, b in zip(some[:-1], some[1:], strict=True)]
        x, y, z = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(z, pa.binary())], ["_id", "_tag", "_marks"])


def _merged(batches: Iterator[pa.RecordBatch], earliest: bool, slices: int) -> Iterator[pa.RecordBatch]:
    """For the slices of one task, the places of repeated entries, with earliest of all but the first, dealt by document."""
    ids, tags, owner, pos, h, more, n = [], [], [], [], [], [], 0
    out: list[tuple] = []
    for b in batches:
        for kind, owners, hashes, mores, refs in zip(*(b.column(k).to_pylist() for k in range(1, 6)), strict=True):
            if kind:
                i, t = np.frombuffer(owners, "<i8").tolist()
                ref = np.frombuffer(refs, "<u4")
                out.append((np.full(len(ref), i), np.full(len(ref), t), ref))
                continue
            own, ref = _unplaned(owners, "<i8").reshape(2, -1), _unplaned(refs, "<u4").reshape(2, -1)
            ids.append(np.cumsum(own[0]))
            tags.append(own[1])
            owner.append(ref[0].astype(np.int64) + n)
            pos.append(ref[1])
            h.append(_unplaned(hashes, "<u8"))
            more.append(_unplaned(mores, "<u4"))
            n += own.shape[1]
    if n:
        ids, tags, owner, pos, h, more = map(np.concatenate, (ids, tags, owner, pos, h, more))
        by = np.argsort(h, kind="stable")
        twice = np.zeros(len(h), bool)
        eq = h[by][1:] == h[by][:-1]
        twice[by[1:][eq]] = twice[by[:-1][eq]] = True
        owner, pos, h, more = owner[twice], pos[twice], h[twice], more[twice]
        # the first of each hash by id, tag and position; equal places are one
        order = np.lexsort((pos, tags[owner], ids[owner], more, h))
        owner, pos, h, more = owner[order], pos[order], h[order], more[order]
        i, t = ids[owner], tags[owner]
        head, same = np.ones(len(h), bool), np.zeros(len(h), bool)
        head[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1])
        same[1:] = (i[1:] == i[:-1]) & (t[1:] == t[:-1]) & (pos[1:] == pos[:-1]) & ~head[1:]
        i, t, pos, head = i[~same], t[~same], pos[~same], head[~same]
        hit = ~head if earliest else ~(head & np.append(head[1:], True)[: len(head)])
        out.append((i[hit], t[hit], pos[hit]))
    if sum(len(x[0]) for x in out):
        yield from _dealt(*(np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)), slices)


def _positions(marks: bytes | None) -> np.ndarray:
    return np.frombuffer(marks or b"", "<u4").astype(np.int64)


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of starts."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + window, n), -1)
    return np.cumsum(step[:-1]) > 0


def repeated_windows(keyed: DataFrame, by_doc: DataFrame, window: int, tasks: int) -> DataFrame:
    """_id, _tag and _marks (packed starts) of the windows that also start earlier."""
    anchor, slices = window - PERIOD + 1, tasks
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tags, texts, _ in _batches(batches):
            owner, pos, hs = [], [], []
            for k, text in enumerate(texts):
                h = _hashes(_split(text))
                if len(h) >= window:
                    at = np.flatnonzero(cover[np.arange(len(h) - anchor + 1) % PERIOD])
                    owner.append(np.full(len(at), k))
                    pos.append(at)
                    # 48 bits will do: a chance match only costs a look at the windows around it
                    hs.append(_windows(h, at, anchor, _ONE) & ~np.uint64(0xFFFF))
            if hs:
                h = np.concatenate(hs)
                yield _packed(list(_emit(ids, tags, np.concatenate(owner), np.concatenate(pos), h, np.zeros(len(h), np.uint32), slices, False)))

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tags, texts, marks in _batches(batches):
            owner, pos, hs, more = [], [], [], []
            for k, (text, mark) in enumerate(zip(texts, marks, strict=True)):
                h, at = _hashes(_split(text)), _positions(mark)
                if len(h) < window or not len(at):
                    continue
                # windows that hold a marked anchor: starts from PERIOD - 1 before it up to it
                at = np.flatnonzero(covered(np.maximum(at - PERIOD + 1, 0), len(h), PERIOD)[: len(h) - window + 1])
                owner.append(np.full(len(at), k))
                pos.append(at)
                hs.append(_windows(h, at, window, _ONE))
                more.append((_windows(h, at, window, _TWO) >> np.uint64(32)).astype(np.uint32))
            if hs:
                yield _packed(list(_emit(ids, tags, *map(np.concatenate, (owner, pos, hs, more)), slices, True)))

    def gathered(rows: DataFrame, earliest: bool) -> DataFrame:
        hashes = rows.repartition(tasks, "_slice").mapInArrow(tidy(lambda b: _merged(b, earliest, slices), OWNER), "_slice int, _owners binary, _ref binary")
        return hashes.repartition(tasks, "_slice").mapInArrow(tidy(_documents, OWNER), "_id long, _tag long, _marks binary")

    marked = gathered(keyed.select("_id", "_tag", "_text").mapInArrow(tidy(anchors, OWNER), _ROW), False)
    # with _row, though it isn't used, so that the last join can read the same exchange of texts
    some = by_doc.join(marked, ["_id", "_tag"]).select("_id", "_tag", "_text", "_marks", "_row")
    return gathered(some.mapInArrow(tidy(extended, OWNER), _ROW), True)


def _slices(docs: DataFrame) -> int:
    """By the input's size, so a slice's entries fit in a task whatever the number of shuffle partitions."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n = partitions(docs.sparkSession)
    return max(n, min(-(-size // SLICE_BYTES), 1 << UPPER - 4)) if size < 1 << 60 else n  # no estimate


def substring_dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", count: bool = False) -> DataFrame:
    """docs without the words of windows (of that many words) that also start earlier.

    Texts that lose words are the kept ones joined by one space; others stay as
    they are. count joins the words of all texts so, and adds _n_words and
    _n_removed (with one more underscore where docs has such a column).
    """
    if window < PERIOD + 1:
        raise ValueError(f"window: {PERIOD + 1} words at least")
    spark = docs.sparkSession
    ship(spark)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    keyed = docs.select(key.alias("_id"), F.hash(F.xxhash64(text_col)).cast("long").alias("_tag"), F.col(text_col).alias("_text"), F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("_row"))
    n = _slices(docs)
    by_doc = keyed.repartition(n, "_id", "_tag")
    marks = repeated_windows(keyed, by_doc, window, n)
    joined = by_doc.join(marks, ["_id", "_tag"], "left").select("_row", "_text", "_marks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, n, gone = [], [], []
            for text, marks in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                text = text.as_py()
                if not marks and not count:
                    out.append(text)
                    continue
                words = _split(text)
                n.append(len(words))
                if marks:
                    drop = covered(_positions(marks), len(words), window)
                    words = [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
                gone.append(n[-1] - len(words))
                out.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            cols = [b.column(0), pa.array(out, pa.string())] + [pa.array(n, pa.int64()), pa.array(gone, pa.int64())] * count
            yield pa.RecordBatch.from_arrays(cols, ["_row", "_text", "_n_words", "_n_removed"][: len(cols)])

    row = keyed.schema["_row"].dataType.simpleString()
    done = joined.mapInArrow(tidy(cut, OWNER), f"_row {row}, _text string" + ", _n_words long, _n_removed long" * count)
    fields = [F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return done.select(*fields, *[F.col(c).alias(free_name(c, docs.columns)) for c in ("_n_words", "_n_removed")[: 2 * count]])
