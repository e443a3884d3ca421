"""Best-fit packing by a grouping genetic algorithm on islands.

Texts become token ids once, in Arrow batches; from there on only skinny rows
(id, piece, length) move. Pieces are dealt by hash to groups of about
GROUP_SIZE. Each group is packed on several islands, each a task with a
population of its own; then the islands' elites migrate to one task for the
group, are crossed again, and the best packing is kept. Well-filled sequences
are final. The pieces of the worst ones, at most GROUP_SIZE / MERGE from each
group, go on to the next round, where MERGE groups meet in one; so no task ever
gets more than about GROUP_SIZE pieces, and the last round ends with one group.

Crossover injects the best-filled bins of one parent whole into the other,
removes the bins there that hold any of their pieces, lets displaced pieces
change places with smaller ones that leave more room, and best-fits the rest; a
mutation opens the worst bins. Fitness is the number of sequences, then the mean
of the squared fill. An island ends at the lower bound or when it has not
got better for a while. Where best fit alone meets the bound, as it does with many
small pieces, nothing is left to evolve.

Defined results: a null or empty text is the closing id alone. Rows that repeat
are packed each for itself; a row without an id too. An empty table gives an
empty one. Texts over the capacity are cut, and nothing else is. Other columns
of the input, whatever their names, aren't returned.
"""

from __future__ import annotations

import json
import random
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cache_of, ship, tidy, written

GROUP_SIZE, MERGE, ISLANDS = 4096, 4, 3
POPULATION, STALE, GENERATIONS = 10, 25, 200
#: bins that a repair tries to fill better by changing items
SWAPPED = 32
#: Byte-level vocabularies write bytes as letters: printable Latin-1 as itself, the others from U+0100 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_ENCODERS: dict[str, "WordEncoder | TextEncoder"] = {}


# The settings of a tokenizer file for which words may be looked up one by one.
_NORMAL = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"})
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_words(settings: dict) -> bool:
    """Whether a tokenizer's settings are those: lower case and normal form, cut by a pattern that never joins what white space parts, byte letters."""
    normal, cut = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    split, *rest = cut.get("pretokenizers") or [{}]
    return (
        tuple(normal.get("normalizers") or ()) == _NORMAL and split.get("pattern") == {"Regex": _PATTERN} and split.get("behavior") == "Removed" and split.get("invert") is True
        and [x.get("type") for x in rest] == ["ByteLevel"] and not rest[0].get("add_prefix_space") and not rest[0].get("use_regex")
        and settings["model"].get("type") == "BPE" and not settings["model"].get("dropout") and not settings.get("truncation") and not settings.get("padding")
    )


class TextEncoder:
    """Ids of whole texts, by the tokenizer itself: for files of any other settings."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def document(self, text: str | None) -> bytes:
        return np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


class WordEncoder(dict):
    """Ids (little-endian unsigned 32 bits) of words between ASCII white space, for files whose settings are by_words.

    A word is first cut into the pattern's units, which repeat far more often
    than words do. A full table becomes the old one, from which what is still used
    comes back; the one before goes.
    """

    MOST = 250_000

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.units: dict[str, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.old_units: dict[str, bytes] = {}
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+").findall

    def unit(self, unit: str) -> bytes:
        """One match of the pattern, in lower case and normal form."""
        if (ids := self.units.get(unit)) is None:
            if len(self.units) >= self.MOST:
                self.units, self.old_units = {}, self.units
            if (ids := self.old_units.get(unit)) is None:
                written = unit if unit.isascii() and unit.isprintable() else unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
                found = [t.id for t in self.merge(written)]
                ids = struct.pack(f"<{len(found)}I", *found)
            self.units[unit] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.MOST:
            self.old = dict(self)
            super().clear()
        if (ids := self.old.get(word)) is not None:
            self[word] = ids
            return ids
        text = word.decode("utf-8", "surrogatepass")
        if not text.isascii():
            if "\u03a3" in text or not unicodedata.is_normalized("NFC", text):  # the tokenizer's own business
                out = self[word] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                return out
            text = text.lower()
        if text.isalpha():  # one unit; and two, as most others are
            out = self.unit(text)
        elif text[-1] in ".,;:!?" and text[:-1].isalpha():
            out = self.unit(text[:-1]) + self.unit(text[-1])
        else:
            out = b"".join(map(self.unit, self.cut(text)))
        self[word] = out
        return out

    def clear(self) -> None:
        super().clear()
        for other in (self.units, self.old, self.old_units):
            other.clear()

    def document(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").encode("utf-8", "surrogatepass").lower().split()))


def encoder(path: str) -> WordEncoder | TextEncoder:
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            _ENCODERS[path] = (WordEncoder if by_words(json.load(f)) else TextEncoder)(path)
    found = _ENCODERS[path]
    return cache_of(found) if isinstance(found, dict) else found


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """_id, piece, start, length, ids_crc32 (and ids, if kept) of each document's pieces."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for b in batches:
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                ids = words.document(text.as_py()) + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    at.append(i)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
            cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * keep_ids, ["_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(rows, "packing"), schema)


Bins = list[list[int]]


def best_fit(sizes: list[int], items: list[int], capacity: int, bins: Bins | None = None) -> Bins:
    """Each item, in order, into the fullest bin that has room; bins' own items stay."""
    bins = [list(b) for b in bins or []]
    room: dict[int, list[int]] = defaultdict(list)
    open_at = 0  # bit r: some bin has room for exactly r more
    for k, b in enumerate(bins):
        r = capacity - sum(sizes[i] for i in b)
        room[r].append(k)
        open_at |= 1 << r
    for i in items:
        s = sizes[i]
        if fits := open_at >> s:
            r = s + (fits & -fits).bit_length() - 1
            k = room[r].pop()
            if not room[r]:
                open_at ^= 1 << r
            bins[k].append(i)
            r -= s
        else:
            k, r = len(bins), capacity - s
            bins.append([i])
        room[r].append(k)
        open_at |= 1 << r
    return bins


def loads_of(sizes: list[int], bins: Bins) -> list[int]:
    return [sum(map(sizes.__getitem__, b)) for b in bins]


def fitness(sizes: list[int], bins: Bins, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the mean of the squared fill; larger is better."""
    return -len(bins), sum((x / capacity) ** 2 for x in loads_of(sizes, bins)) / max(1, len(bins))


def crossed(sizes: list[int], one: Bins, other: Bins, capacity: int, share: float) -> Bins:
    """one with the best-filled share of other's bins injected whole."""
    loads = loads_of(sizes, other)
    inject = [other[k] for k in sorted(range(len(other)), key=lambda k: -loads[k])[: max(1, int(len(other) * share))]]
    taken = {i for b in inject for i in b}
    stay, displaced = [], []
    for b in one:
        if taken.isdisjoint(b):
            stay.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    return repaired(sizes, displaced, capacity, inject + stay)


def repaired(sizes: list[int], displaced: list[int], capacity: int, bins: Bins) -> Bins:
    """bins with the displaced items: larger ones change places with smaller ones that they fill a bin better than, then best fit."""
    bins, free = [list(b) for b in bins], sorted(displaced, key=lambda i: -sizes[i])
    if free:
        loads = loads_of(sizes, bins)
        for k in sorted(range(len(bins)), key=loads.__getitem__)[:SWAPPED]:
            gap = capacity - loads[k]
            if not gap:
                continue
            best = None  # the swap that leaves the least room
            for a, i in enumerate(bins[k]):
                for f, j in enumerate(free):
                    more = sizes[j] - sizes[i]
                    if 0 < more <= gap and (best is None or more > best[0]):
                        best = (more, a, f)
                        if more == gap:
                            break
            if best:
                _, a, f = best
                bins[k][a], free[f] = free[f], bins[k][a]
                free.sort(key=lambda i: -sizes[i])
    return best_fit(sizes, free, capacity, bins)


def broken(sizes: list[int], bins: Bins, capacity: int, rng: random.Random, share: float) -> Bins:
    """A mutation: the worst-filled bins, and some others, are opened and packed anew."""
    loads = loads_of(sizes, bins)
    order = sorted(range(len(bins)), key=loads.__getitem__)
    opened = set(order[: max(1, int(len(bins) * share))]) | set(rng.sample(range(len(bins)), min(len(bins), 1 + int(len(bins) * share))))
    return repaired(sizes, [i for k in opened for i in bins[k]], capacity, [b for k, b in enumerate(bins) if k not in opened])


def least_bins(sizes: list[int], capacity: int) -> int:
    """No packing has fewer: by the total, and by items of over half the capacity, of which each bin holds one."""
    return max(-(-sum(sizes) // capacity), sum(2 * x > capacity for x in sizes))


def evolved(sizes: list[int], capacity: int, seed: int, first: list[Bins] = (), population: int = POPULATION, stale: int = STALE, most: int = GENERATIONS) -> Bins:
    """The elite of one island: first are the packings that it starts from.

    Ends at the bound, or after stale generations without a better elite, and
    after most at last; all of that depends on the group's sizes alone.
    """
    rng, n = random.Random(seed), len(sizes)
    least = least_bins(sizes, capacity)
    pool = list(first)
    while len(pool) < population:
        spread = 0.0 if not pool else rng.uniform(0.05, 0.6)
        pool.append(best_fit(sizes, sorted(range(n), key=lambda i: -sizes[i] * rng.uniform(1 - spread, 1 + spread)), capacity))
        if len(pool[-1]) <= least:
            return pool[-1]
    scored = sorted(((fitness(sizes, b, capacity), b) for b in pool), key=lambda x: x[0], reverse=True)
    idle = 0
    for _ in range(most):
        if -scored[0][0][0] <= least or idle >= stale:
            break
        # tournaments choose the parents
        a, b = (min(rng.sample(range(len(scored)), 2)) for _ in range(2))
        made = [crossed(sizes, scored[a][1], scored[b][1], capacity, rng.uniform(0.1, 0.7)), broken(sizes, scored[rng.randrange(len(scored))][1], capacity, rng, rng.uniform(0.02, 0.15))]
        best = scored[0][0]
        known = {f for f, _ in scored}
        scored += [(f, b) for f, b in ((fitness(sizes, b, capacity), b) for b in made) if f not in known]
        scored = sorted(scored, key=lambda x: x[0], reverse=True)[:population]
        idle = 0 if scored[0][0] > best else idle + 1
    return scored[0][1]


_ORDER = ["_id", "piece", "ids_crc32", "start", "length"]


def _round(rest: DataFrame, capacity: int, groups: int, number: int, last: bool) -> DataFrame:
    """rest with sequence_id, offset and whether that is final."""
    group = F.pmod(F.xxhash64(F.lit(number), *_ORDER), F.lit(groups)).alias("_group")
    dealt = rest.select("*", group, F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("_island"))
    schema = rest.schema.simpleString()[7:-1]
    keep = GROUP_SIZE // MERGE
    # what a round leaves badly filled goes on to the next one, so only the last has to try everything
    effort = {} if last else {"population": max(ISLANDS + 1, POPULATION // 2), "stale": STALE // 5}

    def island(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(_ORDER, ignore_index=True)
        bins = evolved(pdf["length"].tolist(), capacity, int(key[0]) * ISLANDS + int(key[1]) + number, **effort)
        at = np.empty(len(pdf), np.int64)
        for k, b in enumerate(bins):
            at[b] = k
        return pdf.assign(_bin=at)

    def migrated(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_island", *_ORDER], ignore_index=True)
        n = len(pdf) // ISLANDS
        elites = []
        for k in range(ISLANDS):
            bins = defaultdict(list)
            for i, x in enumerate(pdf["_bin"].iloc[k * n : (k + 1) * n]):
                bins[x].append(i)
            elites.append(list(bins.values()))
        pdf = pdf.iloc[:n].drop(columns=["_bin", "_island", "_group"])
        sizes = pdf["length"].tolist()
        bins = evolved(sizes, capacity, int(key[0]) + number, elites, **effort)
        bins.sort(key=lambda b: sum(sizes[i] for i in b))
        at, offset, final, left = np.empty(n, np.int64), np.empty(n, np.int64), np.ones(n, bool), 0
        for k, b in enumerate(bins):
            at[b] = (number << 52) + (int(key[0]) << 20) + k
            offset[b] = np.concatenate(([0], np.cumsum([sizes[i] for i in b])[:-1]))
            load = sum(sizes[i] for i in b)
            if not last and load < capacity and left + len(b) <= keep:
                final[b], left = False, left + len(b)
        return pdf.assign(sequence_id=at, offset=offset, _final=final)

    packed = dealt.groupBy("_group", "_island").applyInPandas(island, f"{schema}, _group long, _island int, _bin long")
    return packed.groupBy("_group").applyInPandas(migrated, f"{schema}, sequence_id long, offset long, _final boolean")


def packed(parts: DataFrame, capacity: int = 4096) -> DataFrame:
    """parts (a table of pieces) with sequence_id and offset."""
    ship(parts.sparkSession)
    n, done, number = parts.count(), None, 0
    rest = parts
    while True:
        groups = max(1, -(-n // GROUP_SIZE))
        now = written(_round(rest, capacity, groups, number, groups == 1), f"packed{number}")
        final = now.where("_final").drop("_final")
        done = final if done is None else done.unionByName(final)
        if groups == 1:
            return done
        rest = now.where("not _final").drop("_final", "sequence_id", "offset")
        n, number = rest.count(), number + 1


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each piece of each document with its place in a sequence of at most capacity tokens."""
    parts = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    return packed(parts, capacity)


def sequences(docs: DataFrame, places: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """sequence_id and ids (binary) of each whole sequence, from pack_documents' places; needs ids that don't repeat."""
    parts = pieces(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids=True).select("_id", "piece", "ids")
    joined = parts.join(places, ["_id", "piece"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return joined.select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids"))
