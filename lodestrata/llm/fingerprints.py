"""Document fingerprints: invertible Bloom lookup sketches, with SQL functions alone.

A text's paragraphs are its lines, cut after every LONG code points; empty lines
are none. A paragraph's digest is 40 bits of XXH64 and 24 bits of a check on
them. The distinct digests go into a sketch of CELLS cells, four of them each,
one from each quarter; a cell is the exclusive or of its digests. The
fingerprint is those cells in hex. Two sketches subtract cell by cell, which
leaves only what differs; peeling then reads single digests from cells whose
check fits and takes them out of their other cells until nothing is left (a
check that fits by chance leaves something).

Where that fails, there were too many differences: both versions are sketched
again, larger: digests are dealt to shards by a salted hash, a sketch each.
Shards that fail are dealt anew with another salt, and they alone, so each
round costs what the last one left. What is still left after ROUNDS (no digest,
but by extreme chance) is compared as two sets. All steps are linear in the
number of paragraphs, but for one sort of numbers a round.

The likeness is the Jaccard index of the two sets: common / all, from the two
sizes and the number of differing digests; it is never null.

The next document comes from a window over buckets of about BUCKET neighbouring
ids; only the first document of each bucket is sent to another bucket.

Defined results: a null text is empty; an empty text has no paragraph, and two
empty texts have likeness 1. Ids ascend, null ids come last, and rows that share
an id are ordered by a hash of their texts (they are one bucket). A table of one
row has that row as its own next. An empty table gives an empty one. Texts may be
of any length. Other columns pass through, whatever their names; those of the new
columns are a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LAST_ID

CELLS, QUARTERS, LONG, BUCKET = 24, 4, 96, 256
#: rounds of shards before what is left is compared as sets
ROUNDS = 8
NAMES = ("_n_chars", "_edited", "_fingerprint", "_edited_fingerprint", "_near_edited", "_near_next")


def let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def paragraphs(name: str) -> Column:
    """Digests of the distinct paragraphs of the text in the column of that name."""
    parts = f"regexp_extract_all({name}, '[^\\n]{{1,{LONG}}}', 0)"
    return F.expr(f"array_distinct(transform({parts}, x -> {let('shiftleft(xxhash64(x), 24)', 'k', f'k | {_CHECK.format("k")}')}))")


_CHECK = "(xxhash64(shiftrightunsigned({0}, 24)) & 16777215L)"


def _bits(h: str) -> str:
    size = CELLS // QUARTERS
    return "(" + " | ".join(f"shiftleft(1L, {q * size} + cast(pmod(shiftrightunsigned({h}, {8 * q}) & 255L, {size}L) as int))" for q in range(QUARTERS)) + ")"


def _keyed(keys: str, salt: str) -> str:
    """Digest k and cells m (bits) of each key."""
    return f"transform({keys}, k -> {let(f'xxhash64({salt}, k)', 'g', f"named_struct('k', k, 'm', {_bits('g')})")})"


def _sketch(keyed: str) -> str:
    cell = "aggregate(w, 0L, (a, x) -> if(shiftrightunsigned(x.m, j) & 1L = 1L, a ^ x.k, a))"
    return let(keyed, "w", f"transform(sequence(0, {CELLS - 1}), j -> {cell})")


def _differing(one: str, other: str, salt: str) -> str:
    """Number of digests that peeling recovers from one - other; null if some are left, or one came up twice, which only a check that fits by chance does."""
    pure = f"array_distinct(filter(t.c, c -> c != 0L and {_CHECK.format('c')} = c & 16777215L))"
    placed = f"transform({pure}, k -> named_struct('k', k, 'm', {let(f'xxhash64({salt}, k)', 'g', _bits('g'))}))"
    taken = "transform(t.c, (c, j) -> aggregate(u, c, (a, x) -> if(shiftrightunsigned(x.m, j) & 1L = 1L, a ^ x.k, a)))"
    after = f"if(size(u) = 0, named_struct('c', t.c, 'd', t.d, 'e', true), named_struct('c', {taken}, 'd', concat(t.d, u.k), 'e', false))"
    start = f"named_struct('c', zip_with({one}, {other}, (a, b) -> a ^ b), 'd', cast(array() as array<bigint>), 'e', false)"
    done = "if(forall(t.c, c -> c = 0L) and size(array_distinct(t.d)) = size(t.d), size(t.d), null)"
    return f"aggregate(sequence(1, {CELLS}), {start}, (t, turn) -> if(t.e, t, {let(placed, 'u', after)}), t -> {done})"


def _dealt(keys: str, salt: str, shards: str) -> str:
    """keys by shard, and where each shard begins: sorted numbers of shard and place, a mark (place 0) before each shard and one after all."""
    places = f"transform({keys}, (k, i) -> shiftleft(pmod(shiftrightunsigned(xxhash64({salt}, k), 32), {shards}), 32) | cast(i + 1 as bigint))"
    marks = f"transform(sequence(0L, {shards}), s -> shiftleft(s, 32))"
    begin = "filter(transform(y, (x, i) -> if(x & 4294967295L = 0L, i, null)), i -> i is not null)"
    own = f"transform(y, x -> get({keys}, cast(x & 4294967295L as int) - 1))"
    return let(f"sort_array(concat({places}, {marks}))", "y", f"named_struct('k', {own}, 'b', {begin})")


def _shard(name: str) -> str:
    return f"slice({name}.k, get({name}.b, s) + 2, get({name}.b, s + 1) - get({name}.b, s) - 1)"


def _round(share: int) -> str:
    """The state after one more round r: what failed is left, the rest is counted."""
    each = _differing(_sketch(_keyed(_shard("ka"), "r")), _sketch(_keyed(_shard("kb"), "r")), "r")
    failed = "filter(sequence(0, size(d) - 1), s -> get(d, s) is null)"
    left = {n: f"flatten(transform(f, s -> {_shard(f'k{n}')}))" for n in "ab"}
    after = f"named_struct('a', {left['a']}, 'b', {left['b']}, 'd', t.d + aggregate(d, 0, (n, x) -> n + coalesce(x, 0)))"
    counted = let(f"transform(sequence(0, cast(n as int) - 1), s -> {each})", "d", let(failed, "f", after))
    dealt = let(_dealt("t.a", "r", "n"), "ka", let(_dealt("t.b", "r", "n"), "kb", counted))
    return let(f"cast(ceil((size(t.a) + size(t.b)) / {share}D) as bigint)", "n", dealt)


def likeness(a: str, b: str, keys_a: str, keys_b: str, share: int) -> str:
    """Jaccard index, from sketches a and b or, where they are too small, larger ones of keys_a and keys_b: one for every share digests of both."""
    both = f"(size({keys_a}) + size({keys_b}))"
    start = f"named_struct('a', {keys_a}, 'b', {keys_b}, 'd', 0)"
    rest = "t.d + size(array_except(t.a, t.b)) + size(array_except(t.b, t.a))"
    larger = f"aggregate(sequence(1L, {ROUNDS}L), {start}, (t, r) -> if(size(t.a) + size(t.b) = 0, t, {_round(share)}), t -> {rest})"
    differing = f"coalesce({_differing(a, b, '0L')}, {larger})"
    return f"if({both} = 0, 1D, {let(differing, 'd', f'({both} - d) / cast({both} + d as double)')})"


def _hex(cells: str) -> str:
    return f"lower(array_join(transform({cells}, c -> lpad(hex(c), 16, '0')), ''))"


def _width(docs: DataFrame, id_col: str) -> tuple[int, int]:
    """The least id and the ids' range of a bucket of about BUCKET rows."""
    low, high, n = docs.agg(F.min(id_col).cast("long"), F.max(id_col).cast("long"), F.count(id_col)).first()
    return (low, max(1, (high - low + 1) * BUCKET // n)) if n else (0, 1)


def _with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs as _row with _text, _keys, _cells, and _next: those of the following document."""
    low, width = _width(docs, id_col)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    bucket = F.when(F.col(id_col).isNull(), F.lit(LAST_ID)).otherwise(F.expr(f"(cast(`{id_col}` as bigint) - {low}L) div {width}L"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("_row"), F.col(text_col).isNull().alias("_null"), key.alias("_id"), F.xxhash64(text).alias("_tag"),
        bucket.alias("_bucket"), text.alias("_text"),
    ).withColumn("_keys", paragraphs("_text")).withColumn("_cells", F.expr(_sketch(_keyed("_keys", "0L"))))
    w = Window.partitionBy("_bucket").orderBy("_id", "_tag")
    rows = rows.select("*", F.lead(F.struct("_text", "_keys", "_cells")).over(w).alias("_next"), F.row_number().over(w).alias("_n"))
    firsts = rows.where("_n = 1").select(F.col("_bucket").alias("_to"), F.struct("_text", "_keys", "_cells").alias("_first"))
    # the bucket after each, in two levels, so that no window holds all buckets
    buckets = docs.select(bucket.alias("_bucket")).distinct()
    buckets = buckets.withColumn("_super", F.floor(F.col("_bucket") / 4096))
    supers = buckets.groupBy("_super").agg(F.min("_bucket").alias("_low"))
    end = Window.partitionBy(F.lit(0)).orderBy("_super")
    supers = supers.select("_super", F.coalesce(F.lead("_low").over(end), F.first("_low").over(end)).alias("_after"))
    to = F.coalesce(F.lead("_bucket").over(Window.partitionBy("_super").orderBy("_bucket")), F.col("_after"))
    follow = buckets.join(supers, "_super").select(F.col("_bucket").alias("_from"), to.alias("_to")).join(firsts, "_to").select("_from", "_first")
    return rows.join(follow, F.col("_bucket") == F.col("_from"), "left").select(
        "_row", "_null", "_text", "_keys", "_cells", F.coalesce("_next", "_first").alias("_next")
    )


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, ...] = NAMES) -> DataFrame:
    """docs with six more columns: code points, edited text, two fingerprints, likeness to the edited text's, to the next document's.

    The edited text is the text with the last quarter of its code points (rounded
    down) replaced by as many, or all, from the start of the next document.
    """
    rows = _with_next(docs, id_col, text_col)
    n = F.char_length("_text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - quarter), F.substring(F.col("_next._text"), F.lit(1), quarter))
    rows = rows.select(
        "_row", "_null", "_text", "_keys", "_cells", n.cast("long").alias("_n"), edited.alias("_edited"), F.col("_next._keys").alias("_next_keys"), F.col("_next._cells").alias("_next_cells")
    )
    rows = rows.withColumn("_edited_keys", paragraphs("_edited")).withColumn("_edited_cells", F.expr(_sketch(_keyed("_edited_keys", "0L"))))
    near = {name: F.expr(likeness("_cells", f"_{name}_cells", "_keys", f"_{name}_keys", share)) for name, share in (("edited", 24), ("next", 9))}
    kept = F.when(~F.col("_null"), F.col("_text"))
    fields = [kept.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    made = (F.col("_n"), F.col("_edited"), F.expr(_hex("_cells")), F.expr(_hex("_edited_cells")), near["edited"], near["next"])
    return rows.select(*fields, *[c.alias(n) for c, n in zip(made, names, strict=True)])
