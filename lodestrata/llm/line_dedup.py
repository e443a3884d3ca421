"""Line dedup across documents, with DataFrame functions alone.

Lines are exploded with their positions, long ones are normalised and hashed,
once: the hashes are kept in a table in the shared folder (so calling this runs
a job). Rows go to the parts (hash, salt), where the salt is a hash of the
document, so a line that a third of all documents share is SALTS parts, and no
document is in two parts of a hash. Documents are counted in each part and the
parts' counts summed by hash; a common hash goes back to its own parts only. What is to be dropped returns to
its document as positions, and the text is put together again by position from
the lines that stay.

Defined results: a null or empty text is one empty line, which stays. A row
without an id is never counted and loses nothing. Rows that repeat an id count
as one document. Other columns pass through unchanged, whatever their names;
the counts' names are given by the caller. An empty table gives an empty one.
Texts may be of any length. A hash is 128 bits (two seeds of XXH64).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, written

#: parts of a hash at most; a part is made only where it has documents
SALTS = 256


def _stripped(line: Column) -> Column:
    """Without ASCII white space at both ends; most lines have none, which is cheap to see."""
    edge = F.lit(False)
    for c in SPACE:
        edge = edge | F.startswith(line, F.lit(c)) | F.endswith(line, F.lit(c))
    return F.when(edge, F.btrim(line, F.lit(SPACE))).otherwise(line)


def _tag(text: Column) -> Column:
    """Rows that share an id are told apart by their texts."""
    return F.xxhash64(text)


def line_dedup(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None
) -> DataFrame:
    """docs with repeated lines removed from the text.

    A key is a line stripped of ASCII white space at both ends, A-Z in lower
    case. Keys of at least min_chars code points in at least min_docs documents
    lose all lines but those of the largest id that holds them. counts: names
    of two more columns, the lines before dropping and those dropped.
    """
    text = F.col(text_col)
    lines = docs.where(F.col(id_col).isNotNull() & (F.octet_length(text) >= min_chars)).select(
        F.col(id_col).alias("_id"), _tag(text).alias("_tag"), F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line")
    )
    keys = lines.where(F.octet_length("_line") >= min_chars).withColumn("_line", _stripped(F.col("_line"))).where(F.char_length("_line") >= min_chars)
    keys = keys.withColumn("_line", ascii_lower(F.col("_line")))
    held = keys.select(
        F.xxhash64("_line").alias("_a"), F.xxhash64(F.lit(1), "_line").alias("_b"), F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_salt"),
        "_id", "_tag", "_pos",
    )
    held = written(held, "lines")
    parts = held.groupBy("_a", "_b", "_salt").agg(F.count_distinct("_id").alias("_n"), F.max("_id").alias("_last"))
    sums = parts.groupBy("_a", "_b").agg(F.sum("_n").alias("_n"), F.max("_last").alias("_last"), F.collect_list("_salt").alias("_salts"))
    common = sums.where(F.col("_n") >= min_docs).select("_a", "_b", "_last", F.explode("_salts").alias("_salt"))
    gone = held.join(common, ["_a", "_b", "_salt"]).where(F.col("_id") != F.col("_last"))
    drops = gone.groupBy("_id", "_tag").agg(F.collect_set("_pos").alias("_drop"))
    joined = docs.join(drops, (docs[id_col] == drops["_id"]) & (_tag(docs[text_col]) == drops["_tag"]), "left")
    whole = joined.select(
        F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("_row"), docs[text_col].alias("_text"), F.array_sort(drops["_drop"]).alias("_drop")
    )
    n = "(octet_length(coalesce(_text, '')) - octet_length(replace(coalesce(_text, ''), '\n', '')) + 1)"
    stay = f"array_except(sequence(0, {n} - 1), _drop)"
    kept = F.expr(
        f"if(_drop is null, _text, element_at(transform(array(split(_text, '\n', -1)), l -> array_join(transform({stay}, i -> get(l, i)), '\n')), 1))"
    )
    out = [kept.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    if counts:
        out += [F.expr(n).cast("long").alias(counts[0]), F.greatest(F.size("_drop"), F.lit(0)).cast("long").alias(counts[1])]
    return whole.select(*out)
