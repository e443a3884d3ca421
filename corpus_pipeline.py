"""A corpus through five stages, each written as Parquet and read again by the next.

In order: the quality classifier (rejected documents go), line dedup, near-dedup
by 5-word shingles at a Jaccard index of 0.8 (one document of each group stays),
substring dedup, packing. All but the last return the columns of documents.

What the stages keep for themselves, and a stage's own table once the next one is
written, are deleted on the way.

Defined results, for all stages: null and empty texts are scored, kept or dropped
by the classifier like others; all texts without words are near duplicates of each
other; the last stage packs them as their closing id. A row without an id is
scored, loses no lines, is never dropped as a duplicate, and comes last where order counts.
Rows that repeat an id are each scored, count as one document for lines, and stay
or go together as near duplicates. Texts may be of any length. More columns than
the five, whatever their names, pass through all stages but the last. An empty
table gives empty ones; without labels every document stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import dropped, scratch, table, written
from lodestrata.llm.line_dedup import line_dedup
from lodestrata.llm.packing import pack_documents
from lodestrata.llm.quality import quality_scores, score_names
from lodestrata.llm.resemblance import resemblance_dedup
from lodestrata.llm.substring_dedup import substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    good = F.col(score_names(docs.columns)[1]) == 1
    return quality_scores(docs, table(spark, sf_dir, "labels")).where(good).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resemblance_dedup(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(substring_dedup(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    import public_tokenizers

    places = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return places.withColumnRenamed("_id", "doc_id")


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars as the text now is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("passages", passages), ("packing", packing)]
#: SQL can't express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        made = []
        with scratch(keep=made):
            made.append(written(stage(spark, docs, sf_dir), f"stage-{name}"))
        if before is not None:
            dropped(before)
        docs = before = made[0]
    return docs
