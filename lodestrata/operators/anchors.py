"""Calibration anchors and the cohorts they join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active(as_of: Column) -> Column:
    """Whether an evidence row holds at a time."""
    c = F.col
    return (c("evidence_status") == "valid") & (
        c("effective_from").isNull() | (c("effective_from") <= as_of)
    ) & (c("effective_to").isNull() | (c("effective_to") >= as_of)) & (c("expires_at").isNull() | (c("expires_at") >= as_of))


def anchors_as_of(evidence: DataFrame, conflicts: DataFrame, predictions: DataFrame, requests: DataFrame, as_of: str) -> DataFrame:
    """Distinct (address, reason_code) of four populations known at a time.

    evidence: rows of tier B, or verified ones of tier A, active then; conflicts: open ones; predictions
    of entities; requests for known watchlists.
    """

    def at(df: DataFrame, ts: str) -> Column:
        return F.lit(as_of).cast(df.schema[ts].dataType)

    def named(df: DataFrame, reason: str) -> DataFrame:
        return df.select("address", F.lit(reason).alias("reason_code"))

    official = evidence.where(
        (F.col("observed_at") <= at(evidence, "observed_at")) & active(at(evidence, "observed_at")) & (
            (F.col("evidence_tier") == "B") | ((F.col("evidence_tier") == "A") & (F.col("verification_result") == "valid"))
        )
    )
    parts = [
        named(official, "official_or_signed_evidence"), named(
            conflicts.where(
                (F.col("created_at") <= at(conflicts, "created_at")) & (F.col("status") == "active") & (
                    F.col("resolved_at").isNull() | (F.col("resolved_at") > at(conflicts, "resolved_at"))
                )
            ),
            "existing_provider_conflict"
        ),
        named(predictions.where(F.col("observed_at") <= at(predictions, "observed_at")), "provider_entity_prediction"),
        named(
            requests.where((F.col("requested_at") <= at(requests, "requested_at")) & (F.col("reason") == "known_watchlist")),
            "existing_system_watchlist"
        ),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def reasons_by_address(anchors: DataFrame, key: str = "address") -> DataFrame:
    return anchors.groupBy(key).agg(F.sort_array(F.collect_set("reason_code")).alias("calibration_reasons"))


def with_reasons(features: DataFrame, anchors: DataFrame) -> DataFrame:
    """features with their reasons; an address without one gets an empty list."""
    r = reasons_by_address(anchors).withColumnRenamed("address", "normalized_address")
    none = F.array().cast("array<string>")
    return features.join(r, "normalized_address", "left").withColumn("calibration_reasons", F.coalesce("calibration_reasons", none))


def anchor_only(anchors: DataFrame, features: DataFrame) -> DataFrame:
    """Reasons of anchored addresses that have no features."""
    return reasons_by_address(anchors).join(features.select(F.col("normalized_address").alias("address")), "address", "left_anti")


def cohort_overlap(rows: DataFrame, names: str = "cohort_names") -> DataFrame:
    """How many rows each pair of cohorts shares; a cohort with itself gives its size."""
    pairs = F.flatten(
        F.transform(names, lambda a: F.transform(F.filter(names, lambda b: b >= a), lambda b: F.struct(a.alias("cohort_a"), b.alias("cohort_b"))))
    )
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.cohort_a", "p.cohort_b").agg(F.count("*").alias("address_count"))
