"""Replay of events against a snapshot; identity columns are added and nothing else changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import first_by

PROTECTED = ("event_id", "amount_btc", "direction", "threshold_result", "quality_decision", "alert_decision", "ownership_semantics")
ADDRESSES = ("watched_address", "output_address", "counterparty_address", "input_address")
INDEPENDENT = ("reviewed_evidence", "local_override")


def lookup(snapshot: DataFrame, assertion_type: str = "entity_control") -> DataFrame:
    """One row an address: what a lookup finds. Where an address has several, the first by all their fields, nulls first."""
    rows = first_by(
        snapshot.where(F.col("assertion_type") == assertion_type), ["address"], F.asc("identity_state"),
        F.asc("operational_tier"), F.asc("resolution_policy"), F.asc("primary_entity_display")
    )
    usable = F.col("operational_tier") == "lookup_usable"
    return rows.select(
        F.col("address").alias("lookup_address"), F.lit("found").alias("identity_lookup_status"), "identity_state",
        F.when(usable, F.col("primary_entity_display")).alias("identity_entity_display"),
        F.col("operational_tier").alias("identity_operational_tier"),
        F.coalesce("resolution_policy", F.lit("legacy_conservative")).alias("identity_resolution_policy"),
    )


def enriched(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """events with identity columns, by the first address that an event has."""
    address = F.coalesce(*[F.col(a) for a in ADDRESSES])
    out = events.withColumn("event_address", address).join(
        lookup(snapshot), F.col("event_address") == F.col("lookup_address"), "left"
    ).drop("lookup_address", "event_address")
    fill = {
        "identity_lookup_status": "not_found", "identity_state": "unattributed", "identity_operational_tier": "none",
        "identity_resolution_policy": "legacy_conservative"
    }
    return out.na.fill(fill)


def changed_fields(before: DataFrame, after: DataFrame, key: str = "event_id", fields: tuple[str, ...] = PROTECTED) -> DataFrame:
    """One row: how many protected fields differ, nulls compared as values."""
    pairs = before.alias("b").join(after.alias("a"), F.col(f"b.{key}") == F.col(f"a.{key}"))
    diff = sum((F.when(F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), 0).otherwise(1) for f in fields), F.lit(0))
    return pairs.agg(F.coalesce(F.sum(diff), F.lit(0)).cast("bigint").alias("changed_business_fields"))


def weight() -> Column:
    """An event's weight; 1 unless it is at least 1."""
    return F.when(F.coalesce(F.col("replay_weight"), F.lit(0)) >= 1, F.col("replay_weight")).otherwise(1).cast("bigint")


def replay_impact(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Weighted counts in one row."""
    rows, w = enriched(events, snapshot), weight()
    inside, policy = F.col("semantic_decision") == "internal_candidate", F.col("identity_resolution_policy")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, w).otherwise(0)), F.lit(0)).cast("bigint")
    return rows.agg(
        total(F.lit(True)).alias("events"), total(F.col("identity_lookup_status") == "found").alias("found"),
        total(inside).alias("internal_candidate_events"),
        total(inside & (F.col("identity_lookup_status") == "found")).alias("internal_candidate_identity_coverage"),
        *[total(inside & (policy == p)).alias(f"internal_candidate_{p}_events") for p in ("provider_default", "local_override", "conflict_first")],
        total(inside & F.col("input_address").isNull()).alias("internal_candidate_missing_input_context"),
    )


def policy_counts(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Weighted events by lookup status and policy."""
    rows = enriched(events, snapshot)
    return rows.groupBy("identity_lookup_status", "identity_resolution_policy").agg(F.sum(weight()).alias("weighted_events"))


def strong_condition() -> Column:
    c = F.col
    return F.coalesce(
        (c("semantic_decision") == "internal_candidate") & F.array_contains("quality_tags", "self_churn_possible") & (c("internal_transfer_score") >= 85)
        & (F.greatest(F.coalesce(c("ownership_transfer_score"), F.lit(0)), F.lit(0)) < 60), F.lit(False))


def bilateral_events(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Flags of each event with an output and a list of inputs, from both sides' lookups."""
    c, known = F.col, lookup(snapshot)
    ok = c("output_address").isNotNull() & c("input_addresses").isNotNull()
    valid = F.filter("input_addresses", lambda x: x.isNotNull())
    base = events.withColumns({"_ok": ok, "_inputs": F.array_distinct(valid), "_n_valid": F.size(valid)})
    complete = (c("_n_valid") > 0) & (c("_n_valid") == F.size("input_addresses")) & (F.coalesce(c("missing_input_address_count"), F.lit(0)) <= 0)
    side = lambda p: known.select(c("lookup_address").alias(f"{p}_address"), F.lower(F.trim("identity_entity_display")).alias(f"{p}_entity"), c("identity_resolution_policy").alias(f"{p}_policy"))
    inputs = base.where("_ok").select(
        "event_id", "output_address", F.explode("_inputs").alias("i_address")
    ).join(side("i"), "i_address", "left").join(side("o"), c("output_address") == c("o_address"), "left")
    same = (c("i_entity") == c("o_entity")) & (c("i_entity") != "")
    per = inputs.groupBy("event_id").agg(
        F.count("i_policy").alias("input_found"), F.coalesce(F.max(same), F.lit(False)).alias("same_entity"),
        F.coalesce(
            F.max(same & ((c("i_policy") == "provider_default") | (c("o_policy") == "provider_default"))), F.lit(False)
        ).alias("default_match"),
        F.coalesce(F.max(same & c("i_policy").isin(*INDEPENDENT) & c("o_policy").isin(*INDEPENDENT)), F.lit(False)).alias("independent_match"),
        F.coalesce(F.max(c("i_policy") == "conflict_first"), F.lit(False)).alias("_input_conflict"),
    )
    out = base.join(side("o"), c("output_address") == c("o_address"), "left").join(per, "event_id", "left")
    none = {k: False for k in ("same_entity", "default_match", "independent_match", "_input_conflict")} | {"input_found": 0}
    out = out.na.fill(none)
    return out.select(
        "event_id", (~c("_ok")).alias("malformed"), (c("_ok") & ~F.coalesce(complete, F.lit(False))).alias("incomplete"),
        (c("_ok") & c("o_policy").isNotNull()).alias("output_found"),
        F.when(c("_ok"), c("_n_valid")).otherwise(0).cast("bigint").alias("inputs_observed"), "input_found", "same_entity", "default_match",
        "independent_match",
        (
            c("_ok") & ((F.coalesce(c("o_policy"), F.lit("")) == "conflict_first") | c("_input_conflict"))
        ).alias("conflict_first"), (c("_ok") & strong_condition()).alias("strong"),
        (c("_ok") & (F.coalesce(c("semantic_decision"), F.lit("")) == "internal_candidate")).alias("internal"),
    )


def bilateral_impact(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    rows, c = bilateral_events(events, snapshot), F.col
    n = lambda cond: F.count_if(cond)
    usable = c("strong") & ~c("incomplete") & ~c("conflict_first") & c("same_entity")
    return rows.agg(
        F.count("*").alias("events"), n(c("malformed")).alias("malformed_events"), n(c("internal")).alias("internal_candidate_events"),
        n(c("incomplete")).alias("events_with_missing_input_address"),
        n(c("output_found")).alias("output_identity_found_events"),
        F.coalesce(F.sum("inputs_observed"), F.lit(0)).cast("bigint").alias("input_addresses_observed"),
        F.coalesce(F.sum("input_found"), F.lit(0)).cast("bigint").alias("input_identity_found_addresses"),
        n(c("conflict_first")).alias("conflict_first_side_events"),
        n(c("same_entity")).alias("same_entity_bilateral_events"), n(c("default_match")).alias("same_entity_provider_default_events"),
        n(c("independent_match")).alias("same_entity_independent_evidence_events"),
        n(c("strong")).alias("source_strong_condition_events"), n(usable & c("default_match")).alias("provider_default_suppression_candidates"),
        n(usable & c("independent_match")).alias("independent_evidence_suppression_candidates"), F.lit(0).cast("bigint").alias("live_action_changes"),
    )
