"""Point-in-time resolution of competing evidence, as set algebra."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import fingerprint
from .anchors import active
from .evidence import canonical_value, claim_eligible
from .ranking import latest

KEY = ["address", "assertion_type"]
# The order in which authorities are preferred.
AUTHORITY = {"local_inference": 0, "official": 1, "regulator": 1, "commercial_provider": 2, "public_explorer": 3}


def _authority() -> Column:
    out = F.lit(9)
    for name, rank in AUTHORITY.items():
        out = F.when(F.col("source_authority") == name, rank).otherwise(out)
    return out


def claims(evidence: DataFrame, reviews: DataFrame, overrides: DataFrame, as_of: str) -> DataFrame:
    """One claim for each asserted value, with status from overrides, reviews and tiers."""
    c = F.col
    at = F.lit(as_of).cast(evidence.schema["observed_at"].dataType)
    rows = evidence.where((c("observed_at") <= at) & active(at) & claim_eligible()).withColumn("asserted_value", canonical_value())
    # tiers are letters in order, so the struct sorts by authority, tier, time, id
    prefer = F.struct(_authority().alias("a"), c("evidence_tier").alias("b"), c("observed_at").alias("c"), c("evidence_id").alias("d"))
    # the first named row wins; rows without one are left out by min_by's null order
    name, entity = F.when(c("candidate_entity_name") != "", c("candidate_entity_name")), F.when(c("candidate_entity_id") != "", c("candidate_entity_id"))
    grouped = rows.groupBy(*KEY, "asserted_value").agg(
        F.min("evidence_tier").alias("evidence_strength"), F.count("*").alias("corroboration_count"),
        F.count_distinct("independence_group").alias("independence_count"),
        F.min("effective_from").alias("effective_from"), F.max("effective_to").alias("effective_to"),
        (F.count_if(c("evidence_tier").isin("A", "B")) > 0).alias("_strong"),
        (F.count_if(~((c("source_authority") == "commercial_provider") & (c("evidence_tier") == "C"))) == 0).alias("_commercial"),
        F.min_by(name, F.when(name.isNotNull(), prefer)).alias("_name"), F.min_by(entity, F.when(entity.isNotNull(), prefer)).alias("_entity"),
    )
    value = [*KEY, "asserted_value"]
    review = latest(reviews, value, "reviewed_at", "review_id", as_of).select(*value, F.col("decision").alias("_review"), "reviewed_at")
    override = latest(overrides, value, "reviewed_at", "override_id", as_of).select(*value, F.col("decision").alias("override_decision"))
    out = grouped.join(review, value, "left").join(override, value, "left")
    status = (
        F.when(c("override_decision") == "reject", "rejected").when((c("_review") == "accept") & c("_strong"), "accepted")
        .when(c("_review") == "reject", "rejected").otherwise("unreviewed_external")
    )
    is_entity = c("assertion_type") == "entity_control"
    return out.withColumns({
        "claim_status": status, "entity_id": F.when(is_entity, c("_entity")), "entity_display": F.when(is_entity, c("_name")),
        "provider_default": is_entity & c("_commercial"),
        "claim_id": fingerprint(address=c("address"), assertion_type=c("assertion_type"), asserted_value=c("asserted_value"), status=status),
    }).drop("_strong", "_commercial", "_name", "_entity", "_review")


def resolutions(evidence: DataFrame, made: DataFrame, overrides: DataFrame, as_of: str) -> DataFrame:
    """State, policy and primary claim of each (address, assertion) with any evidence by then."""
    c = F.col
    at = F.lit(as_of).cast(evidence.schema["observed_at"].dataType)
    known = evidence.where(c("observed_at") <= at).groupBy(*KEY).agg((F.count_if(~F.coalesce(active(at), F.lit(False))) > 0).alias("_stale"))
    over = latest(
        overrides, [*KEY, "asserted_value"], "reviewed_at", "override_id", as_of
    ).select(*KEY).distinct().withColumn("_override", F.lit(True))
    live, chosen = c("claim_status") != "rejected", (c("claim_status") != "rejected") & (c("override_decision") == "select")
    row = F.struct("asserted_value", "claim_id", "claim_status", "entity_display", "provider_default")
    per = made.groupBy(*KEY).agg(
        F.count_if(live).alias("active_claims"), F.count_if(F.coalesce(chosen, F.lit(False))).alias("selected_claims"),
        F.min(F.when(chosen, row)).alias("_selected"), F.min(F.when(live, row)).alias("_only"),
        F.sort_array(F.collect_list("claim_id")).alias("candidate_claim_ids"),
    )
    out = known.join(per, KEY, "left").join(over, KEY, "left").na.fill(0, ["active_claims", "selected_claims"]).na.fill(False, ["_override"])
    none, one, many = c("active_claims") == 0, c("selected_claims") == 1, (c("active_claims") > 1) | (c("selected_claims") > 1)
    only = c("_only")
    branch = (
        F.when(none, "none").when(one, "override").when(many, "conflict").when(only["claim_status"] == "accepted", "reviewed").when(only["provider_default"], "default").otherwise("plain")
    )
    out = out.withColumn("_b", branch)

    def by(**values: object) -> Column:
        last = values.pop("other")
        e = last if isinstance(last, Column) else F.lit(last)
        for k, v in values.items():
            e = F.when(c("_b") == k, v if isinstance(v, Column) else F.lit(v)).otherwise(e)
        return e

    primary = F.when(c("_b") == "override", c("_selected")).when(~c("_b").isin("none", "conflict"), only)
    return out.withColumns({
        "identity_state": by(none=F.when(c("_stale"), "stale").otherwise("unattributed"), conflict="ambiguous", other="resolved"),
        "operational_tier": by(none="none", conflict="lookup_only", plain="discovery_only", other="lookup_usable"),
        "resolution_policy": by(
            none=F.when(c("_override"), "local_override").otherwise("unattributed"), override="local_override",
            conflict="conflict_first", reviewed="reviewed_evidence", default="provider_default", other="unreviewed_evidence"
        ),
        "freshness_status": by(
            none=F.when(c("_stale"), "stale").when(c("_override"), "locally_rejected").otherwise("unknown"),
            conflict="conflicted", other="fresh"
        ),
        "primary_claim_id": primary["claim_id"], "primary_entity_display": primary["entity_display"],
        "resolved_asserted_value": primary["asserted_value"],
        "candidate_claim_ids": F.coalesce("candidate_claim_ids", F.array().cast("array<string>")),
    }).drop("_stale", "_override", "_selected", "_only", "_b")


def conflicts(made: DataFrame, before: DataFrame | None, as_of: str) -> DataFrame:
    """Open conflicts (more than one live claim) and those of before that this closes.

    before: address, assertion_type, conflict_set_id, created_at of conflicts that were open.
    """
    c = F.col
    now = made.where("claim_status <> 'rejected'").groupBy(*KEY).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list("claim_id")).alias("claim_ids")
    ).where("n > 1").drop("n")
    if before is None:
        before = made.sparkSession.createDataFrame([], "address string, assertion_type string, conflict_set_id string, created_at timestamp")
    at = F.lit(as_of).cast(before.schema["created_at"].dataType)
    both = now.join(before.select(*KEY, "conflict_set_id", "created_at"), KEY, "full")
    new_id = fingerprint(address=c("address"), assertion_type=c("assertion_type"), opened=F.lit(as_of))
    return both.select(
        *KEY, F.coalesce("conflict_set_id", new_id).alias("conflict_set_id"), F.coalesce("created_at", at).alias("created_at"),
        F.when(c("claim_ids").isNull(), at).alias("resolved_at"),
        F.when(c("claim_ids").isNull(), "resolved").otherwise("active").alias("status"),
        F.coalesce("claim_ids", F.array().cast("array<string>")).alias("claim_ids"),
    )


def show(resolved: DataFrame, address: str, assertion_type: str) -> DataFrame:
    return resolved.where((F.col("address") == address) & (F.col("assertion_type") == assertion_type))


def decision_errors(entry: DataFrame, decisions: tuple[str, ...]) -> DataFrame:
    """Rows that can't be recorded, with codes."""
    missing = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rules = {
        "unknown_decision": ~F.coalesce(F.col("decision").isin(*decisions), F.lit(False)), "no_reviewer": missing("reviewer_ref"),
        "no_address": missing("address"), "no_time": F.col("reviewed_at").isNull()
    }
    return entry.withColumn("codes", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))).where(F.size("codes") > 0)


def recorded(log: DataFrame, entry: DataFrame, decisions: tuple[str, ...]) -> DataFrame:
    """log with entry appended; an error where any of its rows can't be recorded."""
    wrong = decision_errors(entry, decisions).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set(F.array_join("codes", ","))).alias("codes")
    ).first()
    if wrong.n:
        raise ValueError(f"{wrong.n} decisions can't be recorded: {'; '.join(wrong.codes)}")
    return log.unionByName(entry)
