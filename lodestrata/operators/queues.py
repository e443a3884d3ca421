"""Enrichment queues: deterministic, bounded by a budget, reconciled with their sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import address_id, sha256_text
from .ranking import ranked, top

KEYS = ["normalized_address", "candidate_tier", "candidate_row_sha256"]
# Fixed value: what the tie-break digest starts with.
SEED = "btc-v2s-p2-economic-leader-v1:"


def needed(candidates: DataFrame, coverage: DataFrame) -> DataFrame:
    return candidates.join(
        coverage.where("coverage_state = 'needs_direct_enrichment'").select(*KEYS, "active_conflict", "explicit_direct_requirement"),
        KEYS
    )


def reconciliation(candidates: DataFrame, coverage: DataFrame, tiers: tuple[str, ...]) -> DataFrame:
    """Seven counts of two tables and their join; one row."""
    own, cov = candidates.where(F.col("candidate_tier").isin(*tiers)), coverage.where(F.col("candidate_tier").isin(*tiers))

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(f"{name}_rows"), F.count_distinct("normalized_address").alias(f"{name}_unique"))

    need = F.col("coverage_state") == "needs_direct_enrichment"
    must = need & (F.col("active_conflict") | F.col("explicit_direct_requirement"))
    joined = own.select(*KEYS).join(cov, KEYS).agg(
        F.count("*").alias("joined_rows"), F.count_if(need).alias("eligible_rows"),
        F.count_if(must).alias("mandatory_direct_rows")
    )
    return count(own, "candidate").crossJoin(count(cov, "coverage")).crossJoin(joined)


def budget(points_limit: int, points_used: int, points_each: int, runtime_minutes: int, requests_per_minute: int) -> int:
    """How many addresses both the points and the time allow."""
    return max(0, min((points_limit - points_used) // max(1, points_each), runtime_minutes * requests_per_minute))


def leaders(candidates: DataFrame, coverage: DataFrame, k: int, seed: str = SEED) -> DataFrame:
    """The k most valuable edge and other candidates that need direct enrichment, mandatory ones first; ties by seeded digest."""
    rows = needed(candidates.where("candidate_tier in ('edge', 'coarse_other')"), coverage)
    value = F.greatest(
        "current_utxo_sats", "lifetime_received_sats", "residual_gross_90d_sats", "max_same_tx_received_lifetime_sats",
        "max_same_tx_received_365d_sats", "max_same_tx_received_90d_sats"
    )
    rows = rows.withColumns({
        "economic_value_sats": value, "selection_key_sha256": sha256_text(F.concat(F.lit(seed), F.col("normalized_address"))),
        "address_id": address_id(F.col("normalized_address")), "cohort": F.lit("p2"),
        "_must": F.col("active_conflict") | F.col("explicit_direct_requirement"),
    })
    order = (F.desc("_must"), F.desc("economic_value_sats"), F.desc("v2_chain_score"), F.asc("selection_key_sha256"))
    return top(rows, k, *order).select(
        "queue_rank", "address_id", "normalized_address", "candidate_tier", "cohort", "v2_chain_score", "current_utxo_sats",
        "lifetime_received_sats", "economic_value_sats", "selection_key_sha256", "active_conflict", "explicit_direct_requirement",
        "candidate_row_sha256"
    )


def priority_queue(candidates: DataFrame, coverage: DataFrame) -> DataFrame:
    """All P0 and P1 candidates that need direct enrichment, in order; the ranking has no single task."""
    rows = needed(candidates.where("candidate_tier in ('p0', 'p1')"), coverage).withColumns(
        {"address_id": address_id(F.col("normalized_address")), "cohort": F.col("candidate_tier")}
    )
    order = (F.asc("cohort"), F.desc("v2_chain_score"), F.desc("current_utxo_sats"), F.desc("lifetime_received_sats"), F.asc("normalized_address"))
    return ranked(rows, *order).select(
        "queue_rank", "address_id", "normalized_address", "candidate_tier", "cohort", "v2_chain_score", "current_utxo_sats",
        "lifetime_received_sats", "active_conflict", "explicit_direct_requirement", "candidate_row_sha256"
    )


def due_rows(queue: DataFrame, attempted: DataFrame, terminal: DataFrame, memberships: DataFrame, evidence: DataFrame) -> DataFrame:
    """Rows still to do: not attempted, not terminal, and not covered since, unless direct enrichment is a must."""
    key = "address_id"
    rows = queue.join(attempted.select(key), key, "left_anti").join(terminal.select(key), key, "left_anti")
    covered = memberships.select(key).union(evidence.select(key)).distinct().withColumn("_covered", F.lit(True))
    rows = rows.join(covered, key, "left")
    return rows.where(F.col("active_conflict") | F.col("explicit_direct_requirement") | F.col("_covered").isNull()).drop("_covered")


def rank_gaps(queue: DataFrame) -> DataFrame:
    """One row: whether queue_rank runs from 1 without gaps or repeats."""
    n = F.count("*")
    return queue.agg(
        n.alias("row_count"),
        ((F.min("queue_rank") == 1) & (F.max("queue_rank") == n) & (F.count_distinct("queue_rank") == n)).alias("contiguous")
    )


def work_queue(requests: DataFrame, observed: DataFrame, prefix: str, fresh_after: str, limit: int) -> DataFrame:
    """Requests by priority and age whose reference has a prefix and whose address has no fresh observation."""
    fresh = observed.where(F.col("observed_at") > F.lit(fresh_after).cast(observed.schema["observed_at"].dataType)).select("address").distinct()
    rows = requests.where(F.startswith(F.col("source_reference"), F.lit(prefix))).join(fresh, "address", "left_anti")
    return rows.orderBy(F.desc("priority"), "requested_at", "created_at", "request_id").limit(limit)
