"""Coverage state of candidates, and which addresses and entities are due."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAGS = ("direct_enriched", "entity_membership_covered", "local_evidence_covered", "active_conflict", "explicit_direct_requirement")


def coverage_state(
    candidates: DataFrame, direct: DataFrame, memberships: DataFrame, evidence: DataFrame, conflicts: DataFrame,
    explicit: DataFrame
) -> DataFrame:
    """State of each candidate: direct, then conflict or explicit need, then membership, then evidence, else needed.

    Each set has a normalized_address; memberships also an entity_id.
    """
    key, nobody = "normalized_address", F.lit(None).cast("string")
    sets = (direct, memberships, evidence, conflicts, explicit)
    # one grouping of all sets' rows, told apart by a number, and one join, in place of a join a set
    parts = [
        df.select(key, F.lit(k).alias("_set"), (F.col("entity_id") if df is memberships else nobody).alias("_entity")) for k,
        df in enumerate(sets)
    ]
    found = reduce(DataFrame.unionByName, parts).groupBy(key).agg(
        *[
            F.coalesce(F.max(F.col("_set") == k), F.lit(False)).alias(name) for k, name in enumerate(FLAGS)
        ], F.sort_array(F.collect_set("_entity")).alias("provider_entity_ids")
    )
    out = candidates.select(key, "candidate_tier", "candidate_row_sha256").join(found, key, "left").na.fill(False, list(FLAGS))
    out = out.withColumn("provider_entity_ids", F.coalesce("provider_entity_ids", F.array().cast("array<string>")))
    d, m, e, c, x = (F.col(f) for f in FLAGS)
    state = F.when(d, "direct_enriched").when(c | x, "needs_direct_enrichment").when(m, "entity_membership_covered").when(e, "local_evidence_covered").otherwise("needs_direct_enrichment")
    need = F.array_compact(F.array(F.when(c, F.lit("active_identity_conflict")), F.when(x, F.lit("explicit_address_level_requirement"))))
    reasons = (
        F.when(d, F.array(F.lit("direct_provider_response"))).when(c | x, need).when(m, F.array(F.lit("provider_entity_prediction")))
        .when(e, F.array(F.lit("valid_local_entity_evidence"))).otherwise(F.array(F.lit("no_explicit_entity_membership")))
    )
    return out.withColumns({"coverage_state": state, "coverage_reason_codes": reasons})


def coverage_counts(states: DataFrame) -> DataFrame:
    """Rows by state, and how many of them each set holds."""
    return states.groupBy("coverage_state").agg(F.count("*").alias("row_count"), *[F.count_if(f).alias(f"{f}_count") for f in FLAGS])


def set_overlap(sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """How many addresses of a set are candidates and how many are not."""
    own = sets.select("normalized_address").distinct().join(
        candidates.select("normalized_address").distinct().withColumn("_in", F.lit(True)), "normalized_address", "left"
    )
    return own.agg(F.count_if(F.col("_in").isNotNull()).alias("inside_count"), F.count_if(F.col("_in").isNull()).alias("outside_count"))


def due_addresses(requests: DataFrame, conflicts: DataFrame, parsed: DataFrame, fresh_after: str, limit: int) -> DataFrame:
    """Addresses requested or in conflict without a fresh parse, the most urgent first."""
    fresh = parsed.where(
        (F.col("parse_outcome") == "parsed_success") & (F.col("parsed_at") > F.lit(fresh_after).cast(parsed.schema["parsed_at"].dataType))
    ).select("address").distinct()
    asked = requests.groupBy("address").agg(F.max("priority").alias("priority"), F.min("requested_at").alias("due_at")).withColumn("c", F.lit(0))
    open_ = conflicts.where("status = 'active'").groupBy("address").agg(F.min("created_at").alias("due_at")).withColumns({"priority": F.lit(100), "c": F.lit(1)})
    due = asked.unionByName(open_).join(fresh, "address", "left_anti").groupBy("address").agg(
        F.max("priority").alias("priority"), F.max("c").alias("c"), F.min("due_at").alias("due_at")
    )
    kind = F.when(F.col("c") == 1, "active_conflict").otherwise("candidate_request")
    return due.select("address", "priority", kind.alias("source_kind"), "due_at").orderBy(F.desc("priority"), "due_at", "address").limit(limit)


def with_subjects(rows: DataFrame, subjects: DataFrame) -> DataFrame:
    """rows whose address is a known subject, with its subject_id and chain_key."""
    return rows.join(subjects.select("address", "subject_id", "chain_key"), "address")


def discovery_priority(rank: Column) -> Column:
    return F.when(rank.isNull(), 50).otherwise(F.greatest(F.lit(20), F.lit(70) - F.least(rank - 1, F.lit(50))))


def due_entities(
    observations: DataFrame, parses: DataFrame, attempts: DataFrame, seeds: DataFrame, exhausted: DataFrame, fresh_after: str,
    retry_after: str, limit: int, extra: DataFrame | None = None
) -> DataFrame:
    """Entities to look up, by priority: incomplete ones, discovered ones by rank, seeded ones; not the fresh, cooling or exhausted.

    extra: entities (entity_id, rank) that this run has discovered itself.
    """
    key = "entity_id"

    def after(df: DataFrame, ts: str, t: str) -> Column:
        return F.col(ts) > F.lit(t).cast(df.schema[ts].dataType)

    ids = lambda df: df.select(key).distinct()
    detail = observations.where("discovery_method = 'entity_detail'")
    fresh_detail = ids(detail.where(after(detail, "observed_at", fresh_after)))
    fresh_parse = ids(parses.where(F.col("parse_outcome").isin("parsed_success", "no_bitcoin_addresses") & after(parses, "parsed_at", fresh_after)))
    cooling = ids(
        attempts.where(F.col("outcome").isin("http_error", "transport_error", "rate_limited") & after(attempts, "attempted_at", retry_after))
    )
    found = observations.where(
        "discovery_method = 'balance_changes' and discovery_rank is not null"
    ).groupBy(key).agg(F.min("discovery_rank").alias("r"))
    scored = [
        ids(detail).withColumn("priority", F.lit(75)), found.select(key, discovery_priority(F.col("r")).alias("priority")),
        seeds.groupBy(key).agg(F.max("priority").alias("priority")),
    ]
    if extra is not None:
        scored.append(extra.groupBy(key).agg(F.min("rank").alias("r")).select(key, discovery_priority(F.col("r")).alias("priority")))
    # a detail that isn't fresh counts only where nothing else gives a priority
    other = reduce(DataFrame.unionByName, scored[1:])
    base = fresh_detail.join(fresh_parse, key, "left_anti").withColumn("priority", F.lit(75)).unionByName(other)
    rest = scored[0].join(base.select(key).distinct(), key, "left_anti")
    both = fresh_detail.join(fresh_parse, key, "left_semi")
    live = base.unionByName(rest).groupBy(key).agg(F.max("priority").alias("priority"))
    for out in (both, cooling, ids(exhausted)):
        live = live.join(out, key, "left_anti")
    return live.orderBy(F.desc("priority"), key).limit(limit)


def fetch_profile(
    requests: DataFrame, observations: DataFrame, conflicts: DataFrame, evidence: DataFrame, now: str, discovery_hours: int = 720,
    detail_hours: int = 720, high_priority: int = 80, near_days: int = 7
) -> DataFrame:
    """Which profile each requested address is fetched with next: discovery, detail, or none (null).

    observations: successful ones of profile discovery or detail, with a payload digest.
    """
    at = F.lit(now).cast(observations.schema["completed_at"].dataType)
    found, detail = F.col("query_profile") == "discovery", F.col("query_profile") == "detail"
    seen = observations.groupBy("address").agg(
        F.max(F.when(found, F.col("completed_at"))).alias("found_at"), F.max(F.when(detail, F.col("completed_at"))).alias("detail_at"),
        (F.count_distinct(F.when(found, F.col("payload_sha256"))) > 1).alias("changed"),
    )
    soon = evidence.where(
        (F.col("expires_at") > at) & (F.col("expires_at") <= at + F.expr(f"INTERVAL {near_days} DAYS"))
    ).select("address").distinct().withColumn("soon", F.lit(True))
    open_ = conflicts.where("status = 'active'").select("address").distinct().withColumn("conflict", F.lit(True))
    rows = requests.groupBy("address").agg(F.max("priority").alias("priority"))
    for df in (seen, soon, open_):
        rows = rows.join(df, "address", "left")
    fresh = lambda c, h: F.coalesce(F.col(c) > at - F.expr(f"INTERVAL {h} HOURS"), F.lit(False))
    needs = (F.col("priority") >= high_priority) | F.coalesce("conflict", F.lit(False)) | F.coalesce("changed", F.lit(False)) | F.coalesce("soon", F.lit(False))
    fetched = fresh("found_at", discovery_hours)
    profile = (
        F.when(F.col("found_at").isNull(), "discovery").when(fresh("detail_at", detail_hours), F.lit(None).cast("string"))
        .when(fetched & F.col("detail_at").isNull() & needs, "detail").when(fetched, F.lit(None).cast("string")).otherwise("discovery")
    )
    return rows.select("address", profile.alias("fetch_profile"))


def admission(reservations: DataFrame, now: str, run: str, requests_per_minute: int, run_points: int) -> DataFrame:
    """Requests in the last minute, the run's bytes so far (estimates where unknown), and whether one more is admitted."""
    at = F.lit(now).cast(reservations.schema["reserved_at"].dataType)
    minute = (F.col("reserved_at") > at - F.expr("INTERVAL 1 MINUTE")) & (F.col("reserved_at") <= at)
    one = reservations.agg(
        F.count_if(minute).alias("last_minute"),
        F.coalesce(F.sum(F.when(F.col("run_id") == run, F.coalesce("actual_bytes", "estimated_bytes"))), F.lit(0)).cast("bigint").alias("run_bytes")
    )
    return one.withColumn("admitted", (F.col("last_minute") < requests_per_minute) & (F.col("run_bytes") < run_points * 100_000))


def retry_exhausted(attempts: DataFrame, least: int = 3) -> DataFrame:
    """Entities whose attempts all failed with status 502, at least so many times."""
    by = attempts.groupBy("entity_id").agg(
        F.count("*").alias("attempt_count"), F.count_if(F.coalesce(F.col("http_status"), F.lit(0)) != 502).alias("_other")
    )
    return by.where((F.col("attempt_count") >= least) & (F.col("_other") == 0)).drop("_other")


def entity_frequency(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity_id").agg(F.count("*").alias("mention_count")).orderBy(F.desc("mention_count"), "entity_id")
