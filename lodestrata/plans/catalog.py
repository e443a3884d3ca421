"""Every query by name, over the test tables' projections."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anchors as A
from ..operators import audit as U
from ..operators import candidates as C
from ..operators import census as N
from ..operators import coverage as V
from ..operators import economics as E
from ..operators import evidence as I
from ..operators import firstwave as W
from ..operators import flatten as X
from ..operators import policy as P
from ..operators import queues as Q
from ..operators import ranking as K
from ..operators import reconcile as R
from ..operators import replay as Y
from ..operators import resolver as S
from ..operators import snapshot as H
from ..sources import evidence_projection as D
from ..sources import projection as J
from ..sources.shared import kept
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
AS_OF_DAY, EARLY, SCRIPTED = "2001-07-25", "1995-01-31 00:00:00", True


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


def _tx(s: SparkSession, d: str) -> DataFrame:
    return X.at_cutoff(J.transactions(s, d), J.CUTOFF_HEIGHT, J.CUTOFF_TIME)


def _io(s: SparkSession, d: str, full: bool = False) -> DataFrame:
    return X.flatten_io(_tx(s, d), full)


def _economics(s: SparkSession, d: str) -> DataFrame:
    return E.address_economics(_io(s, d), J.CUTOFF_TIME)


def _chain_v1(s: SparkSession, d: str) -> DataFrame:
    return P.chain_policy_v1(E.economics_v1(_io(s, d), J.CUTOFF_TIME), J.CUTOFF_TIME)


def _variants(s: SparkSession, d: str) -> DataFrame:
    return P.variants_v2(_economics(s, d), J.CUTOFF_TIME)


def _features(s: SparkSession, d: str) -> DataFrame:
    return E.address_features(_io(s, d, True), J.CUTOFF_TIME)


def _anchors(s: SparkSession, d: str) -> DataFrame:
    return A.anchors_as_of(D.evidence(s, d), D.conflicts(s, d), D.predictions(s, d), D.requests(s, d), D.AS_OF)


def _decisions(s: SparkSession, d: str) -> DataFrame:
    return P.importance_v1(A.with_reasons(_features(s, d), _anchors(s, d)), J.CUTOFF_TIME, J.CAMPAIGN)


def _named(df: DataFrame) -> DataFrame:
    return df.select(F.col("address").alias("normalized_address"))


def _candidates(s: SparkSession, d: str) -> DataFrame:
    """Kept, as queues and coverage both read it; in production it is the published artifact (sources.sinks.publish_candidates)."""
    return kept(C.strict_candidates(_variants(s, d)), "candidates")


def _coverage(s: SparkSession, d: str, candidates: DataFrame | None = None) -> DataFrame:
    """Kept too: its counts, queues and reconciliation read it several times."""
    direct = D.parses(s, d).where("parse_outcome = 'parsed_success'")
    members = D.predictions(s, d).withColumnRenamed("address", "normalized_address")
    proven = D.evidence(s, d).where("evidence_tier in ('A', 'B')")
    explicit = D.requests(s, d).where("reason = 'known_watchlist' and priority > 90")
    own = _candidates(s, d) if candidates is None else candidates
    conflicts = _named(D.conflicts(s, d).where("status = 'active'"))
    return kept(V.coverage_state(own, _named(direct), members, _named(proven), conflicts, _named(explicit)), "coverage")


def _claims(s: SparkSession, d: str) -> DataFrame:
    return kept(S.claims(D.evidence(s, d), D.reviews(s, d), D.overrides(s, d), D.AS_OF), "claims")


def _resolutions(s: SparkSession, d: str) -> DataFrame:
    return S.resolutions(D.evidence(s, d), _claims(s, d), D.overrides(s, d), D.AS_OF)


@query
def flatten_io(s, d):
    return _io(s, d).select(
        "transaction_hash", "row_kind", "block_number", F.size("addresses").alias("n_addresses"),
        F.get("addresses", F.lit(0)).alias("first_address"), F.col("value_sats").cast("bigint").alias("value_sats")
    )


@query
def cutoff_scan(s, d):
    rows = X.at_cutoff(J.transactions(s, d), 1200, "1998-03-01 00:00:00")
    return rows.agg(F.count("*").alias("transactions"), F.max("block_number").alias("height"), F.max("block_timestamp").alias("time"))


@query
def recent_outputs(s, d):
    rows = X.recent(J.transactions(s, d), AS_OF_DAY).select("block_number", F.explode("outputs").alias("o"))
    return rows.groupBy("block_number").agg(F.count("*").alias("output_count"))


@query
def address_scale(s, d):
    return E.address_scale(_io(s, d))


@query
def address_economics_v2(s, d):
    return _economics(s, d)


@query
def economics_v1(s, d):
    return E.economics_v1(_io(s, d), J.CUTOFF_TIME)


@query
def received_by_transaction(s, d):
    return E.received_by_transaction(_io(s, d)).withColumn("same_tx_received_sats", F.col("same_tx_received_sats").cast("bigint"))


@query
def large_counterparties(s, d):
    return E.large_counterparties(_io(s, d))


@query
def address_features(s, d):
    return _features(s, d)


@query
def script_subjects(s, d):
    return E.script_subjects(_io(s, d, SCRIPTED))


@query
def source_accounting(s, d):
    return E.source_accounting(_io(s, d, True))


@query
def source_checkpoint(s, d):
    return E.source_checkpoint(J.transactions(s, d), J.blocks(s, d), AS_OF_DAY, 2)


@query
def source_quality(s, d):
    return N.source_quality(_economics(s, d))


@query
def quality_counts(s, d):
    return N.quality_counts(_io(s, d))


@query
def policy_v1_chain(s, d):
    return _chain_v1(s, d).select(
        "normalized_address", "recency_days", "chain_importance_score", "p0_mask", "is_chain_p0", "is_chain_p1",
        "is_edge_upgrade_frontier", "has_positive_economic_component", "is_coarse_candidate"
    )


@query
def importance_v1(s, d):
    rows = _decisions(s, d)
    return rows.select(
        "address_id", "priority_class", "importance_score", F.array_join("reason_codes", ",").alias("reasons"),
        F.array_join("cohort_names", ",").alias("cohorts")
    )


@query
def policy_v2_variants(s, d):
    return _variants(s, d).select(
        "normalized_address", "residual_gross_90d_sats", "v2_chain_score", "receipt_support_mask",
        *[f"{v}_{x}" for v in P.VARIANTS for x in ("p0_mask", "is_p1", "is_edge", "is_coarse")]
    )


@query
def census_v1(s, d):
    return N.counters_v1(_chain_v1(s, d))


@query
def census_v2(s, d):
    return N.counters_v2(_variants(s, d))


@query
def overlap_histograms(s, d):
    return N.histograms(
        _variants(s, d),
        {"receipt_support": "receipt_support_mask", "score": "v2_chain_score"} | {f"{v}_p0": f"{v}_p0_mask" for v in P.VARIANTS}
    )


@query
def p0_overlap(s, d):
    return N.ordered(N.histogram(_chain_v1(s, d), "p0_mask", "mask"), "dist", "mask").select(
        F.array_join(F.transform("dist", lambda x: F.concat(x["mask"], F.lit(":"), x["address_count"])), ",").alias("distribution")
    )


@query
def census_v1_reconciled(s, d):
    io = _io(s, d)
    economics = E.economics_v1(io, J.CUTOFF_TIME)
    return R.reconcile_v1(N.census_v1(io, economics, P.chain_policy_v1(economics, J.CUTOFF_TIME))).select(
        "outcome", F.array_join("blocked_codes", ",").alias("blocked"), F.array_join("warning_codes", ",").alias("warned")
    )


@query
def census_v2_reconciled(s, d):
    io = _io(s, d)
    economics = E.address_economics(io, J.CUTOFF_TIME)
    return R.reconcile_v2(N.census_v2(io, economics, P.variants_v2(economics, J.CUTOFF_TIME))).select(
        "outcome", F.array_join("blocked_codes", ",").alias("blocked"), F.array_join("warning_codes", ",").alias("warned")
    )


def _dist(name: str):
    """A distribution as text: value:count, by value."""
    key = "score" if name.startswith("score") else "mask"
    return F.array_join(F.transform(name, lambda x: F.concat(x[key], F.lit(":"), x["address_count"])), ",")


@query
def census_v1_row(s, d):
    economics = E.economics_v1(_io(s, d), J.CUTOFF_TIME)
    row = N.census_v1(_io(s, d), economics, P.chain_policy_v1(economics, J.CUTOFF_TIME))
    return row.withColumns({c: _dist(c) for c in ("p0_overlap_distribution", "score_histogram")})


@query
def census_v2_row(s, d):
    economics = _economics(s, d)
    row = N.census_v2(_io(s, d), economics, P.variants_v2(economics, J.CUTOFF_TIME))
    for v in P.VARIANTS:
        struct = row.schema[f"{v}_variant"].dataType
        parts = {f"{v}_variant_{f.name}": _dist(f"{v}_variant.{f.name}") if f.name.endswith("distribution") else F.col(f"{v}_variant.{f.name}") for f in struct}
        row = row.withColumns(parts).drop(f"{v}_variant")
    return row.withColumns({c: _dist(c) for c in ("receipt_support_overlap_distribution", "score_histogram")})


@query
def population_contract(s, d):
    positive = _economics(s, d).where("has_output")
    by_output = E.economics_v1(_io(s, d), J.CUTOFF_TIME).where("has_output")
    return R.population_contract(positive, by_output, 5_000_000).withColumn("blocked_codes", F.array_join("blocked_codes", ","))


@query
def candidates_v2_s(s, d):
    return _candidates(s, d)


@query
def candidate_violations(s, d):
    """Rows of one bucket with another score: their digests no longer fit."""
    bad = _candidates(s, d).withColumn("v2_chain_score", F.col("v2_chain_score") + F.when(F.col("address_bucket") == 3, 1).otherwise(0))
    return C.violations(bad).select("normalized_address", F.array_contains("codes", "row_digest").alias("digest_differs"))


@query
def tier_bucket_counts(s, d):
    return C.tier_bucket_counts(_candidates(s, d))


@query
def excluded_candidates(s, d):
    rows = _candidates(s, d)
    out = rows.where("address_bucket = 7").select(F.sha2(F.col("normalized_address").cast("binary"), 256).alias("address_sha256"))
    return C.without_excluded(rows, out)[0].select("normalized_address", "candidate_tier")


@query
def anchors_as_of(s, d):
    return _anchors(s, d)


def _early(s: SparkSession, d: str) -> DataFrame:
    """Features of a campaign that ended after the first month, so many anchors of today have none."""
    return E.address_features(X.flatten_io(X.at_cutoff(J.transactions(s, d), 30, EARLY), True), EARLY)


@query
def anchor_only(s, d):
    return A.anchor_only(_anchors(s, d), _early(s, d)).withColumn("calibration_reasons", F.array_join("calibration_reasons", ","))


@query
def cohort_overlap(s, d):
    return A.cohort_overlap(_decisions(s, d))


@query
def topk_per_cohort(s, d):
    return W.best_by_group(_decisions(s, d), 20).select("quota_group", "group_rank", "address_id", "importance_score", "largest_sats")


@query
def p0_leaders(s, d):
    return W.best_p0(_decisions(s, d), 50).select("address_id", "p0_place", "p0_metric")


def _campaign(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Decisions of the early campaign, kept, and the anchors without features."""
    rows, anchors = kept(_early(s, d), "features"), _anchors(s, d)
    decided = P.importance_v1(A.with_reasons(rows, anchors), EARLY, J.CAMPAIGN)
    return kept(decided, "decisions"), A.anchor_only(anchors, rows)


@query
def first_wave(s, d):
    decided, anchors = _campaign(s, d)
    return W.select_first_wave(decided, _slots(decided, anchors), anchors)


def _slots(decided: DataFrame, anchors: DataFrame) -> int:
    """Past all P0 rows and a third of the others, so quotas and caps both count."""
    n = {r.priority_class: r["count"] for r in decided.groupBy("priority_class").count().collect()}
    return n.get("P0", 0) + anchors.count() + (n.get("P1", 0) + n.get("CONTROL", 0)) // 3


@query
def first_wave_statistics(s, d):
    decided, anchors = _campaign(s, d)
    rows = W.first_wave_statistics(decided, anchors, W.capacity(4, 5, 1000, 25), 5)
    return rows.where("metric <> 'first_wave'")


@query
def first_wave_leaders(s, d):
    return W.best_p0(*(lambda x: (x[0], 80, x[1]))(_campaign(s, d)))


@query
def coverage_state(s, d):
    return _coverage(s, d).withColumns({x: F.array_join(x, ",") for x in ("provider_entity_ids", "coverage_reason_codes")})


@query
def coverage_counts(s, d):
    return V.coverage_counts(_coverage(s, d))


@query
def set_overlap(s, d):
    return V.set_overlap(D.predictions(s, d).withColumnRenamed("address", "normalized_address"), _candidates(s, d))


@query
def queue_reconciliation(s, d):
    own = _candidates(s, d)
    return Q.reconciliation(own, _coverage(s, d, own), ("edge", "coarse_other"))


@query
def p2_queue(s, d):
    own = _candidates(s, d)
    return Q.leaders(own, _coverage(s, d, own), 100)


@query
def p0p1_queue(s, d):
    own = _candidates(s, d)
    return Q.priority_queue(own, _coverage(s, d, own))


@query
def queue_due(s, d):
    queue, ids = p0p1_queue(s, d), lambda df: df.select(Q.address_id(F.col("address")).alias("address_id")).distinct()
    done = Q.due_rows(
        queue, ids(D.observations(s, d).where("observation_id % 30 = 0")),
        ids(D.parses(s, d).where("parse_outcome = 'parsed_success'")), ids(D.predictions(s, d)),
        ids(D.evidence(s, d).where("evidence_tier = 'A'"))
    )
    return done.select("queue_rank", "normalized_address")


@query
def due_addresses(s, d):
    return V.due_addresses(D.requests(s, d), D.conflicts(s, d), D.parses(s, d), "2024-01-20 00:00:00", 40)


@query
def due_entities(s, d):
    e = J.table(s, d, "events").withColumn("entity_id", F.concat(F.lit("e"), F.col("event_id") % 97))
    obs = e.select(
        "entity_id",
        F.when(F.col("event_type") == "view", "entity_detail").otherwise("balance_changes").alias("discovery_method"),
        (F.col("event_id") % 60 + 1).cast("int").alias("discovery_rank"), F.col("ts").alias("observed_at")
    )
    parses = e.where("event_type = 'click'").select(
        "entity_id", F.when(F.col("event_id") % 2 == 0, "parsed_success").otherwise("failed").alias("parse_outcome"),
        F.col("ts").alias("parsed_at")
    )
    attempts = e.where("event_type = 'error'").select(
        "entity_id", F.when(F.col("event_id") % 3 == 0, "rate_limited").otherwise("ok").alias("outcome"),
        F.col("ts").alias("attempted_at")
    )
    seeds = e.where("event_id % 31 = 0").select("entity_id", (F.col("event_id") % 90).cast("int").alias("priority"))
    out = e.where("event_id % 97 = 5").select("entity_id").distinct()
    return V.due_entities(obs, parses, attempts, seeds, out, "2024-01-30 12:00:00", "2024-01-30 18:00:00", 60)


@query
def fetch_profile(s, d):
    seen = D.observations(s, d).where("outcome = 'success'")
    return V.fetch_profile(D.requests(s, d), seen, D.conflicts(s, d), D.evidence(s, d), D.AS_OF, 24, 24, 101)


@query
def admission_window(s, d):
    r = J.table(s, d, "events").select(
        F.col("ts").alias("reserved_at"), (F.col("event_id") % 3).cast("string").alias("run_id"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("actual_bytes"),
        F.lit(1000).cast("bigint").alias("estimated_bytes")
    )
    return V.admission(r, "2024-01-15 00:00:00", "1", 25, 1000)


@query
def entity_frequency(s, d):
    return V.entity_frequency(D.predictions(s, d))


@query
def work_queue(s, d):
    return Q.work_queue(
        D.requests(s, d), D.observations(s, d).withColumnRenamed("completed_at", "observed_at"), "panel:", "2024-01-29 12:00:00",
        30
    ).select("request_id", "address", "priority", "source_reference")


@query
def evidence_contract(s, d):
    return I.checked(D.evidence(s, d))[1].groupBy(F.array_join("codes", ",").alias("codes")).agg(F.count("*").alias("row_count"))


@query
def claims(s, d):
    return _claims(s, d)


@query
def resolutions(s, d):
    return _resolutions(s, d).select(
        "address", "assertion_type", "active_claims", "selected_claims", "identity_state", "operational_tier",
        "resolution_policy", "freshness_status", "primary_entity_display", "resolved_asserted_value"
    )


@query
def conflicts(s, d):
    return S.conflicts(_claims(s, d), None, D.AS_OF).select(
        "address", "assertion_type", "status", "conflict_set_id", F.array_join("claim_ids", ",").alias("claim_ids")
    )


@query
def snapshot_rows(s, d):
    made = _claims(s, d)
    now, at = _resolutions(s, d), F.lit(D.AS_OF).cast("timestamp")
    other = now.withColumns({"operational_tier": F.lit("discovery_only"), "primary_entity_display": F.lit("someone else")})
    # an older resolution, one of the same time with a lesser id, and one from after the snapshot's time
    times = ((now, 0, "r"), (other, -24, "s"), (other, 0, "a"), (other, 24, "t"))
    made_at = [df.withColumns({"resolved_at": at + F.expr(f"INTERVAL '{h}' HOUR"), "resolution_id": F.lit(i)}) for df, h, i in times]
    rows = reduce(DataFrame.unionByName, made_at)
    return H.snapshot_rows(rows, made, D.AS_OF).select(
        "address", "assertion_type", "operational_tier", "primary_entity_display",
        F.size("candidate_entities").alias("candidates")
    )


@query
def latest_message(s, d):
    return K.first_by(J.table(s, d, "conversations"), ["conv_id"], F.desc("turn"), F.desc("role")).select("conv_id", "turn", "role")


@query
def replay_impact(s, d):
    return Y.replay_impact(D.replay_events(s, d), _resolutions(s, d))


@query
def replay_policy_counts(s, d):
    return Y.policy_counts(D.replay_events(s, d), _resolutions(s, d))


@query
def replay_changed_fields(s, d):
    """Replay itself changes nothing; every 13th event was changed on the way here, in one field."""
    events = D.replay_events(s, d)
    changed = events.withColumn(
        "amount_btc",
        F.when(F.col("event_id").cast("long") % 13 == 0, F.concat("amount_btc", F.lit("0"))).otherwise(F.col("amount_btc"))
    )
    return Y.changed_fields(events, Y.enriched(changed, _resolutions(s, d)))


@query
def bilateral_impact(s, d):
    return Y.bilateral_impact(D.replay_events(s, d), _resolutions(s, d))


@query
def provider_panel(s, d):
    return U.provider_panel(_panel(s, d))


@query
def panel_by_stratum(s, d):
    return U.panel_by_stratum(_panel(s, d))


def _panel(s: SparkSession, d: str) -> DataFrame:
    return U.panel_rows(D.requests(s, d), D.observations(s, d), D.evidence(s, d), D.payloads(s, d), "panel:", ("A", "B"))


@query
def calibration_seeds(s, d):
    return U.calibration_seeds(D.evidence(s, d), ("A", "B"), "purchase", "panel:v", D.requests(s, d).where("request_id % 4 = 0"))


@query
def outcome_counts(s, d):
    return U.group_counts(D.observations(s, d), "outcome", "completed_at", "2024-01-05 00:00:00", "2024-01-20 00:00:00")


@query
def point_totals(s, d):
    sized = D.observations(s, d).withColumn("response_bytes", F.col("observation_id") * 777)
    return U.point_totals(sized)


@query
def nearest_rank(s, d):
    return K.nearest_rank(D.observations(s, d), "observation_id", {"p50": 0.5, "p95": 0.95})
