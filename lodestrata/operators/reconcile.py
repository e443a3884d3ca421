"""Census reconciliation: a table of rules over the one-row census gives its reason codes and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def _ladder(*names: str) -> Column:
    """Counts must not grow from a lower threshold to a higher one."""
    out = F.lit(False)
    for a, b in zip(names, names[1:], strict=False):
        out = out | (c(a) < c(b))
    return out


def _total(dist: str | Column) -> Column:
    return F.aggregate(dist, F.lit(0).cast("bigint"), lambda a, x: a + x["address_count"])


def _with_bit(dist: Column, bit: int) -> Column:
    return F.aggregate(dist, F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["mask"].bitwiseAND(bit) != 0, x["address_count"]).otherwise(0))


def _nonzero(dist: Column) -> Column:
    return F.aggregate(dist, F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["mask"] != 0, x["address_count"]).otherwise(0))


def _steps(prefix: str, steps: tuple, suffix: str = "_btc_count") -> tuple[str, ...]:
    return tuple(f"{prefix}{s}{suffix}" for s in steps)


def judged(row: DataFrame, blocked: dict[str, Column], warned: dict[str, Column]) -> DataFrame:
    """row with outcome (allow, warn, blocked) and the sorted codes of the rules that it breaks."""
    hard = F.array_sort(F.array_compact(F.array(*[F.when(x, F.lit(k)) for k, x in blocked.items()])))
    soft = F.array_sort(F.array_compact(F.array(*[F.when(x, F.lit(k)) for k, x in warned.items()])))
    outcome = F.when(F.size(hard) > 0, "blocked").when(F.size(soft) > 0, "warn").otherwise("allow")
    return row.withColumns({"outcome": outcome, "blocked_codes": hard, "warning_codes": soft})


def reconcile_v1(row: DataFrame) -> DataFrame:
    source, dist = c("source_standard_address_count"), c("p0_overlap_distribution")
    blocked = {
        "null_values": c("null_value_count") > 0, "value_cast_failures": c("value_cast_failure_count") > 0,
        "negative_utxo": c("negative_current_utxo_count") > 0,
        "p0_distribution_total": _total(dist) != source, "p0_union": _nonzero(dist) != c("chain_p0_union_count"),
        "score_total": _total("score_histogram") != source,
        "p0_bits": (_with_bit(dist, 1) != c("p0_utxo_ge_100_btc_count")) | (_with_bit(dist, 2) != c("p0_same_tx_receive_ge_500_btc_count"))
        | (_with_bit(dist, 4) != c("p0_gross_90d_ge_1000_btc_count")) | (_with_bit(dist, 8) != c("p0_lifetime_ge_10000_active_365d_count")),
        "p0_p1_overlap": c("p0_p1_overlap_count") != 0,
        "coarse_partition": c("coarse_candidate_union_count") + c("excluded_source_address_count") != source,
        "coarse_too_small": c("coarse_candidate_union_count") < c("chain_p0_union_count") + c("chain_p1_count") + c("edge_upgrade_frontier_count"),
        "utxo_ladder": _ladder(*_steps("utxo_ge_", (1, 10, 100, 1000))),
        "receipt_ladder": _ladder(*_steps("same_tx_receive_ge_", (100, 500, 1000, 5000))),
        "gross_ladder": _ladder(*_steps("gross_90d_ge_", (10, 100, 1000, 10000))),
        "recency_ladder": _ladder(*_steps("recency_le_", (365, 90, 30), "d_count")),
    }
    cohort = F.greatest("current_capital_count", "historical_large_receipt_count", "high_turnover_count", "dormant_holder_count")
    warned = {
        "coarse_over_5m": c("coarse_candidate_union_count") > 5_000_000, "p0_over_120k": c("chain_p0_union_count") > 120_000,
        "edge_over_1m": c("edge_upgrade_frontier_count") > 1_000_000,
        "cohort_over_40_percent": cohort * 100 > c("coarse_candidate_union_count") * 40,
    }
    return judged(row, blocked, warned)


def reconcile_v2(row: DataFrame, hard: dict[str, int] | None = None, review: dict[str, int] | None = None) -> DataFrame:
    """hard and review: most P0, coarse, edge (and receipts) before the census is stopped or looked at."""
    hard = {"p0": 1_000_000, "coarse": 5_000_000, "edge": 1_000_000} | (hard or {})
    review = {"p0": 120_000, "coarse": 2_000_000, "receipt": 95_906} | (review or {})
    source = c("source_standard_address_count")
    blocked = {
        "null_values": c("null_value_count") > 0, "value_cast_failures": c("value_cast_failure_count") > 0,
        "negative_utxo": c("negative_current_utxo_count") > 0,
        "score_total": _total("score_histogram") != source, "support_total": _total("receipt_support_overlap_distribution") != source,
        "support_bits": (_with_bit(c("receipt_support_overlap_distribution"), 1) != c("recent_receipt_retained_count"))
        | (_with_bit(c("receipt_support_overlap_distribution"), 2) != c("recent_receipt_repeated_count"))
        | (_with_bit(c("receipt_support_overlap_distribution"), 4) != c("recent_receipt_sustained_activity_count")),
        "utxo_ladder": _ladder(*_steps("utxo_ge_", (1, 10, 100, 1000))),
        "raw_gross_ladder": _ladder(*_steps("raw_gross_90d_ge_", (10, 100, 1000, 10000))),
        "residual_ladder": _ladder(*_steps("residual_gross_90d_ge_", (10, 100, 1000, 10000))),
        "recency_ladder": _ladder(*_steps("recency_le_", (365, 90, 30), "d_count")),
        "horizon_ladder": _ladder("lifetime_max_receipt_ge_500_btc_count", "max_receipt_365d_ge_500_btc_count", "max_receipt_90d_ge_500_btc_count"),
        "residual_over_raw": _ladder("raw_gross_90d_ge_10_btc_count", "residual_gross_90d_ge_10_btc_count"),
        "variant_funnel": _ladder("balanced_p0_receipt_count", "strict_p0_receipt_count") | _ladder("balanced_p0_union_count", "strict_p0_union_count"),
        "hard_stop_p0": c("strict_p0_union_count") > hard["p0"], "hard_stop_coarse": c("strict_coarse_count") > hard["coarse"],
        "hard_stop_edge": c("strict_edge_count") > hard["edge"],
    }
    for v in ("strict", "balanced", "retention"):
        d = c(f"{v}_variant.p0_overlap_distribution")
        blocked[f"{v}_partition"] = (_total(d) != source) | (_nonzero(d) != c(f"{v}_p0_union_count")) | (c(f"{v}_coarse_count") + c(f"{v}_excluded_count") != source)
        blocked[f"{v}_bits"] = (_with_bit(d, 1) != c("p0_utxo_count")) | (_with_bit(d, 2) != c("p0_sustained_residual_gross_count")) | (_with_bit(d, 4) != c(f"{v}_p0_receipt_count")) | (_with_bit(d, 8) != c("p0_lifetime_active_supported_count"))
        blocked[f"{v}_p0_p1_overlap"] = c(f"{v}_p0_p1_overlap_count") != 0
    warned = {
        "review_p0": c("strict_p0_union_count") > review["p0"], "review_coarse": c("strict_coarse_count") > review["coarse"],
        "review_receipt": c("strict_p0_receipt_count") > review["receipt"]
    }
    return judged(row, blocked, warned)


def population_contract(positive: DataFrame, by_output: DataFrame, capacity: int) -> DataFrame:
    """One row: the positive-value population lies within the output-defined one, they partition it, and it fits the capacity."""
    p, o = positive.select("normalized_address"), by_output.select("normalized_address")
    outside = p.join(o, "normalized_address", "left_anti").agg(F.count("*").alias("outside_count"))
    counts = o.agg(
        F.count("*").alias("output_defined_count"), F.count_distinct("normalized_address").alias("_d")
    ).crossJoin(p.agg(F.count("*").alias("positive_value_count"))).crossJoin(outside)
    counts = counts.withColumn("zero_value_only_count", c("output_defined_count") - c("positive_value_count") + c("outside_count"))
    blocked = {
        "not_contained": c("outside_count") > 0, "duplicate_addresses": c("_d") != c("output_defined_count"),
        "over_capacity": c("positive_value_count") > capacity
    }
    return judged(counts, blocked, {}).drop("_d", "warning_codes")
