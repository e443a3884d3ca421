"""Aggregate-only censuses: one pass of conditional counts, and histograms as ordered arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import kept
from .economics import BTC
from .flatten import single_address
from .policy import VARIANTS

c = F.col
#: what the first census reads of the first policy's rows
POLICY_V1 = (
    "current_utxo_sats", "max_same_tx_received_sats", "gross_flow_90d_sats", "recency_days", "p0_mask", "chain_importance_score",
    "is_chain_p0", "is_chain_p1",
    "is_edge_upgrade_frontier", "has_positive_economic_component", "is_coarse_candidate",
)


def histogram(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(c(column).alias(name)).agg(F.count("*").alias("address_count"))


def histograms(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Several histograms in one pass: metric, value, address_count; columns: metric to column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), c(x).cast("int").alias("value")) for m, x in columns.items()]))
    return df.select(pairs.alias("p")).groupBy("p.metric", "p.value").agg(F.count("*").alias("address_count"))


def ordered(rows: DataFrame, name: str, key: str) -> DataFrame:
    """rows of (key, address_count) as one array of structs by key."""
    return rows.agg(F.sort_array(F.collect_list(F.struct(key, "address_count"))).alias(name))


def quality_counts(io: DataFrame) -> DataFrame:
    rows = single_address(io)
    failed = c("source_value").isNotNull() & c("value_sats").isNull()
    return rows.agg(F.count_if(c("source_value").isNull()).alias("null_value_count"), F.count_if(failed).alias("value_cast_failure_count"))


def source_quality(economics: DataFrame) -> DataFrame:
    out = c("has_output")
    return economics.agg(
        F.count_if(out).alias("source_standard_address_count"), F.count_if(c("has_input") & ~out).alias("source_input_only_address_count"),
        F.count_if(out & (c("current_utxo_sats") < 0)).alias("negative_current_utxo_count"),
        F.max(F.when(out, c("last_seen_time"))).alias("max_observed_activity_time"),
    )


def _at_least(column: str, steps: tuple[int, ...], name: str, unit: int = BTC) -> list[Column]:
    return [F.count_if(c(column) >= s * unit).alias(name.format(s)) for s in steps]


def _recency() -> list[Column]:
    return [F.count_if(c("recency_days") <= d).alias(f"recency_le_{d}d_count") for d in (30, 90, 365)]


def counters_v1(policy: DataFrame) -> DataFrame:
    """31 counters over the first policy's rows."""
    n, utxo, receipt, gross = F.count_if, c("current_utxo_sats"), c("max_same_tx_received_sats"), c("gross_flow_90d_sats")
    active = c("p0_mask").bitwiseAND(8) != 0
    return policy.agg(
        *_at_least("current_utxo_sats", (1, 10, 100, 1000), "utxo_ge_{}_btc_count"), *_at_least(
            "max_same_tx_received_sats", (100, 500, 1000, 5000), "same_tx_receive_ge_{}_btc_count"
        ),
        *_at_least(
            "gross_flow_90d_sats", (10, 100, 1000, 10000), "gross_90d_ge_{}_btc_count"
        ), *_recency(), n(active).alias("lifetime_ge_10000_active_365d_count"),
        *[
            n(c("p0_mask").bitwiseAND(b) != 0).alias(x) for b,
            x in (
                (1, "p0_utxo_ge_100_btc_count"), (2, "p0_same_tx_receive_ge_500_btc_count"),
                (4, "p0_gross_90d_ge_1000_btc_count"), (8, "p0_lifetime_ge_10000_active_365d_count")
            )
        ],
        n("is_chain_p0").alias("chain_p0_union_count"), n("is_chain_p1").alias("chain_p1_count"),
        n(c("is_chain_p0") & c("is_chain_p1")).alias("p0_p1_overlap_count"),
        n("is_edge_upgrade_frontier").alias("edge_upgrade_frontier_count"),
        n("has_positive_economic_component").alias("positive_economic_component_count"),
        n("is_coarse_candidate").alias("coarse_candidate_union_count"), n(~c("is_coarse_candidate")).alias("excluded_source_address_count"),
        n(utxo >= BTC).alias("current_capital_count"), n(receipt >= 100 * BTC).alias("historical_large_receipt_count"),
        n(gross >= 10 * BTC).alias("high_turnover_count"),
        n((utxo >= BTC) & (c("recency_days") > 365)).alias("dormant_holder_count"),
    )


def counters_v2(policy: DataFrame) -> DataFrame:
    """66 counters over the second policy's rows."""
    n = F.count_if
    out = [
        *_at_least("current_utxo_sats", (1, 10, 100, 1000), "utxo_ge_{}_btc_count"), *_at_least(
            "gross_flow_90d_sats", (10, 100, 1000, 10000), "raw_gross_90d_ge_{}_btc_count"
        ),
        *_at_least("residual_gross_90d_sats", (10, 100, 1000, 10000), "residual_gross_90d_ge_{}_btc_count"), *_recency(),
        *_at_least("max_same_tx_received_lifetime_sats", (500, 1000, 5000), "lifetime_max_receipt_ge_{}_btc_count"),
    ]
    for h in ("365d", "90d"):
        out += _at_least(f"max_same_tx_received_{h}_sats", (500, 1000, 5000), f"max_receipt_{h}_ge_{{}}_btc_count")
    for h in ("lifetime", "365d", "90d"):
        out += _at_least(f"same_tx_receive_ge_500_btc_{h}_count", (1, 2, 3), f"receipt_count_{h}_ge_{{}}_count", 1)
    out += [n(x).alias(f"{x}_count") for x in ("recent_receipt_retained", "recent_receipt_repeated", "recent_receipt_sustained_activity")]
    one = c("same_tx_receive_ge_500_btc_90d_count") == 1
    stale = (c("same_tx_receive_ge_500_btc_lifetime_count") == 1) & (c("same_tx_receive_ge_500_btc_365d_count") == 0)
    out += [
        n("strict_receipt_supported").alias("strict_supported_receipt_count"),
        n(one & ~c("strict_receipt_supported")).alias("unsupported_recent_singleton_count"),
        n(stale).alias("stale_lifetime_singleton_count")
    ]
    out += [n(x).alias(f"{x}_count") for x in ("p0_utxo", "p0_sustained_residual_gross", "p0_lifetime_active_supported")]
    for v in VARIANTS:
        p0, p1 = c(f"{v}_is_p0"), c(f"{v}_is_p1")
        out += [
            n(f"{v}_receipt_supported").alias(f"{v}_p0_receipt_count"), n(p0).alias(f"{v}_p0_union_count"),
            n(c(f"{v}_p0_mask") == 4).alias(f"{v}_incremental_receipt_p0_count"),
            n(p1).alias(f"{v}_p1_count"), n(p0 & p1).alias(f"{v}_p0_p1_overlap_count"), n(f"{v}_is_edge").alias(f"{v}_edge_count"),
            n(f"{v}_is_coarse").alias(f"{v}_coarse_count"), n(~c(f"{v}_is_coarse")).alias(f"{v}_excluded_count"),
        ]
    return policy.agg(*out)


def census_v1(io: DataFrame, economics: DataFrame, policy: DataFrame) -> DataFrame:
    """The whole first census as one row; each part is one row, so the cross joins are of one row each.

    The policy's rows are kept once: all counters and histograms read that table.
    """
    policy = kept(policy.select(*POLICY_V1), "census")
    row = counters_v1(policy).crossJoin(source_quality(economics)).crossJoin(quality_counts(io))
    masks = ordered(histogram(policy, "p0_mask", "mask"), "p0_overlap_distribution", "mask")
    scores = ordered(histogram(policy, "chain_importance_score", "score"), "score_histogram", "score")
    return row.crossJoin(masks).crossJoin(scores).withColumn("contract_version", F.lit("btc_candidate_statistics_v1"))


def census_v2(io: DataFrame, economics: DataFrame, policy: DataFrame) -> DataFrame:
    """The whole second census as one row, with a struct for each variant; the policy's rows are kept once."""
    policy = kept(policy, "census")
    row = counters_v2(policy).crossJoin(source_quality(economics)).crossJoin(quality_counts(io))
    row = row.crossJoin(ordered(histogram(policy, "receipt_support_mask", "mask"), "receipt_support_overlap_distribution", "mask"))
    row = row.crossJoin(ordered(histogram(policy, "v2_chain_score", "score"), "score_histogram", "score"))
    for v in VARIANTS:
        row = row.crossJoin(ordered(histogram(policy, f"{v}_p0_mask", "mask"), f"_{v}", "mask"))
        row = row.withColumn(f"{v}_variant", F.struct(
            F.lit(
                {"strict": "V2-S", "balanced": "V2-B", "retention": "V2-R"}[v]
            ).alias("variant"), c("p0_utxo_count").alias("p0_utxo_ge_100_btc_count"),
            c("p0_sustained_residual_gross_count").alias("p0_sustained_residual_gross_90d_ge_1000_btc_count"),
            c(f"{v}_p0_receipt_count").alias("p0_receipt_rule_count"),
            c("p0_lifetime_active_supported_count").alias("p0_lifetime_ge_10000_active_supported_90d_count"),
            c(f"{v}_p0_union_count").alias("chain_p0_union_count"),
            c(f"{v}_incremental_receipt_p0_count").alias("incremental_receipt_p0_count"), c(f"_{v}").alias("p0_overlap_distribution"),
            c(f"{v}_p1_count").alias("chain_p1_count"),
            c(f"{v}_p0_p1_overlap_count").alias("p0_p1_overlap_count"), c(f"{v}_edge_count").alias("edge_upgrade_frontier_count"),
            c(f"{v}_coarse_count").alias("coarse_candidate_union_count"), c(f"{v}_excluded_count").alias("excluded_source_address_count"),
        )).drop(f"_{v}")
    return row.withColumn("contract_version", F.lit("btc_candidate_statistics_v2"))
