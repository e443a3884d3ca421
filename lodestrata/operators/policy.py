"""Scores, reasons and tiers, as column expressions over feature tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import control_sample, elapsed_days
from .economics import BTC

# Thresholds in whole coins and their points; the first that holds counts.
BALANCE = ((1_000, 25, "balance_ge_1000_btc"), (100, 20, "balance_ge_100_btc"), (10, 12, "balance_ge_10_btc"), (1, 5, "balance_ge_1_btc"))
RECEIPT = (
    (5_000, 25, "max_same_tx_receipt_ge_5000_btc"), (1_000, 20, "max_same_tx_receipt_ge_1000_btc"),
    (500, 18, "max_same_tx_receipt_ge_500_btc"), (100, 10, "max_same_tx_receipt_ge_100_btc"),
)
TURNOVER = (
    (10_000, 20, "gross_90d_ge_10000_btc_score"), (1_000, 15, "gross_90d_ge_1000_btc_score"),
    (100, 8, "gross_90d_ge_100_btc_score"), (10, 3, "gross_90d_ge_10_btc_score"),
)
RECENCY = ((30, 10, "recency_le_30d"), (90, 7, "recency_le_90d"), (365, 3, "recency_le_365d"))
FORCED = ("official_or_signed_evidence", "existing_provider_conflict")
CALIBRATION = ("existing_provider_conflict", "existing_system_watchlist", "official_or_signed_evidence", "provider_entity_prediction")
EDGE_POINTS, PREDICTION_POINTS, WATCHLIST_POINTS = 10, 15, 10


@dataclass(frozen=True)
class Thresholds:
    """Points from which an address is P1 or on the edge."""

    p1: int = 25
    edge: int = 15


def _ladder(c: Column, steps: tuple, unit: int, at_most: bool = False) -> tuple[Column, Column]:
    """Points and code of the first step that holds; 0 and null without one."""
    points, code = F.lit(0), F.lit(None).cast("string")
    for least, p, name in reversed(steps):
        holds = c <= least * unit if at_most else c >= least * unit
        points, code = F.when(holds, p).otherwise(points), F.when(holds, F.lit(name)).otherwise(code)
    return points, code


def _flag(cond: Column, name: str) -> Column:
    return F.when(cond, F.lit(name))


def _codes(*columns: Column) -> Column:
    return F.array_sort(F.array_compact(F.array(*columns)))


def recency(df: DataFrame, cutoff_time: str) -> Column:
    return elapsed_days(F.col("last_seen_time"), F.lit(cutoff_time).cast(df.schema["last_seen_time"].dataType))


def importance_v1(features: DataFrame, cutoff_time: str, campaign: str, t: Thresholds = Thresholds()) -> DataFrame:
    """Decision, score, reasons, components and cohorts of each feature row; features carries calibration_reasons."""
    cal = F.col("calibration_reasons")
    utxo, receipt, gross, life, edges = (
        F.col(c) for c in (
            "current_utxo_sats", "max_same_tx_received_sats", "gross_flow_90d_sats", "lifetime_received_sats",
            "direct_large_counterparty_count"
        )
    )
    df = features.withColumn("recency_days", recency(features, cutoff_time))
    days = F.col("recency_days")
    ladders = [_ladder(utxo, BALANCE, BTC), _ladder(receipt, RECEIPT, BTC), _ladder(gross, TURNOVER, BTC), _ladder(days, RECENCY, 1, True)]
    extra = [
        (edges > 0, EDGE_POINTS, "direct_large_selected_edge"), (
            F.array_contains(cal, "provider_entity_prediction"), PREDICTION_POINTS, "provider_entity_prediction"
        ),
        (F.array_contains(cal, "existing_system_watchlist"), WATCHLIST_POINTS, "existing_system_watchlist"),
    ]
    score = sum((p for p, _ in ladders), F.lit(0)) + sum((F.when(c, p).otherwise(0) for c, p, _ in extra), F.lit(0))
    components = _codes(*[c for _, c in ladders], *[_flag(c, n) for c, _, n in extra])
    p0 = _codes(
        *[_flag(F.array_contains(cal, n), n) for n in FORCED], _flag(utxo >= 100 * BTC, "utxo_ge_100_btc"),
        _flag(receipt >= 500 * BTC, "same_tx_receive_ge_500_btc"),
        _flag(gross >= 1_000 * BTC, "gross_90d_ge_1000_btc"), _flag((life >= 10_000 * BTC) & (days <= 365), "lifetime_ge_10000_active_365d"),
    )
    cohorts = [
        _flag(F.size(cal) > 0, "calibration"), _flag(utxo >= BTC, "current_capital"), _flag((utxo >= BTC) & (days > 365), "dormant_holder"),
        _flag(edges > 0, "high_value_connector"), _flag(gross >= 10 * BTC, "high_turnover"), _flag(receipt >= 100 * BTC, "historical_large_receipt"),
    ]
    df = df.withColumns(
        {"importance_score": score.cast("int"), "_p0": p0, "_components": components, "_sample": control_sample(campaign, F.col("address_id"))}
    )
    kind = F.when(F.size("_p0") > 0, "P0").when(F.col("importance_score") >= t.p1, "P1").when(F.col("_sample"), "CONTROL").otherwise("NONE")
    df = df.withColumn("priority_class", kind)
    control = F.col("priority_class") == "CONTROL"
    reasons = F.when(F.size("_p0") > 0, F.col("_p0")).when(F.col("priority_class") == "P1", F.col("_components")).when(control, F.array(F.lit("deterministic_low_score_control"))).otherwise(F.array().cast("array<string>"))
    return df.withColumns(
        {"reason_codes": reasons, "cohort_names": _codes(*cohorts, _flag(control, "control")), "score_components": F.col("_components")}
    ).drop("_p0", "_components", "_sample")


def chain_policy_v1(economics: DataFrame, cutoff_time: str, t: Thresholds = Thresholds()) -> DataFrame:
    """The part of the first policy that needs the chain alone, for every address with an output."""
    df = economics.where("has_output").withColumn("recency_days", recency(economics, cutoff_time))
    utxo, receipt, gross = F.col("current_utxo_sats"), F.col("max_same_tx_received_sats"), F.col("gross_flow_90d_sats")
    score = _ladder(utxo, BALANCE, BTC)[0] + _ladder(receipt, RECEIPT, BTC)[0] + _ladder(gross, TURNOVER, BTC)[0] + _ladder(F.col("recency_days"), RECENCY, 1, True)[0]
    bits = (
        (utxo >= 100 * BTC, 1), (receipt >= 500 * BTC, 2), (gross >= 1_000 * BTC, 4),
        ((F.col("lifetime_received_sats") >= 10_000 * BTC) & (F.col("recency_days") <= 365), 8)
    )
    df = df.withColumns({"chain_importance_score": score.cast("int"), "p0_mask": mask(*bits)})
    economic = (utxo >= BTC) | (receipt >= 100 * BTC) | (gross >= 10 * BTC)
    s, m = F.col("chain_importance_score"), F.col("p0_mask")
    return df.withColumns({
        "is_chain_p0": m != 0, "is_chain_p1": (m == 0) & (s >= t.p1), "is_edge_upgrade_frontier": (m == 0) & s.between(t.edge, t.p1 - 1),
        "has_positive_economic_component": economic, "is_coarse_candidate": (m != 0) | (s >= t.edge) | economic,
    })


def mask(*bits: tuple[Column, int]) -> Column:
    return sum((F.when(c, b).otherwise(0) for c, b in bits), F.lit(0)).cast("int")


def _retained(horizon: str) -> Column:
    most, utxo = F.col(f"max_same_tx_received_{horizon}_sats"), F.col("current_utxo_sats")
    return (most >= 500 * BTC) & (utxo >= 10 * BTC) & (utxo * 100 >= most)


VARIANTS = ("strict", "balanced", "retention")


def variants_v2(economics: DataFrame, cutoff_time: str, t: Thresholds = Thresholds()) -> DataFrame:
    """The second policy: one score, three variants of the receipt rule, for addresses that received a positive value."""
    c = F.col
    df = economics.where("has_output").withColumns({
        "recency_days": recency(economics, cutoff_time),
        "residual_gross_90d_sats": F.greatest(c("gross_flow_90d_sats") - c("max_same_tx_received_90d_sats"), F.lit(0).cast("bigint")),
        "recent_receipt_retained": _retained("90d"), "balanced_receipt_retained": _retained("365d"),
        "retention_receipt_supported": _retained("lifetime"),
        "recent_receipt_repeated": c("same_tx_receive_ge_500_btc_90d_count") >= 2,
    })
    active = (c("active_tx_90d_count") >= 3) & (c("active_day_90d_count") >= 2)
    residual, large90, large365 = c("residual_gross_90d_sats"), c("max_same_tx_received_90d_sats") >= 500 * BTC, c("max_same_tx_received_365d_sats") >= 500 * BTC
    df = df.withColumn("recent_receipt_sustained_activity", large90 & active & (residual >= 500 * BTC))
    strict = large90 & (c("recent_receipt_retained") | c("recent_receipt_repeated") | c("recent_receipt_sustained_activity"))
    again = (c("same_tx_receive_ge_500_btc_365d_count") >= 2) & (c("active_day_365d_count") >= 2)
    held = (c("current_utxo_sats") >= 10 * BTC) | ((residual >= 500 * BTC) & active)
    df = df.withColumns({
        "strict_receipt_supported": strict, "balanced_receipt_supported": strict | (large365 & (c("balanced_receipt_retained") | again)),
        "p0_utxo": c("current_utxo_sats") >= 100 * BTC, "p0_sustained_residual_gross": (residual >= 1_000 * BTC) & active,
        "p0_lifetime_active_supported": (c("lifetime_received_sats") >= 10_000 * BTC) & (c("recency_days") <= 90) & held,
    })
    one = lambda cond, p, *rest: F.when(cond, p).otherwise(one(*rest) if rest else 0)
    score = (
        _ladder(c("current_utxo_sats"), BALANCE, BTC)[0] + _ladder(residual, TURNOVER, BTC)[0] + _ladder(c("recency_days"), RECENCY, 1, True)[0]
        + one(large90, 10, large365, 5) + one(c("recent_receipt_repeated"), 12, c("same_tx_receive_ge_500_btc_365d_count") >= 2, 7)
        + one(c("recent_receipt_retained"), 10) + one(c("recent_receipt_sustained_activity"), 8)
    )
    masks = {f"{v}_p0_mask": mask((c("p0_utxo"), 1), (c("p0_sustained_residual_gross"), 2), (c(f"{v}_receipt_supported"), 4), (c("p0_lifetime_active_supported"), 8)) for v in VARIANTS}
    support = mask((c("recent_receipt_retained"), 1), (c("recent_receipt_repeated"), 2), (c("recent_receipt_sustained_activity"), 4))
    df = df.withColumns({"v2_chain_score": score.cast("int"), "receipt_support_mask": support, **masks})
    wide = (c("v2_chain_score") >= t.edge) | (c("current_utxo_sats") >= BTC) | (residual >= 10 * BTC) | large365
    tiers = {}
    for v in VARIANTS:
        none = c(f"{v}_p0_mask") == 0
        tiers |= {
            f"{v}_is_p0": ~none, f"{v}_is_p1": none & (c("v2_chain_score") >= t.p1),
            f"{v}_is_edge": none & c("v2_chain_score").between(t.edge, t.p1 - 1), f"{v}_is_coarse": ~none | wide
        }
    return df.withColumns(tiers)
