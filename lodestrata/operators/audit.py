"""Coverage audit and the provider reliability panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapsed, points, stratum
from .ranking import first_by


def group_counts(df: DataFrame, key: str, ts: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    if ts and since:
        df = df.where(F.col(ts) >= F.lit(since).cast(df.schema[ts].dataType))
    if ts and until:
        df = df.where(F.col(ts) < F.lit(until).cast(df.schema[ts].dataType))
    return df.groupBy(key).agg(F.count("*").alias("row_count"))


def point_totals(responses: DataFrame, least: int = 1) -> DataFrame:
    """Points of all responses: each begun 100,000 bytes is one, and least a response."""
    return responses.agg(F.coalesce(F.sum(points(F.col("response_bytes"), least=least)), F.lit(0)).cast("bigint").alias("points"))


def panel_rows(
    candidates: DataFrame, observations: DataFrame, evidence: DataFrame, payloads: DataFrame, prefix: str, tiers: tuple[str, ...],
    group: str | None = None
) -> DataFrame:
    """Flags of each candidate address whose reference has the prefix; its first such request counts."""
    c = F.col
    own = candidates.where(F.startswith(c("source_reference"), F.lit(prefix)))
    own = first_by(own, ["address"], F.asc("requested_at"), F.asc("request_id")).select("address", "source_reference")
    last = first_by(observations, ["address"], F.desc("completed_at"), F.desc("observation_id")).join(
        payloads.select("payload_sha256", "retention_status"), "payload_sha256", "left"
    )
    commercial = (c("source_authority") == "commercial_provider") & (c("evidence_tier") == "C")
    label, tag = (c("assertion_type") == "address_label") & (c("candidate_label") != ""), F.coalesce(c("provider_tag_id"), F.lit("")) != ""
    entity = (c("assertion_type") == "entity_control") & (c("candidate_entity_name") != "")
    official = c("source_authority").isin("official", "regulator") & c("evidence_tier").isin(*tiers) & (
        F.lit(True) if group is None else c("independence_group") == group
    )
    some = lambda cond: F.coalesce(F.max(cond), F.lit(False))
    per = evidence.where("evidence_status = 'valid'").groupBy("address").agg(
        some(commercial & label & ~tag).alias("has_label"), some(commercial & label & tag).alias("has_tag"),
        some(commercial & (c("candidate_wallet_role") != "")).alias("has_role"),
        F.collect_set(
            F.when(commercial & entity, collapsed(c("candidate_entity_name")))
        ).alias("provider"), F.collect_set(F.when(official & entity, collapsed(c("candidate_entity_name")))).alias("official"),
    )
    none = F.array().cast("array<string>")
    out = own.join(last.select("address", "outcome", "payload_sha256", "retention_status"), "address", "left").join(per, "address", "left")
    out = out.na.fill(False, ["has_label", "has_tag", "has_role"]).withColumns(
        {"provider": F.coalesce("provider", none), "official": F.coalesce("official", none), "stratum": stratum(c("source_reference"))}
    )
    p, o = F.size("provider") > 0, F.size("official") > 0
    return out.select(
        "address", "stratum", F.coalesce("outcome", F.lit("not_fetched")).alias("outcome"), p.alias("entity_supported"),
        c("has_label").alias("primary_address_label_supported"), c("has_tag").alias("tag_supported"),
        (c("has_label") | c("has_tag")).alias("address_label_or_tag_supported"),
        (~p & ~c("has_label") & ~c("has_tag")).alias("fully_empty_attribution"), c("has_role").alias("formal_wallet_role_supported"),
        c("payload_sha256").isNotNull().alias("raw_payload_referenced"),
        F.coalesce(c("retention_status") == "active", F.lit(False)).alias("raw_payload_active"), (o & p).alias("comparable"),
        (o & p & F.arrays_overlap("official", "provider")).alias("entity_match"),
        (o & p & ~F.arrays_overlap("official", "provider")).alias("entity_conflict"), (o & ~p).alias("indeterminate"),
    )


PANEL = (
    "entity_supported", "primary_address_label_supported", "tag_supported", "address_label_or_tag_supported", "fully_empty_attribution",
    "formal_wallet_role_supported",
    "raw_payload_referenced", "raw_payload_active", "comparable", "entity_match", "entity_conflict", "indeterminate",
)


def _counts() -> list[Column]:
    return [F.count("*").alias("candidate_addresses"), *[F.count_if(f).alias(f"{f}_count") for f in PANEL]]


def provider_panel(rows: DataFrame) -> DataFrame:
    return rows.agg(*_counts())


def panel_by_stratum(rows: DataFrame) -> DataFrame:
    return rows.groupBy("stratum", "outcome").agg(*_counts())


def calibration_seeds(evidence: DataFrame, tiers: tuple[str, ...], group: str, prefix: str, requests: DataFrame) -> DataFrame:
    """All addresses with official evidence that have no calibration request yet, by address."""
    own = evidence.where(
        F.col("source_authority").isin("official", "regulator") & F.col("evidence_tier").isin(*tiers) & (F.col("independence_group") == group)
    ).select("address").distinct()
    asked = requests.where(F.startswith(F.col("source_reference"), F.lit(prefix))).select("address").distinct()
    return own.join(asked, "address", "left_anti").orderBy("address").withColumn("source_reference", F.concat(F.lit(prefix), F.lit(group)))
