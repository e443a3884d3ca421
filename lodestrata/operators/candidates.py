"""Tiered candidates with bucket and row digest; their re-derivation; exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bucket, sha256_text, unit_separated, utc_micros

# Fixed value: the tag that starts a row digest.
ROW_TAG = "btc_strict_v2_s_candidate_row_v1"
TIERS = ("p0", "p1", "edge", "coarse_other")
SATS = (
    "current_utxo_sats", "lifetime_received_sats", "residual_gross_90d_sats", "max_same_tx_received_lifetime_sats",
    "max_same_tx_received_365d_sats", "max_same_tx_received_90d_sats"
)
COUNTS = (
    "same_tx_receive_ge_500_btc_90d_count", "same_tx_receive_ge_500_btc_365d_count", "active_tx_90d_count",
    "active_day_90d_count", "active_tx_365d_count", "active_day_365d_count"
)
COLUMNS = (
    "normalized_address", "candidate_tier", "tier_rank", "address_bucket", "v2_chain_score", "strict_p0_mask",
    "receipt_support_mask", *SATS, *COUNTS, "last_seen_time", "candidate_row_sha256"
)


def row_digest() -> F.Column:
    texts = [F.col(c).cast("decimal(38,0)").cast("string") if c in SATS else utc_micros(F.col(c)) if c == "last_seen_time" else F.col(c) for c in COLUMNS[:-1]]
    return sha256_text(unit_separated(F.lit(ROW_TAG), *texts))


def strict_candidates(policy: DataFrame, buckets: int = 64) -> DataFrame:
    """The coarse union of the strict variant. Order is left to the sink (sorted within its partitions)."""
    rank = F.when(F.col("strict_is_p0"), 0).when(F.col("strict_is_p1"), 1).when(F.col("strict_is_edge"), 2).otherwise(3)
    rows = policy.where("strict_is_coarse").withColumns(
        {"tier_rank": rank.cast("bigint"), "address_bucket": bucket(F.col("normalized_address"), buckets)}
    )
    rows = rows.withColumn("candidate_tier", F.element_at(F.array(*map(F.lit, TIERS)), F.col("tier_rank").cast("int") + 1))
    rows = rows.withColumns(
        {
            c: F.col(c).cast("bigint") for c in ("v2_chain_score", "strict_p0_mask", "receipt_support_mask")
        } | {c: F.col(c).cast("decimal(38,0)") for c in SATS}
    )
    return rows.withColumn("candidate_row_sha256", row_digest()).select(*COLUMNS)


def violations(rows: DataFrame, buckets: int = 64) -> DataFrame:
    """Rows whose derived columns or ranges don't hold, with codes."""
    t, mask, score = F.col("candidate_tier"), F.col("strict_p0_mask"), F.col("v2_chain_score")
    right = F.when(mask != 0, "p0").when(score >= 25, "p1").when(score >= 15, "edge").otherwise("coarse_other")
    negative = F.lit(False)
    for c in SATS[1:] + COUNTS:
        negative = negative | (F.col(c) < 0)
    rules = {
        "tier": t != right, "tier_rank": F.col("tier_rank") != F.array_position(F.array(*map(F.lit, TIERS)), t) - 1,
        "bucket": F.col("address_bucket") != bucket(F.col("normalized_address"), buckets),
        "mask_range": ~mask.between(0, 15), "support_range": ~F.col("receipt_support_mask").between(0, 7), "negative": negative,
        "horizons": (F.col(SATS[5]) > F.col(SATS[4])) | (F.col(SATS[4]) > F.col(SATS[3])) | (F.col(COUNTS[0]) > F.col(COUNTS[1])) | (F.col(COUNTS[2]) > F.col(COUNTS[4])) | (F.col(COUNTS[3]) > F.col(COUNTS[5])),
        "days_over_transactions": (F.col(COUNTS[3]) > F.col(COUNTS[2])) | (F.col(COUNTS[5]) > F.col(COUNTS[4])),
        "row_digest": F.col("candidate_row_sha256") != row_digest(),
    }
    codes = F.array_compact(F.array(*[F.when(F.coalesce(x, F.lit(True)), F.lit(k)) for k, x in rules.items()]))
    return rows.select("normalized_address", codes.alias("codes")).where(F.size("codes") > 0)


def duplicates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("normalized_address").agg(F.count("*").alias("n")).where("n > 1")


def without_excluded(rows: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows less those whose address digest is in excluded (address_sha256), and excluded digests that no row has."""
    digested = rows.withColumn("address_sha256", sha256_text(F.col("normalized_address")))
    kept = digested.join(excluded.select("address_sha256").distinct(), "address_sha256", "left_anti").drop("address_sha256")
    return kept, excluded.join(digested.select("address_sha256"), "address_sha256", "left_anti")


def tier_bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("candidate_tier", "address_bucket").agg(F.count("*").alias("row_count"))
