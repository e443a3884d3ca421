"""The evidence side that the test tables stand for: users as addresses, their events as evidence, reviews, requests and replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .projection import table

AS_OF = "2024-01-25 00:00:00"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("address", F.concat(F.lit("acct:"), F.col("user_id")))


def _every(n: int, r: int = 0) -> Column:
    return F.col("event_id") % n == r


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, t, v = _events(spark, sf_dir), F.col("event_type"), F.floor("value")
    none = F.lit(None).cast("string")
    kind = F.when(t == "view", "address_label").when(t == "signup", "wallet_role").otherwise("entity_control")
    authority = F.when(t.isin("click", "view"), "commercial_provider").when(t == "purchase", "official").when(t == "signup", "local_inference").otherwise("public_explorer")
    tier = F.when(t.isin("click", "view"), "C").when(t == "purchase", F.when(_every(2), "A").otherwise("B")).when(t == "signup", "D").otherwise("E")
    name = F.when(t.isin("click", "error"), F.concat(F.lit(" Entity "), v % 4)).when(t == "purchase", F.concat(F.lit("entity "), v % 3))
    return e.select(
        F.concat(F.lit("ev"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("evidence_id"), "address", kind.alias("assertion_type"),
        F.when(kind == "entity_control", F.concat(F.lit("id:"), v % 4)).alias("candidate_entity_id"), name.alias("candidate_entity_name"),
        F.when(t == "view", F.concat(F.lit("Label "), v % 2)).alias("candidate_label"),
        F.when(t == "signup", F.concat(F.lit("role"), v % 2)).alias("candidate_wallet_role"),
        none.alias("provider_entity_id"), F.when((t == "view") & _every(2), F.lit("tag")).alias("provider_tag_id"),
        authority.alias("source_authority"), tier.alias("evidence_tier"),
        none.alias("verification_method"), F.when(_every(4), F.lit("valid")).alias("verification_result"), none.alias("artifact_sha256"),
        t.alias("independence_group"),
        F.col("ts").alias("observed_at"), F.when(_every(9), F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("effective_from"),
        F.when(_every(7), F.col("ts") + F.expr("INTERVAL 5 DAYS")).alias("effective_to"),
        F.when(_every(5), F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("expires_at"),
        F.when(_every(11), "retracted").otherwise("valid").alias("evidence_status"),
    )


def _decisions(spark: SparkSession, sf_dir: str, every: int, words: tuple[str, str], name: str) -> DataFrame:
    e = _events(spark, sf_dir).where(_every(every))
    value = F.concat(F.lit("entity "), F.floor("value") % 4)
    return e.select(
        "address", F.lit("entity_control").alias("assertion_type"), value.alias("asserted_value"),
        F.when(_every(2), words[0]).otherwise(words[1]).alias("decision"), F.col("ts").alias("reviewed_at"),
        F.col("event_id").alias(name), F.lit("reviewer").alias("reviewer_ref")
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir, 5, ("accept", "reject"), "review_id")


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir, 37, ("select", "reject"), "override_id")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.when(_every(6), "known_watchlist").otherwise("research")
    reference = F.concat(F.when(_every(3), F.lit("panel:")).otherwise(F.lit("seed:")), F.col("event_type"))
    return _events(spark, sf_dir).where(_every(3)).select(
        "address", reason.alias("reason"), (F.col("event_id") % 101).cast("int").alias("priority"),
        F.col("ts").alias("requested_at"), F.col("ts").alias("created_at"), F.col("event_id").alias("request_id"),
        reference.alias("source_reference")
    )


def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(_every(46), F.col("ts") + F.expr("INTERVAL 1 DAY"))
    return _events(spark, sf_dir).where(_every(23)).select(
        "address", F.when(_every(69), "resolved").otherwise("active").alias("status"), F.col("ts").alias("created_at"),
        end.alias("resolved_at")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where((F.col("event_type") == "view") & _every(3)).select(
        "address", F.concat(F.lit("e"), F.floor("value") % 7).alias("entity_id"), F.col("ts").alias("observed_at")
    )


def parses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(_every(10, 1)).select(
        "address", F.when(_every(20, 1), "parsed_success").otherwise("failed").alias("parse_outcome"),
        F.col("ts").alias("parsed_at")
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(_every(2)).select(
        "address", F.col("event_id").alias("observation_id"), F.when(_every(8), "detail").otherwise("discovery").alias("query_profile"),
        F.when(_every(14), "http_error").otherwise("success").alias("outcome"),
        F.sha2(F.col("props").cast("binary"), 256).alias("payload_sha256"), F.col("ts").alias("completed_at"),
        F.length("props").cast("bigint").alias("response_bytes"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a payload; those with an even number in them are kept."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.sha2(F.col("props").cast("binary"), 256).alias("payload_sha256"),
        F.when(k % 2 == 0, "active").otherwise("purged").alias("retention_status")
    ).distinct()


def replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an alert, with an output, and as many inputs as its number's remainder by 4."""
    other = lambda k: F.concat(F.lit("acct:"), (F.col("user_id") * k) % 160)
    ins = F.slice(F.array(other(3), other(3), other(7)), 1, (F.col("event_id") % 4).cast("int"))
    none = F.lit(None).cast("string")
    return _events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"), F.when(_every(3), F.col("address")).alias("watched_address"),
        F.when(~_every(17), F.col("address")).alias("output_address"), none.alias("counterparty_address"),
        F.when(_every(2), other(3)).alias("input_address"), ins.alias("input_addresses"),
        F.when(_every(19), 1).otherwise(0).alias("missing_input_address_count"), F.col("value").cast("string").alias("amount_btc"),
        F.col("event_type").alias("direction"), none.alias("threshold_result"), none.alias("quality_decision"),
        none.alias("alert_decision"), none.alias("ownership_semantics"),
        F.when(
            F.col("event_type").isin("click", "purchase", "view"), "internal_candidate"
        ).otherwise("external").alias("semantic_decision"), F.when(_every(2), F.array(F.lit("self_churn_possible"))).alias("quality_tags"),
        F.floor(F.col("value")).cast("int").alias("internal_transfer_score"),
        (F.col("event_id") % 90).cast("int").alias("ownership_transfer_score"), (F.col("event_id") % 5).cast("int").alias("replay_weight"),
    )
