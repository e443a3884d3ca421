"""Snapshot rows for export: the latest resolution of each subject, with its candidates' entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import latest

KEY = ["address", "assertion_type"]


def snapshot_rows(resolved: DataFrame, claims: DataFrame, as_of: str) -> DataFrame:
    """resolved: resolutions of any times, with resolved_at and resolution_id. Entities show where lookups may use them."""
    now = latest(resolved, KEY, "resolved_at", "resolution_id", as_of)
    ids = now.select(*KEY, F.explode("candidate_claim_ids").alias("claim_id"))
    named = claims.groupBy("claim_id").agg(F.min(F.coalesce("entity_id", "asserted_value")).alias("entity"))
    entities = ids.join(named, "claim_id").groupBy(*KEY).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("claim_id", "entity"))), lambda x: x["entity"]).alias("candidate_entities")
    )
    usable = F.col("operational_tier") == "lookup_usable"
    none = F.array().cast("array<string>")
    return now.join(entities, KEY, "left").withColumns({
        "candidate_entities": F.coalesce("candidate_entities", none),
        "primary_entity_display": F.when(usable, F.col("primary_entity_display")),
        "resolved_asserted_value": F.when(usable, F.col("resolved_asserted_value")),
    })


def evidence_summary(claims: DataFrame) -> DataFrame:
    return claims.select("claim_id", *KEY, "asserted_value", "evidence_strength", "corroboration_count", "independence_count", "claim_status")
