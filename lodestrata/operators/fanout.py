"""Plans of what to fetch next, and the accounting of what was fetched; the requests themselves are made elsewhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import points

KEY = "entity_id"


def entity_ids(*sources: DataFrame) -> DataFrame:
    """Distinct, non-empty entity ids of all sources."""
    rows = reduce(DataFrame.union, [s.select(KEY) for s in sources])
    return rows.where(F.coalesce(F.col(KEY), F.lit("")) != "").distinct()


def fanout_plan(ids: DataFrame, finished: DataFrame, exhausted: DataFrame, limit: int) -> DataFrame:
    """The first limit entities, by id, that are neither finished nor given up, with their places."""
    rest = ids.join(finished.select(KEY).distinct(), KEY, "left_anti").join(exhausted.select(KEY).distinct(), KEY, "left_anti")
    rows = rest.orderBy(KEY).limit(limit)  # a budget: the window holds no more
    return rows.withColumn("plan_rank", F.row_number().over(Window.orderBy(KEY)).cast("bigint"))


def profile_attempts(attempts: DataFrame, observations: DataFrame, profile: str) -> DataFrame:
    """Attempts with the observation that they led to, of one profile."""
    own = observations.where(F.col("query_profile") == profile).select("observation_id", F.col("outcome").alias("observed_outcome"), "response_bytes")
    return attempts.join(own, "observation_id")


def accounting(attempts: DataFrame, observations: DataFrame, profile: str) -> DataFrame:
    """By outcome: attempts, their bytes and points."""
    rows = profile_attempts(attempts, observations, profile)
    return rows.groupBy("observed_outcome").agg(
        F.count("*").alias("attempt_count"), F.sum("response_bytes").alias("byte_count"), F.sum(points(F.col("response_bytes"))).alias("point_count")
    )


def enrichment_plan(
    due: DataFrame, points_limit: int, points_used: int, points_each: int, runtime_minutes: int, requests_per_minute: int
) -> DataFrame:
    """Due queue rows, in rank order, that both budgets allow, with the points spent when each is done."""
    from .queues import budget

    most = budget(points_limit, points_used, points_each, runtime_minutes, requests_per_minute)
    rows = due.orderBy("queue_rank").limit(most)
    place = F.row_number().over(Window.orderBy("queue_rank"))
    return rows.withColumn("points_after", (F.lit(points_used) + place * points_each).cast("bigint"))


def sync_plan(entities: DataFrame, addresses: DataFrame, limit: int) -> DataFrame:
    """One cycle: due entities (discover, then detail), then due addresses (enrich), each by priority, limit in all."""
    stages = entities.select(
        F.lit(0).alias("stage"), F.lit("entity").alias("kind"), F.col(KEY).alias("subject"),
        F.col("priority").cast("int").alias("priority")
    )
    rows = stages.unionByName(
        addresses.select(
            F.lit(1).alias("stage"), F.lit("address").alias("kind"), F.col("address").alias("subject"),
            F.col("priority").cast("int").alias("priority")
        )
    )
    first = rows.orderBy("stage", F.desc("priority"), "subject").limit(limit)
    place = F.row_number().over(Window.orderBy("stage", F.desc("priority"), "subject"))
    return first.select(place.cast("bigint").alias("plan_rank"), "kind", "subject", "priority")


def first_seen(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    from .ranking import first_by

    return first_by(df, keys, *order)


def predictions(observations: DataFrame, payload: str = "payload") -> DataFrame:
    """Addresses that a response lists, with their places from 1; an address counts where it is first listed."""
    item = "array<struct<address:string>>"
    p = F.from_json(payload, f"struct<addresses:array<string>,items:{item},data:{item}>")
    listed = F.coalesce(
        p["addresses"], F.transform(p["items"], lambda x: x["address"]), F.transform(p["data"], lambda x: x["address"]),
        F.array().cast("array<string>")
    )
    rows = observations.select(KEY, "observation_id", F.posexplode(listed).alias("_place", "address")).where("address is not null and address <> ''")
    out = rows.withColumn("prediction_rank", F.col("_place") + 1).drop("_place")
    return first_seen(out, [KEY, "observation_id", "address"], F.asc("prediction_rank"))


def payload_evidence(observations: DataFrame, payload: str = "payload") -> DataFrame:
    """Commercial evidence candidates of a provider's responses: an entity, a label, and one row a tag; empty ones make none."""
    p = F.from_json(payload, "struct<entity:struct<id:string,name:string>,label:string,tags:array<struct<id:string,name:string>>>")
    none = F.lit(None).cast("string")

    def row(kind: str, entity_id: Column = none, name: Column = none, label: Column = none, tag: Column = none) -> Column:
        values = {
            "assertion_type": F.lit(kind), "candidate_entity_id": entity_id, "candidate_entity_name": name,
            "candidate_label": label, "provider_tag_id": tag
        }
        return F.struct(*[v.alias(k) for k, v in values.items()])

    entity = row("entity_control", p["entity"]["id"], p["entity"]["name"])
    named = F.coalesce(p["entity"]["id"], p["entity"]["name"]).isNotNull()
    own = F.array_compact(F.array(F.when(named, entity), F.when(F.coalesce(p["label"], F.lit("")) != "", row("address_label", label=p["label"]))))
    tags = F.transform(
        F.filter(F.coalesce(p["tags"], F.array().cast("array<struct<id:string,name:string>>")), lambda t: t["id"].isNotNull()),
        lambda t: row("address_label", label=t["name"], tag=t["id"])
    )
    rows = observations.select("address", "payload_sha256", F.col("completed_at").alias("observed_at"), F.explode(F.concat(own, tags)).alias("_e"))
    return rows.select(
        "address", "_e.*", F.lit("commercial_provider").alias("source_authority"), F.lit("C").alias("evidence_tier"),
        F.col("payload_sha256").alias("artifact_sha256"), "observed_at"
    )
