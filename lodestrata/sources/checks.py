"""Checks of a source before it is read: frozen files, node status, schema and freshness, query templates, export pages."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import contract_violations
from .shared import kept
from .store import Store

_NODE_DDL = (
    "blockchain_info struct<chain:string,blocks:bigint,headers:bigint,bestblockhash:string,initialblockdownload:boolean,verificationprogress:double,pruned:boolean>, "
    "finalized_hash string, finalized_header struct<height:bigint,time:bigint,confirmations:bigint>, indexes struct<txindex:struct<synced:boolean,best_block_height:bigint>>"
)
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}")


def frozen_read(spark: SparkSession, path: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """What read gives of a folder whose files don't change meanwhile: digests before and after must agree."""
    store = Store(spark)
    before = store.digests(path)
    rows = kept(read(path), "frozen")
    if store.digests(path) != before:
        raise ValueError(f"{path} changed while it was read")
    return rows


def recorded_node(spark: SparkSession, path: str) -> DataFrame:
    """Recorded status responses of a node, one JSON object a line."""
    return spark.read.schema(T.StructType.fromDDL(_NODE_DDL)).option("mode", "FAILFAST").json(path)


def node_reasons(status: DataFrame, depth: int = 6) -> DataFrame:
    """status with the sorted reasons why the node can't be a source, and whether it can."""
    info, head, index = F.col("blockchain_info"), F.col("finalized_header"), F.col("indexes.txindex")
    rules = {
        "other_chain": info["chain"] != "main", "initial_download": info["initialblockdownload"],
        "behind_headers": info["blocks"] < info["headers"], "pruned": info["pruned"],
        "not_verified": info["verificationprogress"] < 0.9999, "not_final": head["confirmations"] < depth,
        "above_tip": head["height"] + depth - 1 > info["blocks"],
        "no_transaction_index": ~F.coalesce(index["synced"], F.lit(False)),
        "index_behind": F.coalesce(index["best_block_height"], F.lit(-1)) < head["height"],
        "bad_hash": ~F.coalesce(F.regexp_like("finalized_hash", F.lit("^[0-9a-f]{64}$")), F.lit(False)),
    }
    reasons = F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in rules.items()])))
    return status.withColumn("reasons", reasons).withColumn("usable", F.size("reasons") == 0)


def freshness(df: DataFrame, ts: str, now: str, within_hours: int) -> DataFrame:
    """One row: newest and oldest time, age in hours, and the reasons why the table isn't fresh."""
    at = F.lit(now).cast(df.schema[ts].dataType)
    one = df.agg(F.count("*").alias("row_count"), F.min(ts).alias("oldest"), F.max(ts).alias("newest"))
    age = F.timestamp_diff("HOUR", F.col("newest"), at).cast("bigint")
    rules = {"empty": F.col("row_count") == 0, "stale": age > within_hours, "from_the_future": F.col("newest") > at}
    return one.select(
        "row_count", "oldest", "newest", age.alias("age_hours"),
        F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()])).alias("reasons")
    )


def source_probe(df: DataFrame, contract: T.StructType, ts: str, now: str, within_hours: int) -> dict:
    """Schema and freshness of a source, in one answer."""
    r = freshness(df, ts, now, within_hours).first()
    missing = contract_violations(df, contract)
    return {
        "rows": r.row_count, "newest": str(r.newest), "age_hours": r.age_hours,
        "reasons": sorted([*r.reasons, *(["schema"] if missing else [])]), "schema": missing
    }


def monthly_budget(runs: DataFrame, now: str, limit_bytes: int, reserve_bytes: int, planned_bytes: int) -> DataFrame:
    """One row: bytes of this month's runs (run_at, byte_count), what is left beside the reserve, and whether the planned bytes are admitted."""
    at = F.lit(now).cast(runs.schema["run_at"].dataType)
    own = (F.col("run_at") >= F.date_trunc("month", at)) & (F.col("run_at") < at)
    used = runs.agg(F.coalesce(F.sum(F.when(own, F.col("byte_count"))), F.lit(0)).cast("bigint").alias("used_bytes"))
    left = F.lit(limit_bytes - reserve_bytes).cast("bigint") - F.col("used_bytes")
    return used.select("used_bytes", left.alias("left_bytes"), (left >= planned_bytes).alias("admitted"))


def query_template(spark: SparkSession, sql: str, tables: dict[str, str], pinned_sha256: str | None = None, **values: object) -> DataFrame:
    """SQL with IDENTIFIER(:name) markers for tables and :name for values; names are checked, and the text against its pin."""
    if pinned_sha256 is not None and hashlib.sha256(sql.encode()).hexdigest() != pinned_sha256:
        raise ValueError("the query differs from its pin")
    for name, where in tables.items():
        if not _NAME.fullmatch(where):
            raise ValueError(f"{name}: {where!r} is no table name")
    used = set(re.findall(r":([A-Za-z_]\w*)", re.sub(r"'[^']*'", "", sql)))
    if used != set(tables) | set(values):
        raise ValueError(f"markers {sorted(used)}, values {sorted(set(tables) | set(values))}")
    return spark.sql(sql, args={**tables, **values})


def exported(spark: SparkSession, table: str) -> DataFrame:
    """A table of the catalog, for export as it is."""
    if not _NAME.fullmatch(table):
        raise ValueError(f"{table!r} is no table name")
    return spark.read.table(table)


def pages(df: DataFrame, rows: int = 10_000) -> Iterator[list]:
    """The result in pages, one partition at a time: the edge of a service that streams, never the inside of a query."""
    page = []
    for r in df.toLocalIterator():
        page.append(r)
        if len(page) == rows:
            yield page
            page = []
    if page:
        yield page

