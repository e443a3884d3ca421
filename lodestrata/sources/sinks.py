"""Sinks: partitioned tables, and artifacts that are staged, listed, checked and only then published.

Spark writes and hashes the data, on any file system that it reads. The driver
handles manifests and renames: their size is the number of files.
"""

from __future__ import annotations

import gzip
import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candidates import duplicates
from ..operators.queues import rank_gaps
from ..schemas import canonical_json, schema_sha256
from .store import Store, content_digest

#: versions of snapshots that load_snapshot reads, and the columns that each must have
SNAPSHOT = {1: ("address", "assertion_type", "operational_tier"), 2: ("address", "assertion_type", "operational_tier", "resolution_policy")}


def prefixed(df: DataFrame, path: str, id_col: str = "address_id") -> None:
    """zstd Parquet by the id's first two letters; one file a prefix and task."""
    df.withColumn("prefix", F.substring(id_col, 1, 2)).repartition("prefix").write.partitionBy("prefix").option("compression", "zstd").parquet(path)


def single_file(df: DataFrame, path: str) -> None:
    """One file; for tables that are small by contract."""
    df.coalesce(1).write.option("compression", "zstd").parquet(path)


def tier_buckets(df: DataFrame, path: str) -> None:
    """One sorted file for each tier and bucket."""
    keys = [F.col("candidate_tier").alias("tier"), F.col("address_bucket").alias("bucket")]
    dealt = df.select("*", *keys).repartition("tier", "bucket").sortWithinPartitions("tier", "bucket", "normalized_address")
    dealt.write.partitionBy("tier", "bucket").option("compression", "zstd").parquet(path)


def write_empty(df: DataFrame, path: str) -> None:
    """Fails if the destination exists."""
    df.write.mode("errorifexists").parquet(path)


def appended(rows: DataFrame, path: str, spark: SparkSession, key: str = "evidence_fingerprint") -> None:
    """Append rows whose fingerprint isn't there yet; of rows that share one, the first by all their fields."""
    from ..operators.evidence import new_rows

    ledger = spark.read.parquet(path) if Store(spark).exists(path) else rows.limit(0)
    new_rows(rows, ledger, key).write.mode("append").parquet(path)


def verified(spark: SparkSession, root: str) -> dict:
    """The manifest of an artifact whose files are exactly those listed."""
    return Store(spark).manifest(root)


def published(
    spark: SparkSession, root: str, tables: dict[str, Callable[[str], None]], about: dict,
    frames: dict[str, DataFrame] | None = None
) -> dict:
    """Write each table into a staging folder, list and check it, then rename it to root. An existing root is an error."""
    store, stage = Store(spark), f"{root}.staging"
    if store.exists(root):
        raise FileExistsError(root)
    store.delete(stage)  # what an earlier run left when it was stopped
    for name, write in tables.items():
        write(f"{stage}/{name}")
    schemas = {k: schema_sha256(v.schema) for k, v in (frames or {}).items()}
    made = store.list_manifest(stage, about | {"schemas": schemas})
    store.manifest(stage)
    store.rename(stage, root)
    return made


def publish_candidates(rows: DataFrame, root: str, about: dict, excluded: DataFrame | None = None) -> dict:
    """Candidates by tier and bucket, refused where addresses repeat, or where an excluded address (its SHA-256) isn't one of them."""
    from ..operators.candidates import without_excluded

    if duplicates(rows).limit(1).count():
        raise ValueError("addresses repeat")
    if excluded is not None:
        rows, missing = without_excluded(rows, excluded)
        if not missing.isEmpty():
            raise ValueError("excluded addresses that are no candidates")
        about = about | {"excluded": excluded.distinct().count()}
    return published(rows.sparkSession, root, {"candidates": lambda p: tier_buckets(rows, p)}, about, {"candidates": rows})


def candidates_by_tier(spark: SparkSession, root: str, tiers: tuple[str, ...]) -> DataFrame:
    """The verified files of these tiers, and no others."""
    files = [f["path"] for f in verified(spark, root)["files"] if any(f"tier={t}/" in f["path"] for t in tiers)]
    if not files:
        raise FileNotFoundError(f"{root}: no file of {', '.join(tiers)}")
    return spark.read.option("basePath", f"{root}/candidates").parquet(*[f"{root}/{f}" for f in files]).drop("tier", "bucket")


def source_digest(manifest: dict) -> str:
    """What an artifact made from another one names it by."""
    return hashlib.sha256(canonical_json(manifest).encode()).hexdigest()


def publish_coverage(states: DataFrame, root: str, candidates: dict, built_at: str) -> dict:
    """A coverage snapshot bound to the manifest of its candidates."""
    about = {"kind": "coverage", "built_at": built_at, "candidates_sha256": source_digest(candidates), "rows": states.count()}
    return published(
        states.sparkSession, root, {"coverage": lambda p: states.write.option("compression", "zstd").parquet(p)}, about,
        {"coverage": states}
    )


def publish_queue(queue: DataFrame, root: str, candidates: dict, coverage: dict, dry_run: bool = False) -> dict:
    """A queue bound to its sources, which must be of one another; its ranks must run from 1 without gaps. A dry run writes nothing."""
    if coverage["candidates_sha256"] != source_digest(candidates):
        raise ValueError("the coverage is of other candidates")
    gaps = rank_gaps(queue).first()
    if gaps.row_count and not gaps.contiguous:
        raise ValueError("queue ranks have gaps or repeats")
    about = {"kind": "queue", "candidates_sha256": source_digest(candidates), "coverage_sha256": source_digest(coverage), "rows": gaps.row_count}
    if dry_run:
        return about
    return published(queue.sparkSession, root, {"queue": lambda p: queue.write.option("compression", "zstd").parquet(p)}, about, {"queue": queue})


def read_queue(spark: SparkSession, root: str) -> DataFrame:
    """A published queue, checked: its files, ranks and identifiers."""
    manifest, queue = verified(spark, root), spark.read.parquet(f"{root}/queue")
    gaps = rank_gaps(queue).first()
    if gaps.row_count != manifest["rows"] or (gaps.row_count and not gaps.contiguous):
        raise ValueError(f"{root}: ranks have gaps or repeats")
    if not queue.groupBy("address_id").count().where("count > 1").isEmpty():
        raise ValueError(f"{root}: identifiers repeat")
    return queue


def export_ndjson(df: DataFrame, path: str, *order: str, version: int = 2, about: dict | None = None) -> str:
    """Sorted JSON lines with sorted keys, as parts in order, with a manifest; the same content again is no change, other content an error. Its digest."""
    store, spark = Store(df.sparkSession), df.sparkSession
    rows, digest = content_digest(df)
    if store.exists(path):
        if json.loads(store.text(f"{path}/manifest.json"))["content"] != digest:
            raise FileExistsError(f"{path} has other content")
        return digest
    line = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")
    lines = df.orderBy(*order).select(line)
    published(
        spark, path, {"lines": lambda p: lines.write.text(p)},
        (about or {}) | {"content": digest, "rows": rows, "version": version}, {"lines": df}
    )
    return digest


def load_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """An exported snapshot, its files, rows and content checked against its manifest."""
    manifest = verified(spark, path)
    wanted = SNAPSHOT.get(manifest["version"])
    if wanted is None:
        raise ValueError(f"{path}: version {manifest['version']}")
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/lines")
    if missing := set(wanted) - set(rows.columns):
        raise ValueError(f"{path}: no {', '.join(sorted(missing))}")
    if content_digest(rows) != (manifest["rows"], manifest["content"]):
        raise ValueError(f"{path}: rows differ from the manifest")
    return rows


def stored_payload(spark: SparkSession, root: str, content: bytes) -> dict:
    """Gzip under the content's digest; written once."""
    digest = hashlib.sha256(content).hexdigest()
    name, store = f"{digest}.gz", Store(spark)
    if not store.exists(path := f"{root}/{digest[:2]}/{name}"):
        store.write(path, gzip.compress(content, mtime=0))
    return {"payload_sha256": digest, "payload_name": name, "byte_count": len(content)}


class RunReceipt:
    """A one-shot run: started exactly once, ended exactly once."""

    def __init__(self, spark: SparkSession, path: str):
        self.store, self.path = Store(spark), path

    def start(self, about: dict) -> None:
        self.store.write(self.path, canonical_json(about | {"status": "started"}))

    def status(self) -> dict:
        return json.loads(self.store.text(self.path))

    def end(self, status: str, **more: object) -> dict:
        now = self.status()
        if now["status"] != "started":
            raise ValueError(f"run already {now['status']}")
        now |= {"status": status} | more
        self.store.write(self.path, canonical_json(now), replace=True)
        return now


def once(receipt: RunReceipt, about: dict, work: Callable[[], dict]) -> dict:
    """work, by a receipt: it runs once, whatever comes of it; a second call is an error before anything runs."""
    receipt.start(about)
    try:
        done = work()
    except Exception as e:
        receipt.end("failed", error=type(e).__name__)
        raise
    return receipt.end("done", **done)


def probe_json(spark: SparkSession, path: str, probe: dict) -> None:
    Store(spark).write(path, canonical_json(probe), replace=True)
