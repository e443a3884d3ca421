"""What artifacts, checks and plans refuse."""

import datetime
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators import coverage as V
from lodestrata.operators import evidence as I
from lodestrata.operators import fanout as O
from lodestrata.operators import materialize as M
from lodestrata.operators import ranking as K
from lodestrata.operators import resolver as S
from lodestrata.plans.registry import ORACLE_SQL, QUERIES
from lodestrata.sources import checks as H
from lodestrata.sources import sinks as Z
from lodestrata.sources.store import Store, content_digest


def test_queue_and_coverage_are_bound_to_their_sources(spark, tmp_path):
    rows = spark.createDataFrame([(f"a{i}", "p0", i % 2) for i in range(6)], "normalized_address string, candidate_tier string, address_bucket long")
    about = Z.publish_candidates(rows, f"{tmp_path}/c", {})
    other = Z.publish_candidates(rows.limit(3), f"{tmp_path}/d", {})
    coverage = Z.publish_coverage(rows, f"{tmp_path}/v", about, "2024-01-01")
    queue = rows.select(
        F.col("normalized_address").alias("address_id"),
        F.row_number().over(K.Window.orderBy("normalized_address")).cast("bigint").alias("queue_rank")
    )
    with pytest.raises(ValueError, match="other candidates"):
        Z.publish_queue(queue, f"{tmp_path}/q", other, coverage)
    with pytest.raises(ValueError, match="gaps"):
        Z.publish_queue(queue.where("queue_rank <> 2"), f"{tmp_path}/q", about, coverage)
    assert Z.publish_queue(queue, f"{tmp_path}/q", about, coverage, dry_run=True)["rows"] == 6 and not Store(spark).exists(f"{tmp_path}/q")
    Z.publish_queue(queue, f"{tmp_path}/q", about, coverage)
    assert Z.read_queue(spark, f"{tmp_path}/q").count() == 6
    twice = queue.withColumn("address_id", F.lit("same"))
    Z.publish_queue(twice, f"{tmp_path}/r", about, coverage)
    with pytest.raises(ValueError, match="repeat"):
        Z.read_queue(spark, f"{tmp_path}/r")
    with pytest.raises(ValueError, match="no candidates"):
        Z.publish_candidates(rows, f"{tmp_path}/x", {}, spark.createDataFrame([("0" * 64,)], "address_sha256 string"))


def test_snapshot_is_checked_when_loaded(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "entity_control", "none"), ("b", "entity_control", None)],
        "address string, assertion_type string, operational_tier string"
    )
    path = f"{tmp_path}/s"
    Z.export_ndjson(rows, path, "address", version=1)
    assert Z.load_snapshot(spark, path, rows.schema).count() == 2
    Z.export_ndjson(rows, f"{tmp_path}/two", "address", version=2)
    with pytest.raises(ValueError, match="resolution_policy"):
        Z.load_snapshot(spark, f"{tmp_path}/two", rows.schema)
    Z.export_ndjson(rows, f"{tmp_path}/nine", "address", version=9)
    with pytest.raises(ValueError, match="version"):
        Z.load_snapshot(spark, f"{tmp_path}/nine", rows.schema)
    assert content_digest(rows) == content_digest(rows.repartition(5)) != content_digest(rows.union(rows))


def test_campaign_is_checked(spark, tmp_path):
    features = spark.createDataFrame(
        [("f1", 5, 9, "2020-01-01", "2020-01-02")],
        "address_id string, first_seen_height long, last_seen_height long, t0 string, t1 string"
    )
    features = features.select(
        "address_id", "first_seen_height", "last_seen_height", F.col("t0").cast("timestamp").alias("first_seen_time"),
        F.col("t1").cast("timestamp").alias("last_seen_time")
    )
    scripts, one = spark.createDataFrame([("s1",)], "script_id string"), spark.createDataFrame([(3,)], "total_output_rows long")
    mixed = M.mixed_rows(scripts, features, one)
    columns = {"script_subject": scripts.columns, "address_feature": features.columns, "source_accounting": one.columns}
    assert len(M.materialized(mixed, columns, f"{tmp_path}/ok", 9, "2020-01-02 00:00:00", {})["files"]) == 3
    for height, time in ((8, "2020-01-02 00:00:00"), (9, "2020-01-01 12:00:00")):
        with pytest.raises(ValueError, match="cutoff"):
            M.materialized(mixed, columns, f"{tmp_path}/late", height, time, {})
    with pytest.raises(ValueError, match="unknown kind"):
        M.materialized(mixed.withColumn("row_kind", F.lit("x")), columns, f"{tmp_path}/kind", 9, "2020-01-02 00:00:00", {})
    with pytest.raises(ValueError, match="one row"):
        M.materialized(M.mixed_rows(scripts, features, one.union(one)), columns, f"{tmp_path}/rows", 9, "2020-01-02 00:00:00", {})
    assert not Store(spark).exists(f"{tmp_path}/late")


def test_joins_that_must_fit(spark):
    cand = spark.createDataFrame([("a", "p0", "h1"), ("b", "p1", "h2")], "k string, tier string, digest string")
    assert M.matched(cand.limit(1), cand, "k", ("tier", "digest")).count() == 1
    with pytest.raises(ValueError, match="no_candidate; other_tier"):
        M.matched(spark.createDataFrame([("a", "p1", "h1"), ("z", "p0", "h")], cand.schema), cand, "k", ("tier", "digest"))
    same = M.differences(cand, cand).first()
    assert same.equal and M.differences(cand.union(cand), cand).first().unexpected_count == 2


def test_source_checks(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(5).write.parquet(path)
    assert H.frozen_read(spark, path, spark.read.parquet).count() == 5

    def meddling(p):
        rows = spark.read.parquet(p)
        spark.range(1).write.mode("append").parquet(p)
        return rows

    with pytest.raises(ValueError, match="changed"):
        H.frozen_read(spark, path, meddling)
    spark.range(4).createOrReplaceTempView("four")
    sql = "select count(*) as n from identifier(:t) where id < :most"
    pin = hashlib.sha256(sql.encode()).hexdigest()
    assert H.query_template(spark, sql, {"t": "four"}, pin, most=3).first().n == 3
    for bad in (dict(tables={"t": "four; drop"}, most=3), dict(tables={"t": "four"}), dict(tables={"t": "four"}, pinned_sha256="0" * 64, most=3)):
        with pytest.raises(ValueError):
            H.query_template(spark, sql, **bad)
    with pytest.raises(ValueError):
        H.exported(spark, "a b")
    assert [len(p) for p in H.pages(spark.range(7), 3)] == [3, 3, 1]
    times = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    probe = H.source_probe(
        times, T.StructType([T.StructField("t", T.TimestampType()), T.StructField("x", T.LongType())]), "t",
        "2024-01-03 00:00:00", 24
    )
    assert probe["reasons"] == ["schema", "stale"] and H.freshness(times, "t", "2023-01-01", 24).first().reasons == ["from_the_future"]
    assert H.freshness(times.limit(0), "t", "2023-01-01", 24).first().reasons == ["empty"]


def test_plans(spark):
    ids = O.entity_ids(
        spark.createDataFrame([("a",), ("",), (None,)], "entity_id string"),
        spark.createDataFrame([("a",), ("b",), ("c",)], "entity_id string")
    )
    none = ids.limit(0)
    assert [(r.entity_id, r.plan_rank) for r in O.fanout_plan(ids, ids.where("entity_id = 'a'"), none, 5).collect()] == [("b", 1), ("c", 2)]
    due = spark.createDataFrame([(i,) for i in (4, 2, 9)], "queue_rank long")
    assert [(r.queue_rank, r.points_after) for r in O.enrichment_plan(due, 20, 4, 8, 5, 5).collect()] == [(2, 12), (4, 20)]
    extra = spark.createDataFrame([("n", 3)], "entity_id string, rank int")
    seen = spark.createDataFrame([], "entity_id string, discovery_method string, discovery_rank int, observed_at timestamp")
    parse = spark.createDataFrame([], "entity_id string, parse_outcome string, parsed_at timestamp")
    tried = spark.createDataFrame([], "entity_id string, outcome string, attempted_at timestamp")
    seeds = spark.createDataFrame([], "entity_id string, priority int")
    found = V.due_entities(seen, parse, tried, seeds, none, "2024-01-01", "2024-01-01", 5, extra)
    assert [(r.entity_id, r.priority) for r in found.collect()] == [("n", 68)]


def test_decisions_and_text(spark):
    schema = "address string, assertion_type string, asserted_value string, decision string, reviewed_at timestamp, override_id long, reviewer_ref string"
    log = spark.createDataFrame([("a", "entity_control", "x", "select", None, 1, "me")], schema)
    with pytest.raises(ValueError, match="no_time"):
        S.recorded(log, log, ("select",))
    names = spark.createDataFrame(
        [("entity_control", "\u2003\tAcme \u00a0\n", "", "", "")],
        "assertion_type string, candidate_entity_name string, candidate_entity_id string, candidate_wallet_role string, candidate_label string"
    )
    assert names.select(I.canonical_value().alias("v")).first().v == "acme"


def test_one_shot_run_that_fails(spark, tmp_path):
    run = Z.RunReceipt(spark, f"{tmp_path}/run.json")
    with pytest.raises(ZeroDivisionError):
        Z.once(run, {}, lambda: 1 / 0)
    assert run.status() == {"status": "failed", "error": "ZeroDivisionError"}
    with pytest.raises(FileExistsError):
        Z.once(run, {}, dict)


def test_campaign_total_passes_a_long(spark, tmp_path):
    """Two addresses of 5e18 sats each: either fits a long, their sum doesn't."""
    day = datetime.datetime(2000, 1, 1)
    orders = spark.createDataFrame([(1, 100, 10.0, day)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz")
    lines = [(1, part, 1, line, 5e10, "N") for line, part in ((1, 6), (2, 13))]
    fields = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string"
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, fields).write.parquet(f"{tmp_path}/lineitem.parquet")
    row = QUERIES["materialized_campaign"](spark, str(tmp_path)).first()
    assert (row.feature_count, int(row.utxo_sats), row.script_count, row.output_rows, row.anchor_count) == (2, 10**19, 2, 2, 0)


def test_calibration_seeds_are_all_there(spark, tmp_path):
    day = datetime.datetime(2024, 1, 2)
    events = [(3 * i, day, i // 2, "view" if i % 9 == 0 else "purchase", 1.0) for i in range(3000)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").selectExpr(
        "*", "'{}' as props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    wanted = con.execute(ORACLE_SQL["calibration_seeds"]).fetchall()
    got = [tuple(r) for r in QUERIES["calibration_seeds"](spark, str(tmp_path)).collect()]
    assert len(got) > 1000 and sorted(got) == sorted(wanted)
