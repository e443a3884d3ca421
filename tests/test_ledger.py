"""Rules of single operators, with hand-built rows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.hashing import bucket, control_sample, elapsed_days, fingerprint, script_id
from lodestrata.functions.text import collapsed, parsed_utc, stratum
from lodestrata.operators import anchors as A
from lodestrata.operators import candidates as C
from lodestrata.operators import coverage as V
from lodestrata.operators import economics as E
from lodestrata.operators import firstwave as W
from lodestrata.operators import flatten as X
from lodestrata.operators import policy as P
from lodestrata.operators import queues as Q
from lodestrata.operators import ranking as K
from lodestrata.operators import reconcile as R
from lodestrata.schemas import TRANSACTIONS, contract_violations, schema_sha256, within_budget

BTC, CUT = 10**8, "2020-01-01 00:00:00"


def out(address, value, index=0, script="aa", kind="pubkeyhash"):
    return (index, script, kind, address if isinstance(address, list) else [address], value)


def spend(address, value):
    return (0, None, None, None, "pubkeyhash", [address], value)


def transactions(spark, *rows):
    """rows: hash, block, height, time, inputs, outputs."""
    from decimal import Decimal

    def dec(side, at):
        return [tuple(Decimal(v) if i == at and v is not None else v for i, v in enumerate(x)) for x in side]

    made = [(h, b, n, t, dec(i, 6), dec(o, 4)) for h, b, n, t, i, o in rows]
    schema = "hash string, block_hash string, block_number bigint, t string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in TRANSACTIONS if f.name in ("inputs", "outputs")
    )
    df = spark.createDataFrame(made, schema)
    return df.withColumn("block_timestamp", F.col("t").cast("timestamp")).withColumn("block_timestamp_month", F.trunc("block_timestamp", "MM")).drop("t")


def test_flatten_keeps_all_items_and_drops_none(spark):
    tx = transactions(
        spark, ("x", "b", 1, "2019-12-01", [spend("a", 5)], [out(["a", "b"], 1), out([], 2), out("c", None)]),
        ("y", "b", 2, "2020-02-01", [], [out("c", 1)])
    )
    io = X.flatten_io(X.at_cutoff(tx, 10, CUT), True)
    assert io.count() == 4
    assert [r.normalized_address for r in X.single_address(io).orderBy("row_kind").collect()] == ["a", "c"]
    acc = E.source_accounting(io).first()
    assert (
        acc.total_output_rows, acc.total_input_rows, acc.empty_address_rows, acc.multi_address_rows,
        acc.standard_single_address_rows
    ) == (3, 1, 1, 1, 1)


def test_windows_include_their_edge_and_not_a_microsecond_more(spark):
    tx = transactions(
        spark, ("x", "b", 1, "2019-10-03 00:00:00", [], [out("a", 7)]), ("y", "b", 1, "2019-10-02 23:59:59.999999", [], [out("a", 5)]),
        ("z", "b", 1, "2019-01-01 00:00:00", [], [out("a", 3)]),
    )
    r = E.address_economics(X.flatten_io(tx), CUT).first()
    assert (r.gross_flow_90d_sats, r.lifetime_received_sats, r.active_tx_90d_count, r.active_tx_365d_count) == (7, 15, 1, 3)


def test_the_transaction_key_is_block_and_hash(spark):
    tx = transactions(spark, ("x", "b1", 1, "2019-12-01", [], [out("a", 300 * BTC)]), ("x", "b2", 2, "2019-12-02", [], [out("a", 300 * BTC)]))
    r = E.address_economics(X.flatten_io(tx), CUT).first()
    assert r.max_same_tx_received_lifetime_sats == 300 * BTC and r.active_tx_90d_count == 2 and r.same_tx_receive_ge_500_btc_lifetime_count == 0


def test_zero_outputs_and_input_only_addresses(spark):
    tx = transactions(spark, ("x", "b", 1, "2019-12-01", [spend("in", 5)], [out("zero", 0)]))
    io = X.flatten_io(tx)
    v2 = {r.normalized_address: r.has_output for r in E.address_economics(io, CUT).collect()}
    v1 = {r.normalized_address: r.has_output for r in E.economics_v1(io, CUT).collect()}
    assert v2 == {"zero": False, "in": False} and v1 == {"zero": True, "in": False}
    assert [r.normalized_address for r in E.address_features(X.flatten_io(tx, True), CUT).collect()] == ["zero"]
    contract = R.population_contract(E.address_economics(io, CUT).where("has_output"), E.economics_v1(io, CUT).where("has_output"), 10).first()
    assert (contract.outcome, contract.zero_value_only_count) == ("allow", 1)


def test_co_receivers_count_receivers_only(spark):
    tx = transactions(
        spark,
        ("x", "b", 1, "2019-12-01", [spend("s", 900 * BTC)], [out("a", 60 * BTC), out("a", 50 * BTC), out("b", 200 * BTC), out("c", 99 * BTC)])
    )
    assert {tuple(r) for r in E.large_counterparties(X.flatten_io(tx)).collect()} == {("a", 1), ("b", 1)}


def test_missing_and_empty_scripts_are_one_subject(spark):
    tx = transactions(spark, ("x", "b", 1, "2019-12-01", [], [out("a", 1, script=None), out("b", 1, script=""), out("c", 1, script="00ff")]))
    rows = E.script_subjects(X.flatten_io(tx, True)).collect()
    assert len(rows) == 2
    want = hashlib.sha256(b"bitcoin:mainnet\x00" + bytes.fromhex("00ff")).hexdigest()
    assert want in {r.script_id for r in rows}


def test_elapsed_days_are_not_calendar_days(spark):
    df = spark.sql("select timestamp'2020-01-01 23:00:00' a, timestamp'2020-01-02 01:00:00' b, timestamp'2020-01-02 23:00:00' c")
    assert tuple(df.select(elapsed_days(F.col("a"), F.col("b")), elapsed_days(F.col("a"), F.col("c"))).first()) == (0, 1)


def test_hashes(spark):
    df = spark.createDataFrame([("1BoatSLRHtKNngkdXEeobR76b53LETtpyT",)], "a string")
    assert df.select(bucket(F.col("a"))).first()[0] == int(hashlib.sha256(b"1BoatSLRHtKNngkdXEeobR76b53LETtpyT").hexdigest()[:8], 16) % 64
    got = df.select(fingerprint(z=F.lit(None).cast("string"), a=F.lit("x"))).first()[0]
    assert got == hashlib.sha256(b'{"a":"x","z":null}').hexdigest()
    ids = spark.range(3000).select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("i"))
    want = sum(int.from_bytes(hashlib.sha256(f"c:{hashlib.sha256(str(i).encode()).hexdigest()}".encode()).digest()[:8], "big") < 2**64 * 2 // 100 for i in range(3000))
    assert ids.where(control_sample("c", F.col("i"))).count() == want
    assert df.select(script_id(F.lit(None).cast("string"))).first()[0] == hashlib.sha256(b"bitcoin:mainnet\x00").hexdigest()


def test_text(spark):
    df = spark.createDataFrame([("a:b:c", " Big \t Name "), ("none", "x")], "s string, t string")
    assert [tuple(r) for r in df.select(stratum(F.col("s")), collapsed(F.col("t"))).collect()] == [("c", "big name"), ("unspecified", "x")]
    times = spark.createDataFrame(
        [("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",)], "t string"
    ).select(parsed_utc(F.col("t")).alias("p")).collect()
    assert times[0].p is not None and times[1].p is None


def feature(spark, **values):
    base = {
        "address_id": "00", "current_utxo_sats": 0, "max_same_tx_received_sats": 0, "gross_flow_90d_sats": 0,
        "lifetime_received_sats": 0, "direct_large_counterparty_count": 0
    }
    row = base | values
    df = spark.range(1).select(
        *[F.lit(v).alias(k) if k == "address_id" else F.lit(v).cast("bigint").alias(k) for k, v in row.items() if k not in ("days", "cal")]
    )
    return df.withColumns(
        {
            "last_seen_time": F.lit(CUT).cast("timestamp") - F.make_dt_interval(F.lit(row.get("days", 1000))),
            "calibration_reasons": F.array(*map(F.lit, row.get("cal", ()))).cast("array<string>")
        }
    )


@pytest.mark.parametrize(
    ("values", "kind", "score"),
    [
        ({"current_utxo_sats": 100 * BTC}, "P0", 20), ({"current_utxo_sats": 100 * BTC - 1}, "NONE", 12), (
            {"max_same_tx_received_sats": 499 * BTC, "current_utxo_sats": 10 * BTC, "days": 365}, "P1", 25
        ),
        ({"gross_flow_90d_sats": 10 * BTC, "days": 30}, "NONE", 13), ({"days": 31}, "NONE", 7), ({"cal": ["existing_provider_conflict"]}, "P0", 0),
        (
            {"cal": ["provider_entity_prediction", "existing_system_watchlist"]}, "P1", 25
        ), ({"direct_large_counterparty_count": 1}, "NONE", 10), ({"lifetime_received_sats": 10_000 * BTC, "days": 366}, "NONE", 0),
    ],
)
def test_importance(spark, values, kind, score):
    r = P.importance_v1(feature(spark, **values), CUT, "campaign").first()
    assert (r.priority_class, r.importance_score) == (kind, score)


def test_quotas_are_whole(spark):
    for slots in (0, 1, 7, 99, 100, 12_000):
        assert sum(W.quotas(slots).values()) == slots
    assert W.quotas(10) == {
        "current_capital": 3, "historical_large_receipt": 3, "high_turnover": 2, "dormant_holder": 1, "high_value_connector": 1,
        "calibration_control": 0
    }


WAVE = (
    "address_id string, priority_class string, importance_score int, current_utxo_sats long, max_same_tx_received_sats long, "
    "gross_flow_90d_sats long, lifetime_received_sats long, reason_codes array<string>, cohort_names array<string>"
)


def wave_by_loops(rows, slots):
    """The selection's rules, row by row."""
    p0 = sum(r[1] == "P0" for r in rows)
    counts, free = Counter({"P0": min(p0, slots)}), slots - min(p0, slots)
    line = sorted((r for r in rows if r[1] in ("P1", "CONTROL")), key=lambda r: (-r[2], -max(r[3:7]), r[0]))
    lists = {g: [r for r in line if g in own_groups(r)][:slots] for g in W.GROUPS}
    chosen = set()
    for g, most in W.quotas(free).items():
        for r in [r for r in lists[g] if r[0] not in chosen][:most]:
            chosen.add(r[0])
            counts[g] += 1
    cap = -(-free * 40 // 100)
    for r in line:
        if len(chosen) < free and r[0] not in chosen and any(r in own for own in lists.values()):
            live = sum(any(x[0] not in chosen for x in own) for own in lists.values())
            able = [g for g in own_groups(r) if counts[g] < cap or live < 3]
            if able:
                counts[min(able, key=lambda g: (counts[g], g))] += 1
                chosen.add(r[0])
    return {g: n for g, n in counts.items() if n}


def own_groups(r):
    return sorted({"calibration_control" if c in ("calibration", "control") else c for c in r[8]} & set(W.GROUPS))


@pytest.mark.parametrize("seed", range(3))
def test_first_wave(spark, seed):
    rng = random.Random(seed)
    names = ["current_capital", "high_turnover", "dormant_holder", "historical_large_receipt", "high_value_connector", "calibration", "control"]
    rows = [
        (f"{i:03d}", rng.choice(["P0", "P1", "P1", "P1", "P1", "CONTROL", "NONE"]), rng.randint(0, 40), rng.randint(0, 9), rng.randint(0, 9), 0, 0,
         ["utxo_ge_100_btc"], rng.sample(names[: 3 + 2 * seed], rng.randint(1, 3)))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, WAVE)
    for slots in (5, 40, 70):
        got = {r.quota_group: r.address_count for r in W.select_first_wave(df, slots).collect()}
        assert got == wave_by_loops(rows, slots), slots
    assert W.select_first_wave(df, 0).count() == 0


def test_first_wave_anchors_and_capacity(spark):
    rows = [
        ("a" * 64, "P0", 5, 7, 0, 0, 0, ["utxo_ge_100_btc"], ["current_capital"]),
        ("b" * 64, "P1", 30, 1, 1, 1, 1, ["x", "y"], ["current_capital", "high_turnover"])
    ]
    anchors = spark.createDataFrame([("n1", ["existing_provider_conflict"]), ("n2", [])], "address string, calibration_reasons array<string>")
    best = W.best_p0(spark.createDataFrame(rows, WAVE), 9, anchors).collect()
    assert [r.p0_place for r in best] == [0, 2, 6] and best[1].address_id == "a" * 64
    limits = W.capacity(1, 3, 100, 50)
    assert limits == {"rate_limited": 3, "point_limited": 2, "bounded": 2}
    got = {(r.metric, r.name): r.value for r in W.first_wave_statistics(spark.createDataFrame(rows, WAVE), anchors, limits, 3).collect()}
    assert got["class", "P0"] == 3 and got["class", "P1"] == 1 and got["total", "anchor_only"] == 2 and got["first_wave", "P0"] == 2
    assert got["total", "remaining_p0"] == 1 and got["total", "projected_minimum_minutes"] == 2 and got["overlap", "current_capital&high_turnover"] == 1
    assert got["total", "reason_memberships"] == 5 and got["total", "duplicate_slots_prevented"] == 1 and got["reason", "anchor_only_calibration"] == 1
    with pytest.raises(ValueError):
        W.capacity(0, 1, 1)


def test_candidate_violations(spark):
    row = dict(
        normalized_address="a", strict_is_p0=False, strict_is_p1=False, strict_is_edge=True, strict_is_coarse=True,
        v2_chain_score=16, strict_p0_mask=0, receipt_support_mask=0, **{c: 5 for c in C.SATS}, **{c: 1 for c in C.COUNTS}
    )
    df = spark.createDataFrame([row]).withColumn("last_seen_time", F.lit(CUT).cast("timestamp"))
    good = C.strict_candidates(df)
    assert good.first().candidate_tier == "edge" and C.violations(good).count() == 0
    bad = good.withColumn("candidate_tier", F.lit("p1")).withColumn("active_day_90d_count", F.lit(9).cast("bigint"))
    assert set(C.violations(bad).first().codes) == {"tier", "tier_rank", "horizons", "days_over_transactions", "row_digest"}
    kept, missing = C.without_excluded(good, spark.createDataFrame([(hashlib.sha256(b"a").hexdigest(),), ("no",)], "address_sha256 string"))
    assert kept.count() == 0 and missing.count() == 1


def test_coverage_precedence(spark):
    names = [f"{i:05b}" for i in range(32)]
    cand = spark.createDataFrame([(n, "edge", "h") for n in names], "normalized_address string, candidate_tier string, candidate_row_sha256 string")
    sets = [spark.createDataFrame([(n, "e") for n in names if n[k] == "1"], "normalized_address string, entity_id string") for k in range(5)]
    got = {r.normalized_address: r.coverage_state for r in V.coverage_state(cand, *sets).collect()}
    for n in names:
        direct, member, evidence, conflict, explicit = (c == "1" for c in n)
        assert got[n] == (
            "direct_enriched" if direct else "needs_direct_enrichment" if conflict or explicit else "entity_membership_covered" if member else "local_evidence_covered" if evidence else "needs_direct_enrichment"
        )


@pytest.mark.parametrize("parts", [2, 8, 200])
def test_ranks_of_wide_rows(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(50_000, numPartitions=7).select(
            "id", (F.col("id") * 7_919 % 50_021).alias("v"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("more")
        )
        rows = K.ranked(df, F.desc("v"), F.asc("id")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    places = {r.id: r.queue_rank for r in rows}
    assert len(rows) == 50_000 and all(places[i] == k for k, i in enumerate(sorted(range(50_000), key=lambda i: (-(i * 7_919 % 50_021), i)), 1))


def test_one_address_in_half_the_rows(spark):
    tx = transactions(
        spark,
        *[(f"t{i}", f"b{i % 5}", i, "2019-12-01", [], [out("hot", 10 ** 10 + i), out(f"a{i}", 10 ** 10 * (i % 3))]) for i in range(300)]
    )
    got = {r.normalized_address: r for r in E.address_economics(X.flatten_io(tx), CUT).collect()}
    assert got["hot"].lifetime_received_sats == sum(10 ** 10 + i for i in range(300)) and got["hot"].active_tx_90d_count == 300
    plan = E.address_economics(X.flatten_io(tx), CUT)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan  # both levels sum in part before their shuffles
    feats = {r.normalized_address: r.direct_large_counterparty_count for r in E.address_features(X.flatten_io(tx, True), CUT).collect()}
    assert feats["hot"] == sum(i % 3 > 0 for i in range(300)) and feats["a1"] == 1 and feats["a3"] == 0


def test_ranking(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") * 37 % 101).alias("v"))
    got = [r.id for r in K.ranked(df, F.desc("v"), F.asc("id")).orderBy("queue_rank").collect()]
    assert got == [i for i in sorted(range(500), key=lambda i: (-(i * 37 % 101), i))]
    assert Q.rank_gaps(K.ranked(df, F.desc("v"), F.asc("id"))).first().contiguous
    assert tuple(K.nearest_rank(spark.range(1, 5), "id", {"a": 0.5, "b": 0.95}).first()) == (2, 4)


def test_anchor_joins(spark):
    anchors = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "x")], "address string, reason_code string")
    feats = spark.createDataFrame([("a",), ("c",)], "normalized_address string")
    assert {r.normalized_address: r.calibration_reasons for r in A.with_reasons(feats, anchors).collect()} == {"a": ["x", "y"], "c": []}
    assert [r.address for r in A.anchor_only(anchors, feats).collect()] == ["b"]


def test_census_mutations_are_caught(spark):
    from lodestrata.operators import census as N

    tx = transactions(spark, *[(f"x{i}", "b", i, "2019-12-01", [], [out(f"a{i % 7}", 10 ** (8 + i % 5))]) for i in range(40)])
    io = X.flatten_io(tx)
    e1, e2 = E.economics_v1(io, CUT), E.address_economics(io, CUT)
    row1 = N.census_v1(io, e1, P.chain_policy_v1(e1, CUT)).persist()
    row2 = N.census_v2(io, e2, P.variants_v2(e2, CUT)).persist()
    assert R.reconcile_v1(row1).first().blocked_codes == [] and R.reconcile_v2(row2).first().blocked_codes == []
    for name, code in (
        ("chain_p0_union_count", "p0_union"), ("utxo_ge_10_btc_count", "utxo_ladder"),
        ("excluded_source_address_count", "coarse_partition")
    ):
        assert code in R.reconcile_v1(row1.withColumn(name, F.lit(10**6).cast("bigint"))).first().blocked_codes
    assert "hard_stop_p0" in R.reconcile_v2(row2.withColumn("strict_p0_union_count", F.lit(2 * 10**6).cast("bigint"))).first().blocked_codes


def test_contracts(spark):
    tx = transactions(spark, ("x", "b", 1, "2019-12-01", [], []))
    assert contract_violations(tx, TRANSACTIONS) == []
    assert contract_violations(tx.drop("inputs"), TRANSACTIONS) == ["table.inputs: missing"]
    assert schema_sha256(tx.schema) == schema_sha256(tx.select(*sorted(tx.columns)).schema)
    with pytest.raises(ValueError):
        within_budget(tx, 0)
