"""Addresses, proofs, readers, sinks, resolver and streams."""

import base64
import datetime
import gzip
import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import addresses as A
from lodestrata.functions import proofs as P
from lodestrata.operators import evidence as I
from lodestrata.operators import replay as Y
from lodestrata.operators import resolver as S
from lodestrata.schemas import EVIDENCE, REPLAY_EVENT
from lodestrata.sources import readers as R
from lodestrata.sources import sinks as K
from lodestrata.streaming import ingest

T0 = datetime.datetime(2024, 1, 1)
AS_OF = "2024-02-01 00:00:00"


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "p2pkh"), ("3J98t1WpEZ73CNmQviecrnyiWrnqRhWNLy", "p2sh"),
        ("bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4", "p2wpkh"),
        ("BC1QW508D6QEJXTDG4Y5R3ZARVARY0C5XW7KV8F3T4", "p2wpkh"), ("bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0", "p2tr"),
        ("1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb", None), ("bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t5", None),
        ("Bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4", None), ("tb1qw508d6qejxtdg4y5r3zarvary0c5xw7kxpjzsx", None), ("", None),
    ],
)
def test_address(text, kind):
    if kind is None:
        with pytest.raises(ValueError):
            A.normalized(text)
    else:
        assert A.normalized(text) == (text.lower() if text.lower().startswith("bc1") else text, kind)


def test_address_column(spark):
    df = spark.createDataFrame([("1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa",), ("x",), (None,)], "a string")
    rows = [r.n for r in df.select(A.normalize_address(F.col("a")).alias("n")).collect()]
    assert rows[0].address_type == "p2pkh" and rows[0].error is None and rows[1].error and rows[2].error


def signed(key, digest, k):
    """A compact signature by a private key."""
    point = P.times(k, P.BASE)
    r = point[0] % P.ORDER
    s = pow(k, -1, P.ORDER) * (int.from_bytes(digest, "big") + r * key) % P.ORDER
    for flag in (4, 5):
        text = base64.b64encode(bytes([27 + flag]) + r.to_bytes(32, "big") + s.to_bytes(32, "big")).decode()
        if P.recovered_key(text, digest) == P.encoded(P.times(key, P.BASE), True):
            return text
    raise AssertionError


def test_proof_and_archive(spark, tmp_path):
    keys = [101, 202, 303]
    script = b"\x52" + b"".join(b"\x21" + P.encoded(P.times(k, P.BASE), True) for k in keys) + b"\x53\xae"
    address, message = P.script_address(script), "I am an audited address"
    digest = P.message_digest(message)
    one, two, other = signed(101, digest, 777), signed(303, digest, 888), signed(999, digest, 555)
    assert A.normalized(address)[1] == "p2sh"
    lines = [
        "coin,total", f"BTC,x,y,{address},1,{message},{one},{two},{script.hex()}",
        f"BTC,x,y,{address},1,{message},{one},{one},{script.hex()}",
        f"BTC,x,y,{address},1,{message},{one},{other},{script.hex()}", f"ETH,x,y,{address},1,{message},{one},{two},{script.hex()}"
    ]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("rows.csv", "\n".join(lines))
    rows = R.multisig_rows(R.zipped_rows(spark, str(tmp_path / "a.zip")), message)
    judged = rows.withColumn(
        "verified",
        P.verify_2of3_proof(*[F.col(c) for c in ("address", "message", "first_signature", "second_signature", "redeem_script_hex")])
    )
    assert [r.verified for r in judged.orderBy("row_number").collect()] == [True, False, False]
    assert R.proof_evidence(judged, "id", "name", "2024-01-01", "0" * 64).count() == 1


def test_embedded_wallets(spark):
    data = {"props": [{"deep": {"updatedAt": "2024-01-01T00:00:00Z", "walletBalances": [{"active": True, "address": "a"}, {"active": False, "address": "b"}]}}]}
    page = f'<html><script id="__NEXT_DATA__" type="application/json">{json.dumps(data)}</script></html>'
    pages = spark.createDataFrame([(1, page), (2, "<html></html>"), (3, None)], "page_id long, html string")
    rows = R.wallets(pages)
    assert [(r.page_id, r.address) for r in rows.collect()] == [(1, "a")]
    assert R.issuer_evidence(rows, "id", "n", "2024-01-02", "0" * 64).first().expires_at == datetime.datetime(2024, 2, 1)


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "e.ndjson").write_text('{"event_id":"1","replay_weight":2}\n{"event_id":"2"}\n')
    assert R.ndjson(spark, str(tmp_path / "e.ndjson"), REPLAY_EVENT).count() == 2
    stored = K.stored_payload(spark, str(tmp_path / "blobs"), b"hello")
    assert gzip.decompress(next((tmp_path / "blobs").rglob("*.gz")).read_bytes()) == b"hello"
    ledger = spark.createDataFrame(
        [(stored["payload_name"], stored["payload_sha256"]), (stored["payload_name"], "bad")],
        "payload_name string, payload_sha256 string"
    )
    assert R.payloads(spark, str(tmp_path / "blobs"), ledger).count() == 1
    rows = spark.createDataFrame(
        [(f"a{i}", "p0" if i % 2 else "edge", i % 3) for i in range(20)],
        "normalized_address string, candidate_tier string, address_bucket long"
    )
    root = str(tmp_path / "pub")
    manifest = K.publish_candidates(rows, root, {"kind": "candidates"})
    assert len(manifest["files"]) == 6 and K.verified(spark, root)["kind"] == "candidates"
    assert K.candidates_by_tier(spark, root, ("edge",)).count() == 10
    assert R.partitioned(spark, f"{root}/candidates").count() == 20
    with pytest.raises(FileExistsError):
        K.publish_candidates(rows, root, {})
    with pytest.raises(ValueError):
        K.publish_candidates(rows.union(rows), str(tmp_path / "twice"), {})
    (tmp_path / "pub" / "candidates" / "extra.parquet").write_bytes(b"x")
    with pytest.raises(ValueError):
        K.verified(spark, root)
    first = K.export_ndjson(rows, str(tmp_path / "s"), "normalized_address")
    assert K.export_ndjson(rows.repartition(3), str(tmp_path / "s"), "normalized_address") == first
    with pytest.raises(FileExistsError):
        K.export_ndjson(rows.limit(3), str(tmp_path / "s"), "normalized_address")
    run = K.RunReceipt(spark, str(tmp_path / "run.json"))
    run.start({"query": "q"})
    assert run.end("done", rows=3)["status"] == "done"
    with pytest.raises(ValueError):
        run.end("done")
    with pytest.raises(FileExistsError):
        run.start({})


def proof(spark, *rows):
    """Evidence from dicts over defaults."""
    base = {f.name: None for f in EVIDENCE} | {
        "address": "a", "assertion_type": "entity_control", "source_authority": "commercial_provider", "evidence_tier": "C",
        "independence_group": "g", "observed_at": T0, "evidence_status": "valid", "candidate_entity_name": "Acme"
    }
    return spark.createDataFrame([tuple((base | {"evidence_id": f"e{i}"} | r)[f.name] for f in EVIDENCE) for i, r in enumerate(rows)], EVIDENCE)


def decided(spark, *rows):
    return spark.createDataFrame(
        [("a", "entity_control", v, d, T0 + datetime.timedelta(days=n), n, n) for n, (v, d) in enumerate(rows)],
        "address string, assertion_type string, asserted_value string, decision string, reviewed_at timestamp, review_id int, override_id int"
    )


@pytest.mark.parametrize(
    ("rows", "reviews", "overrides", "state", "policy"),
    [
        ([{}], [], [], "resolved", "provider_default"), (
            [{}, {"candidate_entity_name": " ACME ", "candidate_entity_id": "other"}], [], [], "resolved", "provider_default"
        ),
        (
            [{}, {"source_authority": "official", "evidence_tier": "B"}], [], [], "resolved", "unreviewed_evidence"
        ), ([{}, {"candidate_entity_name": "Beta"}], [], [], "ambiguous", "conflict_first"),
        ([{}, {"candidate_entity_name": "Beta"}], [], [("beta", "select")], "resolved", "local_override"), (
            [{}, {"candidate_entity_name": "Beta"}], [("acme", "reject")], [], "resolved", "provider_default"
        ),
        ([{}], [("acme", "accept")], [], "resolved", "provider_default"), (
            [{"evidence_tier": "B", "source_authority": "official"}], [("acme", "accept")], [], "resolved", "reviewed_evidence"
        ),
        (
            [{"evidence_tier": "B"}], [("acme", "accept")], [("acme", "reject")], "unattributed", "local_override"
        ), ([{"evidence_status": "retracted"}], [], [], "stale", "unattributed"),
        ([{"expires_at": T0}], [], [], "stale", "unattributed"), ([{}], [], [("acme", "reject"), ("acme", "select")], "resolved", "local_override"),
        ([{"assertion_type": "address_label", "candidate_label": "L", "provider_tag_id": "t"}], [], [], "unattributed", "unattributed"),
    ],
)
def test_resolver(spark, rows, reviews, overrides, state, policy):
    ev, over = proof(spark, *rows), decided(spark, *overrides)
    made = S.claims(ev, decided(spark, *reviews), over, AS_OF)
    r = S.resolutions(ev, made, over, AS_OF).first()
    assert (r.identity_state, r.resolution_policy) == (state, policy)


def test_conflicts_open_and_close(spark):
    none = decided(spark)
    made = S.claims(proof(spark, {}, {"candidate_entity_name": "Beta"}), none, none, AS_OF)
    first = S.conflicts(made, None, AS_OF)
    assert [(r.status, len(r.claim_ids)) for r in first.collect()] == [("active", 2)]
    after = S.conflicts(S.claims(proof(spark, {}), none, none, AS_OF), first, "2024-03-01 00:00:00").first()
    assert after.status == "resolved" and after.conflict_set_id == first.first().conflict_set_id


def test_evidence_import(spark):
    rows = proof(spark, {}, {}, {"candidate_entity_name": None}, {"evidence_tier": "A"}, {"source_authority": "rumour"})
    good, bad = I.checked(rows)
    assert good.count() == 2 and sorted(r.codes[0] for r in bad.collect()) == ["entity_missing", "source_authority_unknown", "verification_missing"]
    marked = I.fingerprinted(good)
    assert I.new_rows(marked, marked.limit(0)).count() == 1 and I.new_rows(marked, marked).count() == 0
    a = proof(spark, {"evidence_tier": "A", "verification_method": "m"}, {"evidence_tier": "A", "verification_method": "?"})
    done = I.verified(a, I.Verifiers(m=lambda df: df.withColumn("verification_result", F.lit("valid"))))
    assert sorted(r.verification_result for r in done.collect()) == ["invalid", "valid"]


def test_replay_changes_nothing(spark):
    base = {f.name: None for f in REPLAY_EVENT} | {"output_address": "a", "semantic_decision": "internal_candidate"}
    events = spark.createDataFrame(
        [
            tuple((base | {"event_id": str(i), "replay_weight": w, "input_addresses": ins}).values()) for i,
            (w, ins) in enumerate([(3, ["b", "b", "c"]), (0, []), (None, [None, "b"])])
        ],
        REPLAY_EVENT
    )
    snap = spark.createDataFrame(
        [(x, "entity_control", "resolved", "lookup_usable", "provider_default", " Acme") for x in "ab"],
        "address string, assertion_type string, identity_state string, operational_tier string, resolution_policy string, primary_entity_display string"
    )
    assert Y.changed_fields(events, Y.enriched(events, snap)).first()[0] == 0
    r = Y.replay_impact(events, snap).first()
    assert (r.events, r.found, r.internal_candidate_provider_default_events) == (5, 5, 5)
    b = Y.bilateral_impact(events, snap).first()
    assert (b.events, b.same_entity_bilateral_events, b.events_with_missing_input_address, b.input_addresses_observed) == (3, 2, 2, 4)


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame(
        [(hashlib.sha256(str(i % 4).encode()).hexdigest(), T0 + datetime.timedelta(seconds=i)) for i in range(10)],
        "evidence_fingerprint string, observed_at timestamp"
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.new_evidence(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("fresh").count() == 4
    sized = rows.select(
        F.col("observed_at").alias("reserved_at"), F.lit(None).cast("long").alias("actual_bytes"),
        F.lit(5).cast("long").alias("estimated_bytes")
    )
    assert ingest.admission_counts(sized).first().bytes == 50


