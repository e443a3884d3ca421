"""Queries that go through artifacts, checks and plans: what is written is read back, and the twins see the rows that went in."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.addresses import normalize_address
from ..functions.proofs import verify_2of3_proof
from ..functions.text import is_sha256, json_shape, parsed_utc
from ..operators import anchors as A
from ..operators import coverage as V
from ..operators import evidence as I
from ..operators import fanout as O
from ..operators import materialize as M
from ..operators import queues as Q
from ..operators import ranking as K
from ..operators import resolver as S
from ..operators.economics import script_subjects, source_accounting
from ..sources import checks as H
from ..sources import evidence_projection as D
from ..sources import projection as J
from ..sources import readers as R
from ..sources import sinks as Z
from ..sources.shared import kept, path_for
from ..sources.store import Store
from ..streaming import ingest as T
from . import catalog as C
from .oracle import CAND, COVER, DECIDE, EV, FEATURES, ORACLE_SQL, RESOLVE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}
WATCH = "existing_system_watchlist"


def query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__], TWINS[f.__name__] = f, sql
        return f

    return add


def _candidates(s: SparkSession, d: str) -> tuple[DataFrame, str, dict]:
    rows, root = C._candidates(s, d), path_for(s, "artifact")
    return rows, root, Z.publish_candidates(rows, root, {"source": d})


@query(f"with {CAND} select * from cand where candidate_tier in ('p0', 'p1')")
def published_tiers(s, d):
    """Candidates staged, listed, checked, renamed, and two tiers read by the manifest."""
    return Z.candidates_by_tier(s, _candidates(s, d)[1], ("p0", "p1"))


@query(f"with {CAND} select normalized_address, candidate_tier from cand where address_bucket <> 7")
def published_excluding(s, d):
    rows, root = C._candidates(s, d), path_for(s, "artifact")
    out = rows.where("address_bucket = 7").select(F.sha2(F.col("normalized_address").cast("binary"), 256).alias("address_sha256"))
    Z.publish_candidates(rows, root, {"source": d}, out)
    return R.partitioned(s, f"{root}/candidates").select("normalized_address", "candidate_tier")


@query(ORACLE_SQL["coverage_state"])
def coverage_artifact(s, d):
    own, _, manifest = _candidates(s, d)
    root = path_for(s, "coverage")
    Z.publish_coverage(C._coverage(s, d, own), root, manifest, D.AS_OF)
    assert Z.verified(s, root)["candidates_sha256"] == Z.source_digest(manifest)
    return s.read.parquet(f"{root}/coverage").withColumns({x: F.array_join(x, ",") for x in ("provider_entity_ids", "coverage_reason_codes")})


@query(ORACLE_SQL["p0p1_queue"])
def queue_artifact(s, d):
    """A queue bound to the manifests of its candidates and their coverage, read back with its checks."""
    rows, _, manifest = _candidates(s, d)
    coverage, states, root = path_for(s, "coverage"), C._coverage(s, d, rows), path_for(s, "queue")
    about = Z.publish_coverage(states, coverage, manifest, D.AS_OF)
    Z.publish_queue(Q.priority_queue(rows, s.read.parquet(f"{coverage}/coverage")), root, manifest, about)
    return Z.read_queue(s, root)


@query(ORACLE_SQL["snapshot_rows"])
def snapshot_loaded(s, d):
    """Exported twice, the second time without a change, and loaded with its checks."""
    rows, path = kept(C.QUERIES["snapshot_rows"](s, d), "snapshot"), path_for(s, "export")
    first = Z.export_ndjson(rows, path, "address", "assertion_type", version=1)
    assert Z.export_ndjson(rows.repartition(3), path, "address", "assertion_type", version=1) == first
    return Z.load_snapshot(s, path, rows.schema)


@query(ORACLE_SQL["address_features"])
def prefixed_features(s, d):
    path = path_for(s, "features")
    Z.prefixed(C._features(s, d), path)
    return R.partitioned(s, path).drop("prefix")


@query(ORACLE_SQL["script_subjects"])
def flat_scripts(s, d):
    rows, path = C.QUERIES["script_subjects"](s, d), path_for(s, "scripts")
    Z.single_file(rows, f"{path}/one")
    Z.write_empty(rows.limit(0), f"{path}/none")
    return R.flat(s, rows.schema, f"{path}/one", f"{path}/none")


def _mixed(s: SparkSession, d: str) -> tuple[DataFrame, dict[str, list[str]]]:
    io = C._io(s, d, True)
    parts = {"script_subject": script_subjects(io), "address_feature": C._features(s, d), "source_accounting": source_accounting(io)}
    return kept(M.mixed_rows(*parts.values()), "mixed"), {k: v.columns for k, v in parts.items()}


@query(f"""with {FEATURES} select 'address_feature' as row_kind, count(*) as row_count, count(*) as id_count, 0::bigint as total_count from feat
    union all select 'script_subject', count(distinct coalesce(script, '')), count(distinct coalesce(script, '')), 0 from io where kind = 'output' union all select 'source_accounting', 1, 0, 1""")
def mixed_rows(s, d):
    rows = _mixed(s, d)[0]
    ids = F.coalesce(
        F.when(F.col("row_kind") == "script_subject", F.col("script_id")),
        F.when(F.col("row_kind") == "address_feature", F.col("address_id"))
    )
    return rows.groupBy("row_kind").agg(
        F.count("*").alias("row_count"), F.count(ids).alias("id_count"), F.count("total_output_rows").alias("total_count")
    )


@query(f"""with {FEATURES} select (select count(*) from feat) as feature_count, (select sum(current_utxo_sats)::bigint from feat) as utxo_sats, (select count(distinct coalesce(script, '')) from io where kind = 'output') as script_count,
    (select count(*) from io where kind = 'output') as output_rows, 0::bigint as anchor_count""")
def materialized_campaign(s, d):
    """The campaign split by kind, checked, published, and opened as views."""
    mixed, columns = _mixed(s, d)
    root = path_for(s, "campaign")
    M.materialized(mixed, columns, root, J.CUTOFF_HEIGHT, J.CUTOFF_TIME, {"campaign": J.CAMPAIGN})
    Z.single_file(s.createDataFrame([], "address_id string, normalized_address string, reason_code string"), f"{root}/calibration_anchor")
    R.campaign_views(s, root)
    return M.campaign_totals(s)


@query(f"""with {FEATURES} select normalized_address, array_to_string(list_filter([case when first_seen_height > 1200 then 'first_height_after_cutoff' end, case when last_seen_height > 1200 then 'last_height_after_cutoff' end,
    case when first_seen_time > timestamp '1998-03-01' then 'first_time_after_cutoff' end, case when last_seen_time > timestamp '1998-03-01' then 'last_time_after_cutoff' end], lambda x: x is not null), ',') as codes
    from feat where last_seen_height > 1200 or last_seen_time > timestamp '1998-03-01'""")
def past_cutoff(s, d):
    """Which features an earlier campaign must refuse."""
    return M.past_cutoff(C._features(s, d), 1200, "1998-03-01 00:00:00").select("normalized_address", F.array_join("codes", ",").alias("codes"))


@query(f"""with {DECIDE} select normalized_address, array_to_string(list_filter([case when list_contains(cal, '{WATCH}') then 'unknown_reason' end, case when last_seen_time > timestamp '1999-01-01' then 'activity_after_cutoff' end], lambda x: x is not null), ',') as codes
    from decided where list_contains(cal, '{WATCH}') or last_seen_time > timestamp '1999-01-01'""")
def policy_errors(s, d):
    """What an earlier policy, which doesn't know watchlists, must refuse to judge."""
    rows = A.with_reasons(C._features(s, d), C._anchors(s, d))
    known = ("existing_provider_conflict", "official_or_signed_evidence", "provider_entity_prediction")
    return M.policy_errors(rows, known, "1999-01-01 00:00:00").select("normalized_address", F.array_join("codes", ",").alias("codes"))


_FIELDS = ("candidate_tier", "candidate_row_sha256")


@query(f"with {CAND} select normalized_address, 'other_candidate_row_sha256' as codes from cand where address_bucket = 5 union all select 'nobody', 'no_candidate'")
def coverage_mismatches(s, d):
    """Coverage of one bucket names other row digests, and one row has no candidate."""
    rows = C._candidates(s, d)
    digest = F.when(F.col("address_bucket") == 5, F.reverse("candidate_row_sha256")).otherwise(F.col("candidate_row_sha256"))
    own = rows.select("normalized_address", "candidate_tier", digest.alias("candidate_row_sha256"))
    more = s.createDataFrame([("nobody", "p0", "x")], "normalized_address string, candidate_tier string, candidate_row_sha256 string")
    return M.mismatches(own.union(more), rows, "normalized_address", _FIELDS).select("normalized_address", F.array_join("codes", ",").alias("codes"))


@query(f"with {COVER} select normalized_address, v2_chain_score from need where candidate_tier in ('p0', 'p1')")
def matched_candidates(s, d):
    """Candidates of the selected coverage; a row that doesn't fit would be an error."""
    own = C._candidates(s, d)
    need = C._coverage(s, d, own).where("coverage_state = 'needs_direct_enrichment' and candidate_tier in ('p0', 'p1')")
    return M.matched(need, own, "normalized_address", _FIELDS).select("normalized_address", "v2_chain_score")


@query(f"""with {EV} select (select count(*) from (select address from pred except all select address from req)) as unexpected_count, (select count(*) from (select address from req except all select address from pred)) as missing_count, false as equal""")
def set_differences(s, d):
    return M.differences(D.predictions(s, d).select("address"), D.requests(s, d).select("address"))


def _seeds(s: SparkSession, d: str) -> DataFrame:
    return J.table(s, d, "nation").select(F.concat(F.lit("seed:"), F.col("n_nationkey")).alias("entity_id"))


_IDS = f"""{EV}, ids as (select 'seed:' || n_nationkey as entity_id from nation union select entity_id from pred union select entity_id from ev where entity_id is not null)"""


def _ids(s: SparkSession, d: str) -> DataFrame:
    return O.entity_ids(_seeds(s, d), D.predictions(s, d), D.evidence(s, d).select(F.col("candidate_entity_id").alias("entity_id")))


@query(f"with {_IDS} select * from ids")
def entity_ids(s, d):
    return _ids(s, d)


@query(f"with {_IDS}, r as (select entity_id from ids where entity_id not in (select entity_id from pred) and entity_id not like 'seed:%1') select row_number() over (order by entity_id) as plan_rank, entity_id from r order by entity_id limit 20")
def fanout_plan(s, d):
    gone = _seeds(s, d).where("entity_id like '%1'")
    return O.fanout_plan(_ids(s, d), D.predictions(s, d), gone, 20)


@query("""select case when event_id % 14 = 0 then 'http_error' else 'success' end as observed_outcome, count(*) as attempt_count, sum(length(props))::bigint as byte_count, sum(greatest(1, ceil(length(props) / 100000.0)))::bigint as point_count
    from events where event_id % 2 = 0 and event_id % 8 = 0 group by 1""")
def fanout_accounting(s, d):
    attempts = J.table(s, d, "events").select(F.col("event_id").alias("observation_id"), "ts")
    return O.accounting(attempts, D.observations(s, d), "detail")


@query(f"with due as ({ORACLE_SQL['queue_due']}) select queue_rank, normalized_address, (100 + 7 * row_number() over (order by queue_rank))::bigint as points_after from due order by queue_rank limit 42")
def enrichment_plan(s, d):
    """42 rows: (400 - 100) / 7 by points, 50 by time."""
    return O.enrichment_plan(C.QUERIES["queue_due"](s, d), 400, 100, 7, 10, 5)


@query(f"""with e as ({ORACLE_SQL['due_entities']}), a as ({ORACLE_SQL['due_addresses']}), both_kinds as (select 0 as stage, 'entity' as kind, entity_id as subject, priority from e union all select 1, 'address', address, priority from a)
    select row_number() over (order by stage, priority desc, subject) as plan_rank, kind, subject, priority from both_kinds order by stage, priority desc, subject limit 70""")
def sync_plan(s, d):
    return O.sync_plan(C.QUERIES["due_entities"](s, d), C.QUERIES["due_addresses"](s, d), 70)


def _responses(s: SparkSession, d: str) -> DataFrame:
    """Responses in the three shapes that providers use, with a repeated and an empty address."""
    e = J.table(s, d, "events")
    own, other = F.concat(F.lit("acct:"), F.col("user_id")), F.concat(F.lit("acct:"), (F.col("user_id") * 3) % 160)
    listed = F.array(own, F.lit(""), other, own)
    items = F.transform(listed, lambda x: F.struct(x.alias("address")))
    shape = F.col("event_id") % 3
    body = F.when(shape == 0, F.to_json(F.struct(listed.alias("addresses")))).when(shape == 1, F.to_json(F.struct(items.alias("items")))).otherwise(F.to_json(F.struct(items.alias("data"))))
    return e.select(F.concat(F.lit("e"), F.col("user_id") % 7).alias("entity_id"), F.col("event_id").alias("observation_id"), body.alias("payload"))


@query("""with r as (select 'e' || user_id % 7 as entity_id, event_id as observation_id, ['acct:' || user_id, '', 'acct:' || (user_id * 3) % 160, 'acct:' || user_id] as l from events),
    x as (select entity_id, observation_id, unnest(l) as address, generate_subscripts(l, 1) as p from r)
    select entity_id, observation_id, address, min(p)::int as prediction_rank from x where address <> '' group by all""")
def ranked_predictions(s, d):
    return O.predictions(_responses(s, d))


@query("""with e as (select 'acct:' || user_id as address, sha256(props) as sha, ts, event_id as i, event_type as t from events),
    rows_ as (select address, 'entity_control' as assertion_type, 'id:' || t as candidate_entity_id, 'Name ' || t as candidate_entity_name, null::varchar as candidate_label, null::varchar as provider_tag_id, sha, ts from e where i % 2 = 0
        union all select address, 'address_label', null, null, 'Label ' || t, null, sha, ts from e where i % 3 = 0
        union all select address, 'address_label', null, null, 'first', 'tag1', sha, ts from e union all select address, 'address_label', null, null, 'second', 'tag2', sha, ts from e where i % 5 = 0)
    select address, assertion_type, candidate_entity_id, candidate_entity_name, candidate_label, provider_tag_id, 'commercial_provider' as source_authority, 'C' as evidence_tier, sha as artifact_sha256, ts as observed_at from rows_""")
def payload_evidence(s, d):
    e, t, i = J.table(s, d, "events"), F.col("event_type"), F.col("event_id")
    entity = F.when(i % 2 == 0, F.struct(F.concat(F.lit("id:"), t).alias("id"), F.concat(F.lit("Name "), t).alias("name")))
    tag = lambda k, n: F.struct(F.lit(k).alias("id"), F.lit(n).alias("name"))
    tags = F.when(i % 5 == 0, F.array(tag("tag1", "first"), tag("tag2", "second"), tag(None, "none"))).otherwise(F.array(tag("tag1", "first")))
    body = F.to_json(F.struct(entity.alias("entity"), F.when(i % 3 == 0, F.concat(F.lit("Label "), t)).alias("label"), tags.alias("tags")))
    rows = e.select(
        F.concat(F.lit("acct:"), F.col("user_id")).alias("address"),
        F.sha2(F.col("props").cast("binary"), 256).alias("payload_sha256"), F.col("ts").alias("completed_at"),
        body.alias("payload")
    )
    return O.payload_evidence(rows)


@query("""select 'e' || event_id // 7 as entity_id, count(*) as attempt_count from events where event_type in ('error', 'purchase') group by 1 having count(*) >= 3 and count(*) filter (event_type <> 'error') = 0""")
def retry_exhausted(s, d):
    status = F.when(F.col("event_type") == "error", 502).when(F.col("event_id") % 2 == 0, 200)
    rows = J.table(s, d, "events").where("event_type in ('error', 'purchase')")
    return V.retry_exhausted(rows.select(F.concat(F.lit("e"), F.expr("event_id div 7")).alias("entity_id"), status.alias("http_status")))


@query(f"with {RESOLVE} select address, assertion_type, identity_state, operational_tier from resolved where address = 'acct:7' and assertion_type = 'entity_control'")
def resolution_lookup(s, d):
    return S.show(C._resolutions(s, d), "acct:7", "entity_control").select("address", "assertion_type", "identity_state", "operational_tier")


@query("""select case when event_id % 2 = 0 then 'select' else 'reject' end as decision, count(*) * 2 as row_count from events where event_id % 37 = 0 group by 1""")
def recorded_decisions(s, d):
    log = D.overrides(s, d)
    return S.recorded(log, log, ("select", "reject")).groupBy("decision").agg(F.count("*").alias("row_count"))


@query("""select event_id as override_id, array_to_string(list_filter([case when event_id % 2 = 1 then 'unknown_decision' end, case when event_id % 3 = 0 then 'no_reviewer' end], lambda x: x is not null), ',') as codes
    from events where event_id % 37 = 0 and (event_id % 2 = 1 or event_id % 3 = 0)""")
def decision_errors(s, d):
    """Where rejection isn't allowed, and every third row lacks a reviewer."""
    entry = D.overrides(s, d).withColumn("reviewer_ref", F.when(F.col("override_id") % 3 == 0, F.lit(" ")).otherwise(F.col("reviewer_ref")))
    return S.decision_errors(entry, ("select",)).select("override_id", F.array_join("codes", ",").alias("codes"))


@query("""select event_id as override_id, lag(event_id) over (partition by user_id order by ts, event_id) as supersedes from events where event_id % 37 = 0""")
def superseded_overrides(s, d):
    rows = K.previous(D.overrides(s, d), ["address", "assertion_type"], "override_id", F.asc("reviewed_at"), F.asc("override_id"))
    return rows.select("override_id", "supersedes")


_SAME = "address, assertion_type, entity_id, name, label, role, tag, authority, tier, grp, observed_at"


@query(f"with {EV} select authority as source_authority, count(*) as row_count from (select distinct {_SAME} from ev) group by 1")
def appended_evidence(s, d):
    """All evidence appended to an empty ledger, then again: nothing comes twice."""
    rows, path = I.fingerprinted(D.evidence(s, d)), path_for(s, "ledger")
    Z.appended(rows, path, s)
    Z.appended(rows, path, s)
    return s.read.parquet(path).groupBy("source_authority").agg(F.count("*").alias("row_count"))


@query("""select count(*) as row_count, count(distinct json_structure(props)) as shape_count, count(*) as digest_count, count(*) filter (event_id % 3 <> 0) as time_count from events""")
def text_functions(s, d):
    e = J.table(s, d, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zoned = F.when(F.col("event_id") % 3 == 0, stamp).when(F.col("event_id") % 3 == 1, F.concat(stamp, F.lit("Z"))).otherwise(F.concat(stamp, F.lit("+02:00")))
    return e.agg(
        F.count("*").alias("row_count"), F.count_distinct(json_shape(F.col("props"))).alias("shape_count"),
        F.count_if(is_sha256(F.sha2(F.col("props").cast("binary"), 256)) & ~is_sha256(F.col("props"))).alias("digest_count"),
        F.count(parsed_utc(zoned)).alias("time_count"),
    )


@query("""select n_nationkey::int as node, n_nationkey % 4 <> 1 and n_nationkey % 5 <> 2 and n_nationkey % 3 <> 0 as usable,
    array_to_string(list_filter([case when n_nationkey % 4 = 1 then 'behind_headers' end, case when n_nationkey % 5 = 2 then 'not_final' end, case when n_nationkey % 3 = 0 then 'pruned' end], lambda x: x is not null), ',') as reasons from nation""")
def node_reasons(s, d):
    """Recorded answers of as many nodes as there are nations."""
    k, path = F.col("n_nationkey"), path_for(s, "node")
    info = F.struct(
        F.lit("main").alias("chain"), F.lit(900).alias("blocks"), F.when(k % 4 == 1, 901).otherwise(900).alias("headers"),
        F.lit("x").alias("bestblockhash"), F.lit(False).alias("initialblockdownload"),
        F.lit(1.0).alias("verificationprogress"), (k % 3 == 0).alias("pruned"),
    )
    head = F.struct(F.lit(800).alias("height"), k.cast("bigint").alias("time"), F.when(k % 5 == 2, 5).otherwise(6).alias("confirmations"))
    index = F.struct(F.struct(F.lit(True).alias("synced"), F.lit(900).alias("best_block_height")).alias("txindex"))
    row = F.struct(
        info.alias("blockchain_info"), F.sha2(k.cast("string").cast("binary"), 256).alias("finalized_hash"),
        head.alias("finalized_header"), index.alias("indexes")
    )
    J.table(s, d, "nation").select(F.to_json(row)).write.text(path)
    return H.node_reasons(H.recorded_node(s, path)).select(
        F.col("finalized_header.time").cast("int").alias("node"), "usable", F.array_join("reasons", ",").alias("reasons")
    )


@query("select count(*) as row_count, min(ts) as oldest, max(ts) as newest, date_sub('hour', max(ts), timestamp '2024-06-01')::bigint as age_hours, 'stale' as reasons from events")
def freshness(s, d):
    return H.freshness(J.table(s, d, "events"), "ts", "2024-06-01 00:00:00", 24).withColumn("reasons", F.array_join("reasons", ","))


@query("select o_orderstatus, count(*) as order_count from orders where o_orderdate < timestamp '1997-01-01' group by 1")
def query_template(s, d):
    J.table(s, d, "orders").createOrReplaceTempView("template_orders")
    text = "select o_orderstatus, count(*) as order_count from identifier(:source) where o_orderdate < cast(:until as timestamp) group by 1"
    return H.query_template(s, text, {"source": "template_orders"}, until="1997-01-01 00:00:00")


@query("select n_regionkey, n_name from nation")
def exported_table(s, d):
    J.table(s, d, "nation").createOrReplaceTempView("export_nation")
    return H.exported(s, "export_nation").select("n_regionkey", "n_name")


@query(f"with {EV} select tier as evidence_tier, count(*) as row_count from ev group by 1")
def frozen_evidence(s, d):
    """Evidence read from files that are the same before and after."""
    path = path_for(s, "evidence")
    D.evidence(s, d).write.parquet(path)
    return H.frozen_read(s, path, s.read.parquet).groupBy("evidence_tier").agg(F.count("*").alias("row_count"))


@query("select event_type as profile, count(*) as row_count, count(*) filter (event_id % 2 = 0) as ok_count from events group by 1")
def recorded_responses(s, d):
    """Recorded answers of a service, written and read as JSON lines."""
    path = path_for(s, "recorded")
    e = J.table(s, d, "events")
    e.select(
        F.col("event_type").alias("profile"), F.col("user_id").cast("string").alias("subject"),
        F.when(F.col("event_id") % 2 == 0, 200).otherwise(502).alias("http_status"), F.col("ts").alias("observed_at"),
        F.col("props").alias("body")
    ).write.json(path)
    return R.recorded_responses(s, path).groupBy("profile").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("http_status") == 200).alias("ok_count")
    )


@query("select 'done' as status, count(*) as row_count from orders")
def one_shot_run(s, d):
    """A run by receipt; its second start is refused."""
    run = Z.RunReceipt(s, f"{path_for(s, 'run')}.json")
    Z.once(run, {"query": "orders"}, lambda: {"rows": J.table(s, d, "orders").count()})
    try:
        run.start({})
    except FileExistsError:
        now = run.status()
        return s.createDataFrame([(now["status"], now["rows"])], "status string, row_count bigint")
    raise AssertionError("started twice")




_WALLETS = "'w' || n_nationkey"


@query(f"select n_nationkey::bigint as page_id, '2024-01-0' || (n_nationkey % 9 + 1) as updated_at, {_WALLETS} as address from nation where n_nationkey % 3 <> 1 union all select n_nationkey, '2024-01-0' || (n_nationkey % 9 + 1), 'shared' from nation where n_nationkey % 3 <> 1")
def embedded_wallets(s, d):
    """Pages that embed their data: active wallets at some depth; every third page has two such objects, which is refused."""
    k = F.col("n_nationkey")
    own = F.concat(F.lit("w"), k)
    wallet = lambda a, on: F.struct(a.alias("address"), F.lit(on).alias("active"))
    inner = F.struct(
        F.concat(F.lit("2024-01-0"), k % 9 + 1).alias("updatedAt"),
        F.array(wallet(own, True), wallet(F.lit("off"), False), wallet(F.lit("shared"), True)).alias("walletBalances")
    )
    data = F.to_json(F.struct(F.struct(F.array(inner).alias("list")).alias("props"), F.when(k % 3 == 1, inner).alias("again")))
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script></html>"))
    return R.wallets(J.table(s, d, "nation").select(k.cast("bigint").alias("page_id"), html.alias("html")))


@query("select sha256('region ' || r_name) as payload_sha256, length('region ' || r_name)::int as byte_count from region")
def stored_payloads(s, d):
    """Payloads stored by digest, some twice, and read back by a ledger; one whose digest differs is left out."""
    root, rows = path_for(s, "payloads"), [f"region {r.r_name}".encode() for r in J.table(s, d, "region").collect()]
    ledger = [Z.stored_payload(s, root, x) for x in [*rows, rows[0]]][: len(rows)]
    names = [(x["payload_name"], x["payload_sha256"]) for x in ledger] + [(ledger[0]["payload_name"], "0" * 64)]
    found = R.payloads(s, root, s.createDataFrame(names, "payload_name string, payload_sha256 string"))
    return found.select("payload_sha256", F.octet_length("payload").alias("byte_count"))


@query("""with u as (select coalesce(sum(length(props)) filter (ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-20'), 0)::bigint as used_bytes from events)
    select used_bytes, 9000000000 - used_bytes as left_bytes, 9000000000 - used_bytes >= 1000 as admitted from u""")
def monthly_budget(s, d):
    runs = J.table(s, d, "events").select(F.col("ts").alias("run_at"), F.length("props").cast("bigint").alias("byte_count"))
    return H.monthly_budget(runs, "2024-01-20 00:00:00", 10_000_000_000, 1_000_000_000, 1_000)


@query(f"with {CAND} select normalized_address from cand where candidate_tier = 'p0'")
def repeated_addresses(s, d):
    """What publication refuses: here the first tier comes twice."""
    from ..operators.candidates import duplicates

    rows = C._candidates(s, d)
    return duplicates(rows.union(rows.where("candidate_tier = 'p0'"))).select("normalized_address").distinct()


_SUBJECTS = "subjects as (select 'acct:' || c_custkey as address, 'sub' || c_custkey as subject_id, 'bitcoin' as chain_key from customer)"


def _subjects(s: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return J.table(s, d, "customer").select(
        F.concat(F.lit("acct:"), key).alias("address"), F.concat(F.lit("sub"), key).alias("subject_id"),
        F.lit("bitcoin").alias("chain_key")
    )


@query(f"with due as ({ORACLE_SQL['due_addresses']}), {_SUBJECTS} select subject_id, chain_key, address, priority, source_kind from due join subjects using (address)")
def due_subjects(s, d):
    return V.with_subjects(C.QUERIES["due_addresses"](s, d), _subjects(s, d)).select("subject_id", "chain_key", "address", "priority", "source_kind")


@query(f"with work as ({ORACLE_SQL['work_queue']}), {_SUBJECTS} select subject_id, address, request_id, priority from work join subjects using (address)")
def work_subjects(s, d):
    return V.with_subjects(C.QUERIES["work_queue"](s, d), _subjects(s, d)).select("subject_id", "address", "request_id", "priority")


# Public examples of addresses, and a 2-of-3 script of three small keys with signatures of two of them and of another key.
_ADDRESSES = (
    "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "3J98t1WpEZ73CNmQviecrnyiWrnqRhWNLy", "BC1QW508D6QEJXTDG4Y5R3ZARVARY0C5XW7KV8F3T4",
    "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb", "tb1qw508d6qejxtdg4y5r3zarvary0c5xw7kxpjzsx"
)
_KINDS = ("p2pkh", "p2sh", "p2wpkh", None, None)
_MULTISIG = "3H1z4tjmjnnU6Zcq8jWX3sPdEYmbzDCPDD"
_SCRIPT = (
    "522102311091dd9860e8e20ee13473c1155f5f69635e394704eaa74009452246cfa9b321036c0d1f1784e47ff04108c1d9049df6b"
    "3658aa6490ef4ef1ac1e4dbfd90ac042721036ff180fcdaa3061808e8b306d6f0acff27968c22484ff45e56aeaa7b2b60732f53ae"
)
_MESSAGE = "I am an audited address"
_SIGNED = (
    "IOH+Q000W/Mwg6u2KA9PRKxfsik0l3gTwgwBXytD0/q4U8uJP3VS7tPKYx6fWBfA23TMTVmnWCjxYuPRTSXlO7E=",
    "IMjt9yW1nZ83CHCl3NXnCwuupJOluFyyJ8Hvao6M2tj7bdWmySlXD/cCZeOSgr3GcCXiLjU+EcfydAaxNrC+aVw=",
    "INgR2MQyO0NwJgfCWt6TbArC5KRLK6UfgyDFF550Wn4pvUcTy0+MjETgDRbXJcdRITqsxiw1DkNpu13tjzi1Dl4=",
)


def _case(values: tuple) -> str:
    return "case n_nationkey % 5 " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(values) if v) + " end"


@query(f"""with a as (select n_nationkey, {_case(_ADDRESSES)} as a, {_case(_KINDS)} as address_type from nation), n as (select *, case when address_type is not null then case when lower(a) like 'bc1%' then lower(a) else a end end as normalized_address from a)
    select n_nationkey::int as place, normalized_address, address_type, sha256('bitcoin:' || normalized_address) as address_id from n""")
def normalized_addresses(s, d):
    """Addresses of every kind, in mixed case, with a wrong checksum, and of another network."""
    texts = F.element_at(F.array(*map(F.lit, _ADDRESSES)), (F.col("n_nationkey") % 5 + 1).cast("int"))
    rows = J.table(s, d, "nation").select(F.col("n_nationkey").cast("int").alias("place"), normalize_address(texts).alias("a"))
    return rows.select("place", "a.normalized_address", "a.address_type", "a.address_id")


@query("select r_regionkey::int + 2 as row_number, r_regionkey % 3 = 0 as verified from region")
def verified_proofs(s, d):
    """An archive with a row for each region: two good signatures, one twice, or one of another key; rows of other coins are left out."""
    first, second, other = _SIGNED
    lines = ["coin,total"]
    for r in sorted(x.r_regionkey for x in J.table(s, d, "region").collect()):
        lines.append(f"BTC,x,y,{_MULTISIG},1,{_MESSAGE},{first},{(second, first, other)[r % 3]},{_SCRIPT}")
    lines.append(f"ETH,x,y,{_MULTISIG},1,{_MESSAGE},{first},{second},{_SCRIPT}")
    blob, path = io.BytesIO(), f"{path_for(s, 'proofs')}/proofs.zip"
    with zipfile.ZipFile(blob, "w") as z:
        z.writestr("rows.csv", "\n".join(lines))
    Store(s).write(path, blob.getvalue())
    rows = R.multisig_rows(R.zipped_rows(s, path), _MESSAGE)
    return rows.select(
        "row_number",
        verify_2of3_proof(*[F.col(c) for c in ("address", "message", "first_signature", "second_signature", "redeem_script_hex")]).alias("verified")
    )


@query("select count(*) filter (r_regionkey % 3 = 0) as proof_count, count(*) as issuer_count, timestamp '2024-02-01' as expires_at from region")
def issued_evidence(s, d):
    """Tier A evidence of the verified proofs, tier B of an issuer's list that expires."""
    proofs = R.proof_evidence(QUERIES["verified_proofs"](s, d), "id", "Issuer", D.AS_OF, "0" * 64)
    listed = J.table(s, d, "region").select(F.lit("2024-01-01").alias("updated_at"), F.col("r_name").alias("address"))
    issued = R.issuer_evidence(listed, "id", "Issuer", D.AS_OF, "0" * 64)
    tiers = proofs.select("evidence_tier", F.lit(None).cast("timestamp").alias("expires_at")).union(issued.select("evidence_tier", "expires_at"))
    return tiers.agg(
        F.count_if(F.col("evidence_tier") == "A").alias("proof_count"),
        F.count_if(F.col("evidence_tier") == "B").alias("issuer_count"), F.max("expires_at").alias("expires_at")
    )


def _stream(s: SparkSession, rows: DataFrame) -> DataFrame:
    path = path_for(s, "arrivals")
    rows.write.parquet(path)
    return s.readStream.schema(rows.schema).parquet(path)


@query("select distinct sha256((event_id // 3)::varchar) as evidence_fingerprint from events")
def streamed_evidence(s, d):
    """Evidence that arrives three times is taken once."""
    key = F.sha2(F.expr("event_id div 3").cast("string").cast("binary"), 256)
    rows = J.table(s, d, "events").select(key.alias("evidence_fingerprint"), F.col("ts").cast("timestamp").alias("observed_at"))
    return T.drained(T.new_evidence(_stream(s, rows), late="60 days"), "evidence").select("evidence_fingerprint")


@query("""select date_trunc('minute', ts) as minute, count(*) as requests, sum(case when event_id % 2 = 0 then event_id else 1000 end)::bigint as bytes from events
    group by 1 having date_trunc('minute', ts) + interval 1 minute <= (select max(ts) - interval 5 minute from events)""")
def streamed_minutes(s, d):
    """Requests and bytes of each minute that the watermark has closed."""
    rows = J.table(s, d, "events").select(
        F.col("ts").cast("timestamp").alias("reserved_at"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("actual_bytes"),
        F.lit(1000).cast("bigint").alias("estimated_bytes")
    )
    return T.drained(T.admission_counts(_stream(s, rows)), "minutes").select(
        F.col("window.start").cast("timestamp_ntz").alias("minute"), "requests", "bytes"
    )
