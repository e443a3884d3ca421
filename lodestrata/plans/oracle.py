"""The same queries for DuckDB, written from the definitions and not from the plans."""

from __future__ import annotations

B = 100_000_000
CUT = "timestamp '2001-08-01 00:00:00'"
AS_OF = "timestamp '2024-01-25 00:00:00'"

IO = f"""
tx as (
    select o_orderkey as k, o_custkey, o_totalprice, o_orderdate as ts, date_diff('day', date '1995-01-01', o_orderdate::date)::bigint as height from orders
), every_io as (
    select k, ts, height, 'output' as kind, l_linenumber as line,
           case l_linenumber when 7 then []::varchar[] when 6 then ['acct:' || l_partkey, 'acct:s' || l_suppkey] else ['acct:' || l_partkey] end as addresses,
           case when l_linenumber = 5 and l_returnflag = 'A' then null else round(l_extendedprice * 100)::bigint * pow(10, l_partkey % 7)::bigint end as v,
           case l_linenumber when 4 then null when 3 then '' else lower(hex('acct:' || l_partkey)) end as script, case l_returnflag when 'R' then 'nonstandard' else 'pubkeyhash' end as script_type
    from tx join lineitem on l_orderkey = k
    union all
    select k, ts, height, 'input', 0, ['acct:' || o_custkey], round(o_totalprice * 100)::bigint, null, 'pubkeyhash' from tx
), io as (
    select * from every_io where height <= 2404 and ts <= {CUT}
), one as (
    select *, addresses[1] as a from io where len(addresses) = 1
)"""

ECON = IO + f""", per_tx as (
    select a, k, max(ts) as ts, sum(case kind when 'output' then v else 0 end)::bigint as r, sum(case kind when 'input' then v else 0 end)::bigint as s, sum(v)::bigint as g
    from one where v is not null group by a, k
), flagged as (
    select *, ts >= {CUT} - interval 90 day as q, ts >= {CUT} - interval 365 day as y, r >= {500 * B} as big from per_tx
), econ as (
    select a as normalized_address, sum(r)::bigint as lifetime_received_sats, sum(s)::bigint as lifetime_spent_sats, (sum(r) - sum(s))::bigint as current_utxo_sats,
           coalesce(sum(g) filter (q), 0)::bigint as gross_flow_90d_sats, max(ts) as last_seen_time, max(r) as max_same_tx_received_lifetime_sats,
           coalesce(max(r) filter (q), 0) as max_same_tx_received_90d_sats, coalesce(max(r) filter (y), 0) as max_same_tx_received_365d_sats,
           count(*) filter (big) as same_tx_receive_ge_500_btc_lifetime_count, count(*) filter (big and q) as same_tx_receive_ge_500_btc_90d_count,
           count(*) filter (big and y) as same_tx_receive_ge_500_btc_365d_count, count(*) filter (q) as active_tx_90d_count, count(*) filter (y) as active_tx_365d_count,
           count(distinct ts::date) filter (q) as active_day_90d_count, count(distinct ts::date) filter (y) as active_day_365d_count,
           max(ts) filter (big) as last_same_tx_receive_ge_500_btc_time, bool_or(r > 0) as has_output, bool_or(s > 0) as has_input
    from flagged group by a
)"""

ECON1 = IO + f""", per_kind as (
    select a, k, kind, max(ts) as ts, sum(v)::bigint as v from one where v is not null group by a, k, kind
), econ1 as (
    select a as normalized_address, coalesce(sum(v) filter (kind = 'output'), 0)::bigint as lifetime_received_sats, coalesce(sum(v) filter (kind = 'input'), 0)::bigint as lifetime_spent_sats,
           sum(case kind when 'output' then v else -v end)::bigint as current_utxo_sats, coalesce(max(v) filter (kind = 'output'), 0) as max_same_tx_received_sats,
           coalesce(sum(v) filter (ts >= {CUT} - interval 90 day), 0)::bigint as gross_flow_90d_sats, max(ts) as last_seen_time,
           bool_or(kind = 'output') as has_output, bool_or(kind = 'input') as has_input
    from per_kind group by a
)"""

RECV = "recv as (select k, a, sum(v)::bigint as r from one where kind = 'output' and v is not null group by k, a)"
PEERS = f"""{RECV}, peers as (
    select x.a, count(distinct y.a) as n from recv x join recv y on x.k = y.k and x.a <> y.a and x.r >= {100 * B} and y.r >= {100 * B} group by x.a
)"""


def _flow(kind: str, days: int) -> str:
    return f"coalesce(sum(v) filter (kind = '{kind}' and ts >= {CUT} - interval {days} day), 0)::bigint"


FEATURES = IO + f""", {PEERS}, best as (select a, max(r) as r from recv group by a), feat as (
    select 'features_v1' as feature_version, sha256('bitcoin:' || a) as address_id, a as normalized_address, min(script_type) filter (kind = 'output') as address_type,
           min(height) as first_seen_height, max(height) as last_seen_height, min(ts) as first_seen_time, max(ts) as last_seen_time,
           count(*) filter (kind = 'output') as output_count, count(*) filter (kind = 'input') as spent_output_count, count(distinct k) as transaction_count,
           (coalesce(sum(v) filter (kind = 'output'), 0) - coalesce(sum(v) filter (kind = 'input'), 0))::bigint as current_utxo_sats,
           coalesce(sum(v) filter (kind = 'output'), 0)::bigint as lifetime_received_sats, coalesce(sum(v) filter (kind = 'input'), 0)::bigint as lifetime_spent_sats,
           max(v) filter (kind = 'output') as max_single_output_sats, max(best.r) as max_same_tx_received_sats,
           {_flow('output', 30)} as inflow_30d_sats, {_flow('input', 30)} as outflow_30d_sats, {_flow('output', 90)} as inflow_90d_sats, {_flow('input', 90)} as outflow_90d_sats,
           {_flow('output', 30)} + {_flow('input', 30)} as gross_flow_30d_sats, {_flow('output', 90)} + {_flow('input', 90)} as gross_flow_90d_sats,
           {_flow('output', 365)} + {_flow('input', 365)} as gross_flow_365d_sats, coalesce(max(peers.n), 0) as direct_large_counterparty_count
    from one left join best using (a) left join peers using (a) where v is not null group by a having count(*) filter (kind = 'output') > 0
)"""


def _days(since: str = "last_seen_time") -> str:
    return f"date_sub('day', {since}, {CUT})"


def _points(x: str, *steps: tuple[int, int], unit: int = B, op: str = ">=") -> str:
    return "case " + " ".join(f"when {x} {op} {a * unit} then {p}" for a, p in steps) + " else 0 end"


BAL = ((1000, 25), (100, 20), (10, 12), (1, 5))
RCP = ((5000, 25), (1000, 20), (500, 18), (100, 10))
TRN = ((10000, 20), (1000, 15), (100, 8), (10, 3))
REC = ((30, 10), (90, 7), (365, 3))

CHAIN1 = ECON1 + f""", chain0 as (
    select *, {_days()} as recency_days from econ1 where has_output
), chain1 as (
    select *, ({_points('current_utxo_sats', *BAL)} + {_points('max_same_tx_received_sats', *RCP)} + {_points('gross_flow_90d_sats', *TRN)} + {_points('recency_days', *REC, unit=1, op='<=')})::int as chain_importance_score,
           ((current_utxo_sats >= {100 * B})::int + 2 * (max_same_tx_received_sats >= {500 * B})::int + 4 * (gross_flow_90d_sats >= {1000 * B})::int
            + 8 * (lifetime_received_sats >= {10000 * B} and recency_days <= 365)::int)::int as p0_mask,
           current_utxo_sats >= {B} or max_same_tx_received_sats >= {100 * B} or gross_flow_90d_sats >= {10 * B} as has_positive_economic_component
    from chain0
), chain as (
    select *, p0_mask <> 0 as is_chain_p0, p0_mask = 0 and chain_importance_score >= 25 as is_chain_p1, p0_mask = 0 and chain_importance_score between 15 and 24 as is_edge_upgrade_frontier,
           p0_mask <> 0 or chain_importance_score >= 15 or has_positive_economic_component as is_coarse_candidate
    from chain1
)"""


def _kept(h: str) -> str:
    return f"(max_same_tx_received_{h}_sats >= {500 * B} and current_utxo_sats >= {10 * B} and current_utxo_sats * 100 >= max_same_tx_received_{h}_sats)"


VARIANT = ECON + f""", v0 as (
    select *, {_days()} as recency_days, greatest(gross_flow_90d_sats - max_same_tx_received_90d_sats, 0) as residual_gross_90d_sats, active_tx_90d_count >= 3 and active_day_90d_count >= 2 as lively,
           {_kept('90d')} as recent_receipt_retained, {_kept('365d')} as kept_year, {_kept('lifetime')} as retention_receipt_supported, same_tx_receive_ge_500_btc_90d_count >= 2 as recent_receipt_repeated
    from econ where has_output
), v1 as (
    select *, max_same_tx_received_90d_sats >= {500 * B} and lively and residual_gross_90d_sats >= {500 * B} as recent_receipt_sustained_activity from v0
), v2 as (
    select *, max_same_tx_received_90d_sats >= {500 * B} and (recent_receipt_retained or recent_receipt_repeated or recent_receipt_sustained_activity) as strict_receipt_supported,
           current_utxo_sats >= {100 * B} as p0_utxo, residual_gross_90d_sats >= {1000 * B} and lively as p0_sustained_residual_gross,
           lifetime_received_sats >= {10000 * B} and recency_days <= 90 and (current_utxo_sats >= {10 * B} or (residual_gross_90d_sats >= {500 * B} and lively)) as p0_lifetime_active_supported,
           ({_points('current_utxo_sats', *BAL)} + {_points('residual_gross_90d_sats', *TRN)} + {_points('recency_days', *REC, unit=1, op='<=')}
            + case when max_same_tx_received_90d_sats >= {500 * B} then 10 when max_same_tx_received_365d_sats >= {500 * B} then 5 else 0 end
            + case when recent_receipt_repeated then 12 when same_tx_receive_ge_500_btc_365d_count >= 2 then 7 else 0 end
            + case when recent_receipt_retained then 10 else 0 end + case when recent_receipt_sustained_activity then 8 else 0 end)::int as v2_chain_score,
           (recent_receipt_retained::int + 2 * recent_receipt_repeated::int + 4 * recent_receipt_sustained_activity::int)::int as receipt_support_mask
    from v1
), v3 as (
    select *, strict_receipt_supported or (max_same_tx_received_365d_sats >= {500 * B} and (kept_year or (same_tx_receive_ge_500_btc_365d_count >= 2 and active_day_365d_count >= 2))) as balanced_receipt_supported,
           v2_chain_score >= 15 or current_utxo_sats >= {B} or residual_gross_90d_sats >= {10 * B} or max_same_tx_received_365d_sats >= {500 * B} as wide
    from v2
), v4 as (
    select *, {", ".join(f"(p0_utxo::int + 2 * p0_sustained_residual_gross::int + 4 * {v}_receipt_supported::int + 8 * p0_lifetime_active_supported::int)::int as {v}_p0_mask" for v in ("strict", "balanced", "retention"))}
    from v3
), variants as (
    select *, {", ".join(f"{v}_p0_mask <> 0 as {v}_is_p0, {v}_p0_mask = 0 and v2_chain_score >= 25 as {v}_is_p1, {v}_p0_mask = 0 and v2_chain_score between 15 and 24 as {v}_is_edge, {v}_p0_mask <> 0 or wide as {v}_is_coarse" for v in ("strict", "balanced", "retention"))}
    from v4
)"""

_D = "current_utxo_sats lifetime_received_sats residual_gross_90d_sats max_same_tx_received_lifetime_sats max_same_tx_received_365d_sats max_same_tx_received_90d_sats".split()
_N = "same_tx_receive_ge_500_btc_90d_count same_tx_receive_ge_500_btc_365d_count active_tx_90d_count active_day_90d_count active_tx_365d_count active_day_365d_count".split()
CAND = VARIANT + f""", tiered as (
    select normalized_address, (case when strict_is_p0 then 0 when strict_is_p1 then 1 when strict_is_edge then 2 else 3 end)::bigint as tier_rank,
           ('0x' || substr(sha256(normalized_address), 1, 8))::bigint % 64 as address_bucket, v2_chain_score::bigint as v2_chain_score, strict_p0_mask::bigint as strict_p0_mask,
           receipt_support_mask::bigint as receipt_support_mask, {", ".join(f"{x}::decimal(38, 0) as {x}" for x in _D)}, {", ".join(_N)}, last_seen_time
    from variants where strict_is_coarse
), named as (
    select *, ['p0', 'p1', 'edge', 'coarse_other'][tier_rank::int + 1] as candidate_tier from tiered
), cand as (
    select *, sha256(concat_ws(chr(31), 'btc_strict_v2_s_candidate_row_v1', normalized_address, candidate_tier, tier_rank, address_bucket, v2_chain_score, strict_p0_mask, receipt_support_mask,
                     {", ".join(_D + _N)}, strftime(last_seen_time, '%Y-%m-%dT%H:%M:%S.%fZ'))) as candidate_row_sha256
    from named
)"""

EV = f"""
e as (select *, 'acct:' || user_id as address, floor(value)::bigint as f from events),
ev as (
    select 'ev' || lpad(event_id::varchar, 9, '0') as evidence_id, address, case event_type when 'view' then 'address_label' when 'signup' then 'wallet_role' else 'entity_control' end as assertion_type,
           case when event_type not in ('view', 'signup') then 'id:' || f % 4 end as entity_id,
           case when event_type in ('click', 'error') then ' Entity ' || f % 4 when event_type = 'purchase' then 'entity ' || f % 3 end as name,
           case event_type when 'view' then 'Label ' || f % 2 end as label, case event_type when 'signup' then 'role' || f % 2 end as role,
           case when event_type = 'view' and event_id % 2 = 0 then 'tag' end as tag,
           case event_type when 'click' then 'commercial_provider' when 'view' then 'commercial_provider' when 'purchase' then 'official' when 'signup' then 'local_inference' else 'public_explorer' end as authority,
           case event_type when 'click' then 'C' when 'view' then 'C' when 'purchase' then case when event_id % 2 = 0 then 'A' else 'B' end when 'signup' then 'D' else 'E' end as tier,
           event_id % 4 = 0 as proven, event_type as grp, ts as observed_at, case when event_id % 9 = 0 then ts + interval 2 day end as effective_from,
           case when event_id % 7 = 0 then ts + interval 5 day end as effective_to, case when event_id % 5 = 0 then ts + interval 3 day end as expires_at, event_id % 11 <> 0 as ok
    from e
), req as (
    select address, case when event_id % 6 = 0 then 'known_watchlist' else 'research' end as reason, (event_id % 101)::int as priority, ts, event_id,
           case when event_id % 3 = 0 then 'panel:' else 'seed:' end || event_type as ref
    from e where event_id % 3 = 0
), conf as (
    select address, case when event_id % 69 = 0 then 'resolved' else 'active' end as status, ts, case when event_id % 46 = 0 then ts + interval 1 day end as ended from e where event_id % 23 = 0
), pred as (
    select address, 'e' || f % 7 as entity_id, ts from e where event_type = 'view' and event_id % 3 = 0
), parse as (
    select address, case when event_id % 20 = 1 then 'parsed_success' else 'failed' end as outcome, ts from e where event_id % 10 = 1
), obs as (
    select address, event_id, case when event_id % 8 = 0 then 'detail' else 'discovery' end as profile, case when event_id % 14 = 0 then 'http_error' else 'success' end as outcome, sha256(props) as payload, ts
    from e where event_id % 2 = 0
), held as (
    select *, ok and coalesce(effective_from <= {AS_OF}, true) and coalesce(effective_to >= {AS_OF}, true) and coalesce(expires_at >= {AS_OF}, true) as active from ev where observed_at <= {AS_OF}
), anchors as (
    select address, 'official_or_signed_evidence' as reason_code from held where active and (tier = 'B' or (tier = 'A' and proven))
    union select address, 'existing_provider_conflict' from conf where status = 'active' and ts <= {AS_OF} and (ended is null or ended > {AS_OF})
    union select address, 'provider_entity_prediction' from pred where ts <= {AS_OF}
    union select address, 'existing_system_watchlist' from req where reason = 'known_watchlist' and ts <= {AS_OF}
)"""

_CODES = (
    ("current_utxo_sats", BAL, "balance_ge_{}_btc"), ("max_same_tx_received_sats", RCP, "max_same_tx_receipt_ge_{}_btc"), ("gross_flow_90d_sats", TRN, "gross_90d_ge_{}_btc_score"),
)


def _code(x: str, steps: tuple, name: str) -> str:
    return "case " + " ".join(f"when {x} >= {a * B} then '{name.format(a)}'" for a, _ in steps) + " end"


DECIDE = FEATURES + ", " + EV + f""", why as (select address as normalized_address, list_sort(list(distinct reason_code)) as cal from anchors group by 1), d0 as (
    select feat.*, coalesce(cal, []::varchar[]) as cal, {_days()} as days from feat left join why using (normalized_address)
), d1 as (
    select *, ({_points('current_utxo_sats', *BAL)} + {_points('max_same_tx_received_sats', *RCP)} + {_points('gross_flow_90d_sats', *TRN)} + {_points('days', *REC, unit=1, op='<=')}
               + case when direct_large_counterparty_count > 0 then 10 else 0 end + case when list_contains(cal, 'provider_entity_prediction') then 15 else 0 end
               + case when list_contains(cal, 'existing_system_watchlist') then 10 else 0 end)::int as importance_score,
           list_sort(list_filter([{", ".join(_code(*x) for x in _CODES)}, case when days <= 30 then 'recency_le_30d' when days <= 90 then 'recency_le_90d' when days <= 365 then 'recency_le_365d' end,
               case when direct_large_counterparty_count > 0 then 'direct_large_selected_edge' end, case when list_contains(cal, 'provider_entity_prediction') then 'provider_entity_prediction' end,
               case when list_contains(cal, 'existing_system_watchlist') then 'existing_system_watchlist' end], lambda x: x is not null)) as parts,
           list_sort(list_filter([case when list_contains(cal, 'official_or_signed_evidence') then 'official_or_signed_evidence' end, case when list_contains(cal, 'existing_provider_conflict') then 'existing_provider_conflict' end,
               case when current_utxo_sats >= {100 * B} then 'utxo_ge_100_btc' end, case when max_same_tx_received_sats >= {500 * B} then 'same_tx_receive_ge_500_btc' end,
               case when gross_flow_90d_sats >= {1000 * B} then 'gross_90d_ge_1000_btc' end, case when lifetime_received_sats >= {10000 * B} and days <= 365 then 'lifetime_ge_10000_active_365d' end], lambda x: x is not null)) as p0,
           substr(sha256('synthetic-ledger:' || address_id), 1, 16) < '051eb851eb851eb8' as sampled
    from d0
), d2 as (
    select *, case when len(p0) > 0 then 'P0' when importance_score >= 25 then 'P1' when sampled then 'CONTROL' else 'NONE' end as priority_class from d1
), decided as (
    select *, case priority_class when 'P0' then p0 when 'P1' then parts when 'CONTROL' then ['deterministic_low_score_control'] else []::varchar[] end as reasons,
           list_sort(list_filter([case when len(cal) > 0 then 'calibration' end, case when current_utxo_sats >= {B} then 'current_capital' end, case when current_utxo_sats >= {B} and days > 365 then 'dormant_holder' end,
               case when direct_large_counterparty_count > 0 then 'high_value_connector' end, case when gross_flow_90d_sats >= {10 * B} then 'high_turnover' end,
               case when max_same_tx_received_sats >= {100 * B} then 'historical_large_receipt' end, case when priority_class = 'CONTROL' then 'control' end], lambda x: x is not null)) as cohorts
    from d2
)"""

COVER = CAND + ", " + EV + """, cover as (
    select normalized_address, candidate_tier, candidate_row_sha256, coalesce(m.ids, []::varchar[]) as ids, normalized_address in (select address from parse where outcome = 'parsed_success') as direct_enriched, m.ids is not null as entity_membership_covered,
           normalized_address in (select address from ev where tier in ('A', 'B')) as local_evidence_covered, normalized_address in (select address from conf where status = 'active') as active_conflict,
           normalized_address in (select address from req where reason = 'known_watchlist' and priority > 90) as explicit_direct_requirement
    from cand left join (select address, list_sort(list(distinct entity_id)) as ids from pred group by address) m on m.address = normalized_address
), covered as (
    select *, case when direct_enriched then 'direct_enriched' when active_conflict or explicit_direct_requirement then 'needs_direct_enrichment' when entity_membership_covered then 'entity_membership_covered'
                   when local_evidence_covered then 'local_evidence_covered' else 'needs_direct_enrichment' end as coverage_state,
           case when direct_enriched then 'direct_provider_response'
                when active_conflict or explicit_direct_requirement then concat_ws(',', case when active_conflict then 'active_identity_conflict' end, case when explicit_direct_requirement then 'explicit_address_level_requirement' end)
                when entity_membership_covered then 'provider_entity_prediction' when local_evidence_covered then 'valid_local_entity_evidence' else 'no_explicit_entity_membership' end as reason
    from cover
), need as (
    select c.*, v.active_conflict, v.explicit_direct_requirement from cand c join covered v using (normalized_address, candidate_tier, candidate_row_sha256) where coverage_state = 'needs_direct_enrichment'
)"""

RESOLVE = EV + f""", usable as (
    select *, lower(trim(case assertion_type when 'entity_control' then coalesce(name, entity_id) when 'wallet_role' then role else label end)) as value,
           case authority when 'local_inference' then 0 when 'official' then 1 when 'regulator' then 1 when 'commercial_provider' then 2 when 'public_explorer' then 3 else 9 end as pref
    from held where active and not (assertion_type = 'address_label' and authority = 'commercial_provider' and tag is not null)
), said as (
    select 'acct:' || user_id as address, 'entity_control' as assertion_type, 'entity ' || floor(value)::bigint % 4 as value, ts, event_id from events where ts <= {AS_OF}
), rev as (
    select address, assertion_type, value, arg_max(case when event_id % 2 = 0 then 'accept' else 'reject' end, (ts, event_id)) as review, max(ts) as reviewed_at from said where event_id % 5 = 0 group by all
), ovr as (
    select address, assertion_type, value, arg_max(case when event_id % 2 = 0 then 'select' else 'reject' end, (ts, event_id)) as override_decision from said where event_id % 37 = 0 group by all
), grouped as (
    select address, assertion_type, value, min(tier) as evidence_strength, count(*) as corroboration_count, count(distinct grp) as independence_count, min(effective_from) as effective_from, max(effective_to) as effective_to,
           bool_or(tier in ('A', 'B')) as strong, bool_and(authority = 'commercial_provider' and tier = 'C') as commercial,
           arg_min(name, (pref, tier, observed_at, evidence_id)) filter (name is not null) as best_name, arg_min(entity_id, (pref, tier, observed_at, evidence_id)) filter (entity_id is not null) as best_id
    from usable group by all
), claim as (
    select g.*, reviewed_at, override_decision, case when override_decision = 'reject' then 'rejected' when review = 'accept' and strong then 'accepted' when review = 'reject' then 'rejected' else 'unreviewed_external' end as claim_status,
           case assertion_type when 'entity_control' then best_id end as entity, case assertion_type when 'entity_control' then best_name end as display, assertion_type = 'entity_control' and commercial as provider_default
    from grouped g left join rev using (address, assertion_type, value) left join ovr using (address, assertion_type, value)
), per as (
    select address, assertion_type, count(*) filter (claim_status <> 'rejected') as active_claims, count(*) filter (claim_status <> 'rejected' and override_decision = 'select') as selected_claims,
           min(value) filter (claim_status <> 'rejected') as only_value, min(value) filter (claim_status <> 'rejected' and override_decision = 'select') as selected_value, count(*) as n
    from claim group by all
), branch as (
    select k.*, coalesce(active_claims, 0) as active_claims, coalesce(selected_claims, 0) as selected_claims, coalesce(n, 0) as n, o.address is not null as overridden,
           case when coalesce(selected_claims, 0) = 1 then selected_value when active_claims = 1 then only_value end as value
    from (select address, assertion_type, bool_or(not active) as stale from held group by all) k left join per using (address, assertion_type)
         left join (select distinct address, assertion_type from ovr) o using (address, assertion_type)
), resolved as (
    select b.*, c.display, case when active_claims = 0 then case when stale then 'stale' else 'unattributed' end when selected_claims <> 1 and active_claims > 1 then 'ambiguous' else 'resolved' end as identity_state,
           case when active_claims = 0 then 'none' when selected_claims = 1 then 'lookup_usable' when active_claims > 1 then 'lookup_only' when claim_status = 'accepted' or provider_default then 'lookup_usable' else 'discovery_only' end as operational_tier,
           case when active_claims = 0 then case when overridden then 'local_override' else 'unattributed' end when selected_claims = 1 then 'local_override' when active_claims > 1 then 'conflict_first'
                when claim_status = 'accepted' then 'reviewed_evidence' when provider_default then 'provider_default' else 'unreviewed_evidence' end as resolution_policy,
           case when active_claims = 0 then case when stale then 'stale' when overridden then 'locally_rejected' else 'unknown' end when selected_claims <> 1 and active_claims > 1 then 'conflicted' else 'fresh' end as freshness_status
    from branch b left join claim c using (address, assertion_type, value)
)"""

REPLAY = RESOLVE + """, ids as (
    select address, case operational_tier when 'lookup_usable' then display end as display, resolution_policy as policy from resolved where assertion_type = 'entity_control'
), alert as (
    select event_id, case when event_id % 5 >= 1 then event_id % 5 else 1 end as w, case when event_id % 3 = 0 then address end as watched, case when event_id % 17 <> 0 then address end as outp,
           case when event_id % 2 = 0 then 'acct:' || (user_id * 3) % 160 end as inp, event_type in ('click', 'purchase', 'view') as inside,
           list_slice(['acct:' || (user_id * 3) % 160, 'acct:' || (user_id * 3) % 160, 'acct:' || (user_id * 7) % 160], 1, (event_id % 4)::int) as inputs, event_id % 19 = 0 as lacking,
           event_id % 2 = 0 and f >= 85 and event_id % 90 < 60 as odd
    from e
), seen as (
    select alert.*, ids.address is not null as found, coalesce(policy, 'legacy_conservative') as policy from alert left join ids on ids.address = coalesce(watched, outp, inp)
)"""

BOTH = REPLAY + """, sides as (
    select event_id, o.address is not null as out_found, o.policy as out_policy, lower(trim(o.display)) as out_name from alert left join ids o on o.address = outp
), ins as (
    select distinct event_id, unnest(inputs) as address from alert where outp is not null
), pairs as (
    select ins.event_id, ids.address is not null as found, ids.policy, lower(trim(ids.display)) as name, s.out_policy, coalesce(lower(trim(ids.display)) = s.out_name and s.out_name <> '', false) as same
    from ins left join ids using (address) join sides s using (event_id)
), per_event as (
    select event_id, count(*) filter (found) as found, bool_or(same) as same, bool_or(same and (policy = 'provider_default' or out_policy = 'provider_default')) as dflt,
           bool_or(same and policy in ('reviewed_evidence', 'local_override') and out_policy in ('reviewed_evidence', 'local_override')) as indep, bool_or(policy = 'conflict_first') as clash
    from pairs group by event_id
), flags as (
    select a.event_id, outp is not null as ok, inside, outp is not null and (len(inputs) = 0 or lacking) as incomplete, outp is not null and out_found as out_found, case when outp is not null then len(inputs) else 0 end as n,
           coalesce(p.found, 0) as found, coalesce(same, false) as same, coalesce(dflt, false) as dflt, coalesce(indep, false) as indep,
           outp is not null and (coalesce(out_policy = 'conflict_first', false) or coalesce(clash, false)) as clash, outp is not null and inside and odd as strong
    from alert a join sides using (event_id) left join per_event p using (event_id)
)"""

PANEL = EV + """, last_obs as (
    select address, arg_max(outcome, (ts, event_id)) as outcome, arg_max(payload, (ts, event_id)) as payload from obs group by address
), said as (
    select address, bool_or(assertion_type = 'address_label' and tag is null) filter (authority = 'commercial_provider') as lab, bool_or(assertion_type = 'address_label' and tag is not null) filter (authority = 'commercial_provider') as tg,
           list(distinct lower(trim(name))) filter (authority = 'commercial_provider' and tier = 'C' and assertion_type = 'entity_control' and name is not null) as prov,
           list(distinct lower(trim(name))) filter (authority = 'official' and tier in ('A', 'B') and assertion_type = 'entity_control' and name is not null) as offi
    from ev where ok group by address
), kept as (select distinct sha256(props) as payload from events where (props->>'$.k')::int % 2 = 0
), strata as (
    select address, min(ref) as ref, count(distinct ref) as refs from req where ref like 'panel:%' group by address
), panel as (
    select s.address, coalesce(outcome, 'not_fetched') as outcome, coalesce(len(prov), 0) > 0 as p, coalesce(len(offi), 0) > 0 as o, coalesce(lab, false) as lab, coalesce(tg, false) as tg, l.payload is not null as raw,
           kept.payload is not null as act, coalesce(len(list_intersect(prov, offi)), 0) > 0 as hit
    from strata s left join last_obs l using (address) left join said using (address) left join kept on kept.payload = l.payload
)"""


def _counters1() -> str:
    out = [f"count(*) filter ({x} >= {s * B}) as {n.format(s)}" for x, n, steps in (
        ("current_utxo_sats", "utxo_ge_{}_btc_count", (1, 10, 100, 1000)), ("max_same_tx_received_sats", "same_tx_receive_ge_{}_btc_count", (100, 500, 1000, 5000)),
        ("gross_flow_90d_sats", "gross_90d_ge_{}_btc_count", (10, 100, 1000, 10000))) for s in steps]
    out += [f"count(*) filter (recency_days <= {d}) as recency_le_{d}d_count" for d in (30, 90, 365)]
    out += [f"count(*) filter (p0_mask & {b} <> 0) as {n}" for b, n in ((8, "lifetime_ge_10000_active_365d_count"), (1, "p0_utxo_ge_100_btc_count"), (2, "p0_same_tx_receive_ge_500_btc_count"), (4, "p0_gross_90d_ge_1000_btc_count"), (8, "p0_lifetime_ge_10000_active_365d_count"))]
    out += [f"count(*) filter ({c}) as {n}" for c, n in (
        ("is_chain_p0", "chain_p0_union_count"), ("is_chain_p1", "chain_p1_count"), ("is_chain_p0 and is_chain_p1", "p0_p1_overlap_count"), ("is_edge_upgrade_frontier", "edge_upgrade_frontier_count"),
        ("has_positive_economic_component", "positive_economic_component_count"), ("is_coarse_candidate", "coarse_candidate_union_count"), ("not is_coarse_candidate", "excluded_source_address_count"),
        (f"current_utxo_sats >= {B}", "current_capital_count"), (f"max_same_tx_received_sats >= {100 * B}", "historical_large_receipt_count"), (f"gross_flow_90d_sats >= {10 * B}", "high_turnover_count"),
        (f"current_utxo_sats >= {B} and recency_days > 365", "dormant_holder_count"))]
    return ", ".join(out)


def _counters2() -> str:
    out = [f"count(*) filter ({x} >= {s * B}) as {n.format(s)}" for x, n, steps in (
        ("current_utxo_sats", "utxo_ge_{}_btc_count", (1, 10, 100, 1000)), ("gross_flow_90d_sats", "raw_gross_90d_ge_{}_btc_count", (10, 100, 1000, 10000)), ("residual_gross_90d_sats", "residual_gross_90d_ge_{}_btc_count", (10, 100, 1000, 10000)),
        ("max_same_tx_received_lifetime_sats", "lifetime_max_receipt_ge_{}_btc_count", (500, 1000, 5000)), ("max_same_tx_received_365d_sats", "max_receipt_365d_ge_{}_btc_count", (500, 1000, 5000)),
        ("max_same_tx_received_90d_sats", "max_receipt_90d_ge_{}_btc_count", (500, 1000, 5000))) for s in steps]
    out += [f"count(*) filter (recency_days <= {d}) as recency_le_{d}d_count" for d in (30, 90, 365)]
    out += [f"count(*) filter (same_tx_receive_ge_500_btc_{h}_count >= {k}) as receipt_count_{h}_ge_{k}_count" for h in ("lifetime", "365d", "90d") for k in (1, 2, 3)]
    flags = "recent_receipt_retained recent_receipt_repeated recent_receipt_sustained_activity p0_utxo p0_sustained_residual_gross p0_lifetime_active_supported".split()
    out += [f"count(*) filter ({x}) as {x}_count" for x in flags] + ["count(*) filter (strict_receipt_supported) as strict_supported_receipt_count"]
    out += ["count(*) filter (same_tx_receive_ge_500_btc_90d_count = 1 and not strict_receipt_supported) as unsupported_recent_singleton_count"]
    out += ["count(*) filter (same_tx_receive_ge_500_btc_lifetime_count = 1 and same_tx_receive_ge_500_btc_365d_count = 0) as stale_lifetime_singleton_count"]
    for v in ("strict", "balanced", "retention"):
        out += [f"count(*) filter ({c.format(v)}) as {v}_{n}" for c, n in (
            ("{}_receipt_supported", "p0_receipt_count"), ("{}_is_p0", "p0_union_count"), ("{}_p0_mask = 4", "incremental_receipt_p0_count"), ("{}_is_p1", "p1_count"), ("{0}_is_p0 and {0}_is_p1", "p0_p1_overlap_count"),
            ("{}_is_edge", "edge_count"), ("{}_is_coarse", "coarse_count"), ("not {}_is_coarse", "excluded_count"))]
    return ", ".join(out)


GROUPS = """, grouped as (
    select address_id, importance_score, greatest(current_utxo_sats, max_same_tx_received_sats, gross_flow_90d_sats, lifetime_received_sats) as largest_sats,
           unnest(list_filter(list_concat(cohorts, case when list_contains(cohorts, 'calibration') or list_contains(cohorts, 'control') then ['calibration_control'] else [] end), lambda x: x not in ('calibration', 'control'))) as quota_group
    from decided where priority_class in ('P1', 'CONTROL')
)"""
PLACE = "case " + " ".join(f"when list_contains(reasons, '{n}') then {i}" for i, n in enumerate("existing_provider_conflict official_or_signed_evidence utxo_ge_100_btc same_tx_receive_ge_500_btc gross_90d_ge_1000_btc lifetime_ge_10000_active_365d".split())) + " end"
METRIC = "case place when 2 then current_utxo_sats when 3 then max_same_tx_received_sats when 4 then gross_flow_90d_sats when 5 then lifetime_received_sats else 0 end"
_W = "sum(case when {} then w else 0 end)::bigint"
_PANEL = """count(*) filter (p) as entity_supported_count, count(*) filter (lab) as primary_address_label_supported_count, count(*) filter (tg) as tag_supported_count, count(*) filter (lab or tg) as address_label_or_tag_supported_count,
count(*) filter (not p and not lab and not tg) as fully_empty_attribution_count, 0::bigint as formal_wallet_role_supported_count, count(*) filter (raw) as raw_payload_referenced_count, count(*) filter (act) as raw_payload_active_count,
count(*) filter (o and p) as comparable_count, count(*) filter (o and p and hit) as entity_match_count, count(*) filter (o and p and not hit) as entity_conflict_count, count(*) filter (o and not p) as indeterminate_count"""
QUEUE_COLS = "normalized_address, candidate_tier, {} as cohort, v2_chain_score, current_utxo_sats, lifetime_received_sats, active_conflict, explicit_direct_requirement, candidate_row_sha256"
P01 = COVER + f""", q as (
    select row_number() over (order by candidate_tier, v2_chain_score desc, current_utxo_sats desc, lifetime_received_sats desc, normalized_address) as queue_rank, sha256('bitcoin:' || normalized_address) as address_id, {QUEUE_COLS.format('candidate_tier')}
    from need where candidate_tier in ('p0', 'p1')
)"""
_CLAIM_ID = """sha256('{"address":"' || address || '","asserted_value":"' || value || '","assertion_type":"' || assertion_type || '","status":"' || claim_status || '"}')"""
WEEK = "ts::date >= date '2001-07-18' and ts::date < date '2001-07-25'"

ORACLE_SQL = {
    "flatten_io": f"with {IO} select sha256('tx:' || k) as transaction_hash, kind as row_kind, height as block_number, len(addresses)::int as n_addresses, addresses[1] as first_address, v as value_sats from io",
    "cutoff_scan": f"with {IO} select count(*) as transactions, max(height) as height, max(ts) as time from tx where height <= 1200 and ts <= timestamp '1998-03-01'",
    "recent_outputs": f"with {IO} select height as block_number, count(*) as output_count from every_io where kind = 'output' and {WEEK} group by 1",
    "address_scale": f"with {IO} select count(distinct addresses[1]) as address_count from io where kind = 'output'",
    "address_economics_v2": f"with {ECON} select * from econ",
    "economics_v1": f"with {ECON1} select * from econ1",
    "received_by_transaction": f"with {IO}, {RECV} select sha256('block:' || height) as block_hash, sha256('tx:' || k) as transaction_hash, a as normalized_address, r as same_tx_received_sats from recv join tx using (k)",
    "large_counterparties": f"with {IO}, {PEERS} select a as normalized_address, n as direct_large_counterparty_count from peers",
    "address_features": f"with {FEATURES} select * from feat",
    "script_subjects": f"""with {IO}, firsts as (select coalesce(script, '') as script_hex, min({{'n': len(addresses), 'a': addresses[1], 't': script_type}}) as r from io where kind = 'output' group by 1)
        select sha256('bitcoin:mainnet'::blob || '\\x00'::blob || unhex(script_hex)) as script_id, script_hex, r.t as script_type, case when r.n = 1 then r.a end as normalized_address,
               case when r.n = 1 then sha256('bitcoin:' || r.a) end as address_id, r.n = 1 as provider_enrichable from firsts""",
    "source_accounting": f"""with {IO} select count(*) filter (kind = 'output') as total_output_rows, count(*) filter (kind = 'input') as total_input_rows, count(distinct coalesce(script, '')) filter (kind = 'output') as distinct_script_subjects,
        count(*) filter (kind = 'output' and len(addresses) = 1) as standard_single_address_rows, count(*) filter (kind = 'output' and len(addresses) = 0) as empty_address_rows, count(*) filter (kind = 'output' and len(addresses) > 1) as multi_address_rows,
        count(*) filter (kind = 'output' and script_type = 'nonstandard') as nonstandard_rows, count(*) filter (kind = 'output' and coalesce(script, '') = '') as missing_script_hex_rows, count(*) filter (kind = 'input' and v is null) as unmatched_input_rows from io""",
    "source_checkpoint": f"""with {IO}, b as (select height, max(ts) as ts, row_number() over (order by height desc) as r from tx where {WEEK} group by height)
        select max(height) filter (r = 1) as latest_height, max(sha256('block:' || height)) filter (r = 1) as latest_hash, max(ts) filter (r = 1) as latest_time, max(height) filter (r = 3) as finalized_height,
               max(sha256('block:' || height)) filter (r = 3) as finalized_hash, 0::bigint as taproot_address_count from b""",
    "source_quality": f"with {ECON} select count(*) filter (has_output) as source_standard_address_count, count(*) filter (has_input and not has_output) as source_input_only_address_count, count(*) filter (has_output and current_utxo_sats < 0) as negative_current_utxo_count, max(last_seen_time) filter (has_output) as max_observed_activity_time from econ",
    "quality_counts": f"with {IO} select count(*) filter (v is null) as null_value_count, 0::bigint as value_cast_failure_count from one",
    "policy_v1_chain": f"with {CHAIN1} select normalized_address, recency_days, chain_importance_score, p0_mask, is_chain_p0, is_chain_p1, is_edge_upgrade_frontier, has_positive_economic_component, is_coarse_candidate from chain",
    "importance_v1": f"with {DECIDE} select address_id, priority_class, importance_score, array_to_string(reasons, ',') as reasons, array_to_string(cohorts, ',') as cohorts from decided",
    "policy_v2_variants": f"with {VARIANT} select normalized_address, residual_gross_90d_sats, v2_chain_score, receipt_support_mask, {', '.join(f'{v}_{x}' for v in ('strict', 'balanced', 'retention') for x in ('p0_mask', 'is_p1', 'is_edge', 'is_coarse'))} from variants",
    "census_v1": f"with {CHAIN1} select {_counters1()} from chain",
    "census_v2": f"with {VARIANT} select {_counters2()} from variants",
    "overlap_histograms": f"with {VARIANT} " + " union all ".join(f"select '{m}' as metric, {x} as value, count(*) as address_count from variants group by {x}" for m, x in (("receipt_support", "receipt_support_mask"), ("score", "v2_chain_score"), ("strict_p0", "strict_p0_mask"), ("balanced_p0", "balanced_p0_mask"), ("retention_p0", "retention_p0_mask"))),
    "p0_overlap": f"with {CHAIN1}, m as (select p0_mask, count(*) as n from chain group by 1) select string_agg(p0_mask || ':' || n, ',' order by p0_mask) as distribution from m",
    "population_contract": f"with {ECON1}, {ECON.split(IO)[1].lstrip(', ')}, p as (select normalized_address from econ where has_output), o as (select normalized_address from econ1 where has_output), n as (select (select count(*) from o) as o, (select count(*) from p) as p, (select count(*) from p anti join o using (normalized_address)) as x) select o as output_defined_count, p as positive_value_count, x as outside_count, o - p + x as zero_value_only_count, case when x > 0 then 'blocked' else 'allow' end as outcome, case when x > 0 then 'not_contained' else '' end as blocked_codes from n",
    "candidates_v2_s": f"with {CAND} select * from cand",
    "candidate_violations": f"with {CAND} select normalized_address, true as digest_differs from cand where address_bucket = 3",
    "tier_bucket_counts": f"with {CAND} select candidate_tier, address_bucket, count(*) as row_count from cand group by all",
    "excluded_candidates": f"with {CAND} select normalized_address, candidate_tier from cand where address_bucket <> 7",
    "anchors_as_of": f"with {EV} select * from anchors",
    "cohort_overlap": f"with {DECIDE}, c as (select address_id, unnest(cohorts) as c from decided) select x.c as cohort_a, y.c as cohort_b, count(*) as address_count from c x join c y on x.address_id = y.address_id and x.c <= y.c group by all",
    "topk_per_cohort": f"with {DECIDE}{GROUPS}, r as (select *, (row_number() over (partition by quota_group order by importance_score desc, largest_sats desc, address_id))::int as group_rank from grouped) select quota_group, group_rank, address_id, importance_score, largest_sats from r where group_rank <= 20",
    "p0_leaders": f"with {DECIDE}, p as (select *, ({PLACE})::int as place from decided where priority_class = 'P0') select address_id, place as p0_place, {METRIC} as p0_metric from p order by place, {METRIC} desc, address_id limit 50",
    "coverage_state": f"with {COVER} select normalized_address, candidate_tier, candidate_row_sha256, array_to_string(ids, ',') as provider_entity_ids, direct_enriched, entity_membership_covered, local_evidence_covered, active_conflict, explicit_direct_requirement, coverage_state, reason as coverage_reason_codes from covered",
    "coverage_counts": f"with {COVER} select coverage_state, count(*) as row_count, {', '.join(f'count(*) filter ({x}) as {x}_count' for x in ('direct_enriched', 'entity_membership_covered', 'local_evidence_covered', 'active_conflict', 'explicit_direct_requirement'))} from covered group by 1",
    "set_overlap": f"with {CAND}, {EV}, s as (select distinct address from pred) select count(*) filter (address in (select normalized_address from cand)) as inside_count, count(*) filter (address not in (select normalized_address from cand)) as outside_count from s",
    "queue_reconciliation": f"with {COVER}, t as (select * from covered where candidate_tier in ('edge', 'coarse_other')) select count(*) as candidate_rows, count(*) as candidate_unique, count(*) as coverage_rows, count(*) as coverage_unique, count(*) as joined_rows, count(*) filter (coverage_state = 'needs_direct_enrichment') as eligible_rows, count(*) filter (coverage_state = 'needs_direct_enrichment' and (active_conflict or explicit_direct_requirement)) as mandatory_direct_rows from t",
    "p2_queue": f"""with {COVER}, p as (select *, greatest({', '.join(_D)}) as economic_value_sats, sha256('btc-v2s-p2-economic-leader-v1:' || normalized_address) as selection_key_sha256 from need where candidate_tier in ('edge', 'coarse_other')),
        r as (select row_number() over (order by (active_conflict or explicit_direct_requirement) desc, economic_value_sats desc, v2_chain_score desc, selection_key_sha256) as queue_rank, sha256('bitcoin:' || normalized_address) as address_id, economic_value_sats, selection_key_sha256, {QUEUE_COLS.format("'p2'")} from p)
        select * from r where queue_rank <= 100""",
    "p0p1_queue": f"with {P01} select * from q",
    "queue_due": f"""with {P01} select queue_rank, normalized_address from q where normalized_address not in (select address from obs where event_id % 30 = 0) and normalized_address not in (select address from parse where outcome = 'parsed_success')
        and (active_conflict or explicit_direct_requirement or normalized_address not in (select address from pred union select address from ev where tier = 'A'))""",
    "due_addresses": f"""with {EV}, fresh as (select address from parse where outcome = 'parsed_success' and ts > timestamp '2024-01-20'), due as (select address, max(priority) as p, min(ts) as t, 0 as c from req group by 1 union all select address, 100, min(ts), 1 from conf where status = 'active' group by 1)
        select address, max(p)::int as priority, case when max(c) = 1 then 'active_conflict' else 'candidate_request' end as source_kind, min(t) as due_at from due where address not in (select address from fresh) group by address order by priority desc, due_at, address limit 40""",
    "due_entities": """with x as (select 'e' || event_id % 97 as id, * from events), detail as (select id, max(ts) > timestamp '2024-01-30 12:00:00' as fresh from x where event_type = 'view' group by 1),
        parsed as (select distinct id from x where event_type = 'click' and event_id % 2 = 0 and ts > timestamp '2024-01-30 12:00:00'), cool as (select distinct id from x where event_type = 'error' and event_id % 3 = 0 and ts > timestamp '2024-01-30 18:00:00'),
        base as (select id, 75 as p from detail where fresh and id not in (select id from parsed) union all select id, greatest(20, 70 - least(min(event_id % 60 + 1) - 1, 50)) from x where event_type <> 'view' group by 1 union all select id, max(event_id % 90) from x where event_id % 31 = 0 group by 1),
        everything as (select * from base union all select id, 75 from detail where id not in (select id from base))
        select id as entity_id, max(p)::int as priority from everything where id not in (select id from detail where fresh and id in (select id from parsed)) and id not in (select id from cool) and id not in (select 'e' || event_id % 97 from events where event_id % 97 = 5) group by id order by priority desc, id limit 60""",
    "fetch_profile": f"""with {EV}, s as (select address, max(ts) filter (profile = 'discovery') as f, max(ts) filter (profile = 'detail') as d, count(distinct payload) filter (profile = 'discovery') > 1 as changed from obs where outcome = 'success' group by 1),
        r as (select address, max(priority) as p from req group by 1) select address, case when f is null then 'discovery' when coalesce(d > {AS_OF} - interval 24 hour, false) then null
        when f > {AS_OF} - interval 24 hour then case when d is null and (p >= 101 or coalesce(changed, false) or address in (select address from conf where status = 'active') or address in (select address from ev where expires_at > {AS_OF} and expires_at <= {AS_OF} + interval 7 day)) then 'detail' end
        else 'discovery' end as fetch_profile from r left join s using (address)""",
    "admission_window": "select count(*) filter (ts > timestamp '2024-01-14 23:59:00' and ts <= timestamp '2024-01-15') as last_minute, sum(case when event_id % 2 = 0 then event_id else 1000 end) filter (event_id % 3 = 1)::bigint as run_bytes, count(*) filter (ts > timestamp '2024-01-14 23:59:00' and ts <= timestamp '2024-01-15') < 25 and sum(case when event_id % 2 = 0 then event_id else 1000 end) filter (event_id % 3 = 1) < 100000000 as admitted from events",
    "entity_frequency": f"with {EV} select entity_id, count(*) as mention_count from pred group by 1",
    "work_queue": f"with {EV} select event_id as request_id, address, priority, ref as source_reference from req where starts_with(ref, 'panel:') and address not in (select address from obs where ts > timestamp '2024-01-29 12:00:00') order by priority desc, ts, event_id limit 30",
    "evidence_contract": f"with {EV} select 'verification_missing' as codes, count(*) as row_count from ev where tier = 'A' and not proven group by 1",
    "claims": f"with {RESOLVE} select {_CLAIM_ID} as claim_id, address, assertion_type, value as asserted_value, evidence_strength, corroboration_count, independence_count, effective_from, effective_to, reviewed_at, override_decision, claim_status, entity as entity_id, display as entity_display, provider_default from claim",
    "resolutions": f"with {RESOLVE} select address, assertion_type, active_claims, selected_claims, identity_state, operational_tier, resolution_policy, freshness_status, display as primary_entity_display, value as resolved_asserted_value from resolved",
    "conflicts": f"""with {RESOLVE}, open_ids as (select address, assertion_type, string_agg({_CLAIM_ID}, ',' order by {_CLAIM_ID}) as claim_ids from claim where claim_status <> 'rejected' group by all having count(*) > 1)
        select address, assertion_type, 'active' as status, claim_ids, sha256('{{"address":"' || address || '","assertion_type":"' || assertion_type || '","opened":"2024-01-25 00:00:00"}}') as conflict_set_id from open_ids""",
    "snapshot_rows": f"with {RESOLVE} select address, assertion_type, operational_tier, case operational_tier when 'lookup_usable' then display end as primary_entity_display, n::int as candidates from resolved",
    "latest_message": "select conv_id, turn, role from (select *, row_number() over (partition by conv_id order by turn desc, role desc) as n from conversations) where n = 1",
    "replay_impact": f"""with {REPLAY} select {_W.format('true')} as events, {_W.format('found')} as found, {_W.format('inside')} as internal_candidate_events, {_W.format('inside and found')} as internal_candidate_identity_coverage,
        {', '.join(f"{_W.format(f'inside and policy = {chr(39)}{p}{chr(39)}')} as internal_candidate_{p}_events" for p in ('provider_default', 'local_override', 'conflict_first'))}, {_W.format('inside and inp is null')} as internal_candidate_missing_input_context from seen""",
    "replay_policy_counts": f"with {REPLAY} select case when found then 'found' else 'not_found' end as identity_lookup_status, policy as identity_resolution_policy, sum(w)::bigint as weighted_events from seen group by all",
    "replay_changed_fields": "select count(*) filter (event_id % 13 = 0) as changed_business_fields from events",
    "bilateral_impact": f"""with {BOTH} select count(*) as events, count(*) filter (not ok) as malformed_events, count(*) filter (ok and inside) as internal_candidate_events, count(*) filter (incomplete) as events_with_missing_input_address, count(*) filter (out_found) as output_identity_found_events,
        sum(n)::bigint as input_addresses_observed, sum(found)::bigint as input_identity_found_addresses, count(*) filter (clash) as conflict_first_side_events, count(*) filter (same) as same_entity_bilateral_events, count(*) filter (dflt) as same_entity_provider_default_events,
        count(*) filter (indep) as same_entity_independent_evidence_events, count(*) filter (strong) as source_strong_condition_events, count(*) filter (strong and not incomplete and not clash and same and dflt) as provider_default_suppression_candidates,
        count(*) filter (strong and not incomplete and not clash and same and indep) as independent_evidence_suppression_candidates, 0::bigint as live_action_changes from flags""",
    "provider_panel": f"with {PANEL} select count(*) as candidate_addresses, {_PANEL} from panel",
    "calibration_seeds": f"with {EV} select distinct address, 'panel:vpurchase' as source_reference from ev where authority = 'official' and grp = 'purchase' and address not in (select address from req where event_id % 4 = 0 and starts_with(ref, 'panel:v'))",
    "outcome_counts": f"with {EV} select outcome, count(*) as row_count from obs where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' group by 1",
    "point_totals": f"with {EV} select sum(greatest(1, ceil(event_id * 777 / 100000.0)))::bigint as points from obs",
    "nearest_rank": f"with {EV} select quantile_disc(event_id, 0.5) as p50, quantile_disc(event_id, 0.95) as p95 from obs",
}


def _spread(table: str, column: str) -> str:
    return f"(select string_agg(x || ':' || n, ',' order by x) from (select {column} as x, count(*) as n from {table} group by 1))"


_SOURCE = """select count(*) filter (has_output) as source_standard_address_count, count(*) filter (has_input and not has_output) as source_input_only_address_count,
    count(*) filter (has_output and current_utxo_sats < 0) as negative_current_utxo_count, max(last_seen_time) filter (has_output) as max_observed_activity_time from {}"""
_QUALITY = "select count(*) filter (v is null) as null_value_count, 0::bigint as value_cast_failure_count from one"
ROW1 = CHAIN1 + f""", census as (
    select *, {_spread('chain', 'p0_mask')} as p0_overlap_distribution, {_spread('chain', 'chain_importance_score')} as score_histogram, 'btc_candidate_statistics_v1' as contract_version
    from (select {_counters1()} from chain), ({_SOURCE.format('econ1')}), ({_QUALITY})
)"""
_VARIANT_NAMES = {"strict": "V2-S", "balanced": "V2-B", "retention": "V2-R"}


def _variant_columns(v: str) -> str:
    own = {
        "variant": f"'{_VARIANT_NAMES[v]}'", "p0_utxo_ge_100_btc_count": "p0_utxo_count", "p0_sustained_residual_gross_90d_ge_1000_btc_count": "p0_sustained_residual_gross_count",
        "p0_receipt_rule_count": f"{v}_p0_receipt_count", "p0_lifetime_ge_10000_active_supported_90d_count": "p0_lifetime_active_supported_count",
        "chain_p0_union_count": f"{v}_p0_union_count", "incremental_receipt_p0_count": f"{v}_incremental_receipt_p0_count", "p0_overlap_distribution": _spread("variants", f"{v}_p0_mask"),
        "chain_p1_count": f"{v}_p1_count", "p0_p1_overlap_count": f"{v}_p0_p1_overlap_count", "edge_upgrade_frontier_count": f"{v}_edge_count",
        "coarse_candidate_union_count": f"{v}_coarse_count", "excluded_source_address_count": f"{v}_excluded_count",
    }
    return ", ".join(f"{x} as {v}_variant_{n}" for n, x in own.items())


ROW2 = VARIANT + f""", census as (
    select *, {_spread('variants', 'receipt_support_mask')} as receipt_support_overlap_distribution, {_spread('variants', 'v2_chain_score')} as score_histogram,
           {', '.join(_variant_columns(v) for v in _VARIANT_NAMES)}, 'btc_candidate_statistics_v2' as contract_version
    from (select {_counters2()} from variants), ({_SOURCE.format('econ')}), ({_QUALITY})
)"""


def _falls(*names: str) -> str:
    return " or ".join(f"{a} < {b}" for a, b in zip(names, names[1:], strict=False))


def _by(prefix: str, *steps: int, end: str = "_btc_count") -> str:
    return _falls(*(f"{prefix}{k}{end}" for k in steps))


def _masks(table: str, column: str, cond: str = "true") -> str:
    return f"(select count(*) from {table} where {cond.format(column)})"


def _verdict(rows: str, hard: dict[str, str], soft: dict[str, str]) -> str:
    def broken(rules: dict[str, str]) -> str:
        return "list_sort(list_filter([" + ", ".join(f"case when {x} then '{k}' end" for k, x in rules.items()) + "], lambda x: x is not null))"

    return f"""with {rows}, judged as (select {broken(hard)} as b, {broken(soft)} as w from census)
        select case when len(b) > 0 then 'blocked' when len(w) > 0 then 'warn' else 'allow' end as outcome, array_to_string(b, ',') as blocked, array_to_string(w, ',') as warned from judged"""


_N = "source_standard_address_count"
_HARD = {"null_values": "null_value_count > 0", "value_cast_failures": "value_cast_failure_count > 0", "negative_utxo": "negative_current_utxo_count > 0"}
HARD1 = _HARD | {
    "p0_distribution_total": f"{_masks('chain', 'p0_mask')} <> {_N}", "p0_union": f"{_masks('chain', 'p0_mask', '{} <> 0')} <> chain_p0_union_count",
    "score_total": f"{_masks('chain', '')} <> {_N}",
    "p0_bits": " or ".join(
        f"{_masks('chain', 'p0_mask', '{} & ' + str(b) + ' <> 0')} <> {n}"
        for b, n in ((1, "p0_utxo_ge_100_btc_count"), (2, "p0_same_tx_receive_ge_500_btc_count"), (4, "p0_gross_90d_ge_1000_btc_count"), (8, "p0_lifetime_ge_10000_active_365d_count"))
    ),
    "p0_p1_overlap": "p0_p1_overlap_count <> 0", "coarse_partition": f"coarse_candidate_union_count + excluded_source_address_count <> {_N}",
    "coarse_too_small": "coarse_candidate_union_count < chain_p0_union_count + chain_p1_count + edge_upgrade_frontier_count",
    "utxo_ladder": _by("utxo_ge_", 1, 10, 100, 1000), "receipt_ladder": _by("same_tx_receive_ge_", 100, 500, 1000, 5000), "gross_ladder": _by("gross_90d_ge_", 10, 100, 1000, 10000),
    "recency_ladder": _by("recency_le_", 365, 90, 30, end="d_count"),
}
SOFT1 = {
    "coarse_over_5m": "coarse_candidate_union_count > 5000000", "p0_over_120k": "chain_p0_union_count > 120000", "edge_over_1m": "edge_upgrade_frontier_count > 1000000",
    "cohort_over_40_percent": "greatest(current_capital_count, historical_large_receipt_count, high_turnover_count, dormant_holder_count) * 100 > coarse_candidate_union_count * 40",
}
HARD2 = _HARD | {
    "score_total": f"{_masks('variants', '')} <> {_N}", "support_total": f"{_masks('variants', '')} <> {_N}",
    "support_bits": " or ".join(
        f"{_masks('variants', 'receipt_support_mask', '{} & ' + str(b) + ' <> 0')} <> recent_receipt_{n}_count" for b, n in ((1, "retained"), (2, "repeated"), (4, "sustained_activity"))
    ),
    "utxo_ladder": _by("utxo_ge_", 1, 10, 100, 1000), "raw_gross_ladder": _by("raw_gross_90d_ge_", 10, 100, 1000, 10000), "residual_ladder": _by("residual_gross_90d_ge_", 10, 100, 1000, 10000),
    "recency_ladder": _by("recency_le_", 365, 90, 30, end="d_count"),
    "horizon_ladder": _falls("lifetime_max_receipt_ge_500_btc_count", "max_receipt_365d_ge_500_btc_count", "max_receipt_90d_ge_500_btc_count"),
    "residual_over_raw": _falls("raw_gross_90d_ge_10_btc_count", "residual_gross_90d_ge_10_btc_count"),
    "variant_funnel": _falls("balanced_p0_receipt_count", "strict_p0_receipt_count") + " or " + _falls("balanced_p0_union_count", "strict_p0_union_count"),
    "hard_stop_p0": "strict_p0_union_count > 1000000", "hard_stop_coarse": "strict_coarse_count > 5000000", "hard_stop_edge": "strict_edge_count > 1000000",
}
for _v in _VARIANT_NAMES:
    HARD2[f"{_v}_partition"] = f"{_masks('variants', '')} <> {_N} or {_masks('variants', _v + '_p0_mask', '{} <> 0')} <> {_v}_p0_union_count or {_v}_coarse_count + {_v}_excluded_count <> {_N}"
    HARD2[f"{_v}_bits"] = " or ".join(
        f"{_masks('variants', _v + '_p0_mask', '{} & ' + str(b) + ' <> 0')} <> {n}"
        for b, n in ((1, "p0_utxo_count"), (2, "p0_sustained_residual_gross_count"), (4, f"{_v}_p0_receipt_count"), (8, "p0_lifetime_active_supported_count"))
    )
    HARD2[f"{_v}_p0_p1_overlap"] = f"{_v}_p0_p1_overlap_count <> 0"
SOFT2 = {"review_p0": "strict_p0_union_count > 120000", "review_coarse": "strict_coarse_count > 2000000", "review_receipt": "strict_p0_receipt_count > 95906"}

ORACLE_SQL |= {
    "census_v1_row": f"with {ROW1} select * from census", "census_v2_row": f"with {ROW2} select * from census",
    "census_v1_reconciled": _verdict(ROW1, HARD1, SOFT1), "census_v2_reconciled": _verdict(ROW2, HARD2, SOFT2),
    "panel_by_stratum": f"""with {PANEL}, first_ref as (select address, arg_min(ref, (ts, event_id)) as ref from req where ref like 'panel:%' group by address), cut as (select panel.*, split_part(ref, ':', -1) as stratum from panel join first_ref using (address))
        select stratum, outcome, count(*) as candidate_addresses, {_PANEL} from cut group by stratum, outcome""",
}


def _early(sql: str) -> str:
    """The same of the campaign that ended after the first month."""
    return sql.replace(CUT, "timestamp '1995-01-31 00:00:00'").replace("height <= 2404", "height <= 30")


ALONE = f"""{_early(DECIDE)}, alone as (
    select address, sha256('bitcoin:' || address) as address_id, list(distinct reason_code) as reasons from anchors where address not in (select normalized_address from feat) group by address
)"""
ORACLE_SQL |= {
    "anchor_only": f"with {ALONE} select address, array_to_string(list_sort(reasons), ',') as calibration_reasons from alone",
    "first_wave_leaders": f"""with {ALONE}, p as (select address_id, reasons, current_utxo_sats, max_same_tx_received_sats, gross_flow_90d_sats, lifetime_received_sats from decided where priority_class = 'P0' union all select address_id, reasons, 0, 0, 0, 0 from alone),
        q as (select *, coalesce({PLACE}, 6)::int as place from p) select address_id, place as p0_place, ({METRIC})::bigint as p0_metric from q order by place, p0_metric desc, address_id limit 80""",
    "first_wave_statistics": f"""with {ALONE}, members as (select priority_class as c, reasons, cohorts from decided where priority_class <> 'NONE' union all select 'P0', reasons, ['calibration'] from alone),
        n as (select count(*) as u, count(*) filter (c = 'P0') as p0, sum(len(reasons)) as r, (select count(*) from alone) as a from members),
        numbered as (select row_number() over () as k, cohorts from members), each_cohort as (select k, unnest(cohorts) as a from numbered),
        counts as (
            select 'class' as metric, c as name, count(*) as value from members group by c
            union all select 'reason', x, count(*) from (select unnest(reasons) as x from members) group by x
            union all select 'cohort', a, count(*) from each_cohort group by a
            union all select 'overlap', x.a || '&' || y.a, count(*) from each_cohort x join each_cohort y on x.k = y.k and x.a < y.a group by all
        )
        select * from counts union all
        select 'total' as metric, unnest(['anchor_only', 'reason_memberships', 'duplicate_slots_prevented', 'first_wave_unique', 'unique_selected', 'rate_limited_capacity', 'point_limited_capacity', 'remaining_p0', 'projected_minimum_minutes']),
            unnest([a, r, r - u, least(u, 20), u, 20, 40, p0 - least(p0, u, 20), ceil(u / 5.0)])::bigint from n""",
}


_WAVE = {"calibration_control": (5, 5), "current_capital": (0, 30), "dormant_holder": (3, 10), "high_turnover": (2, 20), "high_value_connector": (4, 10), "historical_large_receipt": (1, 25)}


def _first_wave() -> str:
    """The selection as a recursion over the rows that quotas leave; groups are numbered by name, their quotas by their own order."""
    names = list(_WAVE)
    member = ["list_contains(cohorts, 'calibration') or list_contains(cohorts, 'control')", *[f"list_contains(cohorts, '{g}')" for g in names[1:]]]
    steps, before = [], []
    for k, (o, _) in sorted(enumerate(_WAVE.values()), key=lambda x: x[1][0]):
        gone = " and ".join(f"address_id not in (select address_id from t{b})" for b in before) or "true"
        steps.append(f"t{k} as (select address_id, k from lists where k = {k} and {gone} order by r limit (select m from quota where k = {k}))")
        before.append(k)
    count = lambda t, cond: "[" + ", ".join(f"(select count(*) from {t} where {cond.format(k)})" for k in range(len(names))) + "]"
    return f"""with recursive {ALONE}, mine as (
        select address_id, importance_score as sc, greatest(current_utxo_sats, max_same_tx_received_sats, gross_flow_90d_sats, lifetime_received_sats) as big,
               list_filter([{', '.join(f'case when {m} then {k} end' for k, m in enumerate(member))}], lambda x: x is not null) as g
        from decided where priority_class in ('P1', 'CONTROL')
    ), total as (
        select p0, p0 + o // 3 as slots, o // 3 as free, (o // 3 * 40 + 99) // 100 as cap
        from (select (select count(*) from decided where priority_class = 'P0') + (select count(*) from alone) as p0, (select count(*) from mine) as o)
    ), quota as (
        select k, free * p // 100 + case when row_number() over (order by free * p % 100 desc, o) <= free - sum(free * p // 100) over () then 1 else 0 end as m
        from (values {', '.join(f'({k}, {o}, {p})' for k, (o, p) in enumerate(_WAVE.values()))}) t(k, o, p), total
    ), lists as (
        select address_id, k, row_number() over (partition by k order by sc desc, big desc, address_id) as r from (select *, unnest(g) as k from mine) qualify r <= (select slots from total)
    ), {', '.join(steps)}, taken as ({' union all '.join(f'select * from t{k}' for k in before)}), rest as (
        select address_id, g, list(k) as listed, row_number() over (order by sc desc, big desc, address_id) as pos
        from mine join lists using (address_id) where address_id not in (select address_id from taken) group by address_id, g, sc, big
    ), fold(pos, n, more, free, cap) as (
        select 0::bigint, {count('taken', 'k = {}')}, {count('rest', 'list_contains(listed, {})')}, free - (select count(*) from taken), cap from total
        union all
        select pos + 1, case when c is null then n else list_transform(n, lambda v, i: case when i = c + 1 then v + 1 else v end) end,
               case when c is null then more else list_transform(more, lambda v, i: case when list_contains(listed, i - 1) then v - 1 else v end) end, free - (c is not null)::int, cap
        from (
            select f.*, r.listed, case when f.free > 0 then list_min(list_transform(list_filter(r.g, lambda x: f.n[x + 1] < f.cap or len(list_filter(f.more, lambda v: v > 0)) < 3), lambda x: f.n[x + 1] * 10 + x)) % 10 end as c
            from fold f join rest r on r.pos = f.pos + 1
        )
    ), last as (select n from fold order by pos desc limit 1), named as (select unnest({names}) as quota_group, unnest(n) as address_count from last)
    select 'P0' as quota_group, p0 as address_count from total where p0 > 0 union all select * from named where address_count > 0"""


ORACLE_SQL["first_wave"] = _first_wave()
