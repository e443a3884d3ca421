"""python -m lodestrata COMMAND: lists and runs queries, publishes and checks artifacts; answers are JSON on stdout."""

from __future__ import annotations

import argparse
import json
import sys


#: groups of commands: an action, and the query whose rows it prints
GROUPS = {
    "evidence": {"check": "evidence_contract", "import": "appended_evidence", "payloads": "payload_evidence"},
    "resolve": {"rebuild": "resolutions", "claims": "claims", "conflicts": "conflicts", "show": "resolution_lookup", "errors": "decision_errors"},
    "audit": {
        "coverage": "outcome_counts", "panel": "provider_panel", "strata": "panel_by_stratum", "seeds": "calibration_seeds",
        "points": "point_totals"
    },
    "replay": {"impact": "replay_impact", "policies": "replay_policy_counts", "changes": "replay_changed_fields", "bilateral": "bilateral_impact"},
    "coverage-sync": {"plan": "sync_plan", "entities": "due_entities", "addresses": "due_addresses", "profile": "fetch_profile"},
    "universe": {
        "campaign": "materialized_campaign", "candidates": "first_wave_statistics", "census-v1": "census_v1_row",
        "census-v2": "census_v2_row", "population": "population_contract"
    },
    "enrichment": {
        "queue": "queue_artifact", "plan": "enrichment_plan", "fanout": "fanout_plan", "accounting": "fanout_accounting",
        "due": "queue_due"
    },
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lodestrata")
    parser.add_argument("--master", help="Spark master; the deployment's own if not given")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of all queries")
    for name, text in (("run", "rows of a query"), ("probe", "bytes that its plan reads"), ("explain", "its physical plan")):
        p = sub.add_parser(name, help=text)
        p.add_argument("query")
        p.add_argument("data")
        if name == "run":
            p.add_argument("--output", help="write Parquet there; an existing folder is an error")
    p = sub.add_parser("publish", help="candidates as a checked artifact")
    p.add_argument("data")
    p.add_argument("root")
    p = sub.add_parser("export", help="the resolver's snapshot as sorted JSON lines")
    p.add_argument("data")
    p.add_argument("path")
    p = sub.add_parser("validate", help="check an artifact against its manifest")
    p.add_argument("root")
    for group, actions in GROUPS.items():
        p = sub.add_parser(group, help=", ".join(actions))
        p.add_argument("action", choices=sorted(actions))
        p.add_argument("data")
    args = parser.parse_args(argv)
    try:
        _run(args)
    except (OSError, ValueError, KeyError) as e:
        print(json.dumps({"error": type(e).__name__, "message": str(e)}))
        return 1
    return 0


def _run(args: argparse.Namespace) -> None:
    from .plans.registry import QUERIES
    from .schemas import scan_bytes
    from .session import session
    from .sources import sinks

    if args.command == "queries":
        print(json.dumps(sorted(QUERIES)))
        return
    if args.command == "validate":
        print(json.dumps(sinks.verified(session(master=args.master), args.root)))
        return
    spark = session(master=args.master)
    if args.command in GROUPS:
        args.query, args.command, args.output = GROUPS[args.command][args.action], "run", None
    if args.command == "publish":
        print(json.dumps(sinks.publish_candidates(QUERIES["candidates_v2_s"](spark, args.data), args.root, {"source": args.data})))
    elif args.command == "export":
        print(json.dumps({"sha256": sinks.export_ndjson(QUERIES["snapshot_rows"](spark, args.data), args.path, "address", "assertion_type")}))
    else:
        df = QUERIES[args.query](spark, args.data)
        if args.command == "probe":
            print(json.dumps({"bytes": scan_bytes(df)}))
        elif args.command == "explain":
            df.explain("formatted")
        elif args.output:
            sinks.write_empty(df, args.output)
        else:
            for line in df.toJSON().toLocalIterator():
                sys.stdout.write(line + "\n")


if __name__ == "__main__":
    sys.exit(main())
