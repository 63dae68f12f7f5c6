"""Command line: run a registered query and write or show its rows.

    python -m hemicycle.cli list
    python -m hemicycle.cli run footprint_topic_deputy /data/sf0.1 --out /tmp/scores
"""

from __future__ import annotations

import argparse

from hemicycle.plans import analytics, domain, ingest
from hemicycle.session import local_session

QUERIES = analytics.QUERIES | domain.QUERIES | ingest.QUERIES
# verbs of the batch application, and the queries that answer them
VERBS = {
    "stats": [n for n in QUERIES if n.startswith("stats_")],
    "footprint": [n for n in QUERIES if n.startswith("footprint_")],
    "topic-alignment": ["topic_alignment"],
    "send-alerts": ["alerts_new_published_finished"],
    "tagger": ["tag_documents", "tag_single_kb", "tag_new_topic", "tag_new_tag", "tag_rename", "retag_modify_regex", "tag_amendments"],
    "untagger": ["untag_all", "untag_kb", "untag_topic", "untag_tag", "untag_reference"],
    "references": ["reference_plan_new", "reference_plan_all", "reference_plan_new_single_type", "reference_plan_all_single_type", "skip_oversight_refs"],
    "long-questions": ["tag_propagate_near_duplicates"],
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="hemicycle")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("name", help="a query, or one of: " + ", ".join(VERBS))
    run.add_argument("folder")
    run.add_argument("--out")
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join([*VERBS, *QUERIES]))
        return 0
    names = VERBS.get(args.name, [args.name])
    if unknown := [n for n in names if n not in QUERIES]:
        parser.error(f"no query {unknown[0]}")
    spark = local_session()
    for name in names:
        df = QUERIES[name](spark, args.folder)
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        else:
            print(name)
            df.show(20, truncate=60)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
