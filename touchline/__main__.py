"""Run the whole analysis as one job.

    python -m touchline --raw PATH --start 2020-07-01 --end 2020-09-30 --goals -1 --out DIR

Reads raw visits (parquet, or a JSON export with --json-lines), builds the visit
and touch tables (checkpointed to spark.checkpoint.dir), writes the three
reports as tab-separated files under DIR and prints the four top-10 views.
"""

from __future__ import annotations

import argparse
import os

from touchline.operators.gap_state import read_gap_state
from touchline.operators.skew import BLOCK_ROWS, HOT_USER_ROWS
from touchline.plans.analytics import ChainAnalytics
from touchline.session import get_session
from touchline.sources import load_json_dump, read_raw_visits, read_source_names, write_report_tsv


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="touchline")
    ap.add_argument("--raw", required=True, help="raw visit table (parquet directory or JSON export)")
    ap.add_argument("--json-lines", action="store_true", help="--raw is a JSON export, one visit row per line")
    ap.add_argument("--json", action="store_true", help="--raw holds JSON exports of one document each")
    ap.add_argument("--start", required=True)
    ap.add_argument("--end", required=True)
    ap.add_argument("--goals", default="-1",
                    help="comma-separated goal ids; -1 = purchases; empty = every visit converts")
    ap.add_argument("--names", help="SourceCode<TAB>SourceName file (default: no names)")
    ap.add_argument("--visits-out", help="keep the live visits here (partitioned by StartDate)")
    ap.add_argument("--chains-out", help="write the chain table here (partitioned by StartDate)")
    ap.add_argument("--publish", action="store_true",
                    help="the two tables above become new versions, switched to in one step (sources.read_published)")
    ap.add_argument("--gap-state", help="folder of the daily gap state (operators.gap_state) that D is merged from")
    ap.add_argument("--out", required=True, help="output directory for the report files")
    ap.add_argument("--master", default=None, help="Spark master (default: as configured)")
    ap.add_argument("--top", type=int, default=10)
    ap.add_argument("--hot-user-rows", type=int, default=HOT_USER_ROWS,
                    help="users with more visits take the blocked (user, block) path")
    ap.add_argument("--block-rows", type=int, default=BLOCK_ROWS, help="target rows per block of a hot user")
    a = ap.parse_args(argv)

    # without --master the launcher's master (spark-submit) and partition settings are kept
    spark = get_session(a.master, shuffle_partitions=None)
    raw = (load_json_dump(spark, a.raw, envelope=a.json) if a.json or a.json_lines
           else read_raw_visits(spark, a.raw))
    goals = [int(g) for g in a.goals.split(",") if g.strip()]
    names = read_source_names(spark, a.names) if a.names else None
    ca = ChainAnalytics(spark, raw, a.start, a.end, goals=goals, source_names=names,
                        hot_user_rows=a.hot_user_rows, block_rows=a.block_rows,
                        gap_state=read_gap_state(spark, a.gap_state) if a.gap_state else None)
    ca.prepare_visits(a.visits_out, published=a.publish)
    ca.combine_visits(materialize=True)
    if a.chains_out:
        ca.chains(a.chains_out, published=a.publish)
    for name, report in [("simple_attributions", ca.simple_attributions()),
                         ("associated_conversions", ca.associated_conversions()),
                         ("source_in_chains_metrics", ca.source_in_chains_metrics())]:
        write_report_tsv(report, os.path.join(a.out, name))
    for view in ("simple", "associated", "chains", "conv_chains"):
        print(f"== {view} ==")
        ca.top_report(view, a.top).show(a.top, truncate=False)
    ca.release()


if __name__ == "__main__":
    main()
