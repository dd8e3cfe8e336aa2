"""Print the physical plans of the key stages (used to write PLANS.md).

Broadcast-by-statistics is switched off so the plans show what the large-data path
looks like (at test scale every dimension would be broadcast automatically)."""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cabflow.operators import kpis, matching, profile, quality, questions  # noqa: E402
from cabflow.operators.enrich import add_ymd, analytics_base, question_base  # noqa: E402
from cabflow.plans import flow, job  # noqa: E402
from cabflow.session import build_session  # noqa: E402
from cabflow.sinks import writers  # noqa: E402
from cabflow.sources import feeds  # noqa: E402


def show(title: str, df) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"Location: [^,]+,", "Location: ...,", plan)
    lines = [ln[:220] for ln in plan.splitlines()]
    print(f"\n### {title}\n\n```\n" + "\n".join(lines) + "\n```")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(master="local[4]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="cabflow-plans-")
    trips, fares = flow.fixture_raw(spark, sf)
    show("Dedup + validation of the trip feed (aggregate with map-side partial)",
         quality.validated_trips(trips, multiplicity=quality.MULTIPLICITY))
    staged: dict[str, str] = {}
    tt = job.stage_bucketed(quality.validated_trips(trips, multiplicity=quality.MULTIPLICITY), "tt", 8, root, staged)
    tf = job.stage_bucketed(quality.validated_fares(fares, multiplicity=quality.MULTIPLICITY), "tf", 8, root, staged)
    gt, _ = quality.split(tt)
    gf, _ = quality.split(tf)
    out = matching.match(gt, gf)
    show("Match on the bucketed staged tables: matched rows (Inner, no Exchange)", out["matched"])
    show("Trips without fare (LeftOuter, no Exchange)", out["trip_only"])
    show("Unmatched table from ONE full outer pass, match stats observed (no Exchange)",
         matching.unmatched_with_stats(gt, gf)[0])
    show("Match stats: one aggregate over the full outer join", matching.match_stats(gt, gf))
    proc = f"{root}/processed/{feeds.PROCESSED_TABLE}"
    writers.write_processed(out["matched"], proc)
    p = feeds.load_processed(spark, f"{root}/processed")
    w = feeds.load_or_prepare_weather(spark, f"{root}/processed", None) or flow.fixture_weather(spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    base = question_base(p, weather=w)
    show("Q1 on the processed layout (pruned scan, pushed range filter, holiday flag as an expression)",
         questions.q1_hourly_weekend(base))
    show("Q5a (broadcast weather after one-row-per-hour aggregate)", questions.q5_condition_hour(base))
    show("Q4b growth streak (windows over the vendor-month aggregate)",
         questions.q4_growth_streak(questions.q4_vendor_mom(base)))
    ab = analytics_base(add_ymd(p))
    show("KPI GROUPING SETS: six segmentations, one scan, one shuffle", kpis.kpi_grouping_sets(ab))
    show("Numeric stats: stacked narrow aggregate", profile.numeric_stats(ab))
    show("Exact quantiles: sketch brackets + counts", profile.exact_quantiles(ab))
    for name in staged:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


if __name__ == "__main__":
    main()
