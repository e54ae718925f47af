"""Command line: ``python -m adlens <command>``.

    list                                   names of the registered queries
    run NAME --data DIR [--show N]         one registered query (default parameters)
    report performance|day-performance --data DIR --start D --end D [--show N]
    cohorts day-lift|campaign|campaign-device --data DIR --start D --end D [--show N]
    upsert --data DIR --out NEW_FOLDER     apply the input's cost feed to its daily costs

``--data`` is the folder with the input parquet tables. The session comes from
``get_spark`` (spark-submit / spark-defaults settings apply).
"""

from __future__ import annotations

import argparse
import sys

from adlens.session import get_spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="adlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("name")
    for sp, choices in ((sub.add_parser("report"), ["performance", "day-performance"]),
                        (sub.add_parser("cohorts"), ["day-lift", "campaign", "campaign-device"])):
        sp.add_argument("kind", choices=choices)
        sp.add_argument("--start", required=True)
        sp.add_argument("--end", required=True)
    u = sub.add_parser("upsert")
    u.add_argument("--out", required=True, help="new folder for costs_daily, audit and rejects")
    for sp in sub.choices.values():
        sp.add_argument("--data", default="/root/testdata/sf0.01")
        sp.add_argument("--show", type=int, default=50)
    a = p.parse_args(argv)

    from adlens.plans import catalog as cat
    if a.cmd == "list":
        print("\n".join(sorted(cat.catalog())))
        return 0
    spark = get_spark()
    if a.cmd == "upsert":
        from adlens.operators.upsert import upsert_costs_daily, write_upsert
        from adlens.sources.model import load_model
        m = load_model(spark, a.data)
        paths = write_upsert(upsert_costs_daily(m.costs_daily, m.cost_feed, m.campaigns), a.out)
        spark.read.parquet(paths["audit"]).groupBy("action_taken").count().show()
        print("\n".join(f"{k}: {v}" for k, v in paths.items()))
        return 0
    if a.cmd == "run":
        df = cat.catalog()[a.name](spark, a.data)
    else:
        from adlens.operators import cohorts, reports
        from adlens.sources.model import load_model
        m = load_model(spark, a.data)
        if a.cmd == "report":
            fn = reports.campaign_performance if a.kind == "performance" else reports.campaign_day_performance
            df = fn(m.campaigns, m.clicks, m.sessions, m.conversions, a.start, a.end)
        elif a.kind == "campaign-device":
            df = cohorts.cohort_campaign_device_rollup(cat.cohort_device(m, (a.start, a.end)), m.campaigns,
                                                       a.start, a.end)
        else:
            fn = cohorts.cohort_day_lift if a.kind == "day-lift" else cohorts.cohort_campaign_rollup
            df = fn(cat.cohort(m, (a.start, a.end)), m.campaigns, a.start, a.end)
    df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
