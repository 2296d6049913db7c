"""Command-line entry points (``python -m railpulse ...`` or spark-submit).

    stations  --coords PATH [--coords-format parquet|csv] --stations-out PATH --lookup-out PATH
              (ids of a stations table already at --stations-out are kept)
    delays    --records PATH [--records-format parquet|csv] --lookup PATH [--lookup-format lines|array]
              --out PATH [--start DATE] [--end DATE] [--csv]
    initial   [--delays-csv PATH --delays PATH] [--weather-csv PATH --weather PATH]
              [--stations-csv PATH --stations PATH] [--region-config PATH --regions PATH]
    refresh   --delay-landing P --weather-landing P --delays P --weather P --stations P
              --checkpoints P --results P [--min-trains N] [--max-files N] [--strict]
              [--regions P (the stored region configuration)] [--unified P]
    issues    --delays P --weather P [--dismiss SUBJECT --reason TEXT]
              (lists what keeps a refresh from running, or settles one of them by hand)
    kpis      --delays P --stations P --weather P --results P [--min-trains N]

The session comes from the environment (spark-submit's master and configuration);
``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from railpulse.constants import DELAYS_ALL, WEATHER_ALL


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="railpulse")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stations")
    s.add_argument("--coords", required=True, help="table with station_name, lat, lon")
    s.add_argument("--coords-format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--stations-out", required=True)
    s.add_argument("--lookup-out", required=True)

    d = sub.add_parser("delays")
    d.add_argument("--records", required=True)
    d.add_argument("--records-format", default="parquet", choices=["parquet", "csv"])
    d.add_argument("--lookup", required=True, help="lookup JSON")
    d.add_argument("--lookup-format", default="lines", choices=["lines", "array"],
                   help="lines: as the stations command writes it")
    d.add_argument("--out", required=True)
    d.add_argument("--start")
    d.add_argument("--end")
    d.add_argument("--csv", action="store_true", help="write the CSV export instead of the table")

    i = sub.add_parser("initial")
    for a in ("delays-csv", "delays", "weather-csv", "weather", "stations-csv", "stations", "region-config", "regions"):
        i.add_argument(f"--{a}")

    r = sub.add_parser("refresh")
    for a in ("delay-landing", "weather-landing", "delays", "weather", "stations", "checkpoints",
              "results"):
        r.add_argument(f"--{a}", required=True)
    r.add_argument("--min-trains", type=int, default=10)
    r.add_argument("--max-files", type=int, help="landed files per micro-batch")
    r.add_argument("--strict", action="store_true", help="fail on a missing weather measurement")

    r.add_argument("--regions", help="region table of the initial command; its ids are the regions expected")
    r.add_argument("--unified", help="stored unified table, kept up to date by day")

    o = sub.add_parser("issues")
    for a in ("delays", "weather"):
        o.add_argument(f"--{a}", required=True)
    o.add_argument("--dismiss", help="subject of the issue")
    o.add_argument("--reason", default="dismissed")

    k = sub.add_parser("kpis")
    for a in ("delays", "stations", "weather", "results"):
        k.add_argument(f"--{a}", required=True)
    k.add_argument("--min-trains", type=int, default=10)
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from railpulse import jobs
    from railpulse.session import build_session
    from railpulse.sources import readers as R
    from railpulse.sources.sinks import read_table

    spark = build_session(args.master)
    if args.cmd == "stations":
        coords = R.read_coords(spark, args.coords, args.coords_format)
        st = jobs.preprocess_stations(coords, args.stations_out, args.lookup_out)
        out = {"stations": st.count()}
    elif args.cmd == "delays":
        records = R.read_raw_records(spark, args.records, args.records_format)
        lookup = R.read_station_lookup(spark, args.lookup, multi_line=args.lookup_format == "array")
        rep = jobs.preprocess_delays(records, lookup, args.out, args.start, args.end,
                                     fmt="csv" if args.csv else "parquet")
        out = rep.__dict__
    elif args.cmd == "initial":
        from railpulse.sources.sinks import merge_days
        from railpulse.streaming.refresh import WEATHER_KEY, initial_load
        out = {}
        if args.delays_csv:
            out["delays"] = initial_load(spark, args.delays_csv, args.delays)
        if args.weather_csv:
            out["weather"] = merge_days(R.read_weather_initial_csv(spark, args.weather_csv), args.weather, WEATHER_ALL, WEATHER_KEY)
        for name, path, target, read in (("stations", args.stations_csv, args.stations, R.read_stations_csv),
                                         ("regions", args.region_config, args.regions, R.read_region_config)):
            if path:
                read(spark, path).write.mode("overwrite").parquet(target)
                out[name] = spark.read.parquet(target).count()
    elif args.cmd == "refresh":
        from railpulse.streaming.refresh import RefreshPaths, refresh
        paths = RefreshPaths(args.delay_landing, args.weather_landing, args.delays, args.weather,
                             args.stations, args.checkpoints, args.results, args.regions, args.unified)
        out = {f"{r.step}.{r.metric}": r.value
               for r in refresh(spark, paths, args.min_trains, args.max_files, args.strict).collect()}
    elif args.cmd == "issues":
        from railpulse.streaming.ledger import Ledger
        out = {}
        for name, path in (("delays", args.delays), ("weather", args.weather)):
            ledger = Ledger(spark, path)
            waiting = {r["subject"]: r["reason"] for r in ledger.open_issues().collect()}
            if args.dismiss in waiting:
                ledger.dismiss(args.dismiss, args.reason)
                del waiting[args.dismiss]
            out[name] = waiting
    else:
        from railpulse.operators.unified import unified_all
        unified = unified_all(read_table(spark, args.delays, DELAYS_ALL), spark.read.parquet(args.stations),
                              read_table(spark, args.weather, WEATHER_ALL))
        out = jobs.kpi_report(spark, unified, args.results, min_trains=args.min_trains)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
