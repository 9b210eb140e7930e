"""Command-line entry for spark-submit: the AQI -> weather -> traffic pipeline, then the
serving-mart refresh, optionally the forecast training and batch scoring.

    spark-submit --py-files airshed.zip airshed/plans/run.py \\
        --bronze <shared>/bronze --lake <shared>/lake \\
        [--run-ts 2024-02-01T00:00:00+00:00] [--plain-bronze] [--train --hourly <shared>/hourly]
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from airshed.session import get_spark


def main(argv=None, spark=None) -> dict:
    ap = argparse.ArgumentParser(prog="airshed")
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--lake", required=True)
    ap.add_argument("--run-ts", default=None)
    ap.add_argument("--plain-bronze", action="store_true", help="<dir>/<date>/* layout")
    ap.add_argument("--train", action="store_true", help="fit and save the forecast model")
    ap.add_argument("--hourly", default=None, help="folder with aq_hourly/ and wx_hourly/ tables")
    ap.add_argument("--score", action="store_true",
                    help="score every station with the saved model into forecast marts")
    ap.add_argument("--local", default=None, help="local[N] master for a single-machine run")
    a = ap.parse_args(argv)

    from airshed.plans import jobs
    spark = spark or get_spark(a.local, profile="local" if a.local else "cluster")
    run_ts = a.run_ts or datetime.now(timezone.utc).isoformat()
    lake = jobs.Lake(bronze=a.bronze, root=a.lake,
                     bronze_layout="plain" if a.plain_bronze else "partitioned")
    status = [r.asDict() for r in jobs.run_pipeline(spark, lake, run_ts).collect()]
    out = {"run_ts": run_ts, "jobs": status, "marts": jobs.refresh_marts(spark, lake, run_ts)}
    if a.train:
        if not a.hourly:
            raise SystemExit("--train needs --hourly (hourly AQ and weather tables)")
        from airshed.ml import dataset, model
        aq = spark.read.parquet(f"{a.hourly}/aq_hourly")
        wx = spark.read.parquet(f"{a.hourly}/wx_hourly")
        t = model.train(dataset.training_samples(aq, wx))
        model.save(t, f"{a.lake}/models/forecast", spark)
        out["model"] = {"n_samples": t.n_samples, "mae": round(t.mae, 3), "r2": round(t.r2, 4)}
    if a.score:
        from airshed.ml import model, scoring
        from airshed.plans import snapshots
        m = model.load(f"{a.lake}/models/forecast")
        current = snapshots.read(spark, lake.path("serving", "station_current"))
        mart = lambda name: lake.path("serving", name)
        out["forecast_rows"] = snapshots.publish(scoring.curve(m, current, run_ts), mart("forecast_curve"), run_ts)
        curve = snapshots.read(spark, mart("forecast_curve"))
        out["peaks"] = snapshots.publish(scoring.peak(curve), mart("forecast_peak"), run_ts)
        out["trend"] = snapshots.publish(scoring.trend(m, current, run_ts), mart("trend"), run_ts)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
