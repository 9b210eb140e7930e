"""Averages drop nothing, hours count once, a moved station is one station, and bronze follows the
stream's commit log."""

import math
import shutil

import pytest
from pyspark.sql import functions as F

from airshed.functions.numeric import exact_avg
from airshed.operators import joins, serving
from airshed.sources import bronze


@pytest.mark.parametrize("values", [[1.0, 1e13], [1.0, 3e-7], [1.0, float("nan")], [0.1, 0.2, None],
                                    [None], [1e300, -5.0]])
def test_average_drops_nothing(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got, want = df.agg(exact_avg("v"), F.avg("v")).first()
    if want is None or math.isnan(want):
        assert got is None if want is None else math.isnan(got)
    else:
        assert got == pytest.approx(want, rel=1e-15)


def test_repeated_hour_counts_once(spark):
    aq = spark.sql("""SELECT 's' station, timestamp'2024-01-01 00:00:00' time, 1D pm25, 1D pm10, 1D no2,
                      1D o3, a aqi FROM VALUES (5D), (9D) t(a)""")
    wx = spark.sql("""SELECT 's' station, timestamp'2024-01-01 00:00:00' time, 1D temp_c,
                      1D humidity_pct, 1D wind_speed_ms""")
    assert [r.aqi for r in joins.hourly_training_rows(aq, wx).collect()] == [5.0]


def test_moved_station_is_one_station(spark):
    gold = spark.sql("""SELECT 's' station, lat, 1D lon, 10D avg_aqi, aqi latest_aqi, at last_updated
                        FROM VALUES (1D, 20D, '2024-01-01'), (2D, 60D, '2024-01-02') t(lat, aqi, at)""")
    from airshed.functions import constants as K
    weather = spark.createDataFrame([], "station string, last_updated string, "
                                    + ", ".join(f"{c} double" for c in K.WEATHER_FIELDS))
    got = serving.station_current(gold, weather).collect()
    assert [(r.station, r.lat, r.current_aqi) for r in got] == [("s", 2.0, 60.0)]


def test_stray_file_is_not_read(spark, tmp_path):
    """A part file that the stream never committed does not count."""
    src, root = tmp_path / "in", str(tmp_path / "bronze")
    src.mkdir()
    (src / "a.json").write_text('{"station": "s1", "dir": "aqi", "ingest_date": "2024-01-01"}\n')
    q = (spark.readStream.schema("station string, dir string, ingest_date date").json(str(src))
         .writeStream.format("json").partitionBy("dir", "ingest_date").option("path", root)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    at = next((tmp_path / "bronze" / "dir=aqi").rglob("*.json"))
    shutil.copy(at, at.with_name("part-stray.json"))
    assert bronze.read_bronze(spark, root, "aqi").count() == 1
