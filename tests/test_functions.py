import math


from airshed.functions import (aqi_category, clamp_prediction, compass_point, congestion_level,
                               congestion_ratio, current_value, default_fill, exact_avg,
                               pretty_name, round_half_even, target_parts, trend_label, uv_band)


def one_col(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_aqi_category_batch_and_serving(spark):
    vals = [0.0, 50.0, 50.1, 100.0, 150.0, 151.0, 200.0, 300.0, 300.5, 500.0, None, float("nan")]
    df = one_col(spark, vals).select("x", aqi_category("x").alias("b"),
                                     aqi_category("x", "Unknown").alias("s"))
    got = {(r.x if r.x is None or not math.isnan(r.x) else "nan"): (r.b, r.s) for r in df.collect()}
    assert got[0.0] == ("Good", "Good")
    assert got[50.0][0] == "Good" and got[50.1][0] == "Moderate"
    assert got[150.0][0] == "Unhealthy for Sensitive Groups" and got[151.0][0] == "Unhealthy"
    assert got[300.0][0] == "Very Unhealthy" and got[300.5][0] == "Hazardous"
    assert got[None] == ("Hazardous", "Unknown")      # batch null falls through; serving Unknown
    assert got["nan"][0] == "Hazardous"


def test_congestion_level_bands(spark):
    vals = [0.0, 0.19, 0.2, 0.4, 0.6, 0.8, 1.0, None]
    got = [r[0] for r in one_col(spark, vals).select(congestion_level("x")).collect()]
    assert got == ["Free Flow", "Free Flow", "Light", "Moderate", "Heavy", "Severe", "Severe", "Severe"]


def test_congestion_ratio_rounds_before_banding(spark):
    df = spark.createDataFrame([(40.0, 50.0), (0.0, 0.0), (60.0, 50.0), (10.0, 50.0)], "c double, f double")
    got = [r[0] for r in df.select(congestion_ratio("c", "f")).collect()]
    assert got == [0.2, 1.0, 0.0, 0.8]


def test_uv_band_and_compass(spark):
    got = [r[0] for r in one_col(spark, [0.0, 2.0, 2.1, 5.0, 7.0, 10.0, 11.0, None, float("nan")])
           .select(uv_band("x")).collect()]
    assert got == ["Low", "Low", "Moderate", "Moderate", "High", "Very High", "Extreme", "—", "—"]
    got = [r[0] for r in one_col(spark, [0.0, 22.5, 44.0, 90.0, 337.4, 337.5, 360.0, None, -100.0,
                                         float("nan"), float("inf")])
           .select(compass_point("x")).collect()]
    assert got == ["N", "NE", "NE", "E", "NW", "N", "N", "", "", "", ""]


def test_pretty_name_keeps_rest_of_word(spark):
    got = [r[0] for r in one_col(spark, ["jakarta-pusat", "tb-simatupang", "a--b", "mIxed-CASE", "", None],
                                 "string").select(pretty_name("x")).collect()]
    assert got == ["Jakarta Pusat", "Tb Simatupang", "A  B", "MIxed CASE", "", ""]


def test_default_fill_replaces_zero(spark):
    got = [r[0] for r in one_col(spark, [0.0, None, 21.5]).select(default_fill("x", 30.0)).collect()]
    assert got == [30.0, 30.0, 21.5]


def test_current_value_and_trend(spark):
    df = spark.createDataFrame([(None, 5.0), (3.0, 5.0)], "l double, a double")
    assert [r[0] for r in df.select(current_value("l", "a")).collect()] == [5.0, 3.0]
    got = [r[0] for r in one_col(spark, [1.5, 1.0, -1.0, -1.5, None]).select(trend_label("x")).collect()]
    assert got == ["up", "flat", "flat", "down", ""]


def test_rounding_and_clamp(spark):
    got = [r[0] for r in one_col(spark, [2.5, 3.5, 0.125, -0.04, 12.34]).select(
        round_half_even("x", 0).alias("a")).collect()]
    assert got == [2.0, 4.0, 0.0, -0.0, 12.0]
    got = [r[0] for r in one_col(spark, [-3.2, 41.26, 0.04]).select(clamp_prediction("x")).collect()]
    assert got == [0.0, 41.3, 0.0]


def test_exact_avg_ignores_nulls_and_is_exact(spark):
    df = one_col(spark, [0.1, 0.2, None, 0.3])
    assert df.agg(exact_avg("x")).first()[0] == 0.6 / 3
    assert one_col(spark, [None]).agg(exact_avg("x")).first()[0] is None


def test_target_rollover(spark):
    df = spark.createDataFrame([(23, 6, 1), (12, 0, 24), (0, 3, 0)], "h int, d int, k int")
    th, td = target_parts("h", "d", "k")
    assert [tuple(r) for r in df.select(th, td).collect()] == [(0, 0), (12, 1), (0, 3)]


def test_padded_id_matches_printf(spark):
    from airshed.functions.text import padded_id
    vals = [0, 7, 42, 9999, 12345, -5, None]
    got = [r[0] for r in one_col(spark, vals, "bigint").select(padded_id("co-", "x", 4)).collect()]
    assert got == ["co-0000", "co-0007", "co-0042", "co-9999", "co-12345", "co--005", None]
