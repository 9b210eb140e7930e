import os
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import __spark_entry__ as E
from airshed.ml import dataset, model, scoring
from airshed.operators.joins import horizon_samples, hourly_training_rows

T0 = datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"


def grid(spark, stations=3, hours=48):
    rows = [(f"s{s}", T0 + timedelta(hours=h), float((h % 24) * 3 + s)) for s in range(stations)
            for h in range(hours)]
    df = spark.createDataFrame(rows, "station string, time timestamp, v double")
    aq = df.select("station", "time", F.col("v").alias("pm25"), (F.col("v") * 2).alias("pm10"),
                   F.lit(1.0).alias("no2"), F.lit(2.0).alias("o3"), (F.col("v") + 10).alias("aqi"))
    wx = df.select("station", "time", F.lit(28.0).alias("temp_c"), F.lit(70.0).alias("humidity_pct"),
                   F.lit(2.0).alias("wind_speed_ms"))
    return horizon_samples(hourly_training_rows(aq, wx))


def test_node_statistics_fit_a_small_executor_and_do_not_change_the_forest(spark):
    rf = model.build_pipeline().getStages()[-1]
    assert 4 * rf.getMaxMemoryInMB() <= 1024  # four tasks of one executor
    rows = model._as_features(grid(spark, 2, 30)).cache()

    def forest(mb):
        stages = model.build_pipeline(3, 6).getStages()
        return model.Pipeline(stages=[stages[0], stages[1].copy({stages[1].maxMemoryInMB: mb})]).fit(rows).stages[-1]

    one, other = (forest(mb).toDebugString.split("\n", 1)[1] for mb in (1, 1024))
    assert one == other


def test_gate_split_train_save_load_score(spark, tmpdir_path):
    with pytest.raises(ValueError):
        dataset.check_size(grid(spark, 1, 4))
    samples = grid(spark)
    tr, te = dataset.split(samples)
    n, a, b = samples.count(), tr.count(), te.count()
    assert a + b == n and 0.7 < a / n < 0.9
    t = model.train(samples, num_trees=5, max_depth=8)
    assert t.n_stations == 3 and t.r2 > 0.5
    assert model.importances(spark, t).count() == 12
    path = os.path.join(tmpdir_path, "model")
    model.save(t, path, spark)
    m = model.load(path)
    meta = spark.read.json(f"{path}_meta").first()
    assert meta.n_samples == n and meta.feature_order[0] == "pm25"
    with pytest.raises(FileNotFoundError):
        model.load(os.path.join(tmpdir_path, "missing"))
    cur = spark.createDataFrame([("s0", 5.0, None, 0.0, 1.0, 2.0, 0.0, None, 1.0, 1.0, 28.0, 70.0, 2.0)],
                                "station string, latest_aqi double, latest_pm25 double, latest_pm10 double, "
                                "latest_no2 double, latest_o3 double, avg_aqi double, avg_pm25 double, "
                                "avg_pm10 double, avg_no2 double, temp_c double, humidity_pct double, "
                                "wind_speed_ms double").withColumn("avg_o3", F.lit(1.0))
    curve = scoring.curve(m, cur, "2024-02-01T00:00:00+00:00")
    rows = curve.collect()
    assert len(rows) == 25 and rows[0].valid_time == "2024-02-01T07:00:00+07:00"
    assert all(r.aqi_predicted >= 0 for r in rows)
    pk = scoring.peak(curve).first()
    assert pk.peak_aqi == max(r.aqi_predicted for r in rows)
    tr_ = scoring.trend(m, cur, "2024-02-01T00:00:00+00:00").first()
    assert tr_.trend in ("up", "down", "flat") and tr_.current_aqi == 5.0
    rows = scoring.request_rows(spark.createDataFrame(
        [("q1", "s", None, 3, [0, 6]), ("q2", "s", 25, 1, None)],
        "request_id string, station string, hour int, dayofweek int, horizons array<int>"))
    scored = scoring.score_requests(m, rows).orderBy("horizon_h").collect()
    assert [(r.request_id, r.horizon_h) for r in scored] == [("q1", 0), ("q1", 6)]
    assert all(r.aqi_predicted >= 0 and r.category for r in scored)
    assert [r.rejected for r in scoring.request_rejects(rows).collect()] == ["hour"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_aqi" in df.columns


def test_registry_has_oracle_for_sql_queries():
    q, o = E.queries(), E.oracle_sql()
    rows_only = {"train_metrics", "feature_importance", "nowcast", "forecast_curve", "forecast_peak", "trend",
                 "forecast_downsample", "top_features", "dashboard_forecast", "request_forecast"}
    training_data = {n for n in q if n.startswith("op") and n[2].isdigit()} | {"pipeline"}
    assert set(o) - training_data == set(q) - rows_only - training_data


@pytest.mark.parametrize("name", ["gold_stations", "gold_traffic", "combined", "horizon_samples",
                                  "overview", "sensor_pivot", "source_fallback", "map_points"])
def test_queries_match_duckdb_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["events", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(r[c] for c in cols) for r in sdf.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted((tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want


def test_results_do_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = E.queries()["aqi_silver"](spark, SF).orderBy("station", "timestamp").limit(3).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ts = rows[0].timestamp
    assert rows[0].date == ts[:10] and rows[0].hour == int(ts[11:13])


def test_downsample_and_dims(spark):
    from airshed.sources import dims
    curve = spark.createDataFrame([(h,) for h in range(25)], "horizon_h long")
    assert [r.horizon_h for r in scoring.downsample(curve).collect()] == list(range(0, 25, 3))
    assert dims.stations(spark).count() == 10 and dims.corridors(spark).count() == 10


def one_tree(spark, monkeypatch, local_rows, rows=900, depth=12):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    from airshed.ml import forest
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(forest, "OPEN_NODES", 3)
    df = spark.range(rows).select(*[(F.pmod(F.hash("id", F.lit(i)), F.lit(20)).cast("double")).alias(f"x{i}")
                                    for i in range(3)], F.pmod(F.hash("id"), F.lit(1000)).cast("double").alias("y"))
    df = df.withColumn("y", F.col("y") + 100 * F.col("x0") + F.when(F.col("x1") > 7, 500).otherwise(0)).cache()
    features = ["x0", "x1", "x2"]
    mine = forest.fit(df, "y", features, 1, depth, 5, None, 1)
    theirs = DecisionTreeRegressor(labelCol="y", maxDepth=depth, minInstancesPerNode=5).fit(
        VectorAssembler(inputCols=features, outputCol="features").transform(df))
    both = theirs.transform(VectorAssembler(inputCols=features, outputCol="features").transform(
        mine.transform(df).withColumnRenamed("prediction", "mine"))).select("mine", "prediction").collect()
    return mine, theirs, both


@pytest.mark.parametrize("local_rows,depth", [(10_000, 12), (60, 12), (60, 3)])
def test_a_tree_is_that_of_mllib_wherever_its_branches_begin(spark, monkeypatch, local_rows, depth):
    mine, theirs, both = one_tree(spark, monkeypatch, local_rows, depth=depth)
    assert len(both) == 900 and len({r.mine for r in both}) > 4
    assert all(abs(r.mine - r.prediction) < 1e-6 for r in both)
    assert max(abs(mine.importances - theirs.featureImportances.toArray())) < 1e-9


def test_no_forest_is_broadcast_or_collected(spark, monkeypatch):
    """The model that scores is a folder of branches: what the driver keeps does not grow with the leaves."""
    from airshed.ml import forest
    t = model.train(grid(spark), num_trees=4, max_depth=9)
    nodes = spark.read.parquet(f"{t.model.path}/parts").where("part >= 0").selectExpr(
        f"sum(length(nodes)) / {forest.NODE.itemsize} as n").first().n
    assert nodes > 100 and sum(map(len, t.model.tops.values())) == 4
    again = model.train(grid(spark).repartition(5), num_trees=4, max_depth=9)
    assert [again.mae, again.r2] == pytest.approx([t.mae, t.r2], rel=1e-9)  # the draws don't depend on the layout
    few = scoring.score_requests(t.model, scoring.request_rows(spark.createDataFrame(
        [(f"q{i}", "s", i % 24, i % 7, [0, 6]) for i in range(50)],
        "request_id string, station string, hour int, dayofweek int, horizons array<int>")))
    want = sorted(few.collect())
    monkeypatch.setattr(forest, "LOCAL_ROWS", 7)  # branches copied for shares of the rows
    assert sorted(few.collect()) == want
    again = scoring.score_requests(t.model, scoring.request_rows(spark.createDataFrame(
        [(f"q{i}", "s", i % 24, i % 7, [0, 6]) for i in range(50)],
        "request_id string, station string, hour int, dayofweek int, horizons array<int>")))
    assert sorted(again.collect()) == want


def test_the_forest_scores_like_that_of_mllib(spark):
    samples = grid(spark, 4, 60).withColumn("aqi_target", F.col("aqi_target") + F.pmod(
        F.hash("station", "time", "horizon_h"), F.lit(30))).cache()
    t = model.train(samples, num_trees=20, max_depth=12)
    tr, te = (model._as_features(x) for x in dataset.split(samples))
    mllib = model.build_pipeline(20, 12).fit(tr)
    mae, r2 = model.evaluate(mllib.transform(te))
    assert abs(t.mae - mae) < 0.15 * mae and abs(t.r2 - r2) < 0.05
    theirs = mllib.stages[-1].featureImportances.toArray()
    assert max(abs(t.model.importances - theirs)) < 0.1


def test_rows_of_many_trees_pass_to_their_branches_in_small_batches():
    """A task holds a few MB of what it sends to the branches, not the rows of all trees; none is lost."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from airshed.ml import forest
    n, trees, start = 10_000, 140, 7
    r = np.random.default_rng(1)
    bins, keys, ids = r.integers(0, 32, (12, n)).astype(np.uint8), r.integers(-2**62, 2**62, n), np.arange(n) + start
    top = np.array([(0, 15, 1, 0.0), (forest.BRANCH, 0, 0, 0.0), (forest.LEAF, 0, 0, 0.0)], forest.NODE)
    tops, big, whole = dict.fromkeys(range(trees), top), pa.binary(), pa.int32()
    for rows, columns in (
            (forest.dealt_rows(tops, bins, keys, keys.astype(float), 1, 0.5),
             [("tree", whole), ("part", whole), ("bins", big), ("y", big), ("draws", big)]),
            (forest.routed_rows(tops, {(0, 1): 2}, bins, ids),
             [("tree", whole), ("part", whole), ("copy", whole), ("block", pa.int64()), ("at", big), ("bins", big)])):
        seen, per_block = {t: [] for t in tops}, {}
        tracemalloc.start()
        for b in forest._batches(rows, columns):
            assert b.nbytes < 1.2 * forest.BATCH_BYTES
            for x in b.to_pylist():
                if "at" in x:
                    at = np.frombuffer(x["at"], "<i4")
                    per_block[x["block"]] = max(per_block.get(x["block"], 0), at.max() + 1)
                    seen[x["tree"]].append((x["block"] + at - start).astype("<i2"))
                    assert (np.frombuffer(x["bins"], np.uint8).reshape(12, -1) == bins[:, seen[x["tree"]][-1]]).all()
                else:
                    assert x["part"] == 1 and len(x["bins"]) == 12 * len(x["draws"])
                    seen[x["tree"]].append(np.zeros(len(x["draws"]), "<i2"))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 12e6
        if per_block:
            assert all((np.sort(np.concatenate(x)) == np.arange(n)).all() for x in seen.values())
            assert max(per_block.values()) <= forest.BLOCK_ROWS
        else:
            left = bins[0] <= 15
            assert all(sum(map(len, seen[t])) == (left & (forest.drawn(keys, t, 1, 0.5) > 0)).sum() for t in tops)


def test_scores_of_rows_in_several_blocks_come_back_whole(spark):
    from airshed.ml import forest
    df = spark.range(10_000).select("id", F.pmod(F.hash("id"), F.lit(40)).cast("double").alias("x"))
    df = df.withColumn("y", F.col("x") * 3 + F.pmod("id", F.lit(7))).cache()
    model_ = forest.fit(df, "y", ["x"], 3, 6, 5, 0.5, 1)
    one, many = (sorted((r.id, r.prediction) for r in model_.transform(x).collect())
                 for x in (df.coalesce(1), df.repartition(9)))
    assert len(one) == 10_000 and one == many


def test_no_row_of_the_driver_passes_through_python_workers(spark):
    """What the driver adds to a forest goes by Arrow. A plain list makes a second set of Python workers, one for
    each core, that stay beside those of the fit."""
    from airshed.ml import forest
    df = spark.range(300).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    found = forest.fit(df, "y", ["x"], 2, 4, 5, 0.5, 1)
    t = model.Trained(found, 300, 1, 0.0, 0.0)
    plain, made = SparkSession.createDataFrame, []
    try:
        SparkSession.createDataFrame = lambda s, data, *a, **k: made.append(type(data).__name__) or plain(s, data, *a, **k)
        again = forest.fit(df, "y", ["x"], 2, 4, 5, 0.5, 1)
        scored = {r.x: r.prediction for r in again.transform(df).collect()}
        rows = model.top_importances(spark, model.Trained(again, 300, 1, 0.0, 0.0), 11)
    finally:
        SparkSession.createDataFrame = plain
    assert set(made) == {"Table"} and len(made) == 4
    assert scored == {r.x: r.prediction for r in found.transform(df).collect()} and len(scored) == 300
    assert rows.schema.simpleString() == "struct<feature:string,importance:double>"
    assert rows.collect() == model.top_importances(spark, t, 11).collect()
    parts = spark.read.parquet(f"{again.path}/parts")
    assert parts.schema.simpleString() == "struct<tree:int,part:int,nodes:binary,gains:array<double>>"
    assert parts.where("part = -1").count() == 2


def test_the_forest_of_the_jvm_is_that_of_python(spark, monkeypatch):
    """Growing and scoring run in the JVM, by the same operations: nodes, gains and scores are equal to the last bit,
    whether branches begin at the root or below upper nodes, with more features than a word holds, with ties."""
    from airshed.ml import forest, native
    jvm = native.kernels
    assert jvm(spark) is not None
    for n, wide, local_rows in ((3_000, 14, 10_000), (4_000, 12, 300), (40, 2, 5)):
        monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
        names = [f"x{i}" for i in range(wide)]
        df = spark.range(n).select(*[F.pmod(F.xxhash64("id", F.lit(i // 2)), F.lit(50 if i else 7)).cast("double")
                                     .alias(c) for i, c in enumerate(names)],
                                   (F.pmod(F.hash("id"), F.lit(97)) / 7 - 3).alias("y")).cache()
        found = []
        for kernels in (jvm, lambda s: None):
            monkeypatch.setattr(native, "kernels", kernels)
            f = forest.fit(df, "y", names, 4, 12, 5, 0.5, 42)
            plan = f.transform(df)._jdf.queryExecution().toString()
            assert ("InArrow" in plan or "InPandas" in plan) == (kernels is not jvm)
            parts = spark.read.parquet(f"{f.path}/parts").collect()
            found.append((sorted((r.tree, r.part, bytes(r.nodes), tuple(r.gains)) for r in parts),
                          sorted(map(tuple, f.transform(df).collect()))))
        assert found[0] == found[1] and len(found[0][1]) == n and len(found[0][0]) >= 4 * (1 + (n > local_rows))
        monkeypatch.setattr(native, "kernels", jvm)
    with pytest.raises(Exception, match="has a null or NaN"):
        forest.fit(df.withColumn("x1", F.lit(None).cast("double")), "y", names, 2, 4, 5, 0.5, 1)
