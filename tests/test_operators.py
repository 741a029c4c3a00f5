import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidebook.functions.windows import rolling_sums, rolling_time
from tidebook.operators import book, excursions, fusion, labels, ml, sampling, splits
from tidebook.sources import adapters


def ticks(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    us = np.sort(rng.integers(0, 300, n)) * 1_000_000  # many ties
    mid = 100 + 0.25 * np.cumsum(rng.integers(-1, 2, n))
    pdf = pd.DataFrame({"day": pd.to_datetime("2026-01-05").date(), "us": us, "seq": range(n), "mid": mid})
    return pdf, spark.createDataFrame(pdf, "day date, us bigint, seq bigint, mid double")


def test_rolling_time_equals_pandas_with_ties(spark):
    pdf, df = ticks(spark)
    out = rolling_time(df, {"m": ("mean", "mid"), "s": ("std", "mid"), "n": ("count", "mid")}, ["day"], "us", ["seq"], 30_000_000).orderBy("seq").toPandas()
    r = pdf.set_index(pd.to_datetime(pdf["us"], unit="us"))["mid"].rolling("30s")
    assert np.allclose(out["m"], r.mean()) and np.allclose(out["s"], r.std().fillna(0)) and (out["n"].to_numpy() == r.count().to_numpy()).all()


def test_rolling_time_has_no_frame_by_row_and_keeps_odd_values_in_their_windows(spark):
    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 200, 300)) * 1_000_000
    x = rng.normal(size=300).astype(object)
    x[40], x[90], x[91], x[150:170] = 1e18, float("nan"), float("inf"), None
    rows = [("a", int(t), i, v, i % 7) for i, (t, v) in enumerate(zip(us, x))] + [("b", None, 300, 1.0, 1), ("b", 5, 301, 2.0, 2)]
    df = spark.createDataFrame(rows, "day string, us bigint, seq bigint, x double, k int")
    width = 10_000_000
    out = rolling_time(df, {"m": ("mean", "x"), "s": ("std", "x"), "n": ("count", "x"), "k_sum": ("sum", "k")}, ["day"], "us", ["seq"], width)
    assert "RangeFrame" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.seq: r for r in out.collect()}
    assert len(got) == 302 and (got[300].m, got[300].n, got[301].m) == (1.0, 1, 2.0)
    for i, t in enumerate(us):
        seen = [j for j in range(i + 1) if us[j] > t - width]
        v = np.array([x[j] for j in seen if x[j] is not None], dtype=float)
        with np.errstate(invalid="ignore"):
            m, s = (v.mean() if len(v) else 0.0), (v.std(ddof=1) if len(v) > 1 else 0.0)
        assert got[i].n == len(v) and got[i].k_sum == sum(j % 7 for j in seen)
        assert np.isclose(got[i].m, m, equal_nan=True) and np.isclose(got[i].s, s, equal_nan=True), (i, got[i], m, s)


def test_enrich_takes_the_latest_trade_of_a_millisecond(spark):
    trades = spark.createDataFrame([("a", 1200, 9, "buy", 5), ("a", 1700, 2, "sell", 7), ("a", 1700, 1, "buy", 3), ("a", 2100, 3, "buy", 11)], "day string, us bigint, seq bigint, side string, size bigint")
    events = spark.createDataFrame([("a", 1900, 4), ("a", 2500, 5), ("a", 3000, 6)], "day string, us bigint, seq bigint")
    out = fusion.enrich(events, trades).orderBy("seq").collect()
    assert [(r.trade_side, r.trade_size, r.cum_trade_delta_session) for r in out] == [("none", 0, 0), ("sell", 7, -7), ("buy", 11, 4)]


def test_long_sums_equal_frames(spark):
    _, df = ticks(spark, 1500)
    a = rolling_sums(df, {"x": F.col("mid")}, ["day"], ["seq"], 600)
    w = F.sum("mid").over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("day").orderBy("seq").rowsBetween(-599, 0))
    assert a.withColumn("y", w).filter("abs(x - y) > 1e-6").count() == 0


def test_book_invariants(spark, sf_dir):
    s = book.states(adapters.commands(spark, sf_dir))
    snaps = book.snapshots(s)
    assert snaps.filter("best_bid >= best_ask").count() == 0
    assert s.filter("size(bid_px) > 10 OR size(ask_px) > 10").count() == 0
    assert s.filter(~F.col("bid_px").eqNullSafe(F.reverse(F.array_sort("bid_px"))) | ~F.col("ask_px").eqNullSafe(F.array_sort("ask_px"))).count() == 0
    one = s.filter("seq = 37").collect()
    again = book.states(adapters.commands(spark, sf_dir).repartition(7)).filter("seq = 37").collect()
    assert one == again


def test_cusum_state_stays_in_band_and_ignores_partitioning(spark):
    pdf, df = ticks(spark)
    d = sampling.deltas(df)
    h = spark.createDataFrame([(pdf["day"][0], 0.5)], "day date, h double")
    got = [(r["seq"], r["s"]) for r in sampling.cusum(d.repartition(5), h).orderBy("seq").collect()]
    total, want = 0.0, []
    for i, x in enumerate(np.diff(pdf["mid"], prepend=pdf["mid"][0])):
        total += x
        if abs(total) > 0.5:
            want.append((i, total))
            total = 0.0
    assert got == want


def test_excursion_kernel_equals_frames(spark):
    _, df = ticks(spark)
    a = excursions.search(df, df, 40_000_000).orderBy("seq").toPandas()
    b = excursions.search_frames(df, 40_000_000).orderBy("seq").toPandas()
    for c in ("mid_price_at_t", "max_mid", "min_mid", "n_obs", "last_us"):
        assert (a[c].to_numpy() == b[c].to_numpy()).all(), c


def test_excursion_after_the_last_snapshot_is_zero(spark):
    pdf, df = ticks(spark)
    late = df.limit(1).select("day", F.lit(10**12).alias("us"), F.lit(10**6).alias("seq"))
    r = excursions.excursions(late, df, 1_000_000).first()
    assert r["n_obs"] == 0 and r["mid_price_at_t"] == 0 and r["window_complete"] == 0


def test_first_touch_by_hand_and_symmetry(spark):
    day = pd.to_datetime("2026-01-05").date()
    df = spark.createDataFrame([(day, i, i, m) for i, m in enumerate((100.0, 100.25, 99.75))], "day date, us bigint, seq bigint, mid double")
    grid = labels.candidates(spark, ((3, 4.0, 4.0), (3, 1.0, 1.0)))
    got = {(r["seq"], r["pt_ticks"]): (r["label"], r["hit_price"]) for r in labels.first_touch(df, df, grid).collect()}
    assert got[0, 4.0] == (0, 0.0) and got[0, 1.0] == (1, 100.25) and got[1, 1.0] == (-1, 99.75)
    _, t = ticks(spark)
    g = labels.candidates(spark, ((40, 4.0, 4.0),))
    up = {r["seq"]: r["label"] for r in labels.first_touch(t, t, g).collect()}
    mirrored = t.withColumn("mid", 300 - F.col("mid"))
    down = {r["seq"]: r["label"] for r in labels.first_touch(mirrored, mirrored, g).collect()}
    assert up == {k: -v for k, v in down.items()}


def test_walk_forward_small(spark):
    df = spark.createDataFrame([("a",), ("b",)], "day string")
    assert {r["day"]: r["split"] for r in splits.walk_forward(df).collect()} == {"a": "val", "b": "test"}


def test_models_and_importance(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    pdf = pd.DataFrame(x, columns=["f1", "f2", "f3"]).assign(seq=range(300), label=np.where(x[:, 0] > 0.4, 1, np.where(x[:, 0] < -0.4, -1, 0)), flat=1.0, hit_price=1.0)
    df = spark.createDataFrame(pdf)
    assert ml.feature_columns(df, ["f1", "f2", "f3", "flat", "hit_price"]) == ["f1", "f2", "f3"]
    data = ml.balanced(ml.matrix(df, ["f1", "f2", "f3"]))
    model = ml.models(["f1", "f2", "f3"])["logistic"].fit(data)
    scores = {"logistic": ml.evaluate(ml.predictions(model, data, ["seq"]))}
    assert scores["logistic"]["accuracy"] > 0.8 and ml.select(scores) == "logistic"
    assert ml.importance(spark, model, ["f1", "f2", "f3"]).first()["feature"] == "f1"


def test_empty_tables_are_fine(spark, sf_dir):
    none = adapters.commands(spark, sf_dir).limit(0)
    assert book.snapshots(book.states(none)).count() == 0
    _, df = ticks(spark)
    e = df.limit(0)
    assert sampling.threshold(sampling.deltas(e)).count() == 0
    assert labels.first_touch(e, e, labels.candidates(spark)).count() == 0
    assert excursions.excursions(e, e, 1_000_000).count() == 0


def test_crossings_equal_a_plain_fold():
    import numpy as np

    from tidebook.operators.sampling import crossings

    rng = np.random.default_rng(4)
    for n, h in ((0, 1.0), (1, 0.1), (500, 0.5), (20_000, 40.0), (3000, 1e9), (300, 0.0)):
        d = rng.normal(size=n)
        want, total = [], 0.25
        for i, x in enumerate(d):
            total += x
            if abs(total) > h:
                want.append((i, total))
                total = 0.0
        places, sums, rest = crossings(d, h, 0.25)
        assert list(zip(places.tolist(), sums.tolist())) == want and rest == total
