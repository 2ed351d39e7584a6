"""Ranks, bands and running totals against plain Python, with heavy ties."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenderlake.operators import windows
from tests.conftest import rows

LABELS = ["Very High", "High", "Medium", "Low", "Very Low"]


def expected_bands(scores, total):
    order = sorted(scores, key=lambda kv: (-kv[1], kv[0]))
    n = round(total * 0.042)
    bands = {}
    for i, (key, _) in enumerate(order):
        if i < int(n * 0.10):
            bands[key] = LABELS[0]
        elif i < int(n * 0.30):
            bands[key] = LABELS[1]
        elif i < int(n * 0.60):
            bands[key] = LABELS[2]
        else:
            bands[key] = LABELS[3] if i <= n else LABELS[4]
    return bands


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5), min_size=1, max_size=400), st.integers(1, 10))
def test_bands_match_a_full_sort(spark, values, factor):
    scores = [(f"k{i:04d}", v / 5.0) for i, v in enumerate(values)]
    df = spark.createDataFrame(scores, "key string, score double")
    got = windows.band_by_rank(df, "score", "key", len(scores) * factor, "band")
    assert dict(rows(got, "key", "band")) == expected_bands(scores, len(scores) * factor)


def test_bands_with_one_score_for_a_third_of_the_rows(spark):
    scores = [(f"k{i:05d}", 0.9 if i % 3 == 0 else i / 7000.0) for i in range(6000)]
    df = spark.createDataFrame(scores, "key string, score double")
    got = windows.band_by_rank(df, "score", "key", 6000, "band")
    assert dict(rows(got, "key", "band")) == expected_bands(scores, 6000)


def test_bands_prune_low_scores_in_a_large_table(spark):
    df = spark.range(1_200_000).select(
        F.format_string("%07d", "id").alias("key"), (F.col("id") * 7919 % 1000 / F.lit(1000.0)).alias("score")
    )
    got = windows.band_by_rank(df, "score", "key", 1_200_000, "band").groupBy("band").count()
    assert dict(rows(got)) == {"Very High": 5040, "High": 10080, "Medium": 15120, "Low": 20161, "Very Low": 1149599}


def test_bands_without_a_sort(spark, monkeypatch):
    """Cuts inside one score that many keys share are found by the keys' bytes, whatever their kind."""
    monkeypatch.setattr(windows, "_FEW", 3)
    names = sorted({f"{'é' * (i % 3)}key-{i * 7919 % 5000:x}-{i % 11}" for i in range(3000)}) + [""]
    scores = [(k, 0.5 if i % 4 else float(-i)) for i, k in enumerate(names)]
    df = spark.createDataFrame(scores, "key string, score double")
    want = sorted(scores, key=lambda r: (-r[1], r[0].encode()))
    places = [0, 1, 77, 1500, 2100, len(scores) - 1, len(scores)]
    found, n = windows._rows_at(df, "score", "key", places)
    assert n == len(scores) and {p: (r["key"], r["score"]) for p, r in found.items()} == {p: want[p] for p in places[:-1]}
    numbers = [(i * 7919 % 3001 - 1500, 1.0) for i in range(3001)] + [(1 << 40, 1.0), (-(1 << 62), 1.0)]
    df = spark.createDataFrame(numbers, "key long, score double")
    found, _ = windows._rows_at(df, "score", "key", places[:5])
    assert {p: r["key"] for p, r in found.items()} == {p: sorted(k for k, _ in numbers)[p] for p in places[:5]}
    same = spark.range(5000).selectExpr("'k' as key", "1.0d as score")
    assert windows._rows_at(same, "score", "key", [4000])[0][4000]["key"] == "k"


def test_bands_shuffle_no_scores(spark, capsys):
    df = spark.range(50_000).selectExpr("cast(id as string) as key", "id % 97 / 97.0d as score")
    label = windows.band_label(df, "score", "key", 50_000)
    df.withColumn("band", label).explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_rank_by_is_a_dense_numbering(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 50).alias("v"), F.col("id").alias("key"))
    got = rows(windows.rank_by(df, [F.col("v").desc(), F.col("key").asc()], "pos"), "pos", "v", "key")
    want = sorted(((i * 37 % 50, i) for i in range(5000)), key=lambda t: (-t[0], t[1]))
    assert sorted(got) == [(i, v, k) for i, (v, k) in enumerate(want)]


def test_group_total_keeps_rows_and_skips_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 5.0), ("b", None)], "k string, v double")
    assert rows(windows.group_total(df, ["k"], "v", "t")) == [
        ("a", 1.0, 1.0), ("a", None, 1.0), ("b", None, 0.0), (None, 5.0, None)]


def test_capacity_share_and_forward_fill(spark):
    df = spark.createDataFrame(
        [(1, "A", date(2020, 1, 1), 3.0), (1, "A", date(2020, 1, 5), 1.0), (1, "Z", date(2020, 1, 1), 0.0)],
        "fiscal int, c string, d date, q double")
    shared = windows.capacity_share(df, ["fiscal", "c"], "d", "q", 1.25)
    got = {(r["c"], r["d"].day): r["fill_rate"] for r in shared.collect()}
    assert got[("A", 1)] == pytest.approx(0.6) and got[("A", 5)] == pytest.approx(0.8) and got[("Z", 1)] is None
    filled = shared.withColumn("f", windows.forward_fill("fill_rate", ["fiscal", "c"], "d"))
    assert {(r["c"], r["f"]) for r in filled.where("c = 'Z'").collect()} == {("Z", 0.0)}


def test_win_probability_steps(spark):
    df = spark.createDataFrame([("k", t, float(t)) for t in range(500)], "key string, tree_id int, price double")
    got = windows.win_probability(df).orderBy("win_probability").collect()
    assert got[0]["win_probability"] == pytest.approx(0.2) and got[0]["price"] == 499.0
    assert got[-1]["win_probability"] == 100.0 and got[-1]["price"] == 0.0


def test_top_names_pads_with_null(spark):
    df = spark.createDataFrame([("k", "b", 1.0), ("k", "a", 1.0)], "key string, n string, v double")
    assert rows(windows.top_names(df, "key", "n", "v", 3, "t")) == [("k", "a", "b", None)]
