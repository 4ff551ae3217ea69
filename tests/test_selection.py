"""Ranks by narrowing ordinals: extreme doubles, dense bands, small bounds, the split."""

import hashlib
import math
import random
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.operators import ml, profile, sketches
from carelake.operators.quantiles import exact_quantiles
from carelake.operators.selection import double_ordinal, rows_at_ranks

INF, NAN = float("inf"), float("nan")


def test_ordinals_follow_the_bits(spark):
    rng = random.Random(4)
    values = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(2000)]
    values += [s * 2.0**e * f for e in range(-1074, 1024, 7) for f in (1.0, 1 + 2**-52, 1.5) for s in (1, -1) if 2.0**e * f < INF]
    values += [math.nextafter(2.0**e, 0) for e in range(-1000, 1000, 9)] + [0.0, -0.0, INF, -INF, 5e-324, 1.7976931348623157e308]
    values = [v for v in values if v == v]
    expected = [struct.unpack("q", struct.pack("d", abs(v)))[0] * (1 if v >= 0 else -1) for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double")
    got = dict(df.select("i", double_ordinal(F.col("v"))).collect())
    assert [got[i] for i in range(len(values))] == expected
    nan = spark.createDataFrame([(NAN,)], "v double").select(double_ordinal(F.col("v"))).first()[0]
    assert nan > max(expected)


@pytest.mark.parametrize("kind", ["tiny", "narrow", "spread", "signs", "copies"])
def test_quantiles_of_dense_bands(spark, kind):
    rng = np.random.default_rng(8)
    values = {
        "tiny": rng.random(4000) * 1e-9,
        "narrow": -30.05 + rng.random(4000) * 0.02,
        "spread": 10.0 ** rng.uniform(-300, 300, 4000),
        "signs": np.concatenate([rng.normal(size=3000), [-0.0, 0.0, 5e-324, -5e-324]]),
        "copies": np.repeat(rng.random(40), 100) * 1e-5,
    }[kind]
    df = spark.createDataFrame([("k", float(v)) for v in values] + [("k", None), (None, 1.0)], "k string, v double")
    probs = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.75, "e": 0.999, "f": 1.0}
    for bound in (10_000, 50, 1):
        got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs, bound=bound).collect()}
        for name, p in probs.items():
            assert got["k"][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=0)
        assert got[None].c == 1.0


def test_quantiles_of_nothing_and_of_the_unbounded(spark):
    empty = spark.createDataFrame([("a", None)], "k string, v double")
    assert exact_quantiles(empty, ["k"], "v", {"m": 0.5}).collect() == []
    data = [("a", v) for v in (1.0, 3.0, INF)] + [("b", v) for v in (NAN, NAN, 2.0)] + [("c", -INF), ("c", -INF)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.m for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}, bound=1).collect()}
    assert got["a"] == 3.0 and math.isnan(got["b"]) and got["c"] == -INF


def test_rows_at_ranks_break_ties_by_order(spark):
    rows = spark.createDataFrame([(1, 5, "b", 1), (1, 5, "a", 1), (1, -7, "z", 3), (2, 9, "q", 1)], "k long, _o long, name string, _n long")
    want = F.expr("array(named_struct('rank', 0L), named_struct('rank', 3L), named_struct('rank', 4L), named_struct('rank', 99L))")
    got = rows_at_ranks(rows, ["k"], lambda r: r.withColumn("_want", want), order=["name"])
    assert sorted((r.k, r.name) for r in got.collect()) == [(1, "a"), (1, "b"), (1, "z"), (2, "q")]


@pytest.mark.parametrize("bound", [10_000, 20, 1])
def test_split_equals_plain_ranking(spark, bound):
    rows = [(i, int(i % 17 == 0)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, morte int")
    got = {r.id: r.split for r in ml.stratified_split(df, F.col("id"), bound=bound).collect()}
    for label in (0, 1):
        ranked = sorted((hashlib.md5(f"42|{i}".encode()).hexdigest(), i) for i, y in rows if y == label)
        order = [got[i] for _, i in ranked]
        assert order == sorted(order, key=["train", "val", "test"].index)
        assert abs(order.count("train") - 0.7 * len(order)) <= 1 and abs(order.count("val") - 0.15 * len(order)) <= 1


# --- profiles by groups of columns


def test_value_table_groups(spark):
    rng = random.Random(6)
    rows = [(str(i), rng.choice(["a", "b", "", None]), rng.randrange(3), rng.choice([1.5, None]), "x") for i in range(400)]
    df = spark.createDataFrame(rows, "i string, t string, n int, d double, k string")
    assert profile.folding_groups({"a": 1, "b": 3, "c": 90, "d": 2}, 100) == [["a", "d", "b"], ["c"]]
    expected = {}
    for row in rows:
        for name, v in zip(df.columns, row):
            key = (name, None if v in (None, "") else str(v))
            expected[key] = expected.get(key, 0) + 1
    for sizes in (None, dict.fromkeys(df.columns, 2), dict.fromkeys(df.columns, 10**9)):
        got = profile.value_table(df, df.columns, sizes).collect()
        assert {(r.coluna, r.valor): r.n for r in got} == expected and len(got) == len(expected)


def test_frequent_values(spark, monkeypatch):
    monkeypatch.setattr(profile, "FEW", 5)
    rng = random.Random(7)
    rows = [(str(i), f"v{int(rng.paretovariate(0.6))}", rng.choice(["", None, "y"])) for i in range(5000)]
    df = spark.createDataFrame(rows, "i string, p string, e string").repartition(6)
    got = {(r.coluna, r.valor): r.n for r in profile.frequent_values(df, df.columns, 0.02).collect()}
    expected = Counter((name, v or None) for row in rows for name, v in zip(df.columns, row))
    assert got == {key: n for key, n in expected.items() if n >= 100}
    assert not any(name == "i" for name, _ in got) and len(got) > 5
    with pytest.raises(ValueError):
        profile.frequent_values(df, ["i"], 0.0001)


def test_column_status_finds_late_values(spark, monkeypatch):
    monkeypatch.setattr(profile, "SAMPLE", 2)
    rows = [("x", None, None, None), ("x", None, "", None), ("x", "q", "", "z"), ("y", "q", None, "w")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string").coalesce(1)
    got = {r.coluna: (r.total, r.nulos, r.distintos, r.status) for r in profile.column_status(df).collect()}
    assert got == {
        "a": (4, 0, 2, "100% preenchida"), "b": (4, 2, 1, "constante"), "c": (4, 4, 0, "100% nula"), "d": (4, 2, 2, "parcialmente nula"),
    }


def test_numeric_summary_of_weighted_values(spark):
    values = [1.0, 1.0, 2.5, 0.0, 0.0, 0.0, -3.0]
    rows = [(str(v), v) for v in values] + [("x", None), (None, None)]
    got = {r.coluna: r for r in profile.numeric_summary(spark.createDataFrame(rows, "t string, d double"), ["t", "d"]).collect()}
    for r in got.values():
        assert (r.n_naonulos, r.n_zeros, r.min, r.max) == (7, 3, -3.0, 2.5)
        assert r.media == pytest.approx(np.mean(values)) and r.std == pytest.approx(np.std(values, ddof=1))
        assert r.p75 == pytest.approx(np.quantile(values, 0.75))


# --- sketches of months


def test_month_sketches(spark, tmp_path):
    rows = [(2020 + i // 12000, 1 + i // 1000 % 12, f"id{i % 20000}", f"s{i % 9}", None if i % 2 else "") for i in range(30000)]
    df = spark.createDataFrame(rows, "ano int, mes int, id string, s string, e string")
    path = str(tmp_path / "sketches")
    assert sketches.write_sketches(df, ["id", "s", "e"], path) == 30 * 3
    stored = sketches.read_sketches(spark, path)

    def period(first, last):
        return {r.coluna: r for r in sketches.distinct_in_period(stored, first, last).collect()}

    whole = period((2020, 1), (2022, 12))
    assert whole["s"].distintos == 9 and whole["s"].exato and whole["e"].distintos == 0 and whole["e"].nulos == 30000
    assert not whole["id"].exato and whole["id"].menor <= 20000 <= whole["id"].maior
    two = period((2020, 12), (2021, 1))
    assert two["id"].distintos == 2000 and two["id"].linhas == 2000
    # A month delivered anew replaces its own sketches.
    sketches.write_sketches(spark.createDataFrame([(2020, 12, "id1", "s", "q")], df.schema), ["id", "s", "e"], path)
    again = {r.coluna: r for r in sketches.distinct_in_period(sketches.read_sketches(spark, path), (2020, 12), (2021, 1)).collect()}
    assert again["id"].distintos == 1001 and again["id"].linhas == 1001 and again["e"].distintos == 1
