"""Pattern counts against all pairs, estimated weights against the truth, delivered rows."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from carelake.operators import linkage, linkage_weights
from carelake.operators.linkage_weights import agreement_patterns, estimate_probabilities, estimated_weights

ROW = "cnes string, data date, sexo int, idade int"


def records(rng, n):
    day = lambda: date(2023, 12, 20) + timedelta(rng.randrange(25)) if rng.random() < 0.95 else None
    return [(rng.choice(["1", "1", "1", "2", None]), day(), rng.choice([1, 3, None]), rng.choice([*range(20, 30), None])) for _ in range(n)]


def test_patterns_against_all_pairs(spark):
    rng = random.Random(3)
    left, right = records(rng, 150), records(rng, 120)
    expected = Counter({(s, g, d): 0 for s in (0, 1) for g in (0, 1) for d in (0, 1)})
    for a in left:
        for b in right:
            if a[0] is not None and a[0] == b[0] and a[1] and b[1] and a[1].year == b[1].year:
                sex = int(a[2] is not None and a[2] == b[2])
                age = int(None not in (a[3], b[3]) and abs(a[3] - b[3]) <= 1)
                expected[sex, age, int(abs((a[1] - b[1]).days) <= 1)] += 1
    got = agreement_patterns(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW))
    assert {(r.sexo, r.idade, r.data): r.pares for r in got.collect()} == dict(expected)
    none = agreement_patterns(spark.createDataFrame([], ROW), spark.createDataFrame(right, ROW))
    assert none.agg(F.sum("pares")).first()[0] == 0
    assert estimate_probabilities(none)["share"] == 0.0


def test_estimates_find_the_truth(spark):
    rng = random.Random(5)
    people = [(str(rng.randrange(40)), date(2024, 1, 10) + timedelta(rng.randrange(340)), rng.choice([1, 3]), rng.randrange(0, 90)) for _ in range(4000)]
    right = []
    for cnes, day, sex, age in people[:2500]:
        sex = sex if rng.random() < 0.93 else 4 - sex
        age = age if rng.random() < 0.9 else rng.randrange(0, 90)
        day = day if rng.random() < 0.97 else date(2024, 1, 10) + timedelta(rng.randrange(340))
        right.append((cnes, day, sex, age))
    weights = estimated_weights(spark.createDataFrame(people, ROW), spark.createDataFrame(right, ROW))
    (m_sex, u_sex), (m_age, u_age), (m_day, u_day) = (weights[x] for x in ("sexo", "idade", "data"))
    assert m_sex == pytest.approx(0.93, abs=0.03) and m_age == pytest.approx(0.9, abs=0.04) and m_day == pytest.approx(0.97, abs=0.03)
    assert u_sex == pytest.approx(0.5, abs=0.02) and u_age == pytest.approx(3 / 90, abs=0.01) and u_day == pytest.approx(3 / 340, abs=0.004)
    # They are the weights that link_scored takes.
    adm = spark.createDataFrame([(f"a{i}", *p) for i, p in enumerate(people[:300])], f"id_aih string, {ROW}")
    dth = spark.createDataFrame([(f"d{i}", *p) for i, p in enumerate(right[:300])], f"id_obito string, {ROW}")
    found = {r.id_obito: r.id_aih for r in linkage.link_scored(adm, dth, 8.0, probabilities=weights).collect()}
    right_ones = sum(found.get(f"d{i}") == f"a{i}" for i in range(300))
    assert right_ones > 220 and right_ones >= 0.95 * len(found)


def test_delivered_rows_and_infants(spark):
    adm = spark.createDataFrame(
        [("1", "7", "43", "20240105", "3", "10", "5", "1"), ("2", "7", "43", "20240105", "3", "10", "4", "1")],
        "N_AIH string, CNES string, MUNIC_RES string, DT_SAIDA string, SEXO string, IDADE string, COD_IDADE string, MORTE string",
    )
    dth = spark.createDataFrame(
        [("9", "7", "43", "05012024", "2", "510", "1"), ("8", "7", "43", "05012024", "9", "410", "1"), ("6", "7", "43", "05012024", "2", "410", "3")],
        "CONTADOR string, CODESTAB string, CODMUNRES string, DTOBITO string, SEXO string, IDADE string, LOCOCOR string",
    )
    got = linkage.link_exact(linkage.delivered_admissions(adm), linkage.delivered_deaths(dth)).collect()
    assert [(r.id_aih, r.id_obito, r.idade) for r in got] == [("1", "9", 110)]
    young = spark.createDataFrame(
        [("1", "7", "43", "03032024", "203", "20"), ("2", "7", "43", "03032024", "112", "x"), ("3", "7", "43", "03032024", "301", "20"), ("4", "7", "43", None, "203", "20")],
        "CONTADOR string, CODESTAB string, CODMUNRES string, DTOBITO string, IDADE string, IDADEMAE string",
    )
    born = {r.id_obito: (r.data, r.idade) for r in linkage.infant_deaths(young).collect()}
    assert born == {"1": (date(2024, 2, 29), 20), "2": (date(2024, 3, 3), None)}


def test_patterns_plan_holds_no_join_of_records(spark):
    """The driver plans the joins one after another; what is left is over eight rows."""
    rng = random.Random(7)
    sides = [spark.createDataFrame(records(rng, 200), ROW) for _ in range(2)]
    plan = agreement_patterns(*sides)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("NestedLoopJoin") == plan.count("Join") == 1, plan


def test_estimates_collect_from_a_plan_without_joins_of_records(spark, monkeypatch):
    plans, given = [], linkage_weights.estimate_probabilities
    seen = lambda patterns: plans.append(patterns._jdf.queryExecution().executedPlan().toString()) or given(patterns)
    monkeypatch.setattr(linkage_weights, "estimate_probabilities", seen)
    rng = random.Random(8)
    weights = estimated_weights(*[spark.createDataFrame(records(rng, 100), ROW) for _ in range(2)])
    assert set(weights) == {"sexo", "idade", "data"} and [p.count("Join") for p in plans] == [1]
