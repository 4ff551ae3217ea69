"""The alert stream, end to end over files."""

import json
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.sources.sinks import bucket_of, insert_or_ignore, stored_keys
from carelake.streaming import triage

c = F.col


def event(i, **kw):
    base = {
        "id_evento": f"e{i}", "timestamp": f"2024-01-01T00:00:{i:02d}", "paciente_anon": "p", "municipio_residencia": "430010",
        "spo2": 95, "glasgow": 15, "pas": 120, "queixa": "dor", "idade": 50, "sexo": "M",
    }
    return json.dumps({**base, **kw})


def test_red_rule_and_reason(spark):
    rows = [(89, 15, 120), (90, 15, 120), (95, 8, 120), (95, 9, 120), (95, 15, 79), (95, 15, 80), (None, None, None), (88, 7, 120)]
    df = spark.createDataFrame(rows, "spo2 int, glasgow int, pas int").coalesce(1)
    got = df.select(triage.is_red().alias("r"), triage.reason().alias("t")).collect()
    assert [r.r for r in got] == [True, False, True, False, True, False, False, True]
    assert got[0].t == "SpO2=89%" and got[4].t == "PAS=79mmHg" and got[7].t == "SpO2=88%, Glasgow=7"
    assert got[6].t == ""


def units(spark):
    beds = spark.createDataFrame(
        [("1", 5, date(2024, 1, 1)), ("1", 5, date(2024, 2, 1)), ("2", 9, date(2024, 1, 1)), ("3", 50, date(2024, 1, 1)),
         ("4", 0, date(2024, 1, 1)), ("5", 7, date(2024, 1, 1)), ("6", 99, date(2024, 1, 1)), ("7", 8, date(2024, 1, 1))],
        "cnes string, qt_sus int, competencia date",
    )
    fac = spark.createDataFrame(
        [("1", "430010", date(2024, 1, 1)), ("2", "430011", date(2023, 1, 1)), ("2", "430010", date(2024, 1, 1)),
         ("3", "430012", date(2024, 1, 1)), ("4", "430010", date(2024, 1, 1)), ("5", "430013", date(2024, 1, 1)),
         ("6", "990010", date(2024, 1, 1)), ("7", None, date(2024, 1, 1))],
        "cnes string, codufmun string, competencia date",
    )
    return beds, fac


def test_recommendation_order(spark):
    beds, fac = units(spark)
    places = spark.createDataFrame([("430010",), ("430019",), ("880000",)], "municipio_residencia string")
    rank = lambda **kw: {
        r.municipio_residencia: [(u.cnes, u.leitos_sus, u.distancia_grupo) for u in r.unidades_recomendadas]
        for r in triage.recommend_units(places, beds, fac, **kw).collect()
    }
    got = rank()
    # Own units first (beds over all months), then neighbours by the 4-digit prefix.
    assert got["430010"] == [("1", 10, 0), ("2", 9, 0), ("3", 50, 1)]
    assert got["430019"] == [("3", 50, 1), ("1", 10, 1), ("2", 9, 1)]
    assert got["880000"] == []
    assert rank(latest_only=True)["430010"][0] == ("2", 9, 0)


def test_stream_is_idempotent_and_isolates_bad_events(spark, tmp_path):
    inbox, store, dead, ranked = (str(tmp_path / x) for x in ("in", "store", "dead", "units"))
    triage.publish_units(*units(spark), ranked, "2024-01")
    published = []
    first = [
        event(1, spo2=80), event(2), event(3, pas=70, municipio_residencia="43001"), event(4, glasgow=3, municipio_residencia=430010),
        '{"id_evento": "cut', event(5, spo2="high"), event(7, spo2=70, timestamp="yesterday"), event(8, spo2=70, timestamp=None), event(6, spo2=80, municipio_residencia="880000"), event(1, spo2=70, timestamp="2024-01-01T02:00:00+03:00"),
    ]
    spark.createDataFrame([(x,) for x in first], "value string").coalesce(1).write.text(inbox)
    raw = spark.readStream.schema("value string").text(inbox)
    run = triage.process_batch(
        lambda: triage.newest_units(spark, ranked), lambda df, batch_id: published.extend(df.collect()), store, dead
    )
    check = str(tmp_path / "check")
    triage.start(raw, run, check, once=True).awaitTermination()
    stored = {r.id_evento: r for r in spark.read.parquet(store).collect()}
    assert set(stored) == {"e1", "e4", "e6"}
    assert stored["e1"].spo2 == 70 and stored["e6"].recomendacao_json == "[]"
    assert stored["e4"].municipio_residencia == "430010"
    assert spark.read.parquet(dead).count() == 4
    assert len(published) == 4
    # The same event in a later batch changes nothing; a new one is added.
    spark.createDataFrame([(event(1, spo2=60),), (event(9, spo2=60),)], "value string").coalesce(1).write.mode("append").text(inbox)
    triage.start(raw, run, check, once=True).awaitTermination()
    again = {r.id_evento: r.spo2 for r in spark.read.parquet(store).collect()}
    assert set(again) == {"e1", "e4", "e6", "e9"} and again["e1"] == 70
    triage.start(raw, run, check, once=True).awaitTermination()
    assert spark.read.parquet(store).count() == 4
    assert triage.recent_alerts(spark.read.parquet(store), 1).first().id_evento == "e9"


def test_store_reads_only_the_buckets_of_a_batch(spark, tmp_path):
    path, schema = str(tmp_path / "store"), T.StructType().add("k", "string").add("v", "integer")
    rows = spark.createDataFrame([(f"k{i % 300}", i) for i in range(600)], schema)
    insert_or_ignore(rows, path, schema, "k", [c("v")])
    assert spark.read.parquet(path).count() == 300 and spark.read.parquet(path).agg(F.max("v")).first()[0] == 299
    batch = spark.createDataFrame([("k5", 9), ("new", 9), ("new", 3), (None, 1)], schema)
    touched = [r[0] for r in batch.where("k is not null").select(bucket_of("k")).distinct().collect()]
    keys = stored_keys(spark, path, schema, "k", touched)
    assert "PartitionFilters: [balde" in keys._jdf.queryExecution().executedPlan().toString()
    files = {f.split("balde=")[1].split("/")[0] for f in keys.inputFiles()}
    assert len(touched) == 2 and files
    insert_or_ignore(batch, path, schema, "k", [c("v")])
    insert_or_ignore(batch, path, schema, "k", [c("v")])
    stored = spark.read.parquet(path)
    assert stored.count() == 301 and stored.where("k = 'new'").first().v == 3
    insert_or_ignore(batch.limit(0), path, schema, "k", [c("v")])


def test_units_by_version(spark, tmp_path):
    beds, fac = units(spark)
    path = str(tmp_path / "units")
    alert = spark.createDataFrame([("e", "430010"), ("f", None)], "id string, municipio_residencia string")
    for month, n in (("2024-01", 3), ("2024-02", 4)):
        seen = beds.where(c("competencia") <= f"{month}-01")
        triage.publish_units(seen, fac, path, month)
        got = {r.id: [(u.cnes, u.leitos_sus) for u in r.unidades_recomendadas] for r in triage.recommend(alert, triage.newest_units(spark, path)).collect()}
        assert got == {"e": [("2", 9), ("1", 5), ("3", 50)] if month == "2024-01" else [("1", 10), ("2", 9), ("3", 50)], "f": []}


def test_late_rows_are_kept_apart(spark, tmp_path):
    at = lambda *minutes: spark.createDataFrame([(m, datetime(2024, 1, 1, 0, 0) + timedelta(minutes=m)) for m in minutes], "i int, ts timestamp")
    run = triage.split_late(str(tmp_path), "10 minutes")
    for number, batch in enumerate([at(0, 30), at(19, 20, 5, 60), at(45, 55)]):
        run(batch, number)
        run(batch, number)  # a retried batch gives the same
    side = lambda name: sorted(r.i for r in spark.read.parquet(str(tmp_path / name)).collect())
    assert side("late") == [5, 19, 45] and side("ontime") == [0, 20, 30, 55, 60]


def test_requests_without_an_outcome(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    requests = spark.createDataFrame([(1, t(0)), (2, t(0)), (3, t(5))], "id_pedido int, ts_pedido timestamp")
    outcomes = spark.createDataFrame([(1, t(2), "x"), (2, t(9), "y")], "id_pedido int, ts_desfecho timestamp, desfecho string")
    got = {(r.id_pedido, r.desfecho) for r in triage.request_outcomes(requests, outcomes, unanswered=True).collect()}
    assert got == {(1, "x"), (2, None), (3, None)}
