"""Triage stream over the events table, drained with the file source."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.plans.roles import bed, fac, query, role_sql
from carelake.session import shared_path
from carelake.sources.sinks import BUCKET, insert_or_ignore, keyed_schema
from carelake.streaming import triage

c = F.col

_EVENT_FIELDS = triage.TRIAGE_EVENT.fieldNames()


#: Files of a micro-batch.
FILES = 64


def _stream(t, name: str):
    """A driver table as a stream of its files, a bounded number a batch. The pattern
    matches the table whether it is one file or a folder of parts; the stream source takes
    no plain file path. The files are in no order of time: no watermark on these."""
    reader = t.spark.readStream.option("maxFilesPerTrigger", FILES)
    return reader.schema(t(name).schema).parquet(f"{t.folder}/{name}.parque[t]")


def _messages(events):
    """Events as JSON text; every 40th is cut short and cannot be read."""
    from carelake.plans.roles import TRIAGE

    text = F.to_json(F.struct(*[F.expr(TRIAGE[n]).alias(n) for n in _EVENT_FIELDS]))
    broken = F.expr("substring(v, 1, length(v) - 3)")
    return events.select("event_id", text.alias("v")).select(
        F.when(c("event_id") % 40 == 0, broken).otherwise(c("v")).alias("value")
    )


def _drain(t, stream, write) -> str:
    """Run a streaming query over what is there, twice on one checkpoint (the second
    run must add nothing), and return the folder it wrote."""
    out = shared_path(t.spark, "stream")
    for _ in range(2):
        query_ = (
            stream.writeStream.foreachBatch(lambda df, i: write(df, i, out))
            .option("checkpointLocation", f"{out}-checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query_.awaitTermination()
    return out


def _append(df, batch_id, out):
    """Batch-numbered partition: a retried batch replaces its own rows."""
    df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch").parquet(out)


def _through_stream(t, transform):
    stream = transform(triage.decode(_messages(_stream(t, "events"))))
    out = _drain(t, stream, _append)
    return t.spark.read.schema(stream.schema).parquet(out).drop("batch")


EVENTS = f"(select * from {role_sql('triage', *_EVENT_FIELDS)} e where cast(id_evento as bigint) % 40 <> 0)"
_RED = "(coalesce(spo2 < 90, false) or coalesce(glasgow < 9, false) or coalesce(pas < 80, false))"
_REASON = """concat_ws(', ', case when spo2 < 90 then 'SpO2=' || spo2 || '%' end, case when glasgow < 9 then 'Glasgow=' || glasgow end,
    case when pas < 80 then 'PAS=' || pas || 'mmHg' end)"""
ALERTS = f"(select * from {EVENTS} v where {_RED} and coalesce(length(municipio_residencia) = 6, false))"


@query(
    "stream_decode",
    f'select id_evento, "timestamp", municipio_residencia, spo2, glasgow, pas, idade, sexo, queixa, paciente_anon from {EVENTS} v',
)
def stream_decode(t):
    return _through_stream(t, triage.events)


@query("stream_classify", f"select id_evento, {_RED} as vermelho from {EVENTS} v")
def stream_classify(t):
    return _through_stream(
        t, lambda d: triage.events(d).select("id_evento", triage.is_red().alias("vermelho"))
    )


@query("stream_reason", f"select id_evento, {_REASON} as criterio from {EVENTS} v where {_RED}")
def stream_reason(t):
    return _through_stream(
        t,
        lambda d: triage.events(d)
        .where(triage.is_red())
        .select("id_evento", triage.reason().alias("criterio")),
    )


@query(
    "stream_filter",
    f"""select id_evento, municipio_residencia, case when coalesce(length(municipio_residencia) = 6, false) then 'alerta' else 'rejeitado' end as destino
    from {EVENTS} v where {_RED}""",
)
def stream_filter(t):
    def split(decoded):
        seen = triage.events(decoded)
        kept = triage.alerts(seen).select("id_evento", "municipio_residencia")
        lost = triage.rejected_place(seen).select("id_evento", "municipio_residencia")
        return kept.withColumn("destino", F.lit("alerta")).unionByName(
            lost.withColumn("destino", F.lit("rejeitado"))
        )

    return _through_stream(t, split)


@query(
    "stream_dead_letter",
    f"""select count(*) as ilegiveis, count(distinct event_id) as distintos from (select event_id from events where event_id % 40 = 0) e""",
)
def stream_dead_letter(t):
    """Unreadable texts: how many, and how many events they name."""
    event = F.regexp_extract("value", '"id_evento":"([0-9]+)"', 1).cast("bigint")
    return _through_stream(t, triage.dead_letters).agg(
        F.count(F.lit(1)).alias("ilegiveis"), F.countDistinct(event).alias("distintos")
    )


_UNIT_BEDS = ("cnes", "qt_sus", "competencia")
_UNIT_FAC = ("cnes", "codufmun", "competencia")
_UNITS = f"""(select cnes, codufmun, leitos_sus from (select cnes, cast(sum(qt_sus) as bigint) as leitos_sus from {bed(*_UNIT_BEDS)} b group by cnes) b
    join (select cnes, codufmun from {fac(*_UNIT_FAC)} f qualify row_number() over (partition by cnes order by competencia desc) = 1) f using (cnes)
    where leitos_sus > 0)"""
RECOMMENDED = f"""(select id_evento, rk, cnes, codufmun, leitos_sus, g from (
    select a.id_evento, u.*, case when codufmun = municipio_residencia then 0 else 1 end as g,
      row_number() over (partition by id_evento order by case when codufmun = municipio_residencia then 0 else 1 end, leitos_sus desc, cnes) as rk
    from {ALERTS} a join {_UNITS} u on left(u.codufmun, 4) = left(municipio_residencia, 4)) x where rk <= 3)"""
_JSON = """'{"cnes":"' || cnes || '","codufmun":"' || codufmun || '","leitos_sus":' || leitos_sus || ',"distancia_grupo":' || g || '}'"""


@query(
    "recommend_units",
    f"""select a.id_evento, {_REASON} as criterio, municipio_residencia as municipio_origem,
    coalesce(j, '[]') as unidades from {ALERTS} a left join
    (select id_evento, '[' || string_agg({_JSON}, ',' order by rk) || ']' as j from {RECOMMENDED} r group by 1) r using (id_evento)""",
)
def recommend_units(t):
    """Published alerts of the whole stream, units as JSON text."""
    published, _ = _alert_stream(t)
    message = f"id_evento string, criterio string, municipio_origem string, unidades_recomendadas {triage.UNITS_TYPE}"
    return t.spark.read.schema(message).parquet(published).select(
        "id_evento",
        "criterio",
        "municipio_origem",
        F.to_json("unidades_recomendadas").alias("unidades"),
    )


@query(
    "alert_store",
    f"""select a.id_evento, cast("timestamp" as timestamp) as ts_recebido, paciente_anon, municipio_residencia, 'VERMELHO' as classificacao,
    {_REASON} as criterio_vermelho, spo2, glasgow, pas, idade, sexo, queixa, coalesce(j, '[]') as recomendacao_json, true as processado
    from {ALERTS} a left join (select id_evento, '[' || string_agg({_JSON}, ',' order by rk) || ']' as j from {RECOMMENDED} r group by 1) r using (id_evento)""",
)
def alert_store(t):
    """The stored rows of the whole stream; the moment of processing only as present."""
    _, store = _alert_stream(t)
    rows = triage.read_alerts(t.spark, store)
    stamp = c("ts_recebido").cast("timestamp_ntz").alias("ts_recebido")
    kept = [n for n in rows.columns if n not in ("ts_recebido", "ts_processado")]
    return rows.select(stamp, *kept, c("ts_processado").isNotNull().alias("processado"))


def _alert_stream(t) -> tuple[str, str]:
    """Folders of the published messages and of the store, after the whole stream."""
    published = shared_path(t.spark, "published")
    store = shared_path(t.spark, "alerts")
    ranked = shared_path(t.spark, "units")
    triage.publish_units(t.beds(*_UNIT_BEDS), t.facilities(*_UNIT_FAC), ranked, "2001-11")

    def publish(df, batch_id):  # a retried batch replaces what it published
        _append(df, batch_id, published)

    run = triage.process_batch(lambda: triage.newest_units(t.spark, ranked), publish, store, f"{store}-dead")
    triage.start(
        _messages(_stream(t, "events")), run, f"{store}-checkpoint", once=True
    ).awaitTermination()
    return published, store


# Ids repeat every third event, so the store must keep the first of each.
_KEYED = T.StructType(
    [
        T.StructField("id_evento", T.LongType()),
        T.StructField("ts_recebido", T.TimestampNTZType()),
        T.StructField("valor", T.DoubleType()),
    ]
)


@query(
    "stream_insert_or_ignore",
    """select cast(event_id // 3 as bigint) as id_evento, min(ts) as ts_recebido, arg_min(value, ts) as valor from events group by 1""",
)
def stream_insert_or_ignore(t):
    rows = _stream(t, "events").selectExpr(
        "cast(event_id div 3 as bigint) as id_evento", "ts as ts_recebido", "value as valor"
    )

    def write(df, batch_id, out):
        for _ in range(2):  # a redelivered batch changes nothing
            insert_or_ignore(df, out, _KEYED, "id_evento", [c("ts_recebido")])

    out = _drain(t, rows, write)
    return t.spark.read.schema(keyed_schema(_KEYED)).parquet(out).drop(BUCKET)


@query(
    "recent_alerts",
    """select id_evento, ts_processado from (select cast(event_id // 3 as bigint) as id_evento, min(ts) as ts_processado from events group by 1) a
    order by ts_processado desc, id_evento limit 50""",
)
def recent_alerts(t):
    store = stream_insert_or_ignore(t).select(
        "id_evento", c("ts_recebido").alias("ts_processado")
    )
    return triage.recent_alerts(store, 50)


SLICES = 4
_SLICE = f"least((epoch_us(ts) - a) * {SLICES} // (b - a + 1), {SLICES - 1})"
_BOUNDS = "(select epoch_us(min(ts)) as a, epoch_us(max(ts)) as b from events) lim"
#: One event in fifty is delivered two files late.
_DELIVERED = f"""delivered as (select *, case when event_id % 50 = 0 then least(s + 2, {SLICES - 1}) else s end as f
      from (select *, {_SLICE} as s from events, {_BOUNDS}) x),
    cut as (select f, max(max(ts)) over (order by f rows between unbounded preceding and 1 preceding) - interval 1 day as mark from delivered group by f),
    placed as (select d.*, coalesce(ts < mark, false) as late from delivered d join cut using (f))"""


def _delivered(t, delayed: bool, closing=None):
    """The events as a stream of files in order of time, one file a batch, as a source
    delivers them. With `delayed`, some come two files late; `closing` rows are a last file."""
    events = t("events").withColumn("ts", c("ts").cast("timestamp"))
    first, last = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    place = F.expr(f"least((unix_micros(ts) - {first or 0}L) * {SLICES} div {(last or 0) - (first or 0) + 1}L, {SLICES - 1})")
    if delayed:
        place = F.when(c("event_id") % 50 == 0, F.least(place + 2, F.lit(SLICES - 1))).otherwise(place)
    path = shared_path(t.spark, "delivered")
    for number in range(SLICES):
        events.where(place == number).coalesce(1).write.mode("append").parquet(path)
    if closing is not None:
        end = F.timestamp_micros(F.lit((last or 0) + 10 * 86_400_000_000))
        t.spark.range(1).select(*[closing.get(n, end if n == "ts" else F.lit(None)).cast(k).alias(n) for n, k in events.dtypes]).coalesce(1).write.mode("append").parquet(path)
    return lambda: t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _finish(writer, out: str) -> None:
    writer.option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()


def _parted(t) -> str:
    """Folder of the delivered events parted into those in time and late ones."""
    out = shared_path(t.spark, "parted")
    _finish(_delivered(t, True)().select("event_id", "ts").writeStream.foreachBatch(triage.split_late(out, "1 day")), out)
    return out


@query("stream_late", f"with {_DELIVERED} select event_id, ts from placed where late")
def stream_late(t):
    """Events that came more than a day behind what had been seen."""
    return t.spark.read.schema("event_id bigint, ts timestamp").parquet(f"{_parted(t)}/late").select(
        "event_id", c("ts").cast("timestamp_ntz").alias("ts")
    )


@query("stream_dedupe", f"with {_DELIVERED} select distinct event_id // 2 as id_evento from placed where not late")
def stream_dedupe(t):
    """Repeats dropped over several batches, while the watermark moves on."""
    parted = _parted(t)
    folders = t.spark.readStream.schema("event_id bigint, ts timestamp").option("maxFilesPerTrigger", 2)
    rows = folders.parquet(f"{parted}/ontime/batch=*").select(F.expr("event_id div 2").alias("id_evento"), "ts")
    out = shared_path(t.spark, "deduplicated")
    _finish(triage.deduplicate(rows, "1 day").select("id_evento").writeStream.format("parquet").option("path", out), out)
    return t.spark.read.schema("id_evento bigint").parquet(out)


_REQUEST = "user_id * 1000 + event_id div 100"
_ANSWERS = """p as (select user_id * 1000 + event_id // 100 as id_pedido, ts as ts_pedido from events where event_type = 'click'),
    d as (select user_id * 1000 + event_id // 100 as id_pedido, ts as ts_desfecho, event_type as desfecho from events where event_type in ('purchase', 'error'))"""


@query(
    "stream_interval_join",
    f"""with {_ANSWERS}
    select p.id_pedido, ts_pedido, ts_desfecho, desfecho, epoch_us(ts_desfecho) - epoch_us(ts_pedido) as espera_us
    from p left join d on p.id_pedido = d.id_pedido and ts_desfecho between ts_pedido and ts_pedido + interval 4 hour""",
)
def stream_interval_join(t):
    """Requests and outcomes as two streams of ordered files, unanswered requests included.
    A last file of one request and one outcome, far ahead and with a negative id, moves the
    watermark past all others, as the next files would."""
    key = F.expr(_REQUEST).alias("id_pedido")
    sides = {}
    for side, kinds in (("click", ["click"]), ("purchase", ["purchase", "error"])):
        read = _delivered(t, False, {"event_type": F.lit(side), "user_id": F.lit(-1), "event_id": F.lit(-1)})
        sides[side] = read().where(c("event_type").isin(kinds))
    requests = sides["click"].select(key, c("ts").alias("ts_pedido"))
    outcomes = sides["purchase"].select(key, c("ts").alias("ts_desfecho"), c("event_type").alias("desfecho"))
    out = shared_path(t.spark, "outcomes")
    found = triage.request_outcomes(requests, outcomes, "4 hours", "1 hour", unanswered=True)
    _finish(found.writeStream.format("parquet").option("path", out), out)
    return t.spark.read.schema(found.schema).parquet(out).where("id_pedido >= 0").withColumns(
        {n: c(n).cast("timestamp_ntz") for n in ("ts_pedido", "ts_desfecho")}
    )
