"""Red-triage alerts: decode, classify, recommend units, publish and store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.windows import latest_per_key, top_per_key
from carelake.schemas import ALERT_STORE, TRIAGE_EVENT
from carelake.sources.sinks import BUCKET, insert_or_ignore, keyed_schema, read_or_empty

RED = "VERMELHO"

# Vital sign, red below this value, and its text in the reason.
RED_RULES = (("spo2", 90, "SpO2=", "%"), ("glasgow", 9, "Glasgow=", ""), ("pas", 80, "PAS=", "mmHg"))


def decode(raw: DataFrame) -> DataFrame:
    """(value) JSON text with its parsed event; text that cannot be read, or whose
    timestamp names no instant, gives a NULL event."""
    # A record with a field of the wrong type must not pass half-read.
    parsed = F.from_json(
        "value",
        T.StructType([*TRIAGE_EVENT.fields, T.StructField("_bad", T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )
    fields = TRIAGE_EVENT.fieldNames()
    event = F.struct(*[F.col(f"_e.{f}").alias(f) for f in fields])
    dated = F.col("_e.timestamp").try_cast("timestamp").isNotNull()
    readable = F.col("_e").isNotNull() & F.col("_e._bad").isNull() & dated
    return raw.withColumn("_e", parsed).withColumn("event", F.when(readable, event)).drop("_e")


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("event").isNull()).select("value")


def events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("event").isNotNull()).select("event.*")


def is_red() -> Column:
    """Any vital sign below its limit; a missing sign never counts."""
    hits = [F.coalesce(F.col(name) < limit, F.lit(False)) for name, limit, _, _ in RED_RULES]
    return hits[0] | hits[1] | hits[2]


def reason() -> Column:
    """'SpO2=88%, Glasgow=7': the signs that hit, in fixed order."""
    parts = [
        F.when(F.col(name) < limit, F.concat(F.lit(head), F.col(name).cast("string"), F.lit(tail)))
        for name, limit, head, tail in RED_RULES
    ]
    return F.concat_ws(", ", *parts)


def valid_place() -> Column:
    return F.coalesce(F.length(F.col("municipio_residencia").cast("string")) == 6, F.lit(False))


def alerts(events_df: DataFrame) -> DataFrame:
    """Red events from a usable municipality, with class and reason."""
    return (
        events_df.where(is_red() & valid_place())
        .withColumn("classificacao", F.lit(RED))
        .withColumn("criterio", reason())
    )


def rejected_place(events_df: DataFrame) -> DataFrame:
    return events_df.where(is_red() & ~valid_place())


def open_units(beds: DataFrame, facilities: DataFrame, latest_only: bool = False) -> DataFrame:
    """(cnes, codufmun, leitos_sus) of units with public beds, at their newest address.

    Beds are summed over all months unless latest_only is set.
    """
    c = F.col
    place = latest_per_key(
        facilities.select("cnes", "codufmun", "competencia"),
        ["cnes"],
        [c("competencia").desc_nulls_last()],
    ).select("cnes", "codufmun")
    if latest_only:
        newest = beds.groupBy("cnes").agg(F.max("competencia").alias("competencia"))
        beds = beds.join(newest, ["cnes", "competencia"], "left_semi")
    total = beds.groupBy("cnes").agg(F.sum("qt_sus").alias("leitos_sus"))
    return total.where(c("leitos_sus") > 0).join(place.where(c("codufmun").isNotNull()), "cnes")


UNITS_TYPE = "array<struct<cnes:string,codufmun:string,leitos_sus:bigint,distancia_grupo:int>>"


def _prefix(place: Column) -> Column:
    return F.substring(place, 1, 4)


def rank_units(units: DataFrame, n: int = 3) -> DataFrame:
    """(chave, lista): the best units of every municipality (six digits, n of them) and of
    every 4-digit prefix (2n), most beds first. At most n of a municipality's own and n
    others of its prefix can be recommended, so this is all that an alert needs to meet."""
    c = F.col
    best_first = F.struct((-c("leitos_sus")).alias("a"), c("cnes").alias("b"), c("codufmun").alias("m"))
    keyed = units.withColumn("_o", best_first)
    own = _best_list(keyed.withColumn("chave", c("codufmun")), n)
    near = _best_list(keyed.withColumn("chave", _prefix(c("codufmun"))), 2 * n)
    return own.unionByName(near)


def _best_list(units: DataFrame, n: int) -> DataFrame:
    ranked = top_per_key(units, ["chave"], [F.col("_o")], n)
    return ranked.groupBy("chave").agg(F.array_sort(F.collect_list("_o")).alias("lista"))


RANKED = "chave string, lista array<struct<a:bigint,b:string,m:string>>, versao string"


def publish_units(beds: DataFrame, facilities: DataFrame, path: str, version: str, n: int = 3, latest_only: bool = False) -> str:
    """Rank the units of all months up to now under `path` as a version, for instance the
    newest month: run when a month arrives. A version published again replaces itself."""
    rank_units(open_units(beds, facilities, latest_only), n).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/versao={version}"
    )
    return version


def newest_units(spark, path: str) -> DataFrame:
    """The ranked units of the newest version; folder names alone say which."""
    versions = spark.read.schema(RANKED).parquet(path)
    newest = versions.agg(F.max("versao")).first()[0]
    return versions.where(F.col("versao") == F.lit(newest)).select("chave", "lista")


def recommend(alerts_df: DataFrame, ranked: DataFrame, n: int = 3) -> DataFrame:
    """Alerts with the n best units: of their own municipality first, then of those that
    share its 4-digit prefix. An alert with none keeps an empty array."""
    c = F.col
    own = ranked.select(c("chave").alias("municipio_residencia"), c("lista").alias("_own"))
    near = ranked.select(c("chave").alias("_p"), c("lista").alias("_near"))
    as_unit = lambda group: lambda u: F.struct(
        u["b"].alias("cnes"),
        u["m"].alias("codufmun"),
        (-u["a"]).alias("leitos_sus"),
        F.lit(group).alias("distancia_grupo"),
    )
    none = F.array().cast(UNITS_TYPE)
    others = F.filter("_near", lambda u: u["m"] != c("municipio_residencia"))
    units = F.concat(
        F.coalesce(F.transform("_own", as_unit(0)), none), F.coalesce(F.transform(others, as_unit(1)), none)
    )
    joined = (
        alerts_df.withColumn("_p", _prefix(c("municipio_residencia")))
        .join(own, "municipio_residencia", "left")
        .join(near, "_p", "left")
    )
    return joined.withColumn("unidades_recomendadas", F.slice(units, 1, n)).drop("_p", "_own", "_near")


def recommend_units(
    alerts_df: DataFrame,
    beds: DataFrame,
    facilities: DataFrame,
    n: int = 3,
    latest_only: bool = False,
) -> DataFrame:
    """Alerts with their recommended units, ranked from the tables themselves."""
    return recommend(alerts_df, rank_units(open_units(beds, facilities, latest_only), n), n)


def alert_message(recommended: DataFrame) -> DataFrame:
    """The published form of an alert."""
    return recommended.select(
        "id_evento",
        "classificacao",
        "criterio",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(
            "ts_processado"
        ),
        F.col("municipio_residencia").alias("municipio_origem"),
        "unidades_recomendadas",
    )


def alert_row(recommended: DataFrame) -> DataFrame:
    """The stored form of an alert."""
    c = F.col
    return recommended.select(
        "id_evento",
        c("timestamp").try_cast("timestamp").alias("ts_recebido"),
        F.current_timestamp().alias("ts_processado"),
        "paciente_anon",
        "municipio_residencia",
        "classificacao",
        c("criterio").alias("criterio_vermelho"),
        "spo2",
        "glasgow",
        "pas",
        "idade",
        "sexo",
        "queixa",
        F.to_json("unidades_recomendadas").alias("recomendacao_json"),
    )


def store_alerts(recommended: DataFrame, path: str) -> None:
    insert_or_ignore(alert_row(recommended), path, ALERT_STORE, "id_evento", [F.col("ts_recebido")])


def read_alerts(spark, path: str) -> DataFrame:
    return spark.read.schema(keyed_schema(ALERT_STORE)).parquet(path).drop(BUCKET)


def recent_alerts(store: DataFrame, n: int = 50) -> DataFrame:
    return store.orderBy(F.col("ts_processado").desc(), F.col("id_evento")).limit(n)


def process_batch(
    load_units: Callable[[], DataFrame],
    publish: Callable[[DataFrame, int], None],
    store_path: str,
    dead_letter_path: str,
    n: int = 3,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch body. load_units gives the ranked units, for instance newest_units: a
    version published since is seen by the next batch, and no batch aggregates beds. What
    feeds several writes is persisted for the length of the batch. publish takes the
    messages and the batch id, by which a retried batch can be told from a new one."""

    def run(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch.select("value")).persist()
        try:
            dead_letters(decoded).withColumn("batch", F.lit(batch_id)).write.mode(
                "overwrite"
            ).option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(
                dead_letter_path
            )
            found = recommend(alerts(events(decoded)), load_units(), n).persist()
            try:
                publish(alert_message(found), batch_id)
                store_alerts(found, store_path)
            finally:
                found.unpersist()
        finally:
            decoded.unpersist()

    return run


def start(
    raw: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
):
    """Start the alert query over a (value) stream; once=True drains what is there."""
    writer = raw.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def split_late(path: str, delay: str = "10 minutes") -> Callable[[DataFrame, int], None]:
    """foreachBatch body that parts rows in time from late ones, by `ts`.

    A row is late if it lies more than the delay before the newest `ts` of earlier batches:
    what a watermark would drop silently is kept in {path}/late, the rest goes to
    {path}/ontime for the next query. {path}/marks has the newest `ts` of each batch, from
    which a retried batch takes the same cut and replaces what it wrote.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, c = batch.sparkSession, F.col
        marks = read_or_empty(spark, f"{path}/marks", "ate timestamp, batch bigint")
        newest = marks.where(c("batch") < batch_id).agg(F.max("ate")).first()[0]  # one row a batch
        kept = batch.persist()
        try:
            kept.agg(F.max("ts").alias("ate")).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
            late = F.lit(False) if newest is None else c("ts") < F.lit(newest) - F.expr(f"interval {delay}")
            kept.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            kept.where(~F.coalesce(late, F.lit(False))).write.mode("overwrite").parquet(f"{path}/ontime/batch={batch_id}")
        finally:
            kept.unpersist()

    return run


def deduplicate(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Repeated events dropped while their state lives; later repeats are caught by
    the store. Needs id_evento and an event time `ts`."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id_evento"])


def request_outcomes(
    requests: DataFrame,
    outcomes: DataFrame,
    within: str = "4 hours",
    delay: str = "10 minutes",
    unanswered: bool = False,
) -> DataFrame:
    """Each transfer request with the outcomes that follow it within the interval.

    Works on two streams (watermarks bound the state) or on two tables. With `unanswered`,
    a request whose interval ends without an outcome comes too, once both streams have
    passed it, with NULLs in the outcome's place.
    """
    c = F.col
    left = requests.withWatermark("ts_pedido", delay).alias("p")
    right = outcomes.withWatermark("ts_desfecho", delay).alias("d")
    on = (
        (c("p.id_pedido") == c("d.id_pedido"))
        & (c("d.ts_desfecho") >= c("p.ts_pedido"))
        & (c("d.ts_desfecho") <= c("p.ts_pedido") + F.expr(f"interval {within}"))
    )
    return left.join(right, on, "left" if unanswered else "inner").select(
        "p.id_pedido",
        "p.ts_pedido",
        "d.ts_desfecho",
        "d.desfecho",
        (
            F.unix_micros(c("d.ts_desfecho").cast("timestamp"))
            - F.unix_micros(c("p.ts_pedido").cast("timestamp"))
        ).alias("espera_us"),
    )
