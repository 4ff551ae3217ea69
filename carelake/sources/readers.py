"""Raw, reference and stream sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import functions as cf
from carelake.schemas import DEVELOPMENT_COLUMNS, NEIGHBOURHOOD_POPULATION, POPULATION


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared types; a column the files lack becomes NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def read_union(
    spark: SparkSession, groups: list[str] | list[list[str]], schema: T.StructType
) -> DataFrame:
    """Parquet file groups of drifting schema as one table.

    Each group (a path, or a list of paths of one layout) is read with its own
    schema and cast to the declared one before the union: the same column may be
    a number in one delivery and text in another, which a merged schema refuses.
    Group files by layout, not one by one, to keep the plan short.
    """
    parts = [
        conform(spark.read.parquet(*([g] if isinstance(g, str) else g)), schema) for g in groups
    ]
    return reduce(DataFrame.unionByName, parts)


def _per_file(spark: SparkSession, folder: str, names: list[str], look: Callable[[pq.ParquetFile], list]) -> DataFrame:
    """path and text columns of the given names for every parquet file below a folder, as
    `look` finds them. Files are opened in tasks, a few each, from any store that Arrow
    opens by its address."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path")  # the content is not read
    )

    def opened(path: str) -> list:
        uri = quote(path, safe=":/")
        uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
        files, inner = pafs.FileSystem.from_uri(uri)
        with files.open_input_file(inner) as file:
            return look(pq.ParquetFile(file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [opened(p) for p in batch.column(0).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["path", *names])

    schema = ", ".join(f"{n} string" for n in ("path", *names))
    return listed.repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, schema)


def layouts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, layout) of every parquet file below a folder: column names and types, from
    the footer alone."""
    look = lambda file: [", ".join(sorted(f"{f.name} {f.type}" for f in file.schema_arrow))]
    return _per_file(spark, folder, ["layout"], look)


def read_mixed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A folder whose files drift in columns and types as one table of the declared
    columns: files of one layout are one scan, so the plan grows with the layouts and not
    with the files. The driver holds the file names, as any scan does."""
    by_layout: dict[str, list[str]] = {}
    for row in layouts(spark, folder).collect():
        by_layout.setdefault(row.layout, []).append(row.path)
    if not by_layout:
        return spark.createDataFrame([], schema)
    return read_union(spark, [sorted(paths) for _, paths in sorted(by_layout.items())], schema)


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A hive-partitioned folder (or one sample file) whose columns are all text.

    The declared schema is given to the scan: no footer is read to plan it, and
    columns missing from older files come back NULL. Partition columns uf, ano
    and mes are added from the path.
    """
    return spark.read.schema(schema).parquet(path)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """Municipality population; codes stay text so they join the 6-digit codes."""
    return spark.read.schema(POPULATION).csv(path, header=True)


def read_neighbourhood_population(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NEIGHBOURHOOD_POPULATION).csv(path, header=True)


def census_population(doc: DataFrame, period: str = "2022") -> DataFrame:
    """Population rows from the nested census answer; rows without a number are dropped."""
    c = F.col
    series = doc.select(
        F.explode(F.element_at(F.element_at(c("doc"), 1)["resultados"], 1)["series"]).alias("s")
    )
    code = c("s.localidade.id")
    return (
        series.select(
            F.substring(code, 1, 6).alias("cod6"),
            code.alias("cod7"),
            F.regexp_replace("s.localidade.nome", " - [A-Z]{2}$", "").alias("nome"),
            F.try_element_at(c("s.serie"), F.lit(period)).try_cast("int").alias("populacao"),
        )
        .where((F.length("cod7") == 7) & c("populacao").isNotNull())
    )


CENSUS_DOCUMENT = (
    "array<struct<resultados:array<struct<series:array<struct<"
    "localidade:struct<id:string,nome:string>,serie:map<string,string>>>>>>>"
)


def read_census(spark: SparkSession, path: str, period: str = "2022") -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return census_population(text.select(F.from_json("value", CENSUS_DOCUMENT).alias("doc")), period)


def development_index(raw: DataFrame, uf: str = "43", year: str = "2010") -> DataFrame:
    """One state and year of the development index, decimal points, known columns only."""
    present = {src: dst for src, dst in DEVELOPMENT_COLUMNS.items() if src in raw.columns}
    if not present:
        raise ValueError("none of the expected columns is present")
    return raw.where((F.col("UF") == uf) & (F.col("ANO") == year)).select(
        *[cf.decimal_comma(F.col(f"`{src}`")).alias(dst) for src, dst in present.items()]
    )


def read_development_index(spark: SparkSession, path: str, uf="43", year="2010") -> DataFrame:
    return development_index(spark.read.csv(path, sep=";", header=True), uf, year)


def neighbourhood_rows(lines: DataFrame) -> DataFrame:
    """(value) text lines 'name;62.448;4,69' as typed rows, totals left out."""
    c = F.col
    parts = F.split("value", ";")
    name = F.trim(parts[0])
    population = cf.br_number(parts[1])
    share = cf.br_number(parts[2])
    official = cf.alias_name(name)
    return (
        lines.where(F.size(parts) >= 3)
        .where((name != "") & ~F.lower(name).startswith("total"))
        .where(~F.lower(name).startswith("porto alegre"))
        .select(
            official.alias("bairro"),
            population.cast("int").alias("populacao"),
            share.alias("percentual_cidade"),
            cf.accent_key(official).alias("bairro_norm"),
        )
        .where(c("populacao").isNotNull() & c("percentual_cidade").isNotNull())
    )


def read_neighbourhood_census(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 census file: a title and a header line, then the neighbourhoods. A blank
    figure is 0. The file is a reference list and read whole, so that the two leading
    lines are known by their place."""
    content = F.decode("content", "ISO-8859-1")
    lines = spark.read.format("binaryFile").load(path).select(F.posexplode(F.split(content, "\r\n|\r|\n")).alias("place", "value"))
    return neighbourhood_rows(lines.where("place >= 2").select("value"))


def expand_ranges(ranges: DataFrame, width: int = 5) -> DataFrame:
    """(ordem, cep_min, cep_max, bairro) ranges as one row per prefix; the first
    listed range wins where ranges overlap."""
    c = F.col
    prefix = F.explode(F.sequence(c("cep_min").cast("int"), c("cep_max").cast("int")))
    return (
        ranges.select("ordem", "bairro", prefix.alias("_p"))
        .groupBy("_p")
        .agg(F.min_by("bairro", "ordem").alias("bairro"))
        .select(F.lpad(c("_p").cast("string"), width, "0").alias("cep_prefix"), "bairro")
    )


def _first_period(source: str, columns: list[str]) -> Column:
    """(ano, mes) of a raw row, by the rule of its source."""
    have = set(columns)
    text = lambda name: F.col(name).cast("string")
    ym = lambda c: F.struct(
        F.substring(c, 1, 4).try_cast("int").alias("ano"),
        F.substring(c, 5, 2).try_cast("int").alias("mes"),
    )
    yearly = lambda y: F.struct(
        y.try_cast("int").alias("ano"), F.lit(1).alias("mes")
    )
    pair = lambda y, m: F.struct(
        text(y).try_cast("int").alias("ano"), text(m).try_cast("int").alias("mes")
    )
    if source == "sih" and {"ANO_CMPT", "MES_CMPT"} <= have:
        return pair("ANO_CMPT", "MES_CMPT")
    if source == "sih" and {"ANO", "MES"} <= have:
        return pair("ANO", "MES")
    for src, name in (("cnes", "COMPETEN"), ("sia", "PA_CMP"), ("sia", "DT_PROCESS")):
        if source == src and name in have:
            return ym(text(name))
    for src, name in (("sim", "DTOBITO"), ("sinasc", "DTNASC")):
        if source == src and name in have:
            return yearly(F.right(text(name), F.lit(4)))
    if source == "sinan" and "DT_NOTIFIC" in have:
        return yearly(F.substring(text("DT_NOTIFIC"), 1, 4))
    return F.struct(F.lit(None).cast("int").alias("ano"), F.lit(None).cast("int").alias("mes"))


DEFAULT_PERIOD = (2026, 2)


def infer_period(files: DataFrame, source: str) -> DataFrame:
    """(path, ano, mes) per file, by its first row.

    Only the period columns are scanned; every split of a file but the one with
    its first row yields nothing, and no shuffle is needed.
    """
    period = _first_period(source, files.columns)
    known = period["ano"].isNotNull() & period["mes"].isNotNull()
    pick = lambda name, default: F.when(known, period[name]).otherwise(default)
    return files.where(F.col("_metadata.row_index") == 0).select(
        F.col("_metadata.file_path").alias("path"),
        pick("ano", DEFAULT_PERIOD[0]).alias("ano"),
        pick("mes", DEFAULT_PERIOD[1]).alias("mes"),
    )


# Columns that name a period, most telling first.
PERIOD_COLUMNS = (("ANO_CMPT", "MES_CMPT"), ("ANO", "MES"), ("COMPETEN",), ("PA_CMP",), ("DT_PROCESS",), ("DTOBITO",), ("DTNASC",), ("DT_NOTIFIC",))


def infer_folder_periods(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """(path, ano, mes) of every parquet file below a folder, by its first row: one row of
    the period columns is read per file, however long it is. A file without rows or without
    a period has the default one."""
    names = [n for group in PERIOD_COLUMNS for n in group]

    def first_row(file: pq.ParquetFile) -> list:
        have = [n for n in names if n in file.schema_arrow.names]
        row = next(file.iter_batches(batch_size=1, columns=have), None) if have else None
        values = row.to_pylist()[0] if row is not None and row.num_rows else {}
        return [None if values.get(n) is None else str(values[n]) for n in names]

    periods = [_first_period(source, list(group)) for group in PERIOD_COLUMNS]
    known = F.coalesce(*[F.when(p["ano"].isNotNull() & p["mes"].isNotNull(), p) for p in periods])
    return _per_file(spark, folder, names, first_row).select(
        "path",
        F.coalesce(known["ano"], F.lit(DEFAULT_PERIOD[0])).alias("ano"),
        F.coalesce(known["mes"], F.lit(DEFAULT_PERIOD[1])).alias("mes"),
    )


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Unbounded topic from its latest offsets; the query checkpoint holds the position."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )
