"""Sources, sinks and load planning."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators import planning
from carelake.plans.roles import adm, facility, money, query, ym
from carelake.plans.scalars import sql_map
from carelake.functions.text import NEIGHBOURHOOD_ALIASES
from carelake.session import shared_path
from carelake.sources import readers, sinks

c = F.col

_DRIFT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("situacao", T.StringType()),
        T.StructField("valor", T.DoubleType()),
        T.StructField("prioridade", T.StringType()),
    ]
)


@query(
    "scan_union_by_name",
    """select o_orderkey as id, o_orderstatus as situacao, case when o_custkey % 2 = 0 then o_totalprice end as valor,
    case when o_custkey % 2 = 1 then o_orderpriority end as prioridade from orders""",
)
def scan_union_by_name(t):
    """Two deliveries that differ in columns and types, read as one table."""
    root = shared_path(t.spark, "drift")
    t("orders").where("o_custkey % 2 = 0").selectExpr(
        "o_orderkey as id", "o_orderstatus as situacao", "o_totalprice as valor"
    ).write.parquet(f"{root}/a")
    t("orders").where("o_custkey % 2 = 1").selectExpr(
        "o_orderpriority as prioridade", "cast(o_orderkey as string) as id",
        "o_orderstatus as situacao", "o_custkey as extra",
    ).write.parquet(f"{root}/b")
    return readers.read_union(t.spark, [f"{root}/a", f"{root}/b"], _DRIFT)


@query(
    "scan_mixed_folder",
    """select o_orderkey as id, o_orderstatus as situacao, case when o_custkey % 3 = 0 then o_totalprice end as valor,
    case when o_custkey % 3 = 1 then o_orderpriority end as prioridade from orders""",
)
def scan_mixed_folder(t):
    """One folder of files in three layouts, told apart by their footers."""
    root = shared_path(t.spark, "mixed")
    layouts = [
        ["o_orderkey as id", "o_orderstatus as situacao", "o_totalprice as valor"],
        ["o_orderpriority as prioridade", "cast(o_orderkey as string) as id", "o_orderstatus as situacao", "o_custkey as extra"],
        ["o_orderstatus as situacao", "cast(o_orderkey as decimal(18,0)) as id"],
    ]
    for i, columns in enumerate(layouts):
        t("orders").where(f"o_custkey % 3 = {i}").selectExpr(*columns).write.mode("append").parquet(root)
    return readers.read_mixed(t.spark, root, _DRIFT)


@query(
    "roundtrip_partitioned",
    f"select ano, mes, count(*) as linhas, {money('val_tot')} as valor from {adm('ano', 'mes', 'val_tot')} a group by all",
)
def roundtrip_partitioned(t):
    path = shared_path(t.spark, "clean")
    sinks.write_partitioned(t.admissions("cnes", "ano", "mes", "val_tot"), path, ["ano", "mes"])
    stored = t.spark.read.parquet(path)
    return stored.groupBy("ano", "mes").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(c("val_tot").cast("decimal(18,2)")).cast("double").alias("valor"),
    )


@query("write_row_count", "select count(*) as linhas from orders")
def write_row_count(t):
    rows = sinks.write_partitioned(
        t.deaths("id_obito", "ano"), shared_path(t.spark, "deaths"), ["ano"]
    )
    return t.spark.range(1).select(F.lit(rows).cast("bigint").alias("linhas"))


@query(
    "bronze_partition_replace",
    """select uf, cast(year(o_orderdate) as int) as ano, cast(month(o_orderdate) as int) as mes, count(*) as linhas from
    (select *, 'RS' as uf from orders) o where year(o_orderdate) * 100 + month(o_orderdate) <> 199705
    and (year(o_orderdate) * 100 + month(o_orderdate) <> 199801 or o_orderstatus = 'F') group by all""",
)
def bronze_partition_replace(t):
    """Every month loaded; then one month delivered anew with fewer rows, one with none."""
    root = shared_path(t.spark, "raw")
    raw = t("orders").selectExpr(
        "o_orderkey", "o_orderstatus", "'RS' as uf", "cast(year(o_orderdate) as string) as ano",
        "lpad(cast(month(o_orderdate) as string), 2, '0') as mes",
    )
    sinks.write_partitioned(raw, f"{root}/pedidos", ["uf", "ano", "mes"])
    january = raw.where("ano = '1998' and mes = '01' and o_orderstatus = 'F'")
    for rows, year, month in ((january, 1998, 1), (raw.limit(0), 1997, 5)):
        sinks.replace_partition(rows, root, "pedidos", "RS", year, month)
    schema = "o_orderkey bigint, o_orderstatus string, uf string, ano int, mes int"
    stored = t.spark.read.schema(schema).parquet(f"{root}/pedidos")
    return stored.groupBy("uf", "ano", "mes").agg(F.count(F.lit(1)).alias("linhas"))


_MONTH = "year(o_orderdate) % 12 + 1"
_DAY_FIRST = "'15' || lpad(cast({} as string), 2, '0') || cast(year(o_orderdate) as string)".format(_MONTH)
_MONTH_TEXT = f"cast(year(o_orderdate) * 100 + {_MONTH} as string)"
_SAMPLES = {
    "sih": {"ANO_CMPT": "cast(year(o_orderdate) as string)", "MES_CMPT": f"cast({_MONTH} as string)"},
    "cnes": {"COMPETEN": _MONTH_TEXT},
    "sia": {"PA_CMP": _MONTH_TEXT},
    "sim": {"DTOBITO": _DAY_FIRST},
    "sinasc": {"DTNASC": _DAY_FIRST},
    "sinan": {"DT_NOTIFIC": f"{_MONTH_TEXT} || '15'"},
    "outro": {"X": "o_orderstatus"},
}


@query(
    "infer_period",
    " union all ".join(
        f"""select distinct '{s}' as fonte, cast(year(o_orderdate) as int) as amostra,
        {"2026" if s == "outro" else "cast(year(o_orderdate) as int)"} as ano,
        {"2" if s == "outro" else f"cast({_MONTH} as int)" if s in ("sih", "cnes", "sia") else "1"} as mes
        from orders where o_custkey % 7 = {i}"""
        for i, s in enumerate(_SAMPLES)
    ),
)
def infer_period(t):
    """Sample files of seven kinds; the period comes from each file's first row."""
    root = shared_path(t.spark, "samples")
    out = None
    for i, (source, columns) in enumerate(_SAMPLES.items()):
        rows = t("orders").where(f"o_custkey % 7 = {i}").selectExpr(
            "year(o_orderdate) as amostra", *[f"{e} as {n}" for n, e in columns.items()]
        )
        sinks.write_partitioned(rows, f"{root}/{source}", ["amostra"])
        found = readers.infer_folder_periods(t.spark, f"{root}/{source}", source).select(
            F.lit(source).alias("fonte"),
            F.regexp_extract("path", "amostra=([0-9]+)", 1).cast("int").alias("amostra"),
            "ano",
            "mes",
        )
        out = found if out is None else out.unionByName(found)
    return out.distinct()


_SCOPES = "o_orderpriority as source, o_orderstatus as uf"
_SPAN = "cast(date_trunc('month', min(o_orderdate)) as date) as lo, cast(date_trunc('month', max(o_orderdate)) as date) as hi"


@query(
    "period_range",
    f"""select source, uf, cast(d as date) as competencia, cast(year(d) as int) as ano, cast(month(d) as int) as mes from
    (select {_SCOPES}, {_SPAN} from orders group by all) s, unnest(generate_series(lo, hi - interval 2 month, interval 1 month)) g(d)""",
)
def period_range(t):
    span = t("orders").groupBy(
        c("o_orderpriority").alias("source"), c("o_orderstatus").alias("uf")
    ).agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    return planning.period_range(
        span, F.trunc("lo", "month"), planning.last_period(c("hi"), 2)
    ).drop("lo", "hi")


_LEDGER = f"(select distinct {_SCOPES}, strftime(o_orderdate, '%Y-%m') as competencia from orders where o_custkey % 8 = 0)"


@query(
    "incremental_plan",
    f"""select source, uf, strftime(d, '%Y-%m') as competencia from (select {_SCOPES}, {_SPAN} from orders group by all) s,
    unnest(generate_series(lo, hi, interval 1 month)) g(d) except select * from {_LEDGER} l""",
)
def incremental_plan(t):
    orders = t("orders").select(
        c("o_orderpriority").alias("source"), c("o_orderstatus").alias("uf"),
        c("o_orderdate").cast("date").alias("d"), "o_custkey",
    )
    span = orders.groupBy("source", "uf").agg(
        F.trunc(F.min("d"), "month").alias("lo"), F.trunc(F.max("d"), "month").alias("hi")
    )
    done = orders.where("o_custkey % 8 = 0").select(
        "source", "uf", planning.period_text(c("d")).alias("competencia")
    )
    ledger = shared_path(t.spark, "ledger")
    sinks.mark_completed(t.spark, ledger, done)
    sinks.mark_completed(t.spark, ledger, done)
    return planning.incremental_plan(
        span, c("lo"), c("hi"), t.spark.read.schema(sinks.LEDGER).parquet(ledger)
    )


@query(
    "ingest_outcomes",
    f"""select source, uf, count(*) filter (o_orderkey % 10 <> 0 and o_custkey % 3 > 0) as ok,
    count(*) filter (o_orderkey % 10 <> 0 and o_custkey % 3 = 0) as vazias, count(*) filter (o_orderkey % 10 = 0) as falhas
    from (select *, {_SCOPES} from orders) o group by source, uf""",
)
def ingest_outcomes(t):
    attempts = t("orders").selectExpr(
        *_SCOPES.split(", "), "cast(o_custkey % 3 as int) as arquivos",
        "case when o_orderkey % 10 = 0 then 'timeout' end as erro",
    )
    return planning.ingest_outcomes(attempts)


# File names as delivered, with bad months and foreign extensions among them.
_DATASET = "case o_custkey % 6 when 0 then 'sih' when 1 then 'sia' when 2 then 'cnes' when 3 then 'sim' when 4 then 'sinasc' else 'sinan' end"
_TYPE = "case o_custkey % 6 when 0 then case o_orderkey % 3 when 0 then 'RD' else 'SP' end when 1 then 'PA' when 2 then 'LT' when 3 then 'DO' when 4 then 'DN' else 'DENG' end"
_YY = "lpad(cast(year(o_orderdate) % 100 as string), 2, '0')"
_MM = "lpad(cast(month(o_orderdate) + case when o_orderkey % 31 = 0 then 12 else 0 end as string), 2, '0')"
_FILE = f"""{_TYPE} || case when o_custkey % 6 = 5 then 'BR' || {_YY} when o_custkey % 6 >= 3 then 'RS' || cast(year(o_orderdate) as string)
    else 'rs' || {_YY} || {_MM} end || case when o_orderkey % 37 = 0 then '.csv' else '.parquet' end"""
_FILE = " ".join(_FILE.split())
LISTING = f"(select o_orderkey as size_bytes, {_DATASET} as dataset, {_FILE} as file_name from orders)"

# The check engine slices from the end instead of matching patterns.
ENTRIES = f"""(select size_bytes, dataset, file_name, tipo, uf, cast(ano as int) as ano, cast(mes as int) as mes from (
    select size_bytes, dataset, file_name,
      case when dataset = 'sinan' then left(s, length(s) - 4) else left(s, length(s) - 6) end as tipo,
      case when dataset = 'sinan' then 'BR' else substr(s, length(s) - 5, 2) end as uf,
      case when dataset in ('sim', 'sinasc') then cast(right(s, 4) as int) else
        case when y < 80 then 2000 + y else 1900 + y end end as ano,
      case when dataset in ('sih', 'sia', 'cnes') then cast(right(s, 2) as int) end as mes
    from (select *, cast(case when dataset = 'sinan' then right(s, 2) else substr(s, length(s) - 3, 2) end as int) as y
      from (select *, upper(left(file_name, length(file_name) - 8)) as s from {LISTING} l where file_name like '%.parquet') a) b) p
    where mes is null or mes between 1 and 12)"""


def entries(t):
    listing = t("orders").selectExpr(
        "o_orderkey as size_bytes", f"{_DATASET} as dataset", f"{_FILE} as file_name"
    )
    return planning.catalog_parse(listing)


@query("catalog_parse", f"select * from {ENTRIES} e")
def catalog_parse(t):
    return entries(t)


@query(
    "latest_per_type",
    f"""select dataset, tipo, uf, ano, mes, file_name from {ENTRIES} e
    qualify row_number() over (partition by dataset, tipo order by ano desc, coalesce(mes, 12) desc, file_name) = 1""",
)
def latest_per_type(t):
    columns = ["dataset", "tipo", "uf", "ano", "mes", "file_name"]
    return planning.latest_per_type(entries(t).select(*columns))


GRID = f"""(with e as materialized (select distinct dataset, tipo, ano, mes from {ENTRIES} x), k as (select distinct dataset, tipo from e),
    g as (select dataset, tipo, cast(year(d) as int) as ano, cast(month(d) as int) as mes from k, unnest(generate_series(date '1996-03-01', date '1999-08-01', interval 1 month)) m(d)
        where dataset in ('sih', 'sia', 'cnes')
      union all select dataset, tipo, cast(y as int), null from k, unnest(range(1996, 2000)) n(y) where dataset not in ('sih', 'sia', 'cnes'))
    select g.*, case when e.tipo is not null then 'X' else '' end as disponivel from g left join e
      on e.dataset = g.dataset and e.tipo = g.tipo and e.ano = g.ano and e.mes is not distinct from g.mes)"""
_WINDOW = (date(1996, 3, 1), date(1999, 8, 1))


@query("availability_grid", f"select * from {GRID} g")
def availability_grid(t):
    return planning.availability_grid(entries(t), *_WINDOW)


@query(
    "coverage_ratio",
    f"""select dataset, tipo, count(*) filter (disponivel = 'X') as presentes, count(*) as esperados,
    count(*) filter (disponivel = 'X')::double * 1.0 / count(*) as cobertura from {GRID} g group by all""",
)
def coverage_ratio(t):
    return planning.coverage_ratio(planning.availability_grid(entries(t), *_WINDOW))


@query(
    "catalog_snapshot",
    f"""select d as dt, uf, count(*) as arquivos from (select uf from {ENTRIES} e) f,
    (values (date '2026-06-01'), (date '2026-06-02')) v(d) group by all""",
)
def catalog_snapshot(t):
    """Two days kept; a rerun of the second day replaces it."""
    path = shared_path(t.spark, "catalog")
    for day in ("2026-06-01", "2026-06-02", "2026-06-02"):
        sinks.write_catalog_snapshot(
            entries(t).withColumn("dt", F.lit(day).cast("date")), path
        )
    return t.spark.read.parquet(path).groupBy("dt", "uf").agg(F.count(F.lit(1)).alias("arquivos"))


# --- reference files ----------------------------------------------------------

_PLACE = "cast(4300000 + c_custkey % 99999 as string)"
_COUNT = "case when c_custkey % 13 = 0 then '-' else cast(c_custkey * 3 as string) end"
_DOC = (
    """'[{"resultados":[{"series":[{"localidade":{"id":"' || """ + _PLACE
    + """ || '","nome":"' || c_name || ' - RS"},"serie":{"2022":"' || """ + _COUNT
    + """ || '"}}]}]}]'"""
)


@query(
    "json_flatten",
    f"""select left({_PLACE}, 6) as cod6, {_PLACE} as cod7, c_name as nome, try_cast({_COUNT} as int) as populacao
    from customer where c_custkey % 13 <> 0""",
)
def json_flatten(t):
    text = t("customer").selectExpr(f"{_DOC} as value")
    return readers.census_population(
        text.select(F.from_json("value", readers.CENSUS_DOCUMENT).alias("doc"))
    )


@query(
    "json_props",
    "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
)
def json_props(t):
    return t("events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    "decimal_comma",
    """select cast(c_custkey as varchar) as cod6, replace(cast(c_acctbal as varchar), ',', '.') as idhm, '0.' || cast(c_nationkey as varchar) as gini
    from customer where c_nationkey % 3 = 0 and c_custkey % 2 = 0""",
)
def decimal_comma(t):
    raw = t("customer").selectExpr(
        "case when c_nationkey % 3 = 0 then '43' else '42' end as UF",
        "case when c_custkey % 2 = 0 then '2010' else '2000' end as ANO",
        "cast(c_custkey as string) as Codmun6",
        "replace(cast(c_acctbal as string), '.', ',') as IDHM",
        "' 0,' || cast(c_nationkey as string) as GINI",
        "c_name as OUTRA",
    )
    return readers.development_index(raw)


_PLACE_NAME = "case p_partkey % 9 when 0 then 'Total' when 1 then 'Mont''Serrat' when 2 then 'Passo da Areia' when 3 then 'São ' || p_name else p_name end"
_LINE = (
    f"{_PLACE_NAME} || ' ; ' || cast(p_size as string) || '.' || lpad(cast(p_partkey % 1000 as string), 3, '0') || ';' "
    "|| case when p_partkey % 25 = 4 then 'n/d' else cast(p_size as string) || ',' || cast(10 + p_partkey % 90 as string) end"
)
_ALIASES = sql_map("n", {k.replace("'", "''"): v.replace("'", "''") for k, v in NEIGHBOURHOOD_ALIASES.items()})


@query(
    "br_numbers_alias",
    f"""select bairro, populacao, percentual_cidade, strip_accents(lower(bairro)) as bairro_norm from (
      select coalesce({_ALIASES}, n) as bairro, cast(p_size * 1000 + p_partkey % 1000 as int) as populacao,
        cast(cast(p_size as varchar) || '.' || cast(10 + p_partkey % 90 as varchar) as double) as percentual_cidade
      from (select *, {_PLACE_NAME} as n from part) x where n <> 'Total' and p_partkey % 25 <> 4) y""",
)
def br_numbers_alias(t):
    return readers.neighbourhood_rows(t("part").selectExpr(f"{_LINE} as value"))
