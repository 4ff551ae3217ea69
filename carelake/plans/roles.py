"""Health-record roles played by the driver tables.

Each role is one table with derived columns, as the raw files are: an admission
is a line item, a death certificate an order, a facility month a distinct
(supplier, month), the population the customers of a nation. The expressions
are plain SQL that reads the same in Spark and in the check engine, so a query
and its check start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.session import tune


def _letter(k: str) -> str:
    return f"substr('ABCDEFGHIJKLMNOPQRSTVWXYZ', cast(({k}) % 25 as int) + 1, 1)"


def _code(k: str, j: str) -> str:
    """Diagnosis code: letter, two digits, one digit; 100 three-character groups."""
    digits = f"case ({k}) % 4 when 0 then '00' when 1 then '41' when 2 then '50' else '96' end"
    return f"{_letter(k)} || {digits} || cast(({j}) % 10 as string)"


def municipality(k: str) -> str:
    """Six digits: state 43 or 42, a region of five, the municipality."""
    return (
        f"case when ({k}) % 25 < 20 then '43' else '42' end || '0' || "
        f"cast((({k}) % 25) % 5 as string) || lpad(cast(({k}) % 25 as string), 2, '0')"
    )


def facility(k: str) -> str:
    return f"lpad(cast({k} as string), 7, '0')"


def ymd(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as string)"


def dmy(d: str) -> str:
    return f"lpad(cast(day({d}) * 1000000 + month({d}) * 10000 + year({d}) as string), 8, '0')"


def ym(d: str) -> str:
    return f"cast(year({d}) * 100 + month({d}) as string)"


_SHIP = "cast(l_shipdate as date)"
_STAY = "cast(l_quantity as int)"
_HOME = "case when l_orderkey % 3 = 0 then l_suppkey else l_orderkey end"
_DIED = (
    "case when l_linenumber = 7 and l_returnflag = 'N' then null "
    "when l_returnflag = 'R' then 1 else 0 end"
)
_AGE = (
    "case when l_linenumber = 6 and l_suppkey % 10 = 0 then null "
    "else cast(l_quantity * 2 + l_linenumber - 3 as int) end"
)

ADMISSION = {
    "id_aih": (
        "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
        "cast(l_partkey as string) || '-' || cast(l_suppkey as string)"
    ),
    "n_aih": "l_orderkey * 10 + l_linenumber",
    "cnes": facility("l_suppkey"),
    "ano": f"cast(year({_SHIP}) as int)",
    "mes": f"cast(month({_SHIP}) as int)",
    "competen": ym(_SHIP),
    "cid_principal": _code("l_partkey", "l_orderkey"),
    "cid3": f"substr({_code('l_partkey', 'l_orderkey')}, 1, 3)",
    "cid_cap": _letter("l_partkey"),
    "csap_flag": f"substr({_code('l_partkey', 'l_orderkey')}, 2, 2) in ('00', '50')",
    "sexo": "cast(1 + 2 * (l_orderkey % 2) as int)",
    "idade_anos": _AGE,
    "faixa_etaria": f"case when {_AGE} < 15 then '0-14' when {_AGE} < 60 then '15-59' else '60+' end",
    "raca_cor": "l_linestatus",
    "munic_res": municipality(_HOME),
    "munic_mov": municipality("l_suppkey"),
    "cep": "cast(90010000 + (l_orderkey * 37) % 2500000 as string)",
    "dt_inter": _SHIP,
    "dt_saida": f"{_SHIP} + {_STAY}",
    "dias_perm": _STAY,
    "morte": _DIED,
    "val_tot": "l_extendedprice",
    "uso_uti": "case when l_discount >= 0.08 then 1 else 0 end",
    "uti_dias": "case when l_discount >= 0.08 then l_linenumber else 0 end",
    "especialidade": "cast(1 + l_suppkey % 9 as string)",
    "carater": "lpad(cast(l_linenumber as string), 2, '0')",
    "complexidade": "case when l_tax >= 0.05 then '03' else '02' end",
    # Linkage columns.
    "data": f"{_SHIP} + {_STAY}",
    "idade": "cast(20 + floor(l_quantity / 10) as int)",
    "pessoa": "cast(l_orderkey % 5000 as string)",
}

_BORN = "cast(o_orderdate as date)"
DEATH = {
    "id_obito": "o_orderkey",
    "cnes": facility("o_custkey % 100"),
    "ano": f"cast(year({_BORN}) as int)",
    "mes": f"cast(month({_BORN}) as int)",
    "dt_obito": _BORN,
    "cid3": f"substr({_code('o_custkey', 'o_orderkey')}, 1, 3)",
    "causa_basica": _code("o_custkey", "o_orderkey"),
    "causa_basica_original": (
        "case when o_orderkey % 11 = 0 then null when o_orderkey % 10 = 3 then 'R99' "
        f"else {_code('o_custkey', 'o_orderkey')} end"
    ),
    "munic_res": municipality("o_custkey"),
    "idade_anos": "cast(o_orderkey % 90 as int)",
    "local_ocorrencia": "case when o_orderstatus = 'F' then '1' else '3' end",
    "obito_hospitalar": "case when o_orderstatus = 'F' then 1 else 0 end",
    # Linkage columns.
    "data": _BORN,
    "sexo": "cast(1 + 2 * (o_orderkey % 2) as int)",
    "idade": "cast(20 + o_orderkey % 6 as int)",
    "pessoa": "cast(o_custkey % 5000 as string)",
}

# Raw text deliveries, with the faults real files have.
_K = "l_orderkey + l_partkey"
RAW_ADMISSION = {
    "N_AIH": "case when l_partkey % 101 = 0 then null else cast(l_orderkey * 10 + l_linenumber as string) end",
    "CNES": facility("l_suppkey"),
    "ANO_CMPT": f"cast(year({_SHIP}) as string)",
    "MES_CMPT": f"case when ({_K}) % 97 = 0 then '13' else lpad(cast(month({_SHIP}) as string), 2, '0') end",
    "DIAG_PRINC": (
        f"case when ({_K}) % 31 = 0 then null when ({_K}) % 37 = 0 then {_letter('l_partkey')} || '1' "
        f"else {_code('l_partkey', 'l_orderkey')} end"
    ),
    "SEXO": f"case when ({_K}) % 43 = 0 then 'x' else cast(1 + 2 * (l_orderkey % 2) as string) end",
    "IDADE": f"case when ({_K}) % 41 = 0 then '' else cast(cast(l_quantity as int) as string) end",
    "COD_IDADE": "case l_linenumber when 1 then '3' when 2 then '5' when 3 then null else '4' end",
    "RACA_COR": "l_linestatus",
    "MUNIC_RES": municipality(_HOME),
    "MUNIC_MOV": municipality("l_suppkey"),
    "CEP": "cast(90010000 + (l_orderkey * 37) % 2500000 as string)",
    "DT_INTER": f"case when ({_K}) % 29 = 0 then '20240230' else {ymd(_SHIP)} end",
    "DT_SAIDA": f"case when ({_K}) % 23 = 0 then '00000000' else {ymd(f'({_SHIP} + {_STAY})')} end",
    "DIAS_PERM": f"case when ({_K}) % 19 = 0 then ' 7 ' else cast({_STAY} as string) end",
    "MORTE": f"cast({_DIED} as string)",
    "VAL_TOT": f"case when ({_K}) % 47 = 0 then 'R$' else cast(cast(l_extendedprice as decimal(18,2)) as string) end",
    "VAL_SH": "cast(cast(l_extendedprice - l_quantity as decimal(18,2)) as string)",
    "VAL_SP": "cast(cast(l_quantity as decimal(18,2)) as string)",
    "VAL_UTI": "'0'",
    "UTI_MES_TO": "case when l_discount >= 0.08 then '12.5' when l_discount >= 0.05 then '' else '0' end",
    "MARCA_UTI": "lpad(cast(l_linenumber as string), 2, '0')",
    "PROC_REA": "cast(300000000 + l_partkey as string)",
    "ESPEC": "cast(1 + l_suppkey % 9 as string)",
    "CAR_INT": "lpad(cast(l_linenumber as string), 2, '0')",
    "COMPLEX": "case when l_tax >= 0.05 then '03' else '02' end",
    "COBRANCA": "cast(l_partkey % 30 as string)",
    "ETNIA": "case when l_partkey % 7 = 0 then lpad(cast(l_suppkey % 264 as string), 4, '0') else '0000' end",
    "INSTRU": "cast(l_orderkey % 6 as string)",
    "FINANC": "lpad(cast(4 + l_partkey % 5 as string), 2, '0')",
    "REGCT": "case when l_suppkey % 10 = 0 then '71' || lpad(cast(l_suppkey % 18 as string), 2, '0') else '0000' end",
    "GESTAO": "case l_suppkey % 4 when 0 then 'E' when 1 then 'D' else 'M' end",
    "IDENT": "case when l_orderkey % 50 = 0 then '5' when l_orderkey % 77 = 0 then '' else '1' end",
    "HOMONIMO": "cast(l_partkey % 3 as string)",
    "GESTRISCO": "case when l_linenumber = 5 then '1' when l_linenumber = 6 then null else '0' end",
    "VINCPREV": "cast(l_suppkey % 7 as string)",
    "QT_DIARIAS": f"case when ({_K}) % 83 = 0 then 'x' else cast({_STAY} + l_linenumber as string) end",
    "VAL_UCI": "case when l_discount >= 0.09 then cast(cast(l_quantity * 3 as decimal(18,2)) as string) else '0.00' end",
    "UTI_INT_TO": "case when l_discount >= 0.09 then cast(l_linenumber as string) else '0' end",
    "US_TOT": "cast(cast(l_extendedprice * 2 as decimal(18,2)) as string)",
    "DIAR_ACOM": "case when l_linenumber = 7 then null else cast(l_partkey % 40 as string) end",
    "NASC": f"case when ({_K}) % 17 = 0 then '00000000' else {ymd(f'({_SHIP} - cast(l_partkey as int) % 30000)')} end",
}

RAW_BED = {
    "CNES": "case when l_partkey % 89 = 0 then null else " + facility("l_suppkey") + " end",
    "CODUFMUN": municipality("l_suppkey"),
    "COMPETEN": ym(_SHIP),
    "TP_LEITO": "cast(l_linenumber as string)",
    "CODLEITO": "case when l_partkey % 50 = 0 then 'x' else cast(l_partkey % 90 as string) end",
    "QT_EXIST": f"cast({_STAY} as string)",
    "QT_CONTR": "'0'",
    "QT_SUS": f"case when l_partkey % 53 = 0 then '' else cast(cast(floor(l_quantity / 2) as int) as string) end",
    "QT_NSUS": "null",
}

BED = {
    "cnes": facility("l_suppkey"),
    "codufmun": municipality("l_suppkey"),
    "ano": f"cast(year({_SHIP}) as int)",
    "mes": f"cast(month({_SHIP}) as int)",
    "competen": ym(_SHIP),
    "competencia": f"cast(date_trunc('month', {_SHIP}) as date)",
    "categoria": (
        "case l_linenumber when 1 then 'cirurgico' when 2 then 'clinico' when 3 then 'uti' "
        "when 4 then 'obstetrico' when 5 then 'pediatrico' when 6 then 'hospital_dia' else 'outros' end"
    ),
    "qt_sus": "cast(floor(l_quantity / 2) as int)",
    "qt_exist": _STAY,
}

RAW_DEATH = {
    "CONTADOR": "cast(o_orderkey as string)",
    "NUMEROLOTE": "o_orderpriority",
    "ORIGEM": "'1'",
    "TIPOBITO": "case when o_orderkey % 20 = 0 then '1' when o_orderkey % 21 = 0 then null else '2' end",
    "DTOBITO": f"case when o_orderkey % 61 = 0 then null when o_orderkey % 59 = 0 then '31022024' else {dmy(_BORN)} end",
    "DTNASC": f"case when o_orderkey % 13 = 0 then '' else {dmy(f'({_BORN} - cast(o_custkey as int) % 30000)')} end",
    "IDADE": (
        "case o_orderkey % 6 when 0 then '4' || lpad(cast(o_orderkey % 100 as string), 2, '0') "
        "when 1 then '5' || lpad(cast(o_orderkey % 15 as string), 3, '0') when 2 then '3006' "
        "when 3 then '4' when 4 then null else '4' || lpad(cast(o_orderkey % 95 as string), 3, '0') end"
    ),
    "SEXO": "cast(1 + o_orderkey % 2 as string)",
    "RACACOR": "cast(1 + o_orderkey % 5 as string)",
    "ESTCIV": "null",
    "ESC2010": "cast(o_custkey % 6 as string)",
    "OCUP": "null",
    "CODMUNRES": municipality("o_custkey"),
    "CODMUNOCOR": municipality("o_orderkey"),
    "LOCOCOR": "case when o_orderstatus = 'F' then '1' when o_orderkey % 19 = 0 then null else '3' end",
    "CODESTAB": facility("o_custkey % 100"),
    "ESTABDESCR": "null",
    "CAUSABAS": f"case when o_orderkey % 33 = 0 then null when o_orderkey % 35 = 0 then 'I2' else {_code('o_custkey', 'o_orderkey')} end",
    "CAUSABAS_O": _code("o_custkey", "o_orderkey"),
    "ASSISTMED": "'1'",
    "NECROPSIA": "'2'",
    "STDOEPIDEM": "null",
    "LINHAA": "o_orderpriority",
    "LINHAB": "null",
    "LINHAC": "null",
    "LINHAD": "null",
    "LINHAII": "null",
    "ATESTADO": "o_orderpriority || '/' || o_orderstatus",
}

TRIAGE = {
    "id_evento": "cast(event_id as string)",
    "timestamp": "cast(ts as string)",
    "paciente_anon": "cast(user_id as string)",
    "municipio_residencia": (
        "case when user_id % 29 = 0 then '43001' when user_id % 31 = 0 then null else "
        + municipality("user_id") + " end"
    ),
    "spo2": "cast(case when event_id % 7 = 0 then null else 86 + floor(value) % 14 end as int)",
    "glasgow": "cast(case when event_id % 5 = 0 then null else 3 + (event_id + user_id) % 13 end as int)",
    "pas": "cast(case when event_id % 11 = 0 then null else 70 + floor(value * 10) % 80 end as int)",
    "queixa": "event_type",
    "idade": "cast(user_id % 100 as int)",
    "sexo": "case when user_id % 2 = 0 then 'M' else 'F' end",
}

ROLES = {
    "admission": ("lineitem", ADMISSION),
    "death": ("orders", DEATH),
    "raw_admission": ("lineitem", RAW_ADMISSION),
    "bed": ("lineitem", BED),
    "raw_bed": ("lineitem", RAW_BED),
    "raw_death": ("orders", RAW_DEATH),
    "triage": ("events", TRIAGE),
}

# One row per supplier and month it was active in; attributes change over time.
_FACILITY_BASE = f"select distinct l_suppkey as k, year({_SHIP}) * 100 + month({_SHIP}) as p from lineitem"
FACILITY = {
    "cnes": facility("k"),
    "codufmun": municipality("k"),
    "ano": "cast(floor(p / 100) as int)",
    "mes": "cast(p % 100 as int)",
    "competen": "cast(p as string)",
    "competencia": "make_date(cast(floor(p / 100) as int), cast(p % 100 as int), 1)",
    "tp_unid": "lpad(cast(1 + (k + p) % 7 as string), 2, '0')",
    "esfera": "case when k % 3 = 0 then 'M' else 'E' end",
    "nat_jur": "cast(1000 + k % 5 as string)",
    "clientela": "lpad(cast(k % 4 as string), 2, '0')",
    "dt_atual": "case when k % 9 = 0 then '199501' else cast(p as string) end",
    "idx": "cast((k * 7 + p) % 50 as int)",
}

# Population of a municipality: the customers of its nation, in hundreds.
_POPULATION_BASE = "select c_nationkey as k, count(*) as n from customer group by c_nationkey"
POPULATION = {
    "cod6": municipality("k"),
    "populacao": "case when k % 25 = 7 then 0 else cast(n * 100 as int) end",
}


class Tables:
    """The driver tables of one folder, and the roles derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def role(self, name: str, *columns: str) -> DataFrame:
        table, exprs = ROLES[name]
        return self(table).selectExpr(*[f"{exprs[c]} as {c}" for c in columns or exprs])

    def admissions(self, *columns: str) -> DataFrame:
        return self.role("admission", *columns)

    def deaths(self, *columns: str) -> DataFrame:
        return self.role("death", *columns)

    def beds(self, *columns: str) -> DataFrame:
        return self.role("bed", *columns)

    def facilities(self, *columns: str) -> DataFrame:
        base = self("lineitem").selectExpr(
            "l_suppkey as k", f"year({_SHIP}) * 100 + month({_SHIP}) as p"
        ).distinct()
        return base.selectExpr(*[f"{FACILITY[c]} as {c}" for c in columns or FACILITY])

    def population(self) -> DataFrame:
        base = self("customer").groupBy("c_nationkey").count().toDF("k", "n")
        return base.selectExpr(*[f"{e} as {c}" for c, e in POPULATION.items()])


def _sql(exprs: dict, source: str, columns) -> str:
    body = ", ".join(f"{exprs[c]} as {c}" for c in columns or exprs)
    return f"(select {body} from {source})"


def role_sql(name: str, *columns: str) -> str:
    table, exprs = ROLES[name]
    return _sql(exprs, table, columns)


def adm(*columns: str) -> str:
    return role_sql("admission", *columns)


def dth(*columns: str) -> str:
    return role_sql("death", *columns)


def bed(*columns: str) -> str:
    return role_sql("bed", *columns)


def fac(*columns: str) -> str:
    return _sql(FACILITY, f"({_FACILITY_BASE}) f", columns)


def pop() -> str:
    return _sql(POPULATION, f"({_POPULATION_BASE}) p", None)


def money(expression: str) -> str:
    """Exact sum in the check engine."""
    return f"cast(sum(cast({expression} as decimal(18,2))) as double)"


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query over Tables; `oracle` is the SQL giving the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register
