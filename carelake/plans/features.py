"""Feature table and split."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators import ml
from carelake.plans.roles import adm, query
from carelake.plans.tables import _round
from carelake.schemas import FEATURES
from carelake.session import shared_path

c = F.col

_COLUMNS = (
    "id_aih", "sexo", "idade_anos", "faixa_etaria", "raca_cor", "munic_res", "cid_principal", "cid3",
    "csap_flag", "carater", "especialidade", "complexidade", "cnes", "ano", "mes", "dt_inter", "morte",
)
_NAMES = ", ".join(
    {
        "meso_res": "left(munic_res, 4) as meso_res",
        "dow_admissao": "cast(dayofweek(dt_inter) as int) as dow_admissao",
    }.get(name, name)
    for name in FEATURES
)
FEATURE_SQL = f"""(select id_aih, {_NAMES}, morte from {adm(*_COLUMNS)} a where morte is not null and cid_principal is not null
    and idade_anos between 1 and 120 and left(cid_principal, 1) not in ('V', 'W', 'X', 'Y'))"""

SPLIT_SQL = f"""with f as (select *, row_number() over (partition by morte order by md5('42|' || id_aih)) as rk from {FEATURE_SQL} x),
    s as (select morte, count(*) as n, sum(count(*)) over () as total from f group by morte),
    t as (select *, total - (3 * total + 9) // 10 as tt from s),
    u as (select *, (tt * n) // total as base, (tt * n) % total as rest from t),
    v as (select *, base + case when row_number() over (order by rest desc, morte) <= tt - sum(base) over () then 1 else 0 end as n_train,
      (total - tt) // 2 as vt from u),
    w as (select *, n - n_train as other, total - tt as pool from v),
    y as (select *, (vt * other) // pool as vbase, (vt * other) % pool as vrest from w),
    z as (select *, vbase + case when row_number() over (order by vrest desc, morte) <= vt - sum(vbase) over () then 1 else 0 end as n_val from y),
    split as (select f.* exclude (rk), case when rk <= n_train then 'train' when rk <= n_train + n_val then 'val' else 'test' end as split
      from f join z on z.morte = f.morte)"""


def features(t):
    return ml.feature_table(t.admissions(*_COLUMNS), ["id_aih"])


def split(t):
    return ml.stratified_split(features(t), c("id_aih"))


@query("feature_table", f"select * from {FEATURE_SQL} f")
def feature_table(t):
    return features(t)


@query("stratified_split", f"{SPLIT_SQL} select id_aih, morte, split from split")
def stratified_split(t):
    return split(t).select("id_aih", "morte", "split")


@query(
    "split_stats",
    f"{SPLIT_SQL} select split, count(*) as n, round(avg(morte), 9) as target_rate from split group by split",
)
def split_stats(t):
    return _round(ml.split_stats(split(t)), "target_rate", digits=9)


@query(
    "feature_stats",
    " union all ".join(
        f"""select '{k}' as grupo, cast({k} as varchar) as valor, count(*) as n, sum(morte)::double * 1.0 / count(*) as target_rate
        from {FEATURE_SQL} f group by {k}"""
        for k in ("sexo", "faixa_etaria", "ano")
    ),
)
def feature_stats(t):
    return ml.feature_stats(features(t))


@query(
    "ml_metadata",
    f"""{SPLIT_SQL} select count(*) as n_total, count(*) filter (split = 'train') as n_train, count(*) filter (split = 'val') as n_val,
    count(*) filter (split = 'test') as n_test, 16 as n_features, 42 as random_state from split""",
)
def ml_metadata(t):
    path = shared_path(t.spark, "features")
    ml.write_dataset(split(t).drop("id_aih"), path, "admissions")
    meta = t.spark.read.text(f"{path}/metadata").select(F.parse_json("value").alias("m"))
    number = lambda name: F.variant_get("m", f"$.{name}", "bigint").alias(name)
    return meta.select(
        number("n_total"),
        number("n_train"),
        number("n_val"),
        number("n_test"),
        F.size(F.variant_get("m", "$.features", "array<string>")).alias("n_features"),
        F.variant_get("m", "$.random_state", "int").alias("random_state"),
    )
