"""Documented indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators import explore, indicators as ind
from carelake.operators.windows import latest_per_key
from carelake.plans.joining import FLAGGED, flagged
from carelake.plans.roles import (
    adm,
    dth,
    fac,
    facility,
    money,
    municipality,
    pop,
    query,
    role_sql,
)
from carelake.plans.tables import CAPACITY, MORTALITY, _round, capacity, mortality

c = F.col

# Births: one per order.
BIRTH = {
    "munic_res": municipality("o_custkey"),
    "ano": "cast(year(o_orderdate) as int)",
    "peso": "cast(300 + o_orderkey % 6000 as int)",
    "apgar5": "cast(case when o_orderkey % 15 = 0 then null else o_orderkey % 11 end as int)",
    "consultas": "cast(1 + o_orderkey % 4 as string)",
}
_BIRTHS = ", ".join(f"{e} as {n}" for n, e in BIRTH.items())


def births(t):
    return t("orders").selectExpr(*[f"{e} as {n}" for n, e in BIRTH.items()])


@query(
    "threshold_indicators",
    f"""select munic_res, ano, count(*) as nascimentos, round(avg(case when peso < 2500 then 1.0::double when peso >= 2500 then 0.0 end), 6) as baixo_peso,
    round(avg(case when apgar5 < 7 then 1.0::double when apgar5 >= 7 then 0.0 end), 6) as apgar5_baixo,
    round(avg(case when consultas = '4' then 1.0::double when consultas <> '4' then 0.0 end), 6) as prenatal_adequado
    from (select {_BIRTHS} from orders) b where peso between 500 and 6000 group by all""",
)
def threshold_indicators(t):
    out = ind.threshold_indicators(births(t), ["munic_res", "ano"])
    return _round(out, "baixo_peso", "apgar5_baixo", "prenatal_adequado")


NOTICE = {
    "id": "o_orderkey",
    "dt_notific": "cast(o_orderdate as date)",
    "dt_transf": "cast(o_orderdate as date) + cast(o_custkey % 40 as int)",
    "classi_fin": "cast(1 + o_orderkey % 8 as string)",
    "sg_uf_not": "case when o_custkey % 5 = 0 then '42' else '43' end",
    "sg_uf": "case when o_custkey % 7 = 0 then '41' else '43' end",
}
_NOTICES = ", ".join(f"{e} as {n}" for n, e in NOTICE.items())


@query(
    "event_latency",
    f"""select *, cast(date_diff('day', dt_notific, dt_transf) as int) as latencia_dias from (select {_NOTICES} from orders) n
    where classi_fin in ('1', '5') and sg_uf_not = '43' and sg_uf = '43'""",
)
def event_latency(t):
    return ind.event_latency(t("orders").selectExpr(*[f"{e} as {n}" for n, e in NOTICE.items()]), "43")


_TYPES = [f"{i:02d}" for i in range(1, 8)]


@query(
    "type_distribution",
    f"""select codufmun, {", ".join(f"count(distinct case when tp_unid = '{k}' then cnes end) as tipo_{k}" for k in _TYPES)}
    from {fac("codufmun", "tp_unid", "cnes")} f group by codufmun""",
)
def type_distribution(t):
    return ind.type_distribution(t.facilities("codufmun", "tp_unid", "cnes"), _TYPES)


@query(
    "uncovered",
    f"""select distinct codufmun from {fac("codufmun", "competen")} f where codufmun not in
    (select codufmun from (select * from {fac("cnes", "codufmun", "tp_unid", "competen")} h
      qualify row_number() over (partition by cnes order by competen desc) = 1) g where tp_unid = '05')""",
)
def uncovered(t):
    places = t.facilities("codufmun").distinct()
    facilities = t.facilities("cnes", "codufmun", "tp_unid", "competen")
    newest = latest_per_key(facilities, ["cnes"], [c("competen").desc_nulls_last()])
    return ind.uncovered(newest, places, "05")


@query(
    "below_norm",
    f"select codufmun, ano, mes, leitos_sus_por_1000hab from {CAPACITY} c where leitos_sus_por_1000hab < 12",
)
def below_norm(t):
    return ind.below_norm(capacity(t), 12.0).select(
        "codufmun", "ano", "mes", "leitos_sus_por_1000hab"
    )


_TRACE = ("cnes", "ano", "mes", "morte", "munic_res", "munic_mov")


@query(
    "traceability",
    f"""select sha256(cnes) as cnes_hash, ano, mes, count(*) as internacoes, sum(morte)::double * 100.0 / count(*) as tx_mort_pct,
    count(*) filter (munic_res <> munic_mov)::double * 100.0 / count(*) as pct_fora_municipio from {adm(*_TRACE)} a group by cnes, ano, mes""",
)
def traceability(t):
    return ind.traceability(t.admissions(*_TRACE))


_AREAS = f"""areas as (select m.cod6, sum(obitos)::double * 100.0 / sum(internacoes) as taxa, avg(leitos_sus_por_1000hab) as leitos from
    (select cod6, sum(obitos) as obitos, sum(internacoes) as internacoes from {MORTALITY} x group by cod6) m
    join (select codufmun as cod6, avg(leitos_sus_por_1000hab) as leitos_sus_por_1000hab from {CAPACITY} y group by codufmun) b using (cod6) group by m.cod6)"""


def areas(t):
    from carelake import functions as cf

    lost = mortality(t).groupBy("cod6").agg(
        cf.percent(F.sum("obitos"), F.sum("internacoes")).alias("taxa")
    )
    supply = capacity(t).groupBy(c("codufmun").alias("cod6")).agg(
        F.avg("leitos_sus_por_1000hab").alias("leitos")
    )
    return lost.join(supply, "cod6")


@query(
    "silent_areas",
    f"""with {_AREAS} select cod6, round(taxa, 6) as taxa, round(leitos, 6) as leitos from areas
    where taxa > (select quantile_cont(taxa, 0.75) from areas) and leitos < (select quantile_cont(leitos, 0.25) from areas)""",
)
def silent_areas(t):
    return _round(ind.silent_areas(areas(t), "taxa", "leitos"), "taxa", "leitos")


@query(
    "funnel_outliers",
    f"""with r as (select cnes, count(*) as n, cast(sum(morte) as bigint) as obitos, sum(morte)::double * 100.0 / count(*) as tx_mort_pct
      from {adm("cnes", "morte")} a group by cnes), g as (select sum(obitos)::double / sum(n) as p from r),
    f as (select r.*, obitos::double / n as taxa, p as taxa_geral, sqrt(p * (1 - p) / n) * 1.96 as half from r, g)
    select cnes, n, obitos, tx_mort_pct, taxa, round(taxa_geral, 9) as taxa_geral, round(greatest(taxa_geral - half, 0.0), 9) as limite_inf,
    round(least(taxa_geral + half, 1.0), 9) as limite_sup,
    case when taxa > least(taxa_geral + half, 1.0) then 'acima' when taxa < greatest(taxa_geral - half, 0.0) then 'abaixo' else 'dentro' end as situacao from f""",
)
def funnel_outliers(t):
    counts = explore.rate_by(t.admissions("cnes", "morte"), "cnes")
    return _round(
        ind.funnel_outliers(counts), "taxa_geral", "limite_inf", "limite_sup", digits=9
    )


@query(
    "map_metrics",
    f"""select t.*, populacao, obitos::double * 100.0 / internacoes as taxa_mortalidade, internacoes_uti::double * 100.0 / internacoes as pct_uti,
    round(custo_total / internacoes, 6) as custo_medio, {", ".join(f"case when populacao > 0 then {a}::double * {s} / populacao end as {n}" for a, s, n in
      (("internacoes", "1000.0", "internacoes_por_mil"), ("obitos", "1000.0", "obitos_por_mil"), ("internacoes_uti", "100000.0", "uti_por_100mil")))},
    round(case when populacao > 0 then custo_total / populacao end, 6) as custo_por_habitante
    from (select cod6, cast(sum(internacoes) as bigint) as internacoes, cast(sum(obitos) as bigint) as obitos,
      cast(sum(internacoes_uti) as bigint) as internacoes_uti, {money("custo_total")} as custo_total from {MORTALITY} m group by cod6) t
    left join {pop()} p on p.cod6 = t.cod6""",
)
def map_metrics(t):
    return _round(
        ind.map_metrics(mortality(t), t.population()), "custo_medio", "custo_por_habitante"
    )


@query(
    "rejection_rate",
    f"""select cnes, count(*) as apresentadas, cast(sum(rejeitada) as bigint) as rejeitadas, sum(rejeitada)::double * 100.0 / count(*) as pct_rejeitada
    from {FLAGGED} f group by cnes""",
)
def rejection_rate(t):
    return ind.rejection_rate(flagged(t), ["cnes"])


@query(
    "rejection_reasons",
    f"""select st_mot_blo, count(*) as apresentadas, cast(sum(rejeitada) as bigint) as rejeitadas, sum(rejeitada)::double * 100.0 / count(*) as pct_rejeitada
    from {FLAGGED} f where rejeitada = 1 group by st_mot_blo""",
)
def rejection_reasons(t):
    return ind.rejection_rate(flagged(t).where(c("rejeitada") == 1), ["st_mot_blo"])


_AMOUNTS = "l_suppkey, l_extendedprice as presented, case when l_tax >= 0.07 then l_extendedprice - 1 else l_extendedprice end as approved"


@query(
    "amount_gap",
    f"""select l_suppkey, count(*) as linhas, {money("presented")} as valor_apresentado, {money("approved")} as valor_aprovado,
    count(*) filter (cast(presented as decimal(18,2)) <> cast(approved as decimal(18,2))) as linhas_divergentes,
    count(*) filter (cast(presented as decimal(18,2)) <> cast(approved as decimal(18,2)))::double * 100.0 / count(*) as pct_divergente
    from (select {_AMOUNTS} from lineitem) x group by l_suppkey""",
)
def amount_gap(t):
    return ind.amount_gap(t("lineitem").selectExpr(*_AMOUNTS.split(", ")), ["l_suppkey"])


_CAUSES = ("ano", "causa_basica", "causa_basica_original")


@query(
    "correction_share",
    f"""select ano, count(*) as obitos, count(*) filter (causa_basica is distinct from causa_basica_original) as corrigidos,
    count(*) filter (causa_basica is distinct from causa_basica_original)::double * 100.0 / count(*) as pct_corrigido
    from {dth(*_CAUSES)} d group by ano""",
)
def correction_share(t):
    return ind.correction_share(t.deaths(*_CAUSES), ["ano"])


@query(
    "source_gap",
    f"""select cnes, ano, mes, coalesce(a, 0) as obitos_sih, coalesce(d, 0) as obitos_sim, coalesce(d, 0) - coalesce(a, 0) as diferenca from
    (select cnes, ano, mes, cast(sum(morte) as bigint) as a from {adm("cnes", "ano", "mes", "morte")} x group by all) a full join
    (select cnes, ano, mes, count(*) as d from {dth("cnes", "ano", "mes", "local_ocorrencia")} y where local_ocorrencia = '1'
     group by cnes, ano, mes) d using (cnes, ano, mes)""",
)
def source_gap(t):
    return ind.source_gap(
        t.admissions("cnes", "ano", "mes", "morte"), t.deaths("cnes", "ano", "mes", "local_ocorrencia")
    )


@query(
    "infant_rate",
    f"""select b.munic_res, b.ano, nascimentos, coalesce(obitos, 0) as obitos_menor_1,
    coalesce(obitos, 0)::double * 1000.0 / nascimentos as mortalidade_infantil
    from (select munic_res, ano, count(*) as nascimentos from (select {_BIRTHS} from orders) x group by all) b
    left join (select munic_res, ano, count(*) as obitos from {dth("munic_res", "ano", "idade_anos")} y where idade_anos < 1 group by munic_res, ano) d
    on d.munic_res = b.munic_res and d.ano = b.ano""",
)
def infant_rate(t):
    return ind.infant_rate(births(t), t.deaths("munic_res", "ano", "idade_anos"))


# Development score of a municipality: from its customers' balances.
_INDEX = f"select {municipality('c_nationkey')} as cod6, round(avg(c_acctbal) / 10000.0, 6) as idhm from customer where c_nationkey % 8 <> 3 group by c_nationkey"


@query(
    "overlay_corr",
    f"""with {_AREAS} select count(*) as municipios, count(idhm) as com_indice, round(corr(taxa, idhm), 6) as correlacao
    from areas left join ({_INDEX}) i using (cod6)""",
)
def overlay_corr(t):
    index = (
        t("customer")
        .where("c_nationkey % 8 <> 3")
        .groupBy("c_nationkey")
        .agg(F.round(F.avg("c_acctbal") / 10000.0, 6).alias("idhm"))
        .selectExpr(f"{municipality('c_nationkey')} as cod6", "idhm")
    )
    return _round(ind.overlay_corr(areas(t), index, "taxa", "idhm"), "correlacao")


@query(
    "care_balance",
    f"""with r as (select cod6, populacao, producao, internacoes, case when populacao > 0 then producao::double * 1000.0 / populacao end as amb_por_mil,
      case when populacao > 0 then internacoes::double * 1000.0 / populacao end as int_por_mil from {pop()} p
      left join (select {municipality("o_custkey")} as cod6, count(*) as producao from orders group by 1) a using (cod6)
      left join (select munic_res as cod6, count(*) as internacoes from {adm("munic_res")} x group by 1) h using (cod6))
    select * from r where amb_por_mil < (select avg(amb_por_mil) from r) and int_por_mil > (select avg(int_por_mil) from r)""",
)
def care_balance(t):
    ambulatory = t("orders").selectExpr(f"{municipality('o_custkey')} as cod6")
    admitted = t.admissions("munic_res").withColumnRenamed("munic_res", "cod6")
    return ind.care_balance(ambulatory, admitted, t.population())


_STAFF = {
    "cnes": facility("l_suppkey"),
    "competen": "cast(year(l_shipdate) * 100 + month(l_shipdate) as string)",
    "cbo": "case when l_partkey % 4 = 0 then '225' else '322' end || lpad(cast(l_partkey % 200 as string), 3, '0')",
    "pessoa": "cast(l_orderkey % 700 as string)",
}
_STAFF_SQL = ", ".join(f"{e} as {n}" for n, e in _STAFF.items())


@query(
    "distinct_people",
    f"""select cnes, competen, count(distinct pessoa) as n_medicos from (select {_STAFF_SQL} from lineitem) s where cbo like '22%' group by all""",
)
def distinct_people(t):
    return explore.distinct_people(t("lineitem").selectExpr(*[f"{e} as {n}" for n, e in _STAFF.items()]))


@query(
    "beds_per_facility",
    f"""select cnes, competen, cast(sum(qt_sus) as bigint) as leitos_sus from {role_sql("bed", "cnes", "competen", "qt_sus")} b group by all""",
)
def beds_per_facility(t):
    return explore.beds_per_facility(t.beds("cnes", "competen", "qt_sus"))


@query(
    "conditional_sum",
    f"""select codufmun, cast(sum(qt_uso) as bigint) as qt_uso from {role_sql("equipment", "codufmun", "codequip", "ind_sus", "qt_uso")} e
    where codequip = '44' and ind_sus = '1' group by codufmun""",
)
def conditional_sum(t):
    return explore.conditional_sum(t.role("equipment", "codufmun", "codequip", "ind_sus", "qt_uso"))
