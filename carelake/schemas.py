"""Declared columns of the source files and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(columns) -> T.StructType:
    """Raw files are delivered as text: leading zeros in codes must survive."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Raw columns read by each cleaning step.
RAW_ADMISSIONS = (
    "N_AIH CNES ANO_CMPT MES_CMPT DIAG_PRINC SEXO IDADE COD_IDADE RACA_COR MUNIC_RES MUNIC_MOV "
    "CEP DT_INTER DT_SAIDA DIAS_PERM MORTE VAL_TOT VAL_SH VAL_SP VAL_UTI UTI_MES_TO MARCA_UTI "
    "PROC_REA ESPEC CAR_INT COMPLEX COBRANCA"
).split()
RAW_FACILITIES = (
    "CNES CODUFMUN COMPETEN CPF_CNPJ CNPJ_MAN TPGESTAO ESFERA_A TP_UNID NAT_JUR CLIENTEL NIV_HIER "
    "TURNO_AT VINC_SUS ATIVIDAD COD_CEP URGEMERG ATENDAMB CENTRCIR CENTROBS CENTRNEO ATENDHOS "
    "LEITHOSP AV_ACRED CLASAVAL AV_PNASS COMISS04 COMISS09 COMISS10 COMISS11 COMISSAO QTLEITP1 "
    "QTLEITP2 QTLEITP3"
).split()
RAW_BEDS = "CNES CODUFMUN COMPETEN TP_LEITO CODLEITO QT_EXIST QT_CONTR QT_SUS QT_NSUS".split()
RAW_DEATHS = (
    "CONTADOR NUMEROLOTE ORIGEM TIPOBITO DTOBITO DTNASC IDADE SEXO RACACOR ESTCIV ESC2010 OCUP "
    "CODMUNRES CODMUNOCOR LOCOCOR CODESTAB ESTABDESCR CAUSABAS CAUSABAS_O ASSISTMED NECROPSIA "
    "STDOEPIDEM LINHAA LINHAB LINHAC LINHAD LINHAII ATESTADO"
).split()

RAW = {
    "sih_rd": text_schema(RAW_ADMISSIONS),
    "cnes_st": text_schema(RAW_FACILITIES),
    "cnes_lt": text_schema(RAW_BEDS),
    "sim_do": text_schema(RAW_DEATHS),
}

# Raw facility column -> clean column, where only the name changes.
FACILITY_RENAMES = {
    "CPF_CNPJ": "cpf_cnpj",
    "CNPJ_MAN": "cnpj_mantenedora",
    "TPGESTAO": "gestao",
    "ESFERA_A": "esfera",
    "TP_UNID": "tp_unid",
    "NAT_JUR": "nat_jur",
    "CLIENTEL": "clientela",
    "NIV_HIER": "nivel_hierarquia",
    "TURNO_AT": "turno",
    "VINC_SUS": "vinc_sus",
    "ATIVIDAD": "atividade",
    "COD_CEP": "cep",
    "URGEMERG": "tem_urgencia",
    "ATENDAMB": "tem_ambulatorial",
    "CENTRCIR": "tem_centro_cirurgico",
    "CENTROBS": "tem_centro_obstetrico",
    "CENTRNEO": "tem_centro_neonatal",
    "ATENDHOS": "tem_atend_hospitalar",
    "LEITHOSP": "tem_leitos_hosp",
    "AV_ACRED": "acreditado",
    "CLASAVAL": "class_acreditacao",
    "AV_PNASS": "pnass_avaliado",
    "COMISS04": "tem_ccih",
    "COMISS09": "tem_comissao_obitos",
    "COMISS10": "tem_comissao_epidemio",
    "COMISS11": "tem_comissao_notif",
    "COMISSAO": "tem_alguma_comissao",
}

# Features known at admission, with their types.
FEATURES = {
    "sexo": "int",
    "idade_anos": "int",
    "faixa_etaria": "string",
    "raca_cor": "string",
    "munic_res": "string",
    "meso_res": "string",
    "cid_principal": "string",
    "cid3": "string",
    "csap_flag": "boolean",
    "carater": "string",
    "especialidade": "string",
    "complexidade": "string",
    "cnes": "string",
    "ano": "int",
    "mes": "int",
    "dow_admissao": "int",
}
TARGET = "morte"

# Columns only known after the outcome, never to be features.
LEAKY_COLUMNS = (
    "dias_perm", "dt_saida", "cobranca", "val_tot", "val_sh", "val_sp", "val_uti", "uti_dias",
    "uso_uti", "marca_uti", "proc_rea",
)

# Per source table, the column naming the facility and the columns
# naming the municipality of residence and of occurrence.
KEY_MAPS = {
    "sih_rd": ("CNES", "MUNIC_RES", "MUNIC_MOV"),
    "sih_sp": ("SP_CNES", "SP_M_PAC", "SP_M_HOSP"),
    "sih_rj": ("CNES", "MUNIC_RES", "MUNIC_MOV"),
    "sih_er": ("CNES", "MUN_RES", "MUN_MOV"),
    "sia_pa": ("PA_CODUNI", "PA_MUNPCN", "PA_UFMUN"),
    "sia_bi": ("CODUNI", "MUNPAC", "UFMUN"),
    "sia_ps": ("CNES_EXEC", "MUNPAC", "UFMUN"),
    "sia_sad": ("CNES_EXEC", "MUNPAC", "UFMUN"),
    "sim_do": ("CODESTAB", "CODMUNRES", "CODMUNOCOR"),
    "sinasc_dn": ("CODESTAB", "CODMUNRES", "CODMUNNASC"),
    "sinan": ("ID_UNIDADE", "ID_MN_RESI", "ID_MUNICIP"),
    "cnes": ("CNES", None, "CODUFMUN"),
}

# Columns shared by every notification file.
NOTIFICATION_COLUMNS = (
    "TP_NOT", "ID_AGRAVO", "DT_NOTIFIC", "NU_ANO", "SG_UF_NOT", "ID_MUNICIP", "ID_UNIDADE",
    "ANO_NASC", "NU_IDADE_N", "CS_SEXO", "CS_RACA", "ID_MN_RESI", "CLASSI_FIN", "CRITERIO",
    "EVOLUCAO",
)

# Labels of categorical admission columns (None: no label known).
CATEGORY_LABELS = {
    "SEXO": {"1": "Masculino", "3": "Feminino"},
    "RACA_COR": {
        "1": "Branca", "2": "Preta", "3": "Parda", "4": "Amarela", "5": "Indígena",
        "99": "Sem info",
    },
    "ETNIA": None,
    "INSTRU": {
        "1": "Analfabeto", "2": "Fund. incompleto", "3": "Fund. completo",
        "4": "Médio completo", "5": "Superior",
    },
    "ESPEC": {
        "1": "Cirurgia", "2": "Obstetrícia", "3": "Clínica médica", "4": "Crônicos",
        "5": "Psiquiatria", "6": "Tisiologia", "7": "Pediatria", "8": "Reabilitação",
        "9": "Hospital-dia",
    },
    "MARCA_UTI": None,
    "COMPLEX": {"02": "Média complex", "03": "Alta complex"},
    "FINANC": {
        "04": "Estratégico", "05": "Atenção básica", "06": "Média", "07": "Alta", "08": "FAEC",
    },
    "REGCT": None,
    "CAR_INT": {
        "01": "Eletivo", "02": "Urgência", "03": "Acid. trabalho típico", "04": "Acid. trajeto",
        "05": "Outros traumas", "06": "Outros tipos",
    },
    "COBRANCA": None,
    "GESTAO": {"E": "Estadual", "M": "Municipal", "D": "Dupla"},
    "IDENT": {"1": "AIH normal", "5": "Longa permanência"},
    "MORTE": {"0": "Sobreviveu", "1": "Óbito"},
    "COD_IDADE": {"2": "Dias", "3": "Meses", "4": "Anos", "5": "Anos>100"},
    "HOMONIMO": {"0": "Não", "1": "Sim, conferido", "2": "Sim, não conferido"},
    "GESTRISCO": {"0": "Não-gestação", "1": "Gestação de risco"},
    "VINCPREV": None,
}

# Numeric, high-cardinality, date and critical admission columns that get profiled.
NUMERIC_COLUMNS = (
    "IDADE", "DIAS_PERM", "QT_DIARIAS", "VAL_TOT", "VAL_SH", "VAL_SP", "VAL_UTI", "VAL_UCI",
    "UTI_MES_TO", "UTI_INT_TO", "US_TOT", "DIAR_ACOM",
)
HIGH_CARDINALITY_COLUMNS = ("MUNIC_MOV", "MUNIC_RES", "CNES", "DIAG_PRINC")
DATE_COLUMNS = ("DT_INTER", "DT_SAIDA", "NASC")
CRITICAL_COLUMNS = (
    "UF_ZI", "MUNIC_MOV", "MUNIC_RES", "DT_INTER", "DT_SAIDA", "MORTE", "DIAG_PRINC", "N_AIH",
    "CNES", "SEXO", "NASC", "VAL_TOT",
)

# Development index columns, source name -> our name.
DEVELOPMENT_COLUMNS = {
    "Codmun6": "cod6",
    "Codmun7": "cod7",
    "Município": "nome",
    "IDHM": "idhm",
    "IDHM_R": "idhm_renda",
    "IDHM_L": "idhm_longevidade",
    "IDHM_E": "idhm_educacao",
    "RDPC": "renda_per_capita",
    "GINI": "gini",
    "PMPOB": "pct_pobres",
    "PIND": "pct_extrema_pobreza",
    "ESPVIDA": "esperanca_vida",
    "T_ANALF18M": "pct_analfabetismo_18mais",
}

TRIAGE_EVENT = T.StructType(
    [
        T.StructField("id_evento", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("paciente_anon", T.StringType()),
        T.StructField("municipio_residencia", T.StringType()),
        T.StructField("spo2", T.IntegerType()),
        T.StructField("glasgow", T.IntegerType()),
        T.StructField("pas", T.IntegerType()),
        T.StructField("queixa", T.StringType()),
        T.StructField("idade", T.IntegerType()),
        T.StructField("sexo", T.StringType()),
    ]
)

ALERT_STORE = T.StructType(
    [
        T.StructField("id_evento", T.StringType()),
        T.StructField("ts_recebido", T.TimestampType()),
        T.StructField("ts_processado", T.TimestampType()),
        T.StructField("paciente_anon", T.StringType()),
        T.StructField("municipio_residencia", T.StringType()),
        T.StructField("classificacao", T.StringType()),
        T.StructField("criterio_vermelho", T.StringType()),
        T.StructField("spo2", T.IntegerType()),
        T.StructField("glasgow", T.IntegerType()),
        T.StructField("pas", T.IntegerType()),
        T.StructField("idade", T.IntegerType()),
        T.StructField("sexo", T.StringType()),
        T.StructField("queixa", T.StringType()),
        T.StructField("recomendacao_json", T.StringType()),
    ]
)

POPULATION = T.StructType(
    [
        T.StructField("cod6", T.StringType()),
        T.StructField("cod7", T.StringType()),
        T.StructField("nome", T.StringType()),
        T.StructField("populacao", T.IntegerType()),
    ]
)

NEIGHBOURHOOD_POPULATION = T.StructType(
    [
        T.StructField("bairro", T.StringType()),
        T.StructField("populacao", T.IntegerType()),
        T.StructField("percentual_cidade", T.DoubleType()),
        T.StructField("bairro_norm", T.StringType()),
    ]
)
