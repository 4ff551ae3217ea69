"""Diagnosis, bed and outcome codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.casting import to_int
from carelake.functions.dates import period_date, period_month, period_year

# Diagnosis prefixes of ambulatory-care-sensitive conditions.
SENSITIVE_PREFIXES = (
    "A0[0-9]", "A1[5-9]",
    "B05", "B06", "B16", "B26", "B50", "B51", "B52", "B53", "B54",
    "D50",
    "E1[0-4]", "E4[0-6]", "E50", "E51", "E52", "E53", "E54", "E55", "E56", "E64",
    "G4[0-1]",
    "I1[0-1]", "I20", "I50", "I63", "I64", "I69",
    "J0[0-6]", "J1[2-8]", "J2[0-2]", "J3[0-9]", "J4[0-7]",
    "K2[5-8]",
    "L0[0-8]",
    "N1[0-2]", "N30", "N34", "N39", "N7[0-7]",
    "O23",
    "P3[5-9]",
)
SENSITIVE_REGEX = "^(" + "|".join(SENSITIVE_PREFIXES) + ")"

# Chapter name by first letter of the diagnosis code.
CHAPTER_NAMES = {
    "A": "I-II  Infecciosas/parasitárias",
    "B": "I-II  Infecciosas/parasitárias",
    "C": "II    Neoplasias",
    "D": "II-III Neoplasias/sangue",
    "E": "IV    Endócrinas/metabólicas",
    "F": "V     Transtornos mentais",
    "G": "VI    Sistema nervoso",
    "H": "VII-VIII Olhos/ouvidos",
    "I": "IX    Circulatório",
    "J": "X     Respiratório",
    "K": "XI    Digestivo",
    "L": "XII   Pele",
    "M": "XIII  Musculoesquelético",
    "N": "XIV   Genitourinário",
    "O": "XV    Gravidez/parto",
    "P": "XVI   Perinatal",
    "Q": "XVII  Malformações",
    "R": "XVIII Sintomas/sinais",
    "S": "XIX   Lesões/trauma",
    "T": "XIX   Lesões/trauma (toxicológico)",
    "V": "XX    Causas externas (acidentes)",
    "W": "XX    Causas externas",
    "X": "XX    Causas externas",
    "Y": "XX    Causas externas",
    "Z": "XXI   Fatores de saúde",
}

# Urgent diagnoses (sepsis, stroke, infarction, respiratory
# failure, pneumonia, heart failure).
URGENT_CODES = (
    "A419", "A418", "I64", "I219", "I200", "J960", "J969", "J189", "J180", "I500", "I509",
)

# Bed type code to category; intensive care is decided by bed code.
BED_TYPES = {
    "1": "cirurgico",
    "2": "clinico",
    "4": "obstetrico",
    "5": "pediatrico",
    "7": "hospital_dia",
}
ICU_BED_CODES = (51, 78)

# Meaning of the final class for the diseases that redefine it.
OUTCOME_CLASSES = {
    ("DENG", "5"): "clássica",
    ("DENG", "10"): "com sinais de alarme",
    ("DENG", "11"): "grave",
    ("DENG", "12"): "descartado",
    ("DENG", "13"): "chikungunya/zika",
    ("HEPA", "1"): "A",
    ("HEPA", "2"): "B",
    ("HEPA", "3"): "C",
    ("HEPA", "4"): "D",
    ("HEPA", "5"): "E",
}


def _lookup(key: Column, mapping: dict) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[key]


def code_group(c: Column) -> Column:
    return F.when(F.length(c) >= 3, F.substring(c, 1, 3))


def code_chapter(c: Column) -> Column:
    return F.substring(c, 1, 1)


def chapter_label(chapter: Column) -> Column:
    return F.coalesce(_lookup(chapter, CHAPTER_NAMES), F.lit("?"))


def is_sensitive(c: Column) -> Column:
    return c.rlike(SENSITIVE_REGEX)


def is_external_cause(c: Column) -> Column:
    return code_chapter(c).isin("V", "W", "X", "Y")


def bed_category(bed_code: Column, bed_type: Column, padded: bool = False) -> Column:
    """padded=True also reads two-digit type codes ('01') as their short form."""
    kind = bed_type.cast("string")
    if padded:
        kind = F.regexp_replace(kind, "^0+", "")
    return F.when(to_int(bed_code).between(*ICU_BED_CODES), "uti").otherwise(
        F.coalesce(_lookup(kind, BED_TYPES), F.lit("outros"))
    )


def outcome_label(disease: Column, outcome: Column) -> Column:
    flat = {f"{d}:{c}": label for (d, c), label in OUTCOME_CLASSES.items()}
    return _lookup(F.concat(disease, F.lit(":"), outcome), flat)


def recode_sex_to_admissions(c: Column) -> Column:
    """Death and birth records code sex 1/2, admissions 1/3."""
    return _lookup(c, {"1": "1", "2": "3"})


def reference_month(yyyymm: Column) -> Column:
    return period_date(period_year(yyyymm), period_month(yyyymm))
