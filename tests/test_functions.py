"""Hand-written rows for every scalar rule."""

from datetime import date

from pyspark.sql import functions as F

from carelake import functions as cf
from tests.helpers import evaluate

c = F.col


def one(spark, values, column, kind="string"):
    return [r[0] for r in evaluate(spark, [(v,) for v in values], f"x {kind}", column)]


def test_integers_round_and_read_exponents(spark):
    values = ["12.5", "-12.5", " 7 ", "", "4e2", "abc", "1d", "99999999999", None]
    assert one(spark, values, cf.to_int(c("x"))) == [13, -13, 7, None, 400, None, None, None, None]


def test_long_ids_keep_all_digits(spark):
    assert one(spark, ["4324104486889", "9007199254740993"], cf.to_long(c("x"))) == [
        4324104486889,
        9007199254740993,
    ]


def test_doubles(spark):
    assert one(spark, ["187.62", " 1e3 ", "1f", "", "R$"], cf.to_double(c("x"))) == [
        187.62, 1000.0, None, None, None,
    ]


def test_dates_are_strict(spark):
    bad = ["20240230", "20230229", "", "00000000", "2024011", " 20240101", "20240431", None]
    assert one(spark, bad, cf.parse_ymd(c("x"))) == [None] * len(bad)
    assert one(spark, ["20240229", "20241231"], cf.parse_ymd(c("x"))) == [
        date(2024, 2, 29),
        date(2024, 12, 31),
    ]
    assert one(spark, ["01012024", "31022024", "29022024"], cf.parse_dmy(c("x"))) == [
        date(2024, 1, 1),
        None,
        date(2024, 2, 29),
    ]


def test_period(spark):
    got = evaluate(
        spark, [(2024, 6), (2024, 13), (2024, None), (2024, 0)], "y int, m int",
        cf.period_date(c("y"), c("m")),
    )
    assert got == [(date(2024, 6, 1),), (None,), (None,), (None,)]
    assert one(spark, ["202602", "2026"], cf.reference_month(c("x"))) == [date(2026, 2, 1), None]


def test_admission_age(spark):
    rows = [("30", "4"), ("2", "5"), ("6", "3"), ("x", "4"), (None, "4"), ("9", None)]
    got = evaluate(spark, rows, "v string, u string", cf.decode_admission_age(c("v"), c("u")))
    assert [r[0] for r in got] == [30, 102, 0, None, None, 0]


def test_packed_age(spark):
    values = ["470", "4028", "5002", "3006", "4", None]
    assert one(spark, values, cf.decode_packed_age(c("x"))) == [70, 28, 102, 0, None, None]


def test_age_bands(spark):
    ages = [0, 1, 14, 15, 74, 75, None]
    expected = ["<1", "1-14", "1-14", "15-29", "60-74", "75+", "75+"]
    assert one(spark, ages, cf.age_band(c("x")), "int") == expected
    assert one(spark, [None], cf.age_band(c("x"), strict=True), "int") == [None]
    assert one(spark, [0, 80, 95], cf.age_band8(c("x")), "int") == ["0 <1ano", "6 75-89", "7 90+"]


def test_age_from_dates_truncates_towards_zero(spark):
    rows = [(date(2000, 1, 1), date(2024, 6, 1)), (date(2024, 6, 1), date(2024, 1, 1)), (None, date(2024, 1, 1))]
    got = evaluate(spark, rows, "b date, a date", cf.age_from_dates(c("b"), c("a")))
    assert [r[0] for r in got] == [24, 0, None]


def test_codes(spark):
    assert one(spark, ["O021", "J1", None], cf.code_group(c("x"))) == ["O02", None, None]
    assert one(spark, ["J189", "XJ18", None], cf.is_sensitive(c("x"))) == [True, False, None]
    assert one(spark, ["A", "U", None], cf.chapter_label(c("x"))) == [
        "I-II  Infecciosas/parasitárias", "?", "?",
    ]
    assert one(spark, ["1", "2", "9"], cf.recode_sex_to_admissions(c("x"))) == ["1", "3", None]


def test_bed_category(spark):
    rows = [("51", "1"), ("10", "1"), ("10", "2"), ("10", "4"), ("10", "5"), ("10", "7"), ("10", "9"), ("x", "1"), ("10", "01")]
    schema = "code string, kind string"
    got = evaluate(spark, rows, schema, cf.bed_category(c("code"), c("kind")))
    assert [r[0] for r in got] == [
        "uti", "cirurgico", "clinico", "obstetrico", "pediatrico", "hospital_dia", "outros", "cirurgico", "outros",
    ]
    padded = evaluate(spark, rows[-1:], schema, cf.bed_category(c("code"), c("kind"), padded=True))
    assert padded == [("cirurgico",)]


def test_text_keys(spark):
    assert one(spark, ["90.035-001", "9003", None], cf.postcode_prefix(c("x"))) == ["90035", "", ""]
    assert one(spark, ["  Três Figueiras ", "LAGEADO", "José"], cf.accent_key(c("x"))) == [
        "tres figueiras", "lageado", "jose",
    ]
    assert one(spark, ["Passo da Areia ", "Bom Fim"], cf.alias_name(c("x"))) == ["Passo D'Areia", "Bom Fim"]
    assert one(spark, ["62.448", "4,69", "", "n/d"], cf.br_number(c("x"))) == [62448.0, 4.69, 0.0, None]
    assert one(spark, ["4300109"], cf.truncate_code(c("x"))) == ["430010"]
    assert one(spark, ["12", "123456"], cf.zero_pad(c("x"), 4)) == ["0012", "123456"]
    assert one(spark, ["1"], cf.pseudonym(c("x"))) != one(spark, ["1"], cf.pseudonym(c("x"), "s"))


def test_null_propagation_and_fallbacks(spark):
    rows = [("1", "202401"), (None, "202401"), ("1", None)]
    got = evaluate(spark, rows, "f string, p string", cf.composite_key(c("f"), c("p")))
    assert [r[0] for r in got] == ["1|2024-01", None, None]
    got = evaluate(
        spark, [("0000", "m"), ("12", "m")], "a string, b string", cf.id_or_fallback(c("a"), c("b"))
    )
    assert [r[0] for r in got] == ["m", "12"]
    lat, lon = cf.null_coordinates(c("a"), c("b"))
    rows = [(0.0, 0.0), (0.0, -51.2), (None, -51.2), (-30.0, -51.2)]
    assert evaluate(spark, rows, "a double, b double", lat, lon) == [
        (None, None), (0.0, -51.2), (None, None), (-30.0, -51.2),
    ]


def test_rates(spark):
    rows = [(3, 0), (3, None), (3, 4)]
    got = evaluate(
        spark, rows, "n int, d int", cf.percent(c("n"), c("d")), cf.stored_percent(c("n"), c("d"))
    )
    assert got == [(None, 0.0), (None, 0.0), (75.0, 75.0)]


def test_epi_weeks(spark):
    assert evaluate(
        spark, [("202453",), ("x",)], "x string", cf.epi_year(c("x")), cf.epi_week(c("x"))
    ) == [(2024, 53), (None, None)]
