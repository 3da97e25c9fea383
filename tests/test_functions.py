"""Golden cases for the scalar rules (FIXTURES.md section 6)."""
from pyspark.sql import functions as F

from layerflow.functions import clean, names, typing


def one_col(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]


def test_aspect_type(spark):
    vals = ['{"type": "LOCATION"}', '{"x":{"type" : "A"},"type":"B"}', "LOCATION", '{"type": ""}', None]
    assert one_col(spark, vals, clean.aspect_type) == ["LOCATION", "A", None, None, None]


def test_postcode(spark):
    cases = [("1000-123", None, "1000", "123"), (" 1000 - 123 ", " ", "1000", "123"),
             ("1000-123", "456", "1000", "456"), ("1000", "123", "1000", "123"),
             ("12345", "6789", "1234", "678"), ("1000-12", None, "1000", None),
             ("abc", None, None, None), ("0000-000", None, None, None),
             ("0000", "123", "0000", "123"), (None, "123", None, "123"),
             ("1000-123", "nan", "1000", "123"), ("\u00a01000\u2003-\u00a0123", "\u00a0", "1000", "123")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(cases)], "i int, code string, suf string")
    p, s = clean.split_postcode("code", "suf")
    got = [(r[0], r[1]) for r in df.orderBy("i").select(p, s).collect()]
    assert got == [(c, d) for _, _, c, d in cases]


def test_floor(spark):
    cases = {"0": "R/C", "0º": "R/C", "Piso 0": "R/C", "piso 0": "piso 0", "3": "3º", "3°": "3º",
             "3 º": "3º", "3ª": "3º", "00": "00º", "r/c": "R/C", "rc": "R/C", "RC": "R/C",
             "r/c esq": "R/C esq", "RC Esq": "R/C Esq", "RC-Esq": "RC-Esq", "RCD": "R/CD",
             "Piso 2 - Esq": "Esq", "piso 12 – Dto": "Dto", "Piso 2": "Piso 2", ".": None,
             "": "", "  ": "", "1º Dto": "1º Dto", " 2 ": "2º", "\u00a03": "3º", "2\u00a0º": "2º",
             "Piso\u00a02\u2003- Esq": "Esq"}
    keys = list(cases) + [None]
    got = one_col(spark, keys, clean.standardise_floor)
    assert got == [cases[k] for k in cases] + [None]


def test_gps(spark):
    vals = ["38.7, -9.1", "1.2.3,4", "-,5", "38.7", "38.7,-9.1,0", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    la, lo = clean.split_gps("v")
    got = [(r[0], r[1]) for r in df.orderBy("i").select(la, lo).collect()]
    assert got == [(38.7, -9.1), (None, 4.0), (None, 5.0), (None, None), (None, None), (None, None)]


def test_nullable_int(spark):
    vals = ["3", " 7 ", "3.0", "0012", "x", "3d", "NaN", "9007199254740993", "3.5", "inf", None, "1e3", "\u00a08", "3000000000", "1e30"]
    got = one_col(spark, vals, typing.to_nullable_int)
    assert got == [3, 7, 3, 12, None, None, None, 9007199254740993, None, None, None, 1000, 8, 3000000000, None]
    err = one_col(spark, vals, typing.to_nullable_int_error)
    assert err == [None] * 8 + ["fractional value", "infinite value", None, None, None, None, "value out of range"]
    narrow = one_col(spark, vals, lambda c: typing.to_nullable_int_error(c, "int"))
    assert narrow[7] == narrow[13] == "value out of range" and narrow[0] is None


def test_nullable_float_and_dates(spark):
    assert one_col(spark, ["2.5", "x", "inf", None, " 1e3 "], typing.to_nullable_float) == [2.5, None, None, None, 1000.0]
    import datetime as dt
    got = one_col(spark, ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05", "bad", None,
                          "2024-01-02T10:00:00+02:00", "2024-01-02T10:00:00Z"], typing.to_datetime)
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5), None, None,
                   dt.datetime(2024, 1, 2, 8, 0), dt.datetime(2024, 1, 2, 10, 0)]


def test_sanitize_identifier(spark):
    vals = ["_id", "__hash_a", "a-b.c", "a--b", "___", "", "a" * 70, "Máx.Ocupação"]
    got = one_col(spark, vals, names.sanitize_identifier_col)
    assert got[:6] == ["id", "hash_a", "a_b_c", "a__b", "col", "col"] and got[7] == "m_x_ocupa__o"
    assert got[6].startswith("a" * 55 + "_") and len(got[6]) == 64


def test_clean_column_names(spark):
    assert names.clean_column_names(spark, ["Máx.Ocupação", "  ", "A b", "a_b"]) == ["m_x_ocupa_o", "unnamed_column", "a_b", "a_b_1"]
    assert names.clean_column_names(spark, ["a", "a", "a_1"]) == ["a", "a_2", "a_1"]
    assert names.clean_column_names(spark, []) == []


def test_zero_postcode_and_stale_inactive(spark):
    df = spark.createDataFrame([(1, "0", "0", "2023-01-01"), (2, "1100", "1", "2023-01-01"), (3, None, None, None)],
                               "i int, p string, inactive string, d string")
    eff = [r[0] for r in df.orderBy("i").select(clean.zero_to_null("p")).collect()]
    assert eff == ["0", "1100", None]                    # effective reference behaviour (B2)
    intended = [r[0] for r in df.orderBy("i").select(clean.zero_to_null("p", True)).collect()]
    assert intended == [None, "1100", None]
    stale = [r[0] for r in df.orderBy("i").select(clean.clear_stale_inactive("inactive", "d")).collect()]
    assert stale == [None, "2023-01-01", None]            # active (0) loses its inactive date


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _gps_model(s):
    import re
    m = re.fullmatch(r"\s*([-\d.]+)\s*,\s*([-\d.]+)\s*", s)
    if not m:
        return (None, None)

    def num(x):
        try:
            return float(x) if re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", x) else None
        except ValueError:
            return None
    return (num(m.group(1)), num(m.group(2)))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("-0123456789., ", max_size=12), min_size=1, max_size=12))
def test_gps_split_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    la, lo = clean.split_gps("v")
    got = [(r[0], r[1]) for r in df.orderBy("i").select(la, lo).collect()]
    assert got == [_gps_model(v) for v in values]
