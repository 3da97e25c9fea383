"""Cleaning scalars (F1-F3, F8-F10) as Column expressions.

No Python UDF: each rule is a chain of built-in string/regex functions, so
it stays inside whole-stage codegen and runs on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerflow.functions.typing import EDGE_SPACE

# Fixed values that must equal the reference rules.
ASPECT_TYPE_PATTERN = r'"type"\s*:\s*"([^"]+)"'
POSTCODE_FULL_PATTERN = r"(?U)^\s*(\d{4})\s*-\s*(\d{3})\s*$"
POSTCODE_PREFIX_PATTERN = r"(?U)(\d{4})"
POSTCODE_SUFFIX_PATTERN = r"(?U)(\d{3})"
GPS_PATTERN = r"(?U)^\s*([-\d.]+)\s*,\s*([-\d.]+)\s*$"
FLOOR_GROUND = "R/C"
FLOOR_GROUND_INPUTS = ["0", "0º", "Piso 0"]
FLOOR_ORDINAL = "º"
FLOOR_DEGREE = "°"
FLOOR_FEMININE_ORDINAL = "ª"
FLOOR_PISO_PATTERN = r"(?iU)^piso\s+\d+\s*[-–]\s*(.+)$"
FLOOR_DIGITS_PATTERN = r"(?U)^\d+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: Unicode white space (Spark ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), EDGE_SPACE, "")


def aspect_type(c) -> Column:
    """first ``"type": "..."`` anywhere in the text; no match -> NULL."""
    return F.nullif(F.regexp_extract(_c(c).cast("string"), ASPECT_TYPE_PATTERN, 1), F.lit(""))


def split_postcode(code, suffix) -> tuple[Column, Column]:
    """returns (prefix, suffix) Columns.

    A full ``dddd-ddd`` code gives the prefix, and the suffix when the suffix
    is empty (NULL, blank or 'nan'). Then prefix := first 4-digit run,
    suffix := first 3-digit run; the pair 0000/000 becomes NULL/NULL.
    """
    code, suffix = _c(code), _c(suffix)
    stripped = strip(code)
    g1 = F.regexp_extract(stripped, POSTCODE_FULL_PATTERN, 1)
    g2 = F.regexp_extract(stripped, POSTCODE_FULL_PATTERN, 2)
    full = F.coalesce(g1 != "", F.lit(False))
    suffix_empty = suffix.isNull() | (strip(suffix) == "") | (F.lower(strip(suffix)) == "nan")
    code1 = F.when(full, g1).otherwise(code)
    suffix1 = F.when(full & suffix_empty, g2).otherwise(suffix)
    prefix = F.nullif(F.regexp_extract(code1, POSTCODE_PREFIX_PATTERN, 1), F.lit(""))
    suf = F.nullif(F.regexp_extract(suffix1, POSTCODE_SUFFIX_PATTERN, 1), F.lit(""))
    zero = F.coalesce((prefix == "0000") & (suf == "000"), F.lit(False))
    return (F.when(zero, F.lit(None).cast("string")).otherwise(prefix),
            F.when(zero, F.lit(None).cast("string")).otherwise(suf))


def standardise_floor(c) -> Column:
    """F3, in the reference order: strip; '.' -> NULL; unify ordinal marks;
    ground-floor spellings -> 'R/C'; bare digits get 'º'; leading r/c or RC
    (not followed by '-') -> 'R/C'; 'piso N - rest' -> rest."""
    c = _c(c)
    v = strip(c)
    v = F.replace(v, F.lit(FLOOR_DEGREE), F.lit(FLOOR_ORDINAL))
    v = F.regexp_replace(v, r"(?U)\s+" + FLOOR_ORDINAL, FLOOR_ORDINAL)
    v = F.replace(v, F.lit(FLOOR_FEMININE_ORDINAL), F.lit(FLOOR_ORDINAL))
    rc = F.regexp_replace(v, r"(?i)^r/c", FLOOR_GROUND)
    rc = F.regexp_replace(rc, r"(?i)^RC(?=[^-]|$)", FLOOR_GROUND)
    piso = F.regexp_extract(rc, FLOOR_PISO_PATTERN, 1)
    tail = F.when(piso != "", strip(piso)).otherwise(rc)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(strip(c) == ".", F.lit(None).cast("string"))
        .when(v.isin(*FLOOR_GROUND_INPUTS), F.lit(FLOOR_GROUND))
        .when(v.rlike(FLOOR_DIGITS_PATTERN), F.concat(v, F.lit(FLOOR_ORDINAL)))
        .otherwise(tail)
    )


def split_gps(c) -> tuple[Column, Column]:
    """F8: whole-string ``lat, lon``; each part numeric or NULL."""
    c = _c(c)

    def part(i):
        return F.nullif(F.regexp_extract(c, GPS_PATTERN, i), F.lit("")).try_cast("double")

    return part(1), part(2)


def zero_to_null(c, zero_is_null: bool = False) -> Column:
    """F9. The reference compares text with the number 0, which never holds,
    so by default the value passes unchanged (SURVEY B2); ``zero_is_null``
    applies the intended rule."""
    c = _c(c)
    if not zero_is_null:
        return c
    return F.when(c.try_cast("bigint") == 0, F.lit(None)).otherwise(c)


def clear_stale_inactive(is_inactive, inactive_date) -> Column:
    """active properties (is_inactive = 0) lose their inactive date."""
    return F.when(_c(is_inactive).try_cast("bigint") == 0, F.lit(None)).otherwise(_c(inactive_date))
