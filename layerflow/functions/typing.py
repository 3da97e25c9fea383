"""Typing scalars (F4-F7, F11, F12) as Column expressions.

ANSI mode is on by default, so every conversion of dirty text uses a
``try_*`` form. Each converter has an ``*_error`` twin that is true when the
reference would have failed the whole build; callers route such rows to a
dead-letter table instead (SURVEY B7).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the numeric shapes accepted before any cast.
NUMERIC_SHAPE = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"
INFINITY_SHAPE = r"^[-+]?(?i:inf|infinity)$"
# Fixed value: what the reference strips, Unicode spaces and the four separators.
EDGE_SPACE = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    """Text without outer white space."""
    return F.regexp_replace(_c(c).cast("string"), EDGE_SPACE, "")


def trimmed_mostly(c) -> Column:
    """:func:`trimmed` for text that seldom has outer white space: the pattern is
    tried only where an outer character may be some (of the printable ASCII
    characters only the blank is)."""
    t = _c(c).cast("string")
    return F.when(F.substring(t, 1, 1).between("!", "~") & F.substring(t, -1, 1).between("!", "~"), t).otherwise(trimmed(t))


def to_nullable_float(c) -> Column:
    """numeric text -> DOUBLE, anything else -> NULL."""
    t = trimmed(c)
    return F.when(t.rlike(NUMERIC_SHAPE), t.try_cast("double"))


def to_nullable_int(c, target: str = "bigint", is_trimmed: bool = False) -> Column:
    """integer text, or an integral decimal such as '3.0' -> integer;
    anything unparsable -> NULL. Exact above 2**53 (bigint cast first).
    ``is_trimmed``: the column has no outer white space."""
    t = _c(c) if is_trimmed else trimmed(c)
    d = t.try_cast("double")
    as_int = F.coalesce(
        t.try_cast("bigint"),
        F.when(d == F.floor(d), F.floor(d).try_cast("bigint")),
    )
    return F.when(t.rlike(NUMERIC_SHAPE), as_int.try_cast(target) if target != "bigint" else as_int)


def to_nullable_int_error(c, target: str = "bigint", is_trimmed: bool = False) -> Column:
    """Why F6 would make the reference fail, NULL where it would not: a
    fractional number, an infinity, or a number that ``target`` cannot hold."""
    t = _c(c) if is_trimmed else trimmed(c)
    number = t.rlike(NUMERIC_SHAPE)
    d = t.try_cast("double")
    held = to_nullable_int(t, target, True)
    return (F.when(t.rlike(INFINITY_SHAPE), F.lit("infinite value"))
            .when(number & (F.abs(d) > 2.0 ** 63), F.lit("value out of range"))
            .when(number & t.try_cast("bigint").isNull() & (d != F.floor(d)), F.lit("fractional value"))
            .when(number & held.isNull(), F.lit("value out of range")))


ZONE_SUFFIX = r"(Z|[+-]\d{2}(:?\d{2})?)$"


def to_datetime(c) -> Column:
    """ISO date or date-time text -> TIMESTAMP_NTZ, bad -> NULL. One rule
    per row (the reference's first-value format inference is not kept, B5);
    text with a zone offset is converted to its UTC wall-clock time."""
    t = trimmed_mostly(c)
    local = t.try_cast("timestamp_ntz")
    instant = t.try_cast("timestamp")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    # text without a colon has no time, and so no zone: the pattern is not tried
    return F.when(F.contains(t, F.lit(":")) & t.rlike(r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*" + ZONE_SUFFIX), utc).otherwise(local)


def to_date(c) -> Column:
    """ISO date or date-time text -> DATE, bad -> NULL."""
    return to_datetime(c).cast("date")


def to_strict_bigint(c) -> Column:
    """cast that raises on non-numeric text under ANSI mode."""
    return _c(c).cast("bigint")


def is_failed_int(c, target: str = "bigint") -> Column:
    """Whether :func:`to_nullable_int_error` has a reason, for trimmed text (a
    shorter expression: it stands in filters)."""
    t = _c(c)
    return F.coalesce(t.rlike(NUMERIC_SHAPE + "|" + INFINITY_SHAPE), F.lit(False)) & to_nullable_int(t, target, True).isNull()


def is_small_int(c) -> Column:
    """Whether text is a numeral of up to nine digits, which every integer type
    holds; never NULL."""
    return F.coalesce(_c(c).rlike("^[0-9]{1,9}$"), F.lit(False))


def length_violation(c, max_len: int) -> Column:
    """true where the text is longer than the column size."""
    return F.coalesce(F.length(_c(c)) > max_len, F.lit(False))
