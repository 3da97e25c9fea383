"""Identifier rules (P1, P2) as Column expressions.

Names live in data (field names of documents, the header record of a CSV
file), so the rules run where the names are; only the numbering of repeated
header names is done on the driver, over one header.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference rules.
IDENT_MAX_LEN = 64
IDENT_EMPTY = "col"
CSV_EMPTY = "unnamed_column"
_ONE_BAD_CHAR = r"[^a-zA-Z0-9_]"
_BAD_RUN = r"[^a-zA-Z0-9_]+"
_EDGES = r"^_+|_+$"
_HASH_DIGITS = 8


def _text(c) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def _or_default(name: Column, default: str) -> Column:
    return F.when(name == "", F.lit(default)).otherwise(name)


def sanitize_identifier_col(c, max_len: int = IDENT_MAX_LEN) -> Column:
    """Characters outside [A-Za-z0-9_] become '_', outer '_' go, lower
    case, 'col' if nothing is left; a longer name ends in the first 8 hex
    digits of its md5."""
    name = _or_default(F.lower(F.regexp_replace(F.regexp_replace(_text(c), _ONE_BAD_CHAR, "_"), _EDGES, "")), IDENT_EMPTY)
    short = F.concat_ws("_", F.left(name, F.lit(max_len - _HASH_DIGITS - 1)), F.left(F.md5(name), F.lit(_HASH_DIGITS)))
    return F.when(F.length(name) > max_len, short).otherwise(name)


def csv_name_col(c) -> Column:
    """Lower case, runs outside [A-Za-z0-9_] become one '_', outer '_' go,
    'unnamed_column' if nothing is left."""
    return _or_default(F.regexp_replace(F.regexp_replace(F.lower(_text(c)), _BAD_RUN, "_"), _EDGES, ""), CSV_EMPTY)


def unique_names(names: list[str]) -> list[str]:
    """Duplicates get ``_1``, ``_2`` ... in order of appearance. Unlike the
    reference, a generated name that collides with a later or earlier name
    keeps counting until it is unique (SURVEY B13)."""
    taken: set[str] = set()
    counters: dict[str, int] = {}
    out: list[str] = []
    for n in names:
        if n not in taken:
            taken.add(n)
            counters.setdefault(n, 1)
            out.append(n)
            continue
        k = counters.get(n, 1)
        while f"{n}_{k}" in taken or f"{n}_{k}" in names:
            k += 1
        new = f"{n}_{k}"
        counters[n] = k + 1
        taken.add(new)
        out.append(new)
    return out


def clean_column_names(spark, names: list[str]) -> list[str]:
    """P2 over one header."""
    if not names:
        return []
    rows = spark.createDataFrame(list(enumerate(names)), "place int, name string")
    return unique_names([r[0] for r in rows.orderBy("place").select(csv_name_col("name")).collect()])
