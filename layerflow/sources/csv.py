"""CSV source: every column a string.

Header names are taken as data (the first record) and cleaned by P2, so the
duplicate-suffix rule is ours rather than Spark's ``a0, a1`` renaming.
Tokens that pandas reads as missing become NULL, as the reference reads with
``dtype=str`` and the default NA list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.functions.names import clean_column_names

# The default missing-value tokens of the pandas CSV reader.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]


class SchemaMismatch(ValueError):
    pass


@dataclass
class CsvRead:
    rows: DataFrame      # the cleaned columns, all STRING
    rejects: DataFrame   # source, record (JSON array of the fields read), error


def _reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool):
    return (spark.read.option("sep", sep).option("encoding", encoding)
            .option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE"))


def _check_headers(spark: SparkSession, path: str, encoding: str) -> None:
    """All files of a folder must have the same header line."""
    lines = spark.read.option("encoding", encoding).text(path) \
        .select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"),
                F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"))
    heads = lines.groupBy("file").agg(F.min_by("line", "n").alias("line")).select("line").distinct().limit(2).collect()
    if len(heads) > 1:
        raise SchemaMismatch(f"files of '{path}' have different headers: {[h.line for h in heads]}")


def read_csv_all_string(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8",
                        expected_columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """The good rows of :func:`read_csv`."""
    return read_csv(spark, path, sep, encoding, expected_columns, multi_line).rows


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8",
             expected_columns: list[str] | None = None, multi_line: bool = True) -> CsvRead:
    """Header row, all columns STRING, NA tokens -> NULL, names by P2.
    S7: ``expected_columns`` missing after cleaning raises, listing both sets;
    so do files of one folder whose headers differ. A record with more fields
    than the header is a reject (the reference's reader fails on it), unless the
    surplus is empty and nothing is lost; missing fields at the end are NULL.

    ``multi_line`` keeps quoted newlines (one task per file); pass False for
    very large single files without embedded newlines to split them.
    """
    # Only the header record reaches the driver (bounded by the column count).
    header = _reader(spark, sep, encoding, multi_line).option("header", False).csv(path).first()
    if header is None:
        raw_names: list[str] = []
    else:
        raw_names = ["" if v is None else v for v in header]
    names = clean_column_names(spark, raw_names)
    if expected_columns:
        missing = sorted(set(expected_columns) - set(names))
        if missing:
            raise SchemaMismatch(
                f"Schema mismatch in '{path}': expected columns not found after cleaning: "
                f"{missing}. Actual columns: {sorted(names)}")
    if not names:
        return CsvRead(spark.createDataFrame([], "value string"), spark.createDataFrame([], "source string, record string, error string"))
    _check_headers(spark, path, encoding)
    fields = [f"_c{i}" for i in range(len(names) + 1)]   # one more than the header: a surplus field
    body = _reader(spark, sep, encoding, multi_line).option("header", True).option("enforceSchema", True) \
        .schema(", ".join(f"`{c}` string" for c in fields)).csv(path) \
        .select(*fields, F.col("_metadata.file_path").alias("source"))
    surplus = F.col(fields[-1]).isNotNull()
    rows = body.where(~surplus).select([
        F.when(F.col(c).isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c)).alias(n)
        for c, n in zip(fields, names, strict=False)])
    rejects = body.where(surplus).select("source", F.to_json(F.array(*fields)).alias("record"),
                                         F.lit(f"more than {len(names)} fields").alias("error"))
    return CsvRead(rows, rejects)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """Text-only CSV writer used to stage inputs (quotes where needed)."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("quoteAll", False).option("escape", '"').csv(path))
    return path
