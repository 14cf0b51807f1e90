"""Delimited history files: pipe-separated, quoted, backslash-escaped, gzipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.schemas import MAX_BYTES

# The format of the files, and the bad rows that restoring tolerates.
_FORMAT = {"sep": "|", "quote": '"', "escape": "\\", "charToEscapeQuoteEscaping": "\\"}
MAX_BAD_ROWS = 10

_BAD, _REASON, _RAW, _FILE = "_bad_record", "_bad_reason", "_bad_text", "_file"
_INVALID = "\ufffd"


def export_delimited(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write every column quoted, NULL as the empty text, replacing ``path``.

    A gzip file is read by one task, so files are kept small enough for one.
    """
    text = df.select(*[F.col(f.name).cast("string").alias(f.name) for f in df.schema])
    (
        text.write.mode("overwrite")
        .options(**_FORMAT, quoteAll=True, nullValue="", emptyValue="", compression="gzip")
        .options(
            maxRecordsPerFile=rows_per_file,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def import_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_bad_rows: int = 0,
    staging: str | None = None,
) -> DataFrame:
    """Read files into the declared table; more than ``max_bad_rows`` bad rows fail it.

    Empty or blank text becomes NULL and an invalid character a space. A row is bad
    if it has the wrong number of fields, a value that is not of its type, or a text
    that is too long. With ``staging`` (a new folder of Parquet files) the files are parsed
    once, now; without it once to count the bad rows and once to read.
    ``import_with_rejects`` also keeps the rows that are skipped.
    """
    typed = _typed(_raw(spark, path, schema), schema)
    if staging is not None:
        typed = _staged(typed, staging)
    bad_rows = typed.agg(F.count_if(F.col(_BAD)).alias("n")).scalar()
    message = F.concat(bad_rows.cast("string"), F.lit(f" bad rows in {path}"))
    allowed = F.when(
        bad_rows > max_bad_rows, F.raise_error(message).cast("boolean")
    ).otherwise(True)
    return typed.filter(allowed & ~F.col(_BAD)).select(*schema.fieldNames())


def import_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, staging: str, max_bad_rows: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The rows of the declared table, and the rejected ones: file, reason and raw text.

    Files are parsed once, into ``staging`` (a new folder of Parquet files).
    """
    raw = _raw(spark, path, schema).withColumn(_FILE, F.col("_metadata.file_path"))
    rows = _staged(_typed(raw, schema), staging)
    rejected = rows.filter(_BAD).select(
        F.col(_FILE).alias("file"), F.col(_REASON).alias("reason"), F.col(_RAW).alias("raw")
    )
    found = rejected.count()
    if found > max_bad_rows:
        raise ValueError(f"{found} bad rows in {path}; they are in {staging}")
    return rows.filter(~F.col(_BAD)).select(*schema.fieldNames()), rejected


def _staged(typed: DataFrame, staging: str) -> DataFrame:
    typed.write.mode("errorifexists").parquet(staging)
    return typed.sparkSession.read.schema(typed.schema).parquet(staging)


def _raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    raw_schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in [*schema.fieldNames(), _BAD]]
    )
    return (
        spark.read.schema(raw_schema)
        .options(**_FORMAT, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
        .options(columnPruning=False, nullValue="", emptyValue="", encoding="UTF-8")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns with a flag for bad rows, why they are bad, and their text.

    A row is tested as one array of its columns: as a chain of conditions, the code of a
    wide table grows too long for the JVM to compile.
    """
    cleaned = {f.name: _clean(F.col(f.name)) for f in schema}
    unfit = F.array(*[_unfit(f, cleaned[f.name]) for f in schema])
    names = F.array(*[F.when(_unfit(f, cleaned[f.name]), F.lit(f.name)) for f in schema])
    reason = F.when(F.col(_BAD).isNotNull(), F.lit("number of fields")).otherwise(
        F.concat_ws(", ", F.array_compact(names))
    )
    fields = [F.coalesce(cleaned[f.name], F.lit("")) for f in schema]
    text = F.coalesce(F.col(_BAD), F.concat_ws("|", *fields))
    bad = F.col(_BAD).isNotNull() | F.exists(unfit, lambda x: x)
    return raw.select(
        *[cleaned[f.name].try_cast(f.dataType).alias(f.name) for f in schema],
        bad.alias(_BAD),
        F.when(bad, reason).alias(_REASON),
        F.when(bad, text).alias(_RAW),
        *[c for c in raw.columns if c == _FILE],
    )


def _clean(text: Column) -> Column:
    valid = F.replace(text, F.lit(_INVALID), F.lit(" "))
    return F.when(F.trim(valid) != "", valid)


def _unfit(field: T.StructField, text: Column) -> Column:
    size = field.metadata.get(MAX_BYTES)
    if size is not None:
        return F.coalesce(F.octet_length(text) > size, F.lit(False))
    return text.isNotNull() & text.try_cast(field.dataType).isNull()
