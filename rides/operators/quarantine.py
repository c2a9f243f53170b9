"""Rows that do not fit the declared schema, set aside with their reason.

A reader hands over text columns; every field is cast by ``try_cast``, and a
row with a field that has text but no value, or with another number of fields
than its header, is rejected: it keeps its text and the list of reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

REASONS = "_reasons"
RAW = "_raw"
WRONG_COUNT = "wrong number of fields"


def checked(text: DataFrame, schema: T.StructType, keep: list[str], malformed: Column | None = None) -> DataFrame:
    """``text`` (string columns, those of ``schema`` it has) typed, with
    ``keep``, the reasons against each row (none: accepted) and the text of a
    rejected one. ``malformed`` is the whole line where its fields could not
    be told apart."""
    present = [f for f in schema.fields if f.name in text.columns]
    values = {f.name: F.col(f.name).try_cast(f.dataType) for f in present}
    bad = [F.when(F.col(n).isNotNull() & v.isNull(), F.lit(f"bad {n}")) for n, v in values.items()]
    reasons = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    line = F.to_csv(F.struct(*(F.col(f.name) for f in present)))
    if malformed is not None:
        reasons = F.when(malformed.isNotNull(), F.array(F.lit(WRONG_COUNT))).otherwise(reasons)
        line = F.coalesce(malformed, line)
    typed = [values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return text.select(*typed, *keep, reasons.alias(REASONS), line.alias(RAW)).withColumn(
        RAW, F.when(F.size(REASONS) > 0, F.col(RAW)))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.size(REASONS) == 0).drop(REASONS, RAW)


def rejected(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, reasons, raw) of the rows that were rejected."""
    return rows.where(F.size(REASONS) > 0).select(*keep, F.col(REASONS).alias("reasons"), F.col(RAW).alias("raw"))
