"""Encode and decode JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_BAD = "_malformed"
# Whole microseconds; Spark writes milliseconds unless told otherwise.
TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def decode_with_defaults(
    text: Column, schema: T.StructType, defaults: dict[str, object], malformed: str | None = None
) -> list[Column]:
    """The fields of a JSON text as columns, with a default for a missing, null or NaN field.

    A text that is null, no JSON, or has a field of another type is malformed. It fails the query,
    or, when ``malformed`` names a column, arrives there with all fields null, so that it can be
    set aside. No malformed text turns into a row of defaults.
    """
    record = F.from_json(
        text, T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())]), {"columnNameOfCorruptRecord": _BAD, **TIMES}
    )
    bad = F.when(record.isNull() | record[_BAD].isNotNull(), F.coalesce(text, F.lit("")))
    out = []
    for f in schema:
        value = record[f.name]
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]).cast(f.dataType))
        if malformed is None:
            failed = F.raise_error(F.concat(F.lit("malformed message: "), bad)).cast(f.dataType)
            value = F.when(bad.isNotNull(), failed).otherwise(value)
        else:
            value = F.when(bad.isNull(), value)
        out.append(value.alias(f.name))
    return out if malformed is None else [*out, bad.alias(malformed)]


def encode_rows(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text. Null fields are left out, and times keep their microseconds."""
    return df.select(F.to_json(F.struct("*"), TIMES).alias(name))
