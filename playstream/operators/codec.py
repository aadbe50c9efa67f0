"""Message decode/encode and numeric fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from playstream.schemas import REFERENCE_NAMES, SNAP_FIELDS, reference_schema


def decode(df: DataFrame, schema: StructType, value: str = "value",
           drop_empty: bool = True, reference_names: bool = False) -> DataFrame:
    """Parse a message column (bytes or text) into the fields of ``schema``.

    Malformed messages and wrongly typed fields become nulls; extra fields are
    ignored; with ``drop_empty`` an all-null row (malformed or null message)
    is dropped.  ``reference_names`` reads messages whose fields have the
    reference's names, into the engine's columns.  A field declared ``StringType`` keeps nested JSON as text.
    """
    given = reference_schema(schema) if reference_names else schema
    out = df.select(F.from_json(F.col(value).cast("string"), given).alias("_m")).select("_m.*")
    if reference_names:
        out = out.toDF(*schema.names)
    return out.na.drop(how="all") if drop_empty else out


def encode(df: DataFrame, key: str = "game_id", fields: Sequence[str] = tuple(SNAP_FIELDS),
           reference_names: bool = False) -> DataFrame:
    """``key, value`` message rows: ``value`` is the JSON of ``fields`` (P10),
    named as the reference's messages with ``reference_names``.

    Null fields are omitted from the JSON; empty arrays are kept as ``[]``.
    """
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(f).alias(REFERENCE_NAMES.get(f, f) if reference_names else f)
                                           for f in fields])).alias("value"))


def fill_numeric(df: DataFrame, value=0) -> DataFrame:
    """Replace nulls in every numeric column by ``value`` (P13); text and arrays untouched."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.na.fill(value, subset=cols) if cols else df
