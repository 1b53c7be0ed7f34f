"""Row-wise table operators: partition columns, lineage columns, casts, publishing and time-zone shift."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.times import MARKET_ZONE, ntz, to_local
from ledgerlake.specs import TableSpec


def partition_columns(spec: TableSpec) -> dict[str, Column]:
    if spec.partition_texts:
        return {name: F.col(origin).cast("string") for name, origin in spec.partition_texts.items()}
    return {"partition_date": F.to_date(spec.date_column)} if spec.date_column else {}


def lineage_columns(loaded_at: dt.datetime) -> dict[str, Column]:
    """``valid_from`` is the load time; no version is closed here, so ``valid_to`` is NULL and the row current."""
    return {
        "valid_from": ntz(loaded_at.isoformat(sep=" ")),
        "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    }


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts in one projection; columns that the frame lacks are left out."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items() if name in df.columns})


def publish(df: DataFrame, target: StructType) -> DataFrame:
    """The target's columns, order and types. Columns the target lacks are dropped; a missing one is an error."""
    missing = [name for name in target.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target: {', '.join(missing)}")
    return df.select(*(F.col(field.name).cast(field.dataType) for field in target.fields))


def shift_to_local(df: DataFrame, columns: list[str], zone: str = MARKET_ZONE) -> DataFrame:
    """UTC columns as local time."""
    return df.withColumns({name: to_local(F.col(name), zone) for name in columns})


def computed_once(expression: Column) -> Column:
    """An expensive expression, such as parsed text, for a ``select`` whose result is filtered.

    Spark pushes a filter below a projection by repeating its expressions, so text would be parsed again for every
    condition. It does not push one below a generator, which this one-element explode is.
    """
    return F.explode(F.array(expression))


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all keys, rejected rows with a NULL key)."""
    some_null = F.lit(False)
    for key in keys:
        some_null = some_null | F.col(key).isNull()
    return df.where(~some_null), df.where(some_null)
