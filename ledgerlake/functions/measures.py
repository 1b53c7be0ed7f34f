"""The four account measures as row expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

NARROW = DecimalType(18, 6)
STORED = DecimalType(38, 10)
PRODUCT = DecimalType(38, 12)


def margin_debt() -> Column:
    """Open margin loan of a balance row; NULL if a term is NULL, and then skipped by SUM."""
    return (
        F.col("C_INTERM_LOAN") - F.col("C_INTERM_LOAN_OUT")
        + F.col("C_OUTTERM_LOAN") - F.col("C_OUTTERM_LOAN_OUT")
    )


def mblink_debt() -> Column:
    """Open linked-bank debt of a balance row; NULL handling as in ``margin_debt``."""
    return (
        F.col("C_INTERM_BALANCE") - F.col("C_INTERM_CASH_OUT")
        + F.col("C_OUTTERM_BALANCE") - F.col("C_OUTTERM_CASH_OUT")
        + F.col("C_MBS_EXPIRE_DEBIT") - F.col("C_TLO_COL_1")
    )


def cash_advance() -> Column:
    return F.col("C_CASH_VOLUME")


def product_is_exact(df: DataFrame, left: str, right: str) -> bool:
    """True if the decimal product of two columns keeps every digit (its precision fits in 38)."""
    types = [df.schema[name].dataType for name in (left, right)]
    return all(isinstance(t, DecimalType) for t in types) and sum(t.precision for t in types) + 1 <= 38


def narrowed(column: str) -> Column:
    """Value with six decimals, NULL if it does not fit."""
    return F.col(column).try_cast(NARROW)


def fits_narrow(column: str) -> Column:
    """True for NULL and for values that six decimals hold exactly."""
    value = F.col(column)
    return value.isNull() | F.coalesce(narrowed(column) == value, F.lit(False))


def traded_value(df: DataFrame) -> Column:
    """Price times volume, for every deal.

    The product of wide decimals is rounded to fit, and sums of doubles depend on their order. Where six decimals hold
    both factors, as they nearly always do, the product is exact; elsewhere it is that of the stored decimals, rounded
    to six. ``rounded_deals`` lists the latter.
    """
    price, volume = "C_MATCHED_PRICE", "C_MATCHED_VOLUME"
    if product_is_exact(df, price, volume):
        return F.col(price) * F.col(volume)
    exact = narrowed(price) * narrowed(volume)
    wide = F.col(price).cast(STORED) * F.col(volume).cast(STORED)
    return F.when(fits_narrow(price) & fits_narrow(volume), exact.cast(PRODUCT)).otherwise(wide.cast(PRODUCT))


def rounded_deals(deals: DataFrame) -> DataFrame:
    """Deals whose value ``traded_value`` has to round."""
    price, volume = "C_MATCHED_PRICE", "C_MATCHED_VOLUME"
    if product_is_exact(deals, price, volume):
        return deals.where(F.lit(False))
    return deals.where(~(fits_narrow(price) & fits_narrow(volume)))
