"""Labels, times and measures on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from ledgerlake.functions import labels, measures, times
from ledgerlake.sources import relational
from pyspark.sql import functions as F


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_short_account_is_its_own_origin(spark):
    assert column(spark, ["9091331", "12345", None], "string", labels.origin_account) == ["909133", "12345", None]


def test_ranking_key_has_no_zero_padding(spark):
    key = column(spark, [3, 12, None], "int", lambda m: labels.ranking_key(F.lit("909133"), F.lit(2024), m))
    assert key == ["909133_2024_3", "909133_2024_12", None]


def test_half_years(spark):
    label = column(spark, [1, 6, 7, 12], "int", lambda m: labels.kpi_period(F.lit(2024), m))
    assert label == ["2024 Ky 1", "2024 Ky 1", "2024 Ky 2", "2024 Ky 2"]


def test_ranking_takes_effect_in_the_next_month(spark):
    shifted = column(spark, [Decimal(m) for m in (1, 11, 12)], "decimal(2,0)", lambda m: F.struct(
        *(c.alias(n) for n, c in zip("ym", labels.effective_month(F.lit(Decimal(2024)), m), strict=True))
    ))
    assert [tuple(row) for row in shifted] == [(2024, 2), (2024, 12), (2025, 1)]


def test_names_of_unknown_codes(spark):
    assert column(spark, ["17", "18", None], "string", labels.branch_name) == ["KDS", "SSG", "SSG"]
    assert column(spark, ["MBB", "WEB", None], "string", labels.channel_name) == ["MB", "MBS", "MBS"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        local = column(spark, [1762746854835, None], "bigint", lambda ms: times.local_from_millis(ms).cast("string"))
        assert local == ["2025-11-10 10:54:14.835", None]
        utc = spark.sql("SELECT timestamp'2025-11-10 03:54:14.835Z' AS t")
        assert utc.select(times.as_utc(F.col("t")).cast("string")).first()[0] == "2025-11-10 03:54:14.835"
        back = utc.select(times.as_instant(times.as_utc(F.col("t"))) == F.col("t"))
        assert back.first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_previous_month_of_january():
    assert times.previous_month(dt.date(2024, 1, 31)) == (2023, 12)
    assert times.previous_month(dt.date(2024, 3, 1)) == (2024, 2)


def deals(spark, rows, kind):
    return spark.createDataFrame(
        [("1234567", p, v) for p, v in rows],
        f"C_ACCOUNT_CODE string, C_MATCHED_PRICE {kind}, C_MATCHED_VOLUME {kind}",
    )


def test_value_of_wide_decimals_is_exact(spark):
    df = deals(spark, [(Decimal("40000.123456"), Decimal("20.000001"))], "decimal(38,10)")
    value = df.select(measures.traded_value(df)).first()[0]
    assert value == Decimal("40000.123456") * Decimal("20.000001")
    assert measures.rounded_deals(df).count() == 0


def test_values_beyond_six_decimals_are_counted_and_listed(spark):
    rows = [(Decimal("1.0000000001"), Decimal(1)), (Decimal(10) ** 20, Decimal(1)), (None, Decimal(1)), (Decimal(2), Decimal(3)),
            (Decimal("1.2345678"), Decimal(1000))]
    df = deals(spark, rows, "decimal(38,10)")
    assert sorted(r.C_MATCHED_PRICE for r in measures.rounded_deals(df).collect()) == [
        Decimal("1.0000000001"), Decimal("1.2345678"), Decimal(10) ** 20]
    values = [row[0] for row in df.select(measures.traded_value(df)).collect()]
    assert values == [Decimal(1), Decimal(10) ** 20, None, Decimal(6), Decimal("1234.5678")]


def test_narrow_decimals_are_multiplied_as_they_are(spark):
    df = deals(spark, [(Decimal("1.25"), Decimal("3.50"))], "decimal(15,2)")
    assert measures.product_is_exact(df, "C_MATCHED_PRICE", "C_MATCHED_VOLUME")
    assert df.select(measures.traded_value(df)).first()[0] == Decimal("4.375")


def test_hash_split_covers_null_keys():
    assert relational.hash_split("PK", 2) == ["COALESCE(MOD(ORA_HASH(PK), 2), 0) = 0", "COALESCE(MOD(ORA_HASH(PK), 2), 0) = 1"]
