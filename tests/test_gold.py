"""Gold products on hand-made rows."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from ledgerlake.operators import tables
from ledgerlake.plans import gold
from ledgerlake.sources import bindings
from ledgerlake.streaming import refresh
from pyspark.sql import functions as F

DAY = dt.datetime(2024, 6, 3)


def margin(spark, rows):
    return spark.createDataFrame(rows, (
        "C_ACCOUNT_CODE string, C_TRADING_DATE timestamp_ntz, C_INTERM_LOAN decimal(15,0), "
        "C_INTERM_LOAN_OUT decimal(15,0), C_OUTTERM_LOAN decimal(15,0), C_OUTTERM_LOAN_OUT decimal(15,0)"
    ))


def debit(spark, rows):
    names = ("C_INTERM_BALANCE", "C_INTERM_CASH_OUT", "C_OUTTERM_BALANCE", "C_OUTTERM_CASH_OUT", "C_MBS_EXPIRE_DEBIT", "C_TLO_COL_1")
    return spark.createDataFrame(rows, "C_ACCOUNT_CODE string, C_TRANSACTION_DATE timestamp_ntz, " + ", ".join(
        f"{name} decimal(15,0)" for name in names
    ))


def advances(spark, rows):
    return spark.createDataFrame(
        rows, "C_ACCOUNT_CODE string, C_WITHDRAW_DATE timestamp_ntz, C_CASH_VOLUME decimal(38,10)"
    )


def deals(spark, rows):
    return spark.createDataFrame(rows, (
        "C_ACCOUNT_CODE string, C_TRANSACTION_DATE timestamp_ntz, C_MATCHED_PRICE decimal(38,10), "
        "C_MATCHED_VOLUME decimal(38,10)"
    ))


def D(*values):
    return [None if v is None else Decimal(v) for v in values]


@pytest.fixture
def facts(spark):
    later = [DAY + dt.timedelta(days=i) for i in range(4)]
    return (
        margin(spark, [("1111111", later[0], *D(10, 1, 5, 2)), ("1111111", later[0], *D(10, None, 5, 2)), (None, DAY, *D(1, 1, 1, 1))]),
        debit(spark, [("1111111", later[1], *D(9, 1, 8, 2, 7, 3)), ("2222222", DAY, *D(5, None, 1, 1, 1, 1)), ("2222222", None, *D(1, 1, 1, 1, 1, 1))]),
        advances(spark, [("1111111", later[2], Decimal("2.5")), ("33333", DAY, Decimal("7")), (None, None, Decimal("1"))]),
        deals(spark, [("1111111", later[3], *D(3, 4)), ("1111111", later[3], *D(5, 6)), (None, DAY, *D(1, 1)), ("4444444", DAY, Decimal("1.0000000001"), Decimal(1))]),
    )


def by_key(df):
    return {(row.C_ACCOUNT_CODE, row.C_DATE): row for row in df.collect()}


def test_each_measure_on_its_own_day(facts):
    rows = by_key(gold.back_data(*facts))
    own = [tuple(rows["1111111", DAY + dt.timedelta(days=i)][m] for m in gold.MEASURES) for i in range(4)]
    assert own == [(12, 0, 0, 0), (0, 18, 0, 0), (0, 0, Decimal("2.5"), 0), (0, 0, 0, 42)]


def test_null_terms_are_skipped_and_missing_measures_are_zero(facts):
    rows = by_key(gold.back_data(*facts))
    assert rows["2222222", DAY].C_MBLINK_DEBT == 0
    short = rows["33333", DAY]
    assert (short.C_ORIGIN_ACCOUNT_CODE, short.C_RANKING_KEY, short.C_KY_KPI) == ("33333", "33333_2024_6", "2024 Ky 1")
    assert (short.C_MONTH, short.C_YEAR, short.C_MARGIN_DEBT, short.C_UTTB) == (6, 2024, 0, 7)


def test_rows_without_key_or_exact_value_are_reported(facts):
    assert all(None not in key for key in by_key(gold.back_data(*facts)))
    reasons = Counter((row.measure, row.reason) for row in gold.back_data_rejects(*facts).collect())
    assert reasons == {
        ("margin", "no account or date"): 1, ("debit", "no account or date"): 1, ("advance", "no account or date"): 1,
        ("deal", "no account or date"): 1, ("deal", "value is rounded"): 1,
    }


def test_union_form_equals_joined_form(spark, folder):
    tables = bindings.facts(spark, folder)
    union, joined = gold.back_data(*tables), gold.back_data_joined(*tables)
    assert union.columns == joined.columns
    assert union.exceptAll(joined).count() == 0
    assert joined.exceptAll(union).count() == 0


def test_joined_form_on_non_null_keys(facts):
    joined = {key: tuple(row) for key, row in by_key(gold.back_data_joined(*facts)).items() if None not in key}
    assert joined == {key: tuple(row) for key, row in by_key(gold.back_data(*facts)).items()}


def test_writing_days_twice_keeps_them_once(spark, facts, tmp_path):
    path = str(tmp_path / "gold")
    for _ in range(2):
        gold.write_account_days(gold.back_data(*facts), path)
    stored = spark.read.parquet(path)
    assert stored.count() == gold.back_data(*facts).count()
    assert stored.schema["C_GTGD"].dataType.simpleString() == "decimal(38,18)"


def test_late_advance_changes_its_day_only(spark, facts, tmp_path):
    path = str(tmp_path / "gold")
    gold.write_account_days(gold.back_data(*facts), path)
    late = advances(spark, [("1111111", DAY, Decimal("100"))])
    whole = (facts[0], facts[1], facts[2].union(late), facts[3])
    touched = refresh.touched_periods(late, "C_WITHDRAW_DATE")
    assert touched == [DAY.date()]
    refresh.refresh_account_days(*whole, path, touched)
    rows = by_key(spark.read.parquet(path))
    assert (rows["1111111", DAY].C_UTTB, rows["1111111", DAY].C_MARGIN_DEBT) == (100, 12)
    assert len(rows) == gold.back_data(*facts).count()


def test_backfill_range_is_the_union_of_its_days(spark, folder):
    tables = bindings.facts(spark, folder)
    first, end = dt.date(1996, 3, 1), dt.date(1996, 3, 4)
    days = [first + dt.timedelta(days=i) for i in range(3)]
    whole = Counter(map(tuple, gold.back_data_days(*tables, first, end).collect()))
    parts = Counter()
    for day in days:
        parts.update(map(tuple, gold.back_data_days(*tables, day, day + dt.timedelta(days=1)).collect()))
    assert whole == parts and whole


def test_known_accounts(spark, facts):
    accounts = spark.createDataFrame([("33333",), ("33333",)], "C_ACCOUNT_CODE string")
    assert [row.C_ACCOUNT_CODE for row in gold.known_accounts(gold.back_data(*facts), accounts).collect()] == ["33333"]


def test_ranking_of_december_takes_effect_in_january(spark):
    detail = spark.createDataFrame(
        [("111111", Decimal(2023), Decimal(12), "A")] * 2 + [("111111", Decimal(2024), Decimal(3), "B")],
        "C_ORIGIN_ACCOUNT_CODE string, C_YEAR decimal(4,0), C_MONTH decimal(2,0), C_SYNTHETIC_ANNOUCED_RANKING string",
    )
    assert {tuple(row) for row in gold.erc_ranking(detail).collect()} == {
        ("111111", 2024, 1, "A", "111111_2024_1"), ("111111", 2024, 4, "B", "111111_2024_4"),
    }
    accounts = spark.createDataFrame([("1111119",), ("1111118",), ("2222229",)], "C_ACCOUNT_CODE string")
    assert {row.C_KY_KPI for row in gold.erc_ranking_of_known(detail, accounts).collect()} == {"2024 Ky 1"}


def test_one_account_with_most_rows(spark):
    rows = [("1111111", DAY, *D(1, 0, 0, 0))] * 3000 + [(f"{i:07d}", DAY, *D(1, 0, 0, 0)) for i in range(300)]
    empty = debit(spark, []), advances(spark, []), deals(spark, [])
    result = by_key(gold.back_data(margin(spark, rows), *empty))
    assert result["1111111", DAY].C_MARGIN_DEBT == 3000
    assert len(result) == 301


def test_one_row_per_account_code(spark):
    accounts = spark.createDataFrame(
        [("k1", "1234567", "17", "MBB", 5), ("k2", "1234567", "18", "WEB", 9), ("k3", None, "17", "WEB", 1)],
        "PK_ACCOUNT string, C_ACCOUNT_CODE string, C_ACCOUNT_BRANCH_CODE string, C_CHANNEL string, ts_ms long",
    ).withColumns({"C_OPEN_DATE": F.lit(None).cast("date")})
    assert [row.C_CHANNEL_NAME for row in gold.back_account_dim(accounts).collect()] == ["MBS"]
    opened = spark.createDataFrame([("1234567", dt.date(2020, 1, 1)), ("1234567", dt.date(2021, 1, 1))], "C_ACCOUNT_CODE string, C_OPEN_DATE date")
    found = gold.account_open_dates(accounts, opened).collect()
    assert [(row.C_OPEN_DATE, row.C_CHANNEL) for row in found] == [(dt.date(2021, 1, 1), "WEB")]


def test_labels_are_added_where_account_days_are_written(spark, facts, tmp_path, monkeypatch):
    moved, gather = [], tables.gather

    def seen(df, partition_by):
        moved.append(set(df.columns))
        return gather(df, partition_by)

    monkeypatch.setattr(tables, "gather", seen)
    whole = gold.back_data(*facts)
    gold.write_account_days(whole, str(tmp_path / "gold"))
    assert moved == [{*gold.ACCOUNT_DAY, *gold.MEASURES, "partition_day"}]
    stored = by_key(spark.read.parquet(str(tmp_path / "gold")))
    assert {key: (row.C_RANKING_KEY, row.C_KY_KPI, row.C_MONTH) for key, row in stored.items()} == {
        key: (row.C_RANKING_KEY, row.C_KY_KPI, row.C_MONTH) for key, row in by_key(whole.where("C_ACCOUNT_CODE IS NOT NULL")).items()}
