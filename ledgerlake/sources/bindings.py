"""Test tables in brokerage shape: whole tables of the supplied test set under the names and types of the source
systems. Used by the registered queries and tests only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans import gold
from ledgerlake.schemas import TICK_CLASS

CODE_LENGTH = 7
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_AMOUNTS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def account_code(number: str) -> Column:
    """Account code of a number: at least seven digits."""
    text = F.col(number).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(CODE_LENGTH)), F.lit("0"))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(15,2)")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the account and date of their order. Amounts become decimals before the join, which are shorter to move."""
    lines = table(spark, folder, "lineitem").withColumns({name: money(name) for name in LINE_AMOUNTS})
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumn(
        "C_ACCOUNT_CODE", account_code("o_custkey")
    )


def line_key() -> Column:
    return F.concat_ws("-", *(F.col(name).cast("string") for name in LINE_KEY))


def deal_amounts() -> list[Column]:
    return [money("l_extendedprice").alias("C_MATCHED_PRICE"), money("l_quantity").alias("C_MATCHED_VOLUME")]


def margin_amounts() -> list[Column]:
    price, discount = money("l_extendedprice"), money("l_discount")
    return [
        price.alias("C_INTERM_LOAN"), (price * discount).alias("C_INTERM_LOAN_OUT"),
        money("l_quantity").alias("C_OUTTERM_LOAN"), money("l_tax").alias("C_OUTTERM_LOAN_OUT"),
    ]


def debit_amounts() -> list[Column]:
    return [
        money("l_extendedprice").alias("C_INTERM_BALANCE"), money("l_tax").alias("C_INTERM_CASH_OUT"),
        money("l_quantity").alias("C_OUTTERM_BALANCE"), money("l_discount").alias("C_OUTTERM_CASH_OUT"),
        money("l_quantity").alias("C_MBS_EXPIRE_DEBIT"), money("l_tax").alias("C_TLO_COL_1"),
    ]


def deal_history(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).select(
        line_key().alias("PK_DEAL"), "C_ACCOUNT_CODE", F.col("o_orderdate").alias("C_TRANSACTION_DATE"),
        *deal_amounts(),
    )


def margin_balance(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).where("l_returnflag = 'N'").select(
        line_key().alias("C_DEFAULT_PRIMARY_KEY"), "C_ACCOUNT_CODE", F.col("l_shipdate").alias("C_TRADING_DATE"),
        *margin_amounts(),
    )


def debit_balance(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).where("l_returnflag = 'R'").select(
        line_key().alias("PK_TLO_DEBIT_BALANCE"), "C_ACCOUNT_CODE", F.col("l_shipdate").alias("C_TRANSACTION_DATE"),
        *debit_amounts(),
    )


def advance_withdraw(spark: SparkSession, folder: str) -> DataFrame:
    days = F.make_dt_interval((F.col("o_orderkey") % 5).cast("int"))
    return table(spark, folder, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string").alias("PK_ADVANCE_WITHDRAW"),
        account_code("o_custkey").alias("C_ACCOUNT_CODE"), F.col("o_orderdate").alias("C_WITHDRAW_DATE"),
        (F.col("o_orderdate") + days).alias("C_APPROVE_TIME"), money("o_totalprice").alias("C_CASH_VOLUME"),
    )


def facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four fact tables in the argument order of ``gold.back_data``."""
    return (
        margin_balance(spark, folder), debit_balance(spark, folder),
        advance_withdraw(spark, folder), deal_history(spark, folder),
    )


def back_account(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    opened = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("C_OPEN_DATE"))
    customers = table(spark, folder, "customer")
    return customers.join(opened, customers.c_custkey == opened.o_custkey, "left").select(
        F.col("c_custkey").cast("string").alias("PK_ACCOUNT"), account_code("c_custkey").alias("C_ACCOUNT_CODE"),
        F.col("c_nationkey").cast("string").alias("C_ACCOUNT_BRANCH_CODE"),
        F.when(F.col("c_mktsegment") == "BUILDING", "MBB").otherwise(F.col("c_mktsegment")).alias("C_CHANNEL"),
        "C_OPEN_DATE",
    )


def ranking_detail(spark: SparkSession, folder: str) -> DataFrame:
    """One ranking per customer and month; ten customers share an origin account."""
    orders = table(spark, folder, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("decimal(4,0)").alias("C_YEAR"),
        F.month("o_orderdate").cast("decimal(2,0)").alias("C_MONTH"), "o_orderpriority",
    )
    ranked = orders.groupBy("o_custkey", "C_YEAR", "C_MONTH").agg(
        F.min("o_orderpriority").alias("C_SYNTHETIC_ANNOUCED_RANKING")
    )
    code = account_code("o_custkey")
    return ranked.select(
        F.concat_ws("-", code, F.col("C_YEAR").cast("string"), F.col("C_MONTH").cast("string")).alias(
            "PK_MONTHLY_DETAIL_ID"
        ),
        "C_MONTH", "C_YEAR", F.col("o_custkey").cast("string").alias("C_CUSTOMER_CODE"),
        F.substring(code, 1, 6).alias("C_ORIGIN_ACCOUNT_CODE"), "C_SYNTHETIC_ANNOUCED_RANKING",
    )


def front_user(spark: SparkSession, folder: str) -> DataFrame:
    """One front user per customer."""
    created = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 28).cast("int")).cast("timestamp_ntz")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("PK_FRONT_USER"), created.alias("C_DATE_CREATE"))


def branch_bank(spark: SparkSession, folder: str) -> DataFrame:
    """One bank branch per supplier."""
    return table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("PK_BRANCH_BANK"))


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All loaded tables, by the name of their spec."""
    margin, debit, advances, deals = facts(spark, folder)
    return {
        "fact_t_back_advance_withdraw": advances, "fact_t_back_deal_history": deals,
        "fact_t_tlo_debit_balance_history": debit, "fact_t_margin_extra_balance_his": margin,
        "fact_v_t_erc_monthly_detail": ranking_detail(spark, folder),
        "dim_t_list_branch_bank_adv_wdr": branch_bank(spark, folder), "dim_v_t_list_front_user": front_user(spark, folder),
    }


def index_tick(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("IndexCode"), F.col("ts").alias("Last_updated"),
        (money("value") * 100).cast("bigint").alias("TotalValuesTraded"),
    )


def _operation() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "signup", "c").when(kind == "error", "d").when(kind == "view", "r").otherwise("u")


def _millis() -> Column:
    return F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")


def _change_text(row: Column) -> Column:
    """Change record as text: a delete carries the row before, other records the row after."""
    payload = F.struct(
        F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"),
        "op", "ts_ms", F.struct(F.col("event_id").cast("string").alias("scn"), "ts_ms").alias("source"),
    )
    return F.to_json(F.struct(payload.alias("payload"))).alias("value")


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumns({"op": _operation(), "ts_ms": _millis()})


def deal_wire(spark: SparkSession, folder: str) -> DataFrame:
    """Deal change records, one per event; every user has four deals."""
    row = F.struct(
        (F.col("user_id") * 4 + F.col("event_id") % 4).cast("double").alias("PK_FRONT_DEAL"),
        account_code("user_id").alias("C_ACCOUNT_CODE"), F.col("value").alias("C_MATCHED_PRICE"),
        F.get_json_object("props", "$.k").cast("double").alias("C_MATCHED_VOLUME"),
    )
    return _changes(spark, folder).select(_change_text(row))


def account_wire(spark: SparkSession, folder: str, moved_from: int | None = None) -> DataFrame:
    """Account change records, one per event; one account per user. From the time ``moved_from`` (epoch milliseconds) on, every
    account has the code of the next user."""
    changes = _changes(spark, folder)
    moved = F.lit(0) if moved_from is None else (F.col("ts_ms") >= moved_from).cast("int")
    changes = changes.withColumn("holder", F.col("user_id") + moved)
    row = F.struct(
        F.col("user_id").cast("string").alias("PK_ACCOUNT"), account_code("holder").alias("C_ACCOUNT_CODE"),
        (F.col("event_id") % 25).cast("string").alias("C_ACCOUNT_BRANCH_CODE"),
        F.when(F.col("event_type") == "click", "MBB").otherwise("WEB").alias("C_CHANNEL"),
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("C_CREATE_TIME"),
    )
    return changes.select(_change_text(row))


def tick_wire(spark: SparkSession, folder: str) -> DataFrame:
    """Tick messages, one per event; those of ``error`` events have another message class."""
    other = TICK_CLASS.split(".")[0] + ".SessionUpdate"
    kind = F.when(F.col("event_type") == "error", other).otherwise(TICK_CLASS)
    time = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    body = F.struct(
        F.struct(F.lit("index").alias("MessageType"), time.alias("Last_updated")).alias("Header"),
        F.col("event_type").alias("IndexCode"),
        F.struct("value").alias("IndexValue"),
        F.struct((money("value") * 100).cast("bigint").alias("value")).alias("TotalValuesTraded"),
        F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("value")).alias("TotalTrades"),
        time.alias("Time"),
    )
    message = F.struct(F.concat(F.lit("type.googleapis.com/"), kind).alias("type_url"), body.alias("value"))
    return table(spark, folder, "events").select(F.to_json(message).alias("value"))
