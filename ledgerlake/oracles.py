"""The registered queries as SQL over the supplied tables, for comparison."""

from __future__ import annotations


def account(number: str) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(length({text}), 7) AS INTEGER), '0')"


def money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(15,2))"


LINE_KEY = " || '-' || ".join(
    f"CAST({column} AS VARCHAR)" for column in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
)
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"

VIEWS = {
    "deal_history": f"""
        SELECT {LINE_KEY} AS PK_DEAL, {account('o_custkey')} AS C_ACCOUNT_CODE, o_orderdate AS C_TRANSACTION_DATE,
               {money('l_extendedprice')} AS C_MATCHED_PRICE, {money('l_quantity')} AS C_MATCHED_VOLUME
        FROM {LINES}""",
    "margin_balance": f"""
        SELECT {LINE_KEY} AS C_DEFAULT_PRIMARY_KEY, {account('o_custkey')} AS C_ACCOUNT_CODE, l_shipdate AS C_TRADING_DATE,
               {money('l_extendedprice')} AS C_INTERM_LOAN,
               {money('l_extendedprice')} * {money('l_discount')} AS C_INTERM_LOAN_OUT,
               {money('l_quantity')} AS C_OUTTERM_LOAN, {money('l_tax')} AS C_OUTTERM_LOAN_OUT
        FROM {LINES} WHERE l_returnflag = 'N'""",
    "debit_balance": f"""
        SELECT {LINE_KEY} AS PK_TLO_DEBIT_BALANCE, {account('o_custkey')} AS C_ACCOUNT_CODE, l_shipdate AS C_TRANSACTION_DATE,
               {money('l_extendedprice')} AS C_INTERM_BALANCE, {money('l_tax')} AS C_INTERM_CASH_OUT,
               {money('l_quantity')} AS C_OUTTERM_BALANCE, {money('l_discount')} AS C_OUTTERM_CASH_OUT,
               {money('l_quantity')} AS C_MBS_EXPIRE_DEBIT, {money('l_tax')} AS C_TLO_COL_1
        FROM {LINES} WHERE l_returnflag = 'R'""",
    "advance_withdraw": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS PK_ADVANCE_WITHDRAW, {account('o_custkey')} AS C_ACCOUNT_CODE,
               o_orderdate AS C_WITHDRAW_DATE,
               o_orderdate + CAST(o_orderkey % 5 AS INTEGER) * INTERVAL 1 DAY AS C_APPROVE_TIME,
               {money('o_totalprice')} AS C_CASH_VOLUME
        FROM orders WHERE o_orderstatus = 'F'""",
    "margin_sum": """
        SELECT C_ACCOUNT_CODE, C_TRADING_DATE AS C_DATE,
               CAST(SUM(C_INTERM_LOAN - C_INTERM_LOAN_OUT + C_OUTTERM_LOAN - C_OUTTERM_LOAN_OUT) AS DECIMAL(38,4))
                   AS C_MARGIN_DEBT
        FROM margin_balance GROUP BY 1, 2""",
    "debit_sum": """
        SELECT C_ACCOUNT_CODE, C_TRANSACTION_DATE AS C_DATE,
               CAST(SUM(C_INTERM_BALANCE - C_INTERM_CASH_OUT + C_OUTTERM_BALANCE - C_OUTTERM_CASH_OUT
                        + C_MBS_EXPIRE_DEBIT - C_TLO_COL_1) AS DECIMAL(38,2)) AS C_MBLINK_DEBT
        FROM debit_balance GROUP BY 1, 2""",
    "advance_sum": """
        SELECT C_ACCOUNT_CODE, C_WITHDRAW_DATE AS C_DATE, CAST(SUM(C_CASH_VOLUME) AS DECIMAL(38,2)) AS C_UTTB
        FROM advance_withdraw GROUP BY 1, 2""",
    "deal_sum": """
        SELECT C_ACCOUNT_CODE, C_TRANSACTION_DATE AS C_DATE,
               CAST(SUM(C_MATCHED_PRICE * C_MATCHED_VOLUME) AS DECIMAL(38,4)) AS C_GTGD
        FROM deal_history GROUP BY 1, 2""",
    "joined": """
        SELECT C_ACCOUNT_CODE, C_DATE, C_MARGIN_DEBT, C_MBLINK_DEBT, C_UTTB, C_GTGD
        FROM margin_sum FULL JOIN debit_sum USING (C_ACCOUNT_CODE, C_DATE)
        FULL JOIN advance_sum USING (C_ACCOUNT_CODE, C_DATE) FULL JOIN deal_sum USING (C_ACCOUNT_CODE, C_DATE)""",
    "gold": """
        SELECT left(C_ACCOUNT_CODE, 6) AS C_ORIGIN_ACCOUNT_CODE, C_ACCOUNT_CODE, C_DATE,
               CAST(month(C_DATE) AS INTEGER) AS C_MONTH, CAST(year(C_DATE) AS INTEGER) AS C_YEAR,
               COALESCE(C_MARGIN_DEBT, 0) AS C_MARGIN_DEBT, COALESCE(C_MBLINK_DEBT, 0) AS C_MBLINK_DEBT,
               COALESCE(C_UTTB, 0) AS C_UTTB, COALESCE(C_GTGD, 0) AS C_GTGD,
               left(C_ACCOUNT_CODE, 6) || '_' || year(C_DATE) || '_' || month(C_DATE) AS C_RANKING_KEY,
               year(C_DATE) || CASE WHEN month(C_DATE) <= 6 THEN ' Ky 1' ELSE ' Ky 2' END AS C_KY_KPI
        FROM joined""",
    "back_account": f"""
        SELECT {account('c_custkey')} AS C_ACCOUNT_CODE, CAST(c_nationkey AS VARCHAR) AS C_ACCOUNT_BRANCH_CODE,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'MBB' ELSE c_mktsegment END AS C_CHANNEL, C_OPEN_DATE
        FROM customer LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS C_OPEN_DATE FROM orders GROUP BY 1)
             ON c_custkey = o_custkey""",
    "ranking_detail": f"""
        SELECT {account('o_custkey')} || '-' || year(o_orderdate) || '-' || month(o_orderdate)
                   AS PK_MONTHLY_DETAIL_ID,
               CAST(month(o_orderdate) AS DECIMAL(2,0)) AS C_MONTH, CAST(year(o_orderdate) AS DECIMAL(4,0)) AS C_YEAR,
               CAST(o_custkey AS VARCHAR) AS C_CUSTOMER_CODE, left({account('o_custkey')}, 6) AS C_ORIGIN_ACCOUNT_CODE,
               MIN(o_orderpriority) AS C_SYNTHETIC_ANNOUCED_RANKING
        FROM orders GROUP BY o_custkey, year(o_orderdate), month(o_orderdate)""",
    "ranking": """
        SELECT DISTINCT C_ORIGIN_ACCOUNT_CODE,
               CAST(C_YEAR AS INTEGER) + CASE WHEN C_MONTH = 12 THEN 1 ELSE 0 END AS C_YEAR_ADJ,
               CASE WHEN C_MONTH = 12 THEN 1 ELSE CAST(C_MONTH AS INTEGER) + 1 END AS C_MONTH_ADJ,
               C_SYNTHETIC_ANNOUCED_RANKING
        FROM ranking_detail""",
    "changes": f"""
        SELECT event_id, user_id, epoch_us(ts) // 1000 AS ts_ms, ts, event_type, value, props,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END AS op,
               make_timestamp(epoch_us(ts) // 1000 * 1000) + INTERVAL 7 HOUR AS updated_at,
               CAST(user_id * 4 + event_id % 4 AS VARCHAR) AS PK_FRONT_DEAL, {account('user_id')} AS account_code,
               CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS volume
        FROM events""",
    "accounts": """
        SELECT CAST(user_id AS VARCHAR) AS PK_ACCOUNT, op, ts_ms, event_id AS scn, account_code AS C_ACCOUNT_CODE,
               CAST(event_id % 25 AS VARCHAR) AS C_ACCOUNT_BRANCH_CODE,
               CASE event_type WHEN 'click' THEN 'MBB' ELSE 'WEB' END AS C_CHANNEL
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS place
              FROM changes)
        WHERE place = 1 AND op <> 'd'""",
    "deals_today": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY PK_FRONT_DEAL ORDER BY ts_ms DESC, event_id DESC) AS place
            FROM changes WHERE CAST(updated_at AS DATE) = DATE '2024-01-15')
        WHERE place = 1 AND op <> 'd'""",
    "deals_current": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY PK_FRONT_DEAL ORDER BY ts_ms DESC, event_id DESC) AS place
            FROM changes)
        WHERE place = 1 AND op <> 'd'""",
    "ticks": f"""
        SELECT event_type AS IndexCode, ts + INTERVAL 7 HOUR AS trading_time,
               CAST({money('value')} * 100 AS BIGINT) AS TotalValuesTraded
        FROM events""",
    "last_ticks": """
        SELECT IndexCode, trading_time, TotalValuesTraded, CAST(trading_time AS DATE) AS C_DATE
        FROM (SELECT *, row_number() OVER (PARTITION BY IndexCode, CAST(trading_time AS DATE)
                                           ORDER BY trading_time DESC, TotalValuesTraded DESC) AS place FROM ticks)
        WHERE place = 1""",
}

# views that each view reads, in definition order
NEEDS = {
    "margin_sum": ["margin_balance"], "debit_sum": ["debit_balance"], "advance_sum": ["advance_withdraw"],
    "deal_sum": ["deal_history"], "joined": ["margin_sum", "debit_sum", "advance_sum", "deal_sum"],
    "gold": ["joined"], "ranking": ["ranking_detail"], "accounts": ["changes"], "deals_today": ["changes"],
    "deals_current": ["changes"], "last_ticks": ["ticks"],
}


def _needed(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        for view in [*_needed(NEEDS.get(name, [])), name]:
            if view not in found:
                found.append(view)
    return found


def over(views: str, select: str) -> str:
    """``select`` with the named views defined before it."""
    names = _needed(views.split())
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names) + f"\n{select}"


CALENDAR = "CAST(month(C_DATE) AS INTEGER) AS C_MONTH, CAST(year(C_DATE) AS INTEGER) AS C_YEAR"
RANKING_KEY = "C_ORIGIN_ACCOUNT_CODE || '_' || C_YEAR_ADJ || '_' || C_MONTH_ADJ AS C_RANKING_KEY"
ADVANCE_COLUMNS = (
    "PK_ADVANCE_WITHDRAW, C_ACCOUNT_CODE, C_APPROVE_TIME, C_CASH_VOLUME, CAST(C_APPROVE_TIME AS DATE) AS partition_date"
)
LOADED, RELOADED = "TIMESTAMP '2024-02-01 01:00:00'", "TIMESTAMP '2024-02-02 01:00:00'"
SILVER_DEAL = (
    "PK_DEAL, C_ACCOUNT_CODE, C_TRANSACTION_DATE, CAST(C_MATCHED_PRICE AS DECIMAL(38,10)) AS C_MATCHED_PRICE, "
    "CAST(C_MATCHED_VOLUME AS DECIMAL(38,10)) AS C_MATCHED_VOLUME, "
    f"CAST(C_TRANSACTION_DATE AS DATE) AS partition_date, {LOADED} AS valid_from, TRUE AS is_current"
)
DEAL_VALUE = "CAST(SUM(CAST(value AS DECIMAL(18,6)) * CAST(volume AS DECIMAL(18,6))) AS DECIMAL(38,4)) AS C_GTGD"


def _front(view: str) -> str:
    return over(view, f"""
        SELECT left(account_code, 6) AS C_ORIGIN_ACCOUNT_CODE, account_code AS C_ACCOUNT_CODE,
               DATE '2024-01-15' AS C_DATE, 1 AS C_MONTH, 2024 AS C_YEAR,
               CAST(0 AS DECIMAL(38,4)) AS C_MARGIN_DEBT, CAST(0 AS DECIMAL(38,2)) AS C_MBLINK_DEBT,
               CAST(0 AS DECIMAL(38,2)) AS C_UTTB, {DEAL_VALUE},
               left(account_code, 6) || '_2024_1' AS C_RANKING_KEY, '2024 Ky 1' AS C_KY_KPI
        FROM {view} GROUP BY account_code""")


GOLD = over("gold", "SELECT * FROM gold")
STORED_GOLD = over("gold", """
        SELECT * REPLACE (CAST(C_MARGIN_DEBT AS DECIMAL(38,0)) AS C_MARGIN_DEBT,
                          CAST(C_MBLINK_DEBT AS DECIMAL(38,0)) AS C_MBLINK_DEBT,
                          CAST(C_UTTB AS DECIMAL(38,10)) AS C_UTTB, CAST(C_GTGD AS DECIMAL(38,18)) AS C_GTGD)
        FROM gold""")
MOVED_ADVANCES = f"""
        SELECT * REPLACE (C_WITHDRAW_DATE + CASE WHEN C_WITHDRAW_DATE >= '1997-05-01' AND C_WITHDRAW_DATE < '1997-06-01'
                                                 THEN CAST(PK_ADVANCE_WITHDRAW AS INTEGER) % 3 * 20 ELSE 0 END * INTERVAL 1 DAY
                              AS C_WITHDRAW_DATE)
        FROM ({VIEWS["advance_withdraw"]})"""
LOG = over("changes", """
        SELECT CAST(user_id AS VARCHAR) AS PK_ACCOUNT,
               CASE WHEN op = 'c' THEN updated_at ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) END AS created_at,
               updated_at, op, CASE WHEN op <> 'd' THEN account_code END AS C_ACCOUNT_CODE,
               CASE WHEN op = 'd' THEN NULL WHEN event_type = 'click' THEN 'MBB' ELSE 'WEB' END AS C_CHANNEL,
               CAST(updated_at AS DATE) AS partition_date, ts_ms, event_id AS scn
        FROM changes""")
LOST_KEYS = "CASE WHEN right(C_ACCOUNT_CODE, 1) <> '7' THEN C_ACCOUNT_CODE END AS C_ACCOUNT_CODE"


# Per table: view, key, business date of its days and the column it is loaded by.
DAILY = {
    "fact_t_back_advance_withdraw": ("advance_withdraw", "PK_ADVANCE_WITHDRAW", "C_APPROVE_TIME"),
    "fact_t_back_deal_history": ("deal_history", "PK_DEAL", "C_TRANSACTION_DATE"),
    "fact_t_tlo_debit_balance_history": ("debit_balance", "PK_TLO_DEBIT_BALANCE", "C_TRANSACTION_DATE"),
    "fact_t_margin_extra_balance_his": ("margin_balance", "C_DEFAULT_PRIMARY_KEY", "C_TRADING_DATE"),
}
FACT_VIEWS = " ".join(view for view, _, _ in DAILY.values())


def _summary(table: str, source: str, key: str, part: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, COUNT(*) AS rows, COUNT(DISTINCT {key}) AS keys, COUNT(DISTINCT {part}) AS partitions,
               MIN({part}) AS first_partition, MAX({part}) AS last_partition, COUNT(*) AS current_rows
        FROM {source}"""


def _silver_tables(where: str) -> str:
    """Summaries of all seven tables, the daily ones cut by ``where`` on their day."""
    parts = []
    for table, (view, key, date) in DAILY.items():
        day = f"CAST({date} AS DATE)"
        parts.append(_summary(table, f"(SELECT * FROM {view} WHERE {where.format(day=day)})", key, f"CAST({day} AS VARCHAR)"))
    parts.append(_summary("fact_v_t_erc_monthly_detail", "ranking_detail", "PK_MONTHLY_DETAIL_ID",
                          "(CAST(C_YEAR AS INTEGER) || '/' || CAST(C_MONTH AS INTEGER))"))
    parts.append(_summary("dim_t_list_branch_bank_adv_wdr", "supplier", "s_suppkey", "''"))
    parts.append(_summary("dim_v_t_list_front_user", "customer", "c_custkey",
                          "CAST(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER) AS VARCHAR)"))
    return over(f"{FACT_VIEWS} ranking_detail", " UNION ALL ".join(parts))


def _rejected(measure: str, view: str, date: str) -> str:
    return f"""
        SELECT '{measure}' AS measure, {LOST_KEYS}, CASE WHEN right(C_ACCOUNT_CODE, 1) <> '3' THEN {date} END AS C_DATE,
               'no account or date' AS reason
        FROM {view} WHERE right(C_ACCOUNT_CODE, 1) IN ('3', '7')"""
DEAL_STATE = over("deals_current", """
    SELECT PK_FRONT_DEAL, account_code AS C_ACCOUNT_CODE, value AS C_MATCHED_PRICE, volume AS C_MATCHED_VOLUME,
           0 AS __op, ts_ms
    FROM deals_current""")

ORACLES: dict[str, str] = {
    "extract_full": "SELECT * FROM orders",
    "extract_projection": "SELECT c_custkey, c_mktsegment FROM customer",
    "extract_year": over("deal_history", "SELECT * FROM deal_history WHERE year(C_TRANSACTION_DATE) = 1997"),
    "extract_daily_window": over(
        "deal_history", "SELECT * FROM deal_history WHERE CAST(C_TRANSACTION_DATE AS DATE) = DATE '1997-05-28'"
    ),
    "extract_prev_month": over(
        "ranking_detail", "SELECT * FROM ranking_detail WHERE C_YEAR = 1997 AND C_MONTH = 12"
    ),
    "scan_partition_day": over(
        "advance_withdraw",
        f"SELECT {ADVANCE_COLUMNS} FROM advance_withdraw WHERE CAST(C_APPROVE_TIME AS DATE) = DATE '1997-05-28'",
    ),
    "scan_partition_year": over(
        "advance_withdraw", f"SELECT {ADVANCE_COLUMNS} FROM advance_withdraw WHERE year(C_APPROVE_TIME) = 1998"
    ),
    "add_lineage": f"""
        SELECT c_custkey, c_name, {LOADED} AS valid_from, TRUE AS open_ended, TRUE AS is_current
        FROM customer""",
    "cast_decimals": over("deal_history", """
        SELECT PK_DEAL, CAST(C_MATCHED_PRICE AS DECIMAL(38,10)) AS C_MATCHED_PRICE,
               CAST(C_MATCHED_VOLUME AS DECIMAL(38,10)) AS C_MATCHED_VOLUME
        FROM deal_history"""),
    "fn_calendar": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS C_YEAR, CAST(month(o_orderdate) AS INTEGER) AS C_MONTH,
               CAST(o_orderdate AS DATE) AS C_DATE, strftime(o_orderdate, '%Y-%m-%d') AS partition_text
        FROM orders""",
    "fn_origin_account": f"""
        SELECT c_custkey, left({account('c_custkey')}, 6) AS origin, left(CAST(c_custkey AS VARCHAR), 6) AS short_origin
        FROM customer""",
    "fn_ranking_key": f"""
        SELECT o_orderkey,
               left({account('o_custkey')}, 6) || '_' || year(o_orderdate) || '_' || month(o_orderdate) AS C_RANKING_KEY
        FROM orders""",
    "fn_kpi_period": """
        SELECT o_orderkey,
               CASE WHEN month(o_orderdate) BETWEEN 1 AND 6 THEN year(o_orderdate) || ' Ky 1'
                    ELSE year(o_orderdate) || ' Ky 2' END AS C_KY_KPI
        FROM orders""",
    "fn_month_shift": """
        SELECT o_orderkey, CAST(year(o_orderdate + INTERVAL 1 MONTH) AS INTEGER) AS C_YEAR_ADJ,
               CAST(month(o_orderdate + INTERVAL 1 MONTH) AS INTEGER) AS C_MONTH_ADJ
        FROM orders""",
    "fn_epoch_local": over("changes", """
        SELECT event_id, make_timestamp(ts_ms * 1000) AS utc_time, updated_at AS local_time FROM changes"""),
    "shift_timezone_columns": """
        SELECT event_id, ts + INTERVAL 7 HOUR AS updated_at,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 7 HOUR AS created_at
        FROM events""",
    "bronze_roundtrip": "SELECT * FROM orders",
    "backfill_dynamic_overwrite": over("deal_history", """
        SELECT PK_DEAL, C_TRANSACTION_DATE,
               CAST(C_MATCHED_PRICE * CASE WHEN year(C_TRANSACTION_DATE) = 1997 THEN 2 ELSE 1 END AS DECIMAL(15,2))
                   AS C_MATCHED_PRICE,
               CAST(year(C_TRANSACTION_DATE) AS INTEGER) AS partition_year
        FROM deal_history"""),
    "bronze_to_silver": over("deal_history", f"""
        SELECT {SILVER_DEAL}, {LOADED} AS create_at,
               CAST(date_trunc('year', C_TRANSACTION_DATE) AS DATE) AS partition_year
        FROM deal_history"""),
    "bronze_to_silver_days": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS PK_FRONT_USER, CAST(day AS TIMESTAMP) AS C_DATE_CREATE, day AS partition_date,
               {LOADED} AS valid_from, {LOADED} AS create_at
        FROM (SELECT c_custkey, DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER) AS day FROM customer)""",
    "bronze_to_silver_tables": _silver_tables("TRUE"),
    "source_to_silver_tables": _silver_tables("{day} BETWEEN DATE '1997-04-01' AND DATE '1997-05-31'"),
    "incremental_load_facts": over(FACT_VIEWS, " UNION ALL ".join(f"""
        SELECT '{table}' AS table_name, {key} AS key, C_ACCOUNT_CODE, CAST({date} AS DATE) AS partition_date
        FROM {view} WHERE CAST({date} AS DATE) BETWEEN DATE '1997-05-27' AND DATE '1997-05-28'"""
        for table, (view, key, date) in DAILY.items())),
    "publish_select": over("deal_history", f"SELECT {SILVER_DEAL} FROM deal_history"),
    "silver_ranking_partitions": over("ranking_detail", f"""
        SELECT *, CAST(CAST(C_YEAR AS INTEGER) AS VARCHAR) AS partition_year,
               CAST(CAST(C_MONTH AS INTEGER) AS VARCHAR) AS partition_month,
               CASE WHEN C_YEAR = 1997 AND C_MONTH = 12 THEN {RELOADED} ELSE {LOADED} END AS valid_from
        FROM ranking_detail"""),
    "register_external": "SELECT * FROM supplier",
    "append_managed_table": """
        SELECT c_custkey AS id, c_name AS name, '2024-01-01' AS partition_date FROM customer
        UNION ALL SELECT s_suppkey, s_name, '2024-01-02' FROM supplier""",
    "upsert_by_key": over("advance_withdraw", f"""
        SELECT PK_ADVANCE_WITHDRAW, C_ACCOUNT_CODE, C_WITHDRAW_DATE, C_APPROVE_TIME,
               CAST(C_CASH_VOLUME + CASE WHEN C_APPROVE_TIME >= '2000-01-01' THEN 1 ELSE 0 END AS DECIMAL(38,10))
                   AS C_CASH_VOLUME,
               CAST(C_APPROVE_TIME AS DATE) AS partition_date,
               CASE WHEN C_APPROVE_TIME >= '2000-01-01' THEN {RELOADED} ELSE {LOADED} END AS valid_from,
               CAST(date_trunc('year', C_APPROVE_TIME) AS DATE) AS partition_year
        FROM advance_withdraw"""),
    "incremental_load": over("deal_history", f"""
        SELECT {SILVER_DEAL} FROM deal_history
        WHERE CAST(C_TRANSACTION_DATE AS DATE) BETWEEN DATE '1997-05-26' AND DATE '1997-05-28'"""),
    "truncate_table": over(
        "deals_today",
        "SELECT COUNT(DISTINCT account_code) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM deals_today",
    ),
    "load_report": over("margin_balance debit_balance advance_withdraw deal_history", """
        SELECT 'margin_balance' AS table_name, COUNT(*) AS row_count FROM margin_balance
        UNION ALL SELECT 'debit_balance', COUNT(*) FROM debit_balance
        UNION ALL SELECT 'advance_withdraw', COUNT(*) FROM advance_withdraw
        UNION ALL SELECT 'deal_history', COUNT(*) FROM deal_history"""),
    "agg_margin_debt": over("margin_sum", f"SELECT *, {CALENDAR} FROM margin_sum"),
    "agg_mblink_debt": over("debit_sum", f"SELECT *, {CALENDAR} FROM debit_sum"),
    "agg_advance_withdraw": over("advance_sum", f"SELECT *, {CALENDAR} FROM advance_sum"),
    "agg_traded_value": over("deal_sum", f"SELECT *, {CALENDAR} FROM deal_sum"),
    "full_outer_two": over("margin_sum debit_sum", """
        SELECT C_ACCOUNT_CODE, C_DATE, C_MARGIN_DEBT, C_MBLINK_DEBT
        FROM margin_sum FULL JOIN debit_sum USING (C_ACCOUNT_CODE, C_DATE)"""),
    "back_data": GOLD,
    "back_data_four_tables": GOLD,
    "back_data_fullouter": GOLD,
    "back_data_daily": over("gold", "SELECT * FROM gold WHERE CAST(C_DATE AS DATE) = DATE '1997-05-28'"),
    "back_data_known_accounts": over(
        "gold accounts", "SELECT * FROM gold WHERE C_ACCOUNT_CODE IN (SELECT C_ACCOUNT_CODE FROM accounts)"
    ),
    "front_data": _front("deals_today"),
    "front_data_current": _front("deals_current"),
    "dim_erc_ranking": over("ranking", f"SELECT *, {RANKING_KEY} FROM ranking"),
    "dim_erc_ranking_monthly": over(
        "ranking", f"SELECT *, {RANKING_KEY} FROM ranking WHERE C_YEAR_ADJ = 1998 AND C_MONTH_ADJ = 1"
    ),
    "erc_ranking_known_accounts": over("ranking accounts", f"""
        SELECT *, {RANKING_KEY},
               C_YEAR_ADJ || CASE WHEN C_MONTH_ADJ <= 6 THEN ' Ky 1' ELSE ' Ky 2' END AS C_KY_KPI
        FROM ranking WHERE C_ORIGIN_ACCOUNT_CODE IN (SELECT left(C_ACCOUNT_CODE, 6) FROM accounts)"""),
    "dim_back_account": over("back_account", """
        SELECT left(C_ACCOUNT_CODE, 6) AS C_ORIGIN_ACCOUNT_CODE, C_ACCOUNT_CODE, C_OPEN_DATE,
               CASE C_ACCOUNT_BRANCH_CODE WHEN '17' THEN 'KDS' ELSE 'SSG' END AS C_BRANCH_NAME,
               CASE C_CHANNEL WHEN 'MBB' THEN 'MB' ELSE 'MBS' END AS C_CHANNEL_NAME
        FROM back_account"""),
    "mv_back_account": over("accounts back_account", """
        SELECT a.C_ACCOUNT_CODE, b.C_OPEN_DATE, a.C_ACCOUNT_BRANCH_CODE, a.C_CHANNEL
        FROM accounts a JOIN back_account b ON a.C_ACCOUNT_CODE = b.C_ACCOUNT_CODE"""),
    "last_tick_per_day": over("last_ticks", "SELECT * FROM last_ticks"),
    "market_turnover_daily": over("last_ticks", """
        SELECT C_DATE, CAST(SUM(TotalValuesTraded) AS BIGINT) AS total_market_value
        FROM last_ticks GROUP BY C_DATE ORDER BY C_DATE"""),
    "refresh_touched_days": STORED_GOLD,
    "refresh_moved_rows": STORED_GOLD.replace(VIEWS["advance_withdraw"], MOVED_ADVANCES),
    "refresh_ranking": over("ranking", f"SELECT *, {RANKING_KEY} FROM ranking").replace(
        "MIN(o_orderpriority) AS", "CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) IN (3, 12) THEN 'REVISED' "
        "ELSE MIN(o_orderpriority) END AS"),
    "back_data_indexed": over("gold", "SELECT * FROM gold WHERE CAST(C_DATE AS DATE) BETWEEN DATE '1997-05-01' AND DATE '1997-05-31'"),
    "back_data_rejects": over("margin_balance debit_balance advance_withdraw deal_history", " UNION ALL ".join((
        _rejected("margin", "margin_balance", "C_TRADING_DATE"), _rejected("debit", "debit_balance", "C_TRANSACTION_DATE"),
        _rejected("advance", "advance_withdraw", "C_WITHDRAW_DATE"), _rejected("deal", "deal_history", "C_TRANSACTION_DATE")))),
    "upsert_partial_touch": over("advance_withdraw", """
        SELECT PK_ADVANCE_WITHDRAW, C_ACCOUNT_CODE, C_WITHDRAW_DATE, C_APPROVE_TIME,
               CAST(C_CASH_VOLUME + CASE WHEN year(C_APPROVE_TIME) = 1997 THEN 1 ELSE 0 END AS DECIMAL(15,2)) AS C_CASH_VOLUME,
               CAST(C_APPROVE_TIME AS DATE) AS partition_date,
               CAST(date_trunc('year', C_APPROVE_TIME) AS DATE) AS partition_year
        FROM advance_withdraw"""),
    "update_rows_by_predicate": """
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'REVISED' ELSE o_orderpriority END AS o_orderpriority,
               CAST(year(o_orderdate) AS INTEGER) AS partition_year
        FROM orders""",
    "cdc_apply_deltas": DEAL_STATE,
    "front_data_by_deltas": _front("deals_today"),
    "dim_back_account_incremental": over("changes", f"""
        SELECT left(code, 6) AS C_ORIGIN_ACCOUNT_CODE, code AS C_ACCOUNT_CODE,
               CASE CAST(event_id % 25 AS VARCHAR) WHEN '17' THEN 'KDS' ELSE 'SSG' END AS C_BRANCH_NAME,
               CASE event_type WHEN 'click' THEN 'MB' ELSE 'MBS' END AS C_CHANNEL_NAME
        FROM (
            SELECT *, {account('user_id + CASE WHEN ts_ms >= 1705000000000 THEN 1 ELSE 0 END')} AS code FROM changes
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1)
        WHERE op <> 'd'
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY ts_ms DESC, event_id DESC) = 1"""),
    "change_log_compacted": LOG,
    "latest_version": """
        SELECT user_id, ts, event_id, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
        WHERE place = 1""",
    "cdc_parse": over("changes", """
        SELECT PK_FRONT_DEAL, op, ts_ms, event_id AS scn, CASE WHEN op <> 'd' THEN account_code END AS C_ACCOUNT_CODE,
               CASE WHEN op <> 'd' THEN value END AS C_MATCHED_PRICE,
               CASE WHEN op <> 'd' THEN volume END AS C_MATCHED_VOLUME
        FROM changes"""),
    "cdc_plain_rows": "SELECT CAST(event_id AS VARCHAR) AS PK_FRONT_DEAL, value AS C_MATCHED_PRICE FROM events",
    "register_partitioned": """
        SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS partition_year FROM orders""",
    "cdc_rejects": "SELECT props AS value FROM events",
    "cdc_latest": over("accounts", "SELECT * FROM accounts"),
    "cdc_change_log": LOG,
    "cdc_apply_changes": DEAL_STATE,
    "cdc_restart_idempotent": DEAL_STATE,
    "dim_back_account_stream": over("accounts", """
        SELECT left(C_ACCOUNT_CODE, 6) AS C_ORIGIN_ACCOUNT_CODE, C_ACCOUNT_CODE,
               CASE C_ACCOUNT_BRANCH_CODE WHEN '17' THEN 'KDS' ELSE 'SSG' END AS C_BRANCH_NAME,
               CASE C_CHANNEL WHEN 'MBB' THEN 'MB' ELSE 'MBS' END AS C_CHANNEL_NAME
        FROM accounts"""),
    "tick_parse": f"""
        SELECT 'index' AS MessageType, event_type AS IndexCode, ts AS Last_updated, value AS IndexValue,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS TotalTrades,
               CAST({money('value')} * 100 AS BIGINT) AS TotalValuesTraded
        FROM events WHERE event_type <> 'error'""",
    "tick_flatten": f"""
        SELECT 'index' AS MessageType, ts AS Last_updated, event_type AS IndexCode, value AS IndexValue,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS TotalTrades,
               CAST({money('value')} * 100 AS BIGINT) AS TotalValuesTraded, ts AS "Time", 0 AS other_values
        FROM events WHERE event_type <> 'error'""",
    "market_turnover_live": over("last_ticks", """
        SELECT C_DATE, CAST(SUM(TotalValuesTraded) AS BIGINT) AS total_market_value
        FROM last_ticks WHERE IndexCode <> 'error'
        GROUP BY C_DATE"""),
    "market_turnover_stream": over("last_ticks", """
        SELECT C_DATE, CAST(SUM(TotalValuesTraded) AS BIGINT) AS total_market_value
        FROM last_ticks WHERE IndexCode <> 'error'
        GROUP BY C_DATE
        HAVING C_DATE + INTERVAL 1 DAY <=
               (SELECT MAX(trading_time) FROM ticks WHERE IndexCode <> 'error') - INTERVAL 10 MINUTE"""),
}
