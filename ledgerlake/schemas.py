"""Declared column lists of the tables and change feeds.

Every list below is a fixed value: names, types and order are the contract with the systems that produce or read
the tables. ``struct`` turns a list into a ``StructType``.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: warehouse and gold tables, in column order ---

ADVANCE_WITHDRAW = """
    PK_ADVANCE_WITHDRAW string, partition_date date, C_MARKET string, C_WITHDRAW_DATE timestamp_ntz,
    C_CREATOR_BRANCH_CODE string, C_CREATOR_SUB_BRANCH_CODE string, C_CREATOR_CODE string, C_CREATE_TIME
    timestamp_ntz, C_APPROVER_CODE string, C_APPROVE_TIME timestamp_ntz, C_ACCOUNT_CODE string, C_ACCOUNT_TYPE string,
    C_ACCOUNT_NAME string, C_TRANSACTION_NO string, C_BANK_CODE string, C_SELL_DATE timestamp_ntz, C_DUE_DATE
    timestamp_ntz, C_FILE_NO string, C_CASH_VOLUME decimal(38,10), C_FEE_RATE decimal(38,10), C_FEE decimal(38,10),
    C_CONTENT string, C_STATUS string, C_BANK_CODE_IN string, C_BRANCH_BANK_CODE string, C_BRANCH_BANK_NAME string,
    C_BY_CALL decimal(38,10), C_FEE_CTG decimal(38,10), C_FEE_TSC decimal(38,10), C_FEE_MB decimal(38,10), C_CHANNEL
    string, C_STATUS_PROCESS string, C_ATS_FLAG decimal(38,0), C_ATS_BANK_ACCOUNT string, C_ATS_BANK string,
    C_AUTHOR_CERT_ID string, C_AUTHOR_NAME string, C_PARTNER_BRANCH_BANK_CODE string, C_AUTOADV_WITHDRAW decimal(1,0),
    C_FEE_DAYS decimal(38,10), valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

DEAL_HISTORY = """
    PK_DEAL string, partition_date date, FK_DEAL_ORIGIN string, C_MARKET string, C_TRADING_CENTER string, C_ORDER_NO
    decimal(38,10), C_SUB_ORDER_NO decimal(38,10), C_TRADER_BRANCH_CODE string, C_TRADER_SUB_BRANCH_CODE string,
    C_TRADER_CODE string, C_BROKER_BRANCH_CODE string, C_BROKER_SUB_BRANCH_CODE string, C_BROKER_CODE string,
    C_ACCOUNT_BRANCH_CODE string, C_ACCOUNT_SUB_BRANCH_CODE string, C_ACCOUNT_CODE string, C_ACCOUNT_TYPE string,
    C_SHARE_CODE string, C_SHARE_TYPE string, C_SHARE_STATUS string, C_SIDE string, C_SIDE_TYPE string, C_CHANEL
    string, C_TRANSACTION_NO string, C_TRANSACTION_DATE timestamp_ntz, C_DUEDAY string, C_DUE_DATE timestamp_ntz,
    C_MATCHED_VOLUME decimal(38,10), C_MATCHED_PRICE decimal(38,10), C_SHARE_COMM_GROUP string, C_COMM_PACKAGE string,
    C_COMM_RATE decimal(38,10), C_TAX_FLAG decimal(38,10), C_TAX_RATE decimal(38,10), C_DEAL_STATUS decimal(38,10),
    C_MATCHED_TIME timestamp_ntz, C_SET_ORDER_TYPE string, C_SUB_MARKETING_ID string, C_DEFAULT_PRIMARY_KEY string,
    C_CARE_PACKAGE string, C_CARE_RATE decimal(38,10), C_ISIN_CODE string, C_MARKET_ID string, C_MARKET_SUBID string,
    C_KRX_ORDER_ID string, C_KRX_EXEC_ID string, C_KRX_CLORDID string, C_KRX_ORIG_CLORDID string, valid_from
    timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

DEBIT_BALANCE = """
    PK_TLO_DEBIT_BALANCE string, partition_date date, C_TRANSACTION_DATE timestamp_ntz, C_ACCOUNT_CODE string,
    C_CASH_BUY_T0 decimal(15,0), C_CASH_BUY_T1 decimal(15,0), C_CASH_BUY_T2 decimal(15,0), C_DELIVER_DATE
    timestamp_ntz, C_INTERM_RATE decimal(15,5), C_INTERM_BALANCE decimal(15,0), C_INTERM_CASH_OUT decimal(15,0),
    C_CASH_OUT_TO_OUTTERM decimal(15,0), C_INTERM_FEE decimal(25,10), C_INTERM_FEE_IN decimal(25,10), C_INTERM_FEE_OUT
    decimal(25,10), C_FEE_OUT_TO_OUTTERM decimal(25,10), C_FEE_OUT_TO_ENDMONTH decimal(25,10), C_EXPIRE_DATE
    timestamp_ntz, C_OUTTERM_RATE decimal(15,5), C_OUTTERM_BALANCE decimal(15,0), C_OUTTERM_CASH_OUT decimal(15,0),
    C_OUTTERM_FEE decimal(25,10), C_OUTTERM_FEE_IN decimal(25,10), C_OUTTERM_FEE_OUT decimal(25,10),
    C_ENDMONTH_BALANCE decimal(15,0), C_ENDMONTH_CASH_OUT decimal(15,0), C_ENDMONTH_FEE decimal(25,10),
    C_ENDMONTH_FEE_IN decimal(25,10), C_ENDMONTH_FEE_OUT decimal(25,10), C_DELIEVER_TYPE string, C_YEAR_FEE_RATE
    decimal(15,5), C_YEAR_OUT_RATE decimal(15,5), C_MARKETING_ID string, C_SUB_BRANCH_CODE string, C_BRANCH_CODE
    string, C_BANK_BRANCH_DELIVER string, C_DEBIT_TYPE decimal(1,0), C_MB_PENALTY_FEE decimal(15,0),
    C_MB_PENALTY_DEBIT decimal(15,0), C_MBS_EXPIRE_DEBIT decimal(15,0), C_MBS_EXPIRE_FEE decimal(15,0), C_TLO_COL_1
    decimal(15,0), C_TLO_COL_2 decimal(15,0), C_TLO_COL_3 decimal(15,0), C_TLO_COL_4 decimal(15,0), C_TLO_COL_5
    decimal(15,0), C_TLO_COL_6 decimal(20,5), C_TLO_COL_7 decimal(20,5), C_TLO_COL_8 decimal(20,5), C_TLO_COL_9
    decimal(20,5), C_TLO_COL_10 decimal(20,5), FK_TLO_CONTRACT string, C_BASE_YEAR_FEE decimal(5,0), C_BANK_CODE
    string, C_MBS_RATE decimal(15,5), C_MBS_FEE decimal(15,0), C_MBS_FEE_IN decimal(15,0), C_MBS_FEE_OUT
    decimal(15,0), C_LD_CODE string, C_MBB_DEPARTMENT string, C_DELIVER_CODE string, FK_MD_CONTRACT string, valid_from
    timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

RANKING_DETAIL = """
    PK_MONTHLY_DETAIL_ID string, partition_year string, partition_month string, C_MONTH decimal(2,0), C_YEAR
    decimal(4,0), C_CUSTOMER_CODE string, C_ORIGIN_ACCOUNT_CODE string, C_B_MATCHED_VALUE decimal(20,0),
    C_B_REVENUE_NET decimal(20,0), C_D_REVENUE_NET decimal(20,0), C_MARGIN_LOAN decimal(20,0), C_MARGIN_PLUS_LOAN
    decimal(20,0), C_ADVANCE_LOAN decimal(20,0), C_MARGIN_REVENUE decimal(20,0), C_MARGIN_PLUS_REVENUE decimal(20,0),
    C_ADVANCE_REVENUE decimal(20,0), C_SUM_FINANCE_SERVICE_REVENUE decimal(20,0), C_SUM_FINANCE_SERVICE_LOAN
    decimal(20,0), C_FINANCE_SERVICE_CAP_EXPEND decimal(20,0), C_B_REVENUE_NET_ADJUSTED decimal(20,0),
    C_D_REVENUE_NET_ADJUSTED decimal(20,0), C_SUM_FIN_SERVICE_REVENUE_NET decimal(20,0), C_TOTAL_REVENUE_NET
    decimal(20,0), C_REVENUE_NET_AVERAGE_MONTH decimal(20,0), C_NET_ASSET_AVERAGE decimal(20,0),
    C_FINANCE_MANAGED_RANKING string, C_FINANCE_ANNOUCED_RANKING string, C_NAV_ANNOUCED_RANKING string,
    C_SYNTHETIC_ANNOUCED_RANKING string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

MARGIN_BALANCE = """
    C_DEFAULT_PRIMARY_KEY string, partition_date date, PK_MARGIN_EXTRA_BALANCE string, FK_MARGIN_CONTRACT string,
    C_ACCOUNT_CODE string, C_TRADING_DATE timestamp_ntz, C_DELIVER_DATE timestamp_ntz, C_CAPITAL_CODE string,
    C_DELIEVER_TYPE string, C_DELIVER_VALUE decimal(15,0), C_INTEREST_RATE decimal(15,5), C_INTERM_LOAN decimal(15,0),
    C_INTERM_LOAN_OUT decimal(15,0), C_INTERM_FEE decimal(15,0), C_INTERM_FEE_IN decimal(15,0), C_INTERM_FEE_OUT
    decimal(15,0), C_EXPIRE_DATE timestamp_ntz, C_OUTTERM_RATE decimal(15,5), C_OUTTERM_LOAN decimal(15,0),
    C_OUTTERM_LOAN_OUT decimal(15,0), C_OUTTERM_FEE decimal(15,0), C_OUTTERM_FEE_IN decimal(15,0), C_OUTTERM_FEE_OUT
    decimal(15,0), C_ORIGINAL_EXPIRE_DATE timestamp_ntz, C_LAST_EXPIRE_DATE_BGEDOL timestamp_ntz, C_DELIVER_CODE
    string, C_DELIVER_T decimal(38,0), C_INTEREST_DEBIT_TYPE string, C_SET_ORDER_TYPE string, C_INTEREST_RATE_CODE
    string, C_ACCOUNT_BRANCH_CODE string, C_ACCOUNT_SUB_BRANCH_CODE string, C_MARKETING_ID string, valid_from
    timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

BRANCH_BANK = """
    PK_BRANCH_BANK string, FK_BANK_CODE string, C_BRANCH_BANK_CODE string, C_BRANCH_BANK_NAME string, C_ORDER
    decimal(38,10), C_STATUS decimal(38,10), valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

FRONT_USER = """
    PK_FRONT_USER string, partition_date date, C_BRANCH_CODE string, C_SUB_BRANCH_CODE string, C_FRONT_USER_CODE
    string, C_RESET_PWD_FLAG decimal(1,0), C_BUSINESS_TYPE string, C_FUNC_RIGHT_GROUP string, C_DATA_RIGHT_GROUP
    string, C_DATA_RIGHT_LIST string, C_APPROVE_STATUS decimal(1,0), C_APPROVE_CREDIT decimal(15,0),
    C_ACCOUNT_INTERNET string, C_ENTRUST_AUTHEN_TYPE string, C_VALUE_PER_ORDER decimal(15,0), C_VALUE_PER_DAY
    decimal(15,0), C_FIXIP_FLAG string, C_IP_ASSIGNED string, C_LOCK_STATUS decimal(1,0), C_EXPIRE_DATE timestamp_ntz,
    C_STATUS decimal(1,0), C_TVOL_STATUS decimal(2,0), C_ADMIN_LIST string, C_INFORMATION string, C_BROKER_TYPE
    string, C_MANAGER_CODE string, C_APPROVE_CREDIT_PER_DAY decimal(15,0), C_DATE_CREATE timestamp_ntz,
    C_USER_CRM_STATUS decimal(1,0), C_USER_PARDOT_STATUS decimal(1,0), C_IS_INTERNAL_STAFF decimal(1,0),
    C_STAFF_BRANCH_CODE string, C_STAFF_SUB_BRANCH_CODE string, C_STAFF_COMPANY string, C_STAFF_CODE string,
    C_BACK_USER_CODE string, C_CANCEL_FORCE_SELL_ORDER decimal(1,0), C_USER_FO string, C_LAST_CHANGED_OTP
    timestamp_ntz, C_EXPERT_QUALIFIED string, C_EXPERT_STATUS decimal(1,0), C_ENABLE_SUB_MKT_ID decimal(38,0),
    C_CHANEL string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean
"""

BACK_DATA = """
    C_ORIGIN_ACCOUNT_CODE string, C_ACCOUNT_CODE string, C_DATE timestamp_ntz, C_MONTH int, C_YEAR int, C_MARGIN_DEBT
    decimal(38,0), C_MBLINK_DEBT decimal(38,0), C_UTTB decimal(38,10), C_GTGD decimal(38,18), C_RANKING_KEY string,
    C_KY_KPI string
"""

FRONT_DATA = """
    C_ORIGIN_ACCOUNT_CODE string, C_ACCOUNT_CODE string, C_DATE date, C_MONTH int, C_YEAR int, C_MARGIN_DEBT
    decimal(38,0), C_MBLINK_DEBT decimal(38,0), C_UTTB decimal(38,10), C_GTGD decimal(38,18), C_RANKING_KEY string,
    C_KY_KPI string
"""

ERC_RANKING = """
    C_ORIGIN_ACCOUNT_CODE string, C_YEAR_ADJ int, C_MONTH_ADJ int, C_SYNTHETIC_ANNOUCED_RANKING string, C_RANKING_KEY
    string
"""

# --- fixed values: rows inside the change records ---

ACCOUNT_ROW = """
    PK_ACCOUNT string, C_ACCOUNT_BRANCH_CODE string, C_ACCOUNT_SUB_BRANCH_CODE string, C_CREATOR_CODE string,
    C_CREATOR_BRANCH_CODE string, C_CREATOR_SUB_BRANCH_CODE string, C_CREATE_TIME timestamp, C_APPROVER_CODE string,
    C_APPROVE_TIME timestamp, C_CUSTOMER_CODE string, C_ACCOUNT_CODE string, C_ACCOUNT_TYPE string,
    C_ACCOUNT_FRONT_TYPE string, C_ACCOUNT_RELATION_TYPE string, C_STAFF_FLAG string, C_MARKETING_ID string,
    C_TAX_FLAG string, C_OPEN_DATE timestamp, C_CLOSE_DATE timestamp, C_BANK_CODE string, C_BANK_ACCOUNT string,
    C_COMM_PACKAGE string, C_ACCOUNT_STATUS string, C_CLOSER_CODE string, C_CLOSE_TIME timestamp,
    C_NEW_CUST_EXPIRE_DATE timestamp, C_COLLABORATOR string, C_MODIFY_USER_CODE string, C_RESTRICTION_ID string,
    C_CHANNEL string, C_GROUP_CODE string, C_ACCOUNT_CREDIT_TYPE double, C_ORIGIN_ACCOUNT_CODE string, C_ACCOUNT_LEVEL
    string, C_CAN_SHORT_SELL string, C_CAN_OVER_CREDIT string, C_FORCE_SELL string, C_LENDING_SELL string,
    C_TRADING_STATUS double, C_ONLINE_ACCOUNT_TYPE string, C_SUB_MARKETING_ID string, C_CHANGED_TAB string,
    C_TC_SIGNED_STATUS double, C_ODD_LOT_CONTRACT_SIGNED double, C_ODD_LOT_CONTRACT_NOTE string,
    C_DEPOSIT_APPROVER_CODE string, C_DEPOSIT_APPROVE_DATE timestamp, C_COMM_BASE_RATE double, C_ATS_FLAG double,
    C_ATS_BANK_ACCOUNT string, C_ATS_BANK string, C_BANK_RESPONSE_MAPPING string, C_RESPONSE_MAPPING_TIME timestamp,
    C_BANK_RESPONSE_UNMAPPING string, C_RESPONSE_UNMAPPING_TIME timestamp, C_VSD_STATUS string, C_VSD_RESPONSE string,
    C_VSD_OPEN_FLAG double, C_VSD_CLOSE_FLAG double, C_COMM_START_DATE timestamp, C_COMM_EXPIRE_DATE timestamp,
    C_RECEIVE_FINAN_BILL double, C_VSD_OPEN_STATUS string, C_VSD_OPEN_RESPONSE string, C_VSD_OPEN_LOCATION string,
    C_VSD_CLOSE_STATUS string, C_VSD_CLOSE_RESPONSE string, C_VSD_CLOSE_LOCATION string, C_VSD_OPEN_DATE timestamp,
    C_VSD_CLOSE_DATE timestamp, C_RECEIVED_FEE_CLOSE_ACC double, C_CONFIRM_TYPE string, C_CONFIRM_USER string,
    FK_CONFIRM_CUSTOMER string, C_FILE_STATUS string, C_FILE_CONFIRM_DATE timestamp, C_FILE_COMPLETING_LOCATION
    double, C_IS_NEW_CUSTOMER double, C_FILE_CONFIRM_USER string, C_FILE_CONFIRM_NOTE string, C_SOFT_FILE_STATUS
    string, C_SOFT_FILE_REJECT_REASON string, C_SOFT_FILE_REJECT_DATE timestamp, C_FILE_STATUS_USER string,
    C_ADDRESS_SAVE_INFOR string, C_CUST_CARE_SERVICE_TYPE string, C_ATS_BANK_BRANCH_CD string, C_IS_ONBOARD double,
    C_COPI24_TYPE string, C_VSD_OPEN_SEND_TIME timestamp, C_FOR_TRADING_BOND double, C_VSD_FIRST_OPEN_SEND_TIME
    timestamp, C_CARE_PACKAGE string
"""

DEAL_ROW = """
    PK_FRONT_DEAL double, C_MARKET string, C_TRADING_CENTER string, C_ORDER_NO double, C_SUB_ORDER_NO double,
    C_TRADER_BRANCH_CODE string, C_TRADER_SUB_BRANCH_CODE string, C_TRADER_CODE string, C_BROKER_BRANCH_CODE string,
    C_BROKER_SUB_BRANCH_CODE string, C_BROKER_CODE string, C_ACCOUNT_CODE string, C_ACCOUNT_TYPE string, C_SHARE_CODE
    string, C_SHARE_TYPE string, C_SHARE_STATUS string, C_SIDE string, C_SIDE_TYPE string, C_SHORT_SALE double,
    C_CHANEL string, C_DUEDAY double, C_MATCHED_VOLUME double, C_MATCHED_PRICE double, C_MATCHED_TIME timestamp,
    C_CONFIRM_NO string, C_SET_ORDER_TYPE string, C_MAX_FEE_RATE double, C_DEAL_STATUS double, C_ISIN_CODE string,
    C_MARKET_ID string, C_MARKET_SUBID string, C_KRX_ORDER_ID string, C_KRX_EXEC_ID string, C_KRX_CLORDID string,
    C_KRX_ORIG_CLORDID string, C_TAX_RATE double
"""

# --- fixed values: index tick, nested as on the wire ---

TICK_CLASS = "bgv2.IndexUpdate"

TICK_HEADER = "MessageType string, TradingSession string, CreatedAt timestamp, Last_updated timestamp"

TICK_TEXT = ("IndexCode", "MarketCode", "Session", "OriginalSession", "IndexColor")

TICK_VALUES = ("IndexValue", "ChangedIndexValue", "ChangedIndexPercentage", "PreviousIndexValue")

TICK_COUNTS = (
    "TotalTrades", "TotalSharesTraded", "TotalValuesTraded", "TotalSharesTraded4MT", "TotalValuesTraded4MT",
    "TotalSharesTraded4PT", "TotalValuesTraded4PT", "UpVolume", "DownVolume", "NoChangeVolume", "Advances",
    "Declines", "NoChange",
)

TICK_COLUMNS = (
    "MessageType", "TradingSession", "CreatedAt", "Last_updated", "IndexCode", "MarketCode", "Session",
    "OriginalSession", "IndexValue", "ChangedIndexValue", "ChangedIndexPercentage", "PreviousIndexValue",
    "IndexColor", "TotalTrades", "TotalSharesTraded", "TotalValuesTraded", "TotalSharesTraded4MT",
    "TotalValuesTraded4MT", "TotalSharesTraded4PT", "TotalValuesTraded4PT", "UpVolume", "DownVolume",
    "NoChangeVolume", "Advances", "Declines", "NoChange", "Time",
)


def struct(columns: str) -> StructType:
    """Column list as a ``StructType``."""
    return StructType.fromDDL(columns)


def tick_body() -> StructType:
    """Nested tick message: header, text fields, ``{value}`` wrappers and the exchange time."""
    text = [f"{name} string" for name in TICK_TEXT]
    values = [f"{name} struct<value: double>" for name in TICK_VALUES]
    counts = [f"{name} struct<value: bigint>" for name in TICK_COUNTS]
    header = f"Header struct<{', '.join(c.replace(' ', ': ') for c in TICK_HEADER.split(', '))}>"
    return StructType.fromDDL(", ".join([header, *text, *values, *counts, "Time timestamp"]))


BROKEN = "_broken"  # text of a record that does not fit its columns


def change_envelope(row: StructType) -> StructType:
    """Change record: the row before and after, the operation, its time and its place in the source log."""
    payload = StructType([
        StructField("before", row), StructField("after", row),
        *struct("op string, ts_ms bigint, ts_ns bigint, source struct<scn: string>").fields,
    ])
    return StructType([StructField("payload", payload), StructField(BROKEN, StringType())])
