"""Per-table facts: where a table comes from, its key, its business date, its partitions and its casts."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql.types import StructType

from ledgerlake import schemas


@dataclass(frozen=True)
class TableSpec:
    """One loaded table.

    ``date_column`` gives ``partition_date`` and the extract window; ``partition_texts`` maps string partition columns
    to the columns they are cast from; ``casts`` holds types to force on load; ``partition_in_key`` tells whether the
    warehouse key includes the partition columns, as that of facts does.
    """

    name: str
    source: str
    key: str
    columns: str
    date_column: str | None = None
    partition_texts: dict[str, str] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)
    partition_in_key: bool = True

    @property
    def partition_by(self) -> tuple[str, ...]:
        if self.partition_texts:
            return tuple(self.partition_texts)
        return ("partition_date",) if self.date_column else ()

    @property
    def primary_key(self) -> tuple[str, ...]:
        """Key of the warehouse table."""
        return (self.key, *self.partition_by) if self.partition_in_key else (self.key,)

    @property
    def schema(self) -> StructType:
        return schemas.struct(self.columns)


# fixed values: source names, keys, business dates and forced types
DEAL_DECIMALS = dict.fromkeys(
    ("C_ORDER_NO", "C_SUB_ORDER_NO", "C_MATCHED_VOLUME", "C_MATCHED_PRICE", "C_COMM_RATE", "C_TAX_FLAG",
     "C_TAX_RATE", "C_DEAL_STATUS", "C_CARE_RATE"),
    "decimal(38,10)",
)

ADVANCE_WITHDRAW = TableSpec(
    "fact_t_back_advance_withdraw", "BACK.T_BACK_ADVANCE_WITHDRAW", "PK_ADVANCE_WITHDRAW",
    schemas.ADVANCE_WITHDRAW, date_column="C_APPROVE_TIME",
)
DEAL_HISTORY = TableSpec(
    "fact_t_back_deal_history", "BACK.T_BACK_DEAL_HISTORY", "PK_DEAL",
    schemas.DEAL_HISTORY, date_column="C_TRANSACTION_DATE", casts=DEAL_DECIMALS,
)
DEBIT_BALANCE = TableSpec(
    "fact_t_tlo_debit_balance_history", "BACK.T_TLO_DEBIT_BALANCE_HISTORY", "PK_TLO_DEBIT_BALANCE",
    schemas.DEBIT_BALANCE, date_column="C_TRANSACTION_DATE",
)
MARGIN_BALANCE = TableSpec(
    "fact_t_margin_extra_balance_his", "BACK.T_MARGIN_EXTRA_BALANCE_HIS", "C_DEFAULT_PRIMARY_KEY",
    schemas.MARGIN_BALANCE, date_column="C_TRADING_DATE",
)
RANKING_DETAIL = TableSpec(
    "fact_v_t_erc_monthly_detail", "MISUSER.V_T_ERC_MONTHLY_DETAIL", "PK_MONTHLY_DETAIL_ID",
    schemas.RANKING_DETAIL, partition_texts={"partition_year": "C_YEAR", "partition_month": "C_MONTH"},
)
BRANCH_BANK = TableSpec(
    "dim_t_list_branch_bank_adv_wdr", "BACK.T_LIST_BRANCH_BANK_ADV_WDR", "PK_BRANCH_BANK", schemas.BRANCH_BANK,
    partition_in_key=False,
)
FRONT_USER = TableSpec(
    "dim_v_t_list_front_user", "MISUSER.V_T_LIST_FRONT_USER", "PK_FRONT_USER",
    schemas.FRONT_USER, date_column="C_DATE_CREATE", partition_in_key=False,
)

TABLES = {
    spec.name: spec
    for spec in (
        ADVANCE_WITHDRAW, DEAL_HISTORY, DEBIT_BALANCE, MARGIN_BALANCE, RANKING_DETAIL, BRANCH_BANK, FRONT_USER,
    )
}

DAILY_FACTS = (ADVANCE_WITHDRAW, DEAL_HISTORY, DEBIT_BALANCE, MARGIN_BALANCE)


UPSERTS = ("c", "u", "r")  # create, update, snapshot read
DELETE = "d"
VERSION_ORDER = ("ts_ms", "scn", "ts_ns")  # change time, log position, finer time within one position


@dataclass(frozen=True)
class FeedSpec:
    """One change feed: its row, its key and, if the row carries one, its creation time."""

    name: str
    key: str
    columns: str
    created_column: str | None = None

    @property
    def row(self) -> StructType:
        return schemas.struct(self.columns)

    def only(self, *names: str) -> FeedSpec:
        """The feed with its key and the named columns, for readers that need few: the others are not parsed."""
        kept = {self.key, self.created_column, *names}
        columns = [column.strip() for column in self.columns.split(",")]
        return replace(self, columns=", ".join(column for column in columns if column.split()[0] in kept))


ACCOUNT_FEED = FeedSpec("t_back_account", "PK_ACCOUNT", schemas.ACCOUNT_ROW, created_column="C_CREATE_TIME")
DEAL_FEED = FeedSpec("t_front_deal", "PK_FRONT_DEAL", schemas.DEAL_ROW)
