"""Table descriptions shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# The version column, the load states and the checks on user input.
VERSION = "_version"
LOAD_STATES = ("pending", "running", "done", "partial", "failed", "biz_err")
RETRYABLE = ("pending", "partial", "failed")
CODE_PATTERN = r"^[0-9]{6}\.(SH|SZ|BJ)$"
DATE_PATTERN = r"^[0-9]{8}$"
EXCHANGES = ("SSE", "SZSE", "BSE", "CFFEX", "SHFE", "DCE", "CZCE")
STATEMENTS = ("income", "balancesheet", "cashflow", "fina_indicator")
PRIORITIES = ("P0", "P1", "P2", "P3")
STRATEGIES = (
    "full_once", "date_loop", "period_loop", "monthly_window",
    "per_symbol", "per_symbol_period", "offset_paging",
)
SCOPE_DATE_COLUMNS = ("trade_date", "end_date", "ann_date", "nav_date", "float_date")
AUDIT_COLUMNS = ("created_at", "updated_at")


@dataclass(frozen=True)
class TableSpec:
    """A keyed, versioned table: which columns identify a row and which one dates it."""

    name: str
    keys: tuple[str, ...]
    date_column: str | None = None
    version: str = VERSION


BARS = TableSpec("bars", ("ts_code", "trade_date"), "trade_date")
ADJ_FACTOR = TableSpec("adj_factor", ("ts_code", "trade_date"), "trade_date")
MONEYFLOW = TableSpec("moneyflow", ("ts_code", "trade_date"), "trade_date")
FINANCIALS = TableSpec("financials", ("statement", "ts_code", "end_date"), "end_date")
INDEX_WEIGHT = TableSpec("index_weight", ("index_code", "con_code", "trade_date"), "trade_date")
STATE = TableSpec("sync_state", ("interface", "scope_key"))
