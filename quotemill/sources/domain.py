"""Securities tables derived from the driver's generic tables.

The driver supplies a star schema and an event log, no market data. Every table below is a fixed
expression over them, so its size grows with theirs. `plans/oracle_tables.py` holds the same rules as SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import day_text, quarter_end
from ..model import LOAD_STATES, STATEMENTS, STRATEGIES
from ..operators.calendar import with_previous_open_day

# Fixed values of the derivation.
PACK = 12_000_000  # above any unit price in hundredths; with it, trade ids up to 7.6e11 fit a long
ERRORS = (
    "", "Unrecognized column 'x' in insert", "Unknown strategy: weekly", "SSL handshake failed",
    "The read operation timed out", "unsupported operand type(s)", "permission denied",
)
EVENT_STRATEGY = {
    "view": "date_loop", "click": "offset_paging", "signup": "per_symbol",
    "purchase": "period_loop", "error": "monthly_window",
}
AS_OF = "2024-01-31"


def security_code(key: Column) -> Column:
    digits = F.lpad(key.cast("string"), F.greatest(F.lit(6), F.length(key.cast("string"))), F.lit("0"))
    market = F.when(key % 3 == 0, ".SH").when(key % 3 == 1, ".SZ").otherwise(".BJ")
    return F.concat(digits, market)


def cents(col: Column) -> Column:
    return F.round(col * 100).cast("bigint")


def day_millis(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000


class Domain:
    """Lazy domain tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines as trades of a numeric security; codes are spelled out after aggregation."""
        rank = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("sec"), F.col("l_shipdate").cast("date").alias("trade_date"),
            F.col("l_orderkey").alias("trade_id"), F.col("l_quantity").cast("bigint").alias("qty"),
            cents(F.col("l_extendedprice")).alias("cents"), F.col("l_linestatus").alias("side"), rank.alias("rank"),
        )

    @staticmethod
    def _coded(df: DataFrame, version: str = "rank") -> DataFrame:
        return df.withColumns({"ts_code": security_code(F.col("sec")), "_version": day_millis(F.col("trade_date")) + F.col(version)})

    @cached_property
    def trades(self) -> DataFrame:
        return self._coded(self._lines).select("ts_code", "trade_date", "trade_id", "qty", "cents", "side", "_version")

    @cached_property
    def bars(self) -> DataFrame:
        """Version log of daily bars; a day has up to three versions. Open and close are the prices of the
        first and last trade, found by a plain min/max over (trade, price) packed into one long."""
        price = F.floor(F.col("cents") / F.col("qty")).cast("bigint")
        price = F.when(price < PACK, price).otherwise(F.raise_error(F.lit("a unit price does not fit beside the trade number")).cast("bigint"))
        days = (
            self._lines.withColumn("price", price).withColumn("packed", F.col("trade_id") * PACK + F.col("price"))
            .groupBy("sec", "trade_date", "rank").agg(
                F.min("packed").alias("first"), F.max("packed").alias("last"), F.max("price").alias("high"),
                F.min("price").alias("low"), F.sum("qty").alias("vol"), F.sum("cents").alias("amount"),
            )
        )
        open_, close = F.col("first") % PACK / F.lit(100.0), F.col("last") % PACK / F.lit(100.0)
        return self._coded(days).select(
            "ts_code", "trade_date", open_.alias("open"), (F.col("high") / 100.0).alias("high"),
            (F.col("low") / 100.0).alias("low"), close.alias("close"), F.col("vol").cast("double").alias("vol"),
            (F.col("amount") / 100.0).alias("amount"), ((close - open_) / open_ * 100).alias("pct_chg"), "_version",
        )

    @cached_property
    def adj_factor(self) -> DataFrame:
        """Version log of factors; none on Sundays, a stale first version on Mondays."""
        weekday = F.dayofweek("trade_date")
        days = self._lines.select("sec", "trade_date").filter(weekday != 1).distinct()
        since = F.datediff("trade_date", F.lit("1995-01-01").cast("date"))
        versions = F.when(weekday == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
        factor = F.sqrt((since + 10_000).cast("double")) / 100 + F.when(F.col("v") == 1, 1.0).otherwise(0.0)
        return self._coded(days.withColumn("v", F.explode(versions)), "v").select(
            "ts_code", "trade_date", factor.alias("adj_factor"), "_version"
        )

    @cached_property
    def moneyflow(self) -> DataFrame:
        """Version log of traded volume and amount by size class and side, per code and day."""
        size = F.when(F.col("qty") <= 12, "sm").when(F.col("qty") <= 25, "md").when(F.col("qty") <= 38, "lg").otherwise("elg")
        aggs = []
        for label in ("sm", "md", "lg", "elg"):
            for side, status in (("buy", "O"), ("sell", "F")):
                hit = (F.col("size") == label) & (F.col("side") == status)
                aggs.append(F.sum(F.when(hit, F.col("qty")).otherwise(0)).cast("bigint").alias(f"{side}_{label}_vol"))
                aggs.append((F.sum(F.when(hit, F.col("cents")).otherwise(0)) / 100.0).alias(f"{side}_{label}_amount"))
        days = self._lines.withColumn("size", size).groupBy("sec", "trade_date", "rank").agg(*aggs)
        return self._coded(days).select("ts_code", "trade_date", "_version", *days.columns[3:])

    def _calendar(self, bounds: DataFrame) -> DataFrame:
        day = F.col("cal_date")
        is_open = (F.dayofweek(day).between(2, 6) & (F.dayofmonth(day) != 1)).cast("int")
        days = (
            bounds.select(F.explode(F.sequence("first", "last")).alias("cal_date"))
            .withColumn("exchange", F.explode(F.array(F.lit("SSE"), F.lit("SZSE"))))
            .select("exchange", "cal_date", is_open.alias("is_open"))
        )
        return with_previous_open_day(days)

    @cached_property
    def trade_cal(self) -> DataFrame:
        """Calendar over the days of the bars."""
        return self._calendar(self._lines.agg(F.min("trade_date").alias("first"), F.max("trade_date").alias("last")))

    @cached_property
    def load_cal(self) -> DataFrame:
        """Calendar over the days of the load log."""
        day = F.col("ts").cast("date")
        return self._calendar(self.raw("events").agg(F.min(day).alias("first"), F.max(day).alias("last")))

    @cached_property
    def symbols(self) -> DataFrame:
        return self.raw("supplier").select(
            F.concat(F.lit("basic_"), F.col("s_nationkey").cast("string")).alias("symbol_source"),
            security_code(F.col("s_suppkey")).alias("ts_code"),
        )

    @cached_property
    def interfaces(self) -> DataFrame:
        """Declared datasets: seven per nation, one of each load strategy."""
        key, region = F.col("n_nationkey"), F.col("n_regionkey")
        rows = self.raw("nation").withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in STRATEGIES])))
        return rows.select(
            F.concat_ws("_", F.lit("if"), key.cast("string"), "strategy").alias("interface"),
            F.concat_ws("_", F.lit("t"), key.cast("string"), "strategy").alias("table_name"),
            "strategy",
            F.concat(F.lit("P"), (region % 4).cast("string")).alias("priority"),
            F.when(region < 3, "SSE").otherwise("SZSE").alias("exchange"),
            F.when(region == 1, "ann_date").when(region == 4, "trade_date").alias("date_field"),
            F.concat(F.lit("basic_"), key.cast("string")).alias("symbol_source"),
            F.when(region == 4, AS_OF).when(region == 3, "2023-01-01").otherwise("2024-01-10").cast("date").alias("start_date"),
            (~((region == 2) & (F.col("strategy") == "full_once"))).alias("enabled"),
        )

    @cached_property
    def state_log(self) -> DataFrame:
        return self.state_from(self.raw("events"))

    @staticmethod
    def state_from(events: DataFrame) -> DataFrame:
        """Version log of load units from an event frame, batch or streaming."""
        k = F.get_json_object("props", "$.k").cast("int")
        strategy = F.lit(None).cast("string")
        for event, name in EVENT_STRATEGY.items():
            strategy = F.when(F.col("event_type") == event, name).otherwise(strategy)
        day = F.date_format("ts", "yyyyMMdd")
        scope = (
            F.when(F.col("strategy") == "date_loop", day)
            .when(F.col("strategy") == "offset_paging", F.concat(day, F.lit(":00000000")))
            .when(F.col("strategy") == "per_symbol", security_code(F.col("user_id")))
            .when(F.col("strategy") == "period_loop", day_text(F.date_sub(F.trunc(F.col("ts").cast("date"), "quarter"), 1)))
            .otherwise(F.date_format("ts", "yyyyMM"))
        )
        pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))
        status = pick(LOAD_STATES, k % len(LOAD_STATES))
        name = F.concat_ws("_", F.lit("if"), (F.col("user_id") % 25).cast("string"), "strategy")
        return events.withColumns({"strategy": strategy, "k": k}).select(
            name.alias("interface"), F.concat_ws(":", name, scope).alias("scope_key"), status.alias("status"),
            F.floor("value").cast("bigint").alias("rows"),
            F.when(status == "done", F.col("ts")).otherwise(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("last_success_at"),
            F.col("ts").alias("heartbeat_at"), (F.col("k") % 4).alias("attempts"),
            pick(ERRORS, F.col("k") % len(ERRORS)).alias("last_error"), F.col("event_id").alias("_version"),
        )

    @cached_property
    def api_calls(self) -> DataFrame:
        return self.calls_from(self.raw("events"))

    @staticmethod
    def calls_from(events: DataFrame) -> DataFrame:
        """Call log columns of an event frame, batch or streaming."""
        k = F.get_json_object("props", "$.k").cast("int")
        status = F.when(k % 20 == 0, 429).when(k % 20 == 1, 401).when(k % 20 == 2, 403).otherwise(200)
        return events.select(
            F.concat_ws("-", day_text(F.col("ts")), "event_type").alias("run_id"), F.col("event_type").alias("interface"),
            F.col("ts").alias("started_at"), F.round(F.col("value") * 10).cast("bigint").alias("duration_ms"),
            status.alias("status"), F.when(F.col("user_id") % 3 == 0, "special").otherwise("normal").alias("bucket"),
        )

    @cached_property
    def financials(self) -> DataFrame:
        """Version log of statements, one per order."""
        order = F.col("o_orderpriority")
        kind = F.when(order == "1-URGENT", STATEMENTS[0]).when(order == "2-HIGH", STATEMENTS[1]).when(
            order == "3-MEDIUM", STATEMENTS[2]).otherwise(STATEMENTS[3])
        day = F.col("o_orderdate").cast("date")
        return self.raw("orders").select(
            kind.alias("statement"), security_code(F.col("o_custkey")).alias("ts_code"), quarter_end(day).alias("end_date"),
            day.alias("ann_date"), F.col("o_totalprice").alias("total_revenue"), F.col("o_orderkey").alias("_version"),
        )

    @cached_property
    def index_weight(self) -> DataFrame:
        """Version log of index members by month: region indices over customers."""
        orders = self.raw("orders").select(
            F.col("o_custkey").alias("c_custkey"), F.last_day(F.col("o_orderdate").cast("date")).alias("trade_date"),
            F.col("o_totalprice").alias("weight"), F.col("o_orderkey").alias("_version"),
        )
        members = (
            self.raw("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
            .join(self.raw("nation"), "n_nationkey")
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", F.col("r_name").alias("index_code"))
        )
        return orders.join(members, "c_custkey").select(
            "index_code", security_code(F.col("c_custkey")).alias("con_code"), "trade_date", "weight", "_version"
        )

    @cached_property
    def raw_bars(self) -> DataFrame:
        """Bars as upstream text: the day in five spellings, missing markers, one always-text name field."""
        day, weekday = F.col("trade_date"), F.dayofweek("trade_date")
        spelled = (
            F.when(weekday == 2, day_text(day)).when(weekday == 3, F.date_format(day, "yyyy-MM-dd"))
            .when(weekday == 4, F.date_format(day, "yyyy/MM/dd")).when(weekday == 5, F.date_format(day, "yyyyMM"))
            .when(weekday == 6, F.date_format(day, "yyyy")).when(weekday == 7, "-").otherwise(" NaN ")
        )
        return self.bars.select(
            "ts_code", day_text(day).alias("day"), spelled.alias("trade_date"), "close", F.col("vol").cast("bigint").alias("vol"),
            "amount", "_version",
        )

    PAYLOAD_FIELDS = ("ts_code", "day", "trade_date", "vol", "close", "amount")

    def _packed(self, *by: Column) -> DataFrame:
        """Bars packed into JSON payloads per group; items of Sundays lack their last cell."""
        short = F.col("trade_date") == " NaN "
        text = F.concat(F.lit('["'), F.concat_ws('","', "ts_code", "day", "trade_date"), F.lit('"'))
        numbers = [F.concat(F.lit(","), F.col(c).cast("string")) for c in ("vol", "close")]
        last = F.when(short, "").otherwise(F.concat(F.lit(","), F.col("amount").cast("string")))
        item = F.concat(text, *numbers, last, F.lit("]"))
        body = F.concat(
            F.lit('{"fields":["' + '","'.join(self.PAYLOAD_FIELDS) + '"],"items":['), F.array_join("items", ","), F.lit("]}")
        )
        return self.raw_bars.groupBy(*by).agg(F.collect_list(item).alias("items")).withColumn("body", body)

    @cached_property
    def payloads(self) -> DataFrame:
        """One payload per code and month, so at most 31 days of bars; odd months come without the `data`
        wrapper."""
        packed = self._packed(F.col("ts_code"), F.substring("day", 1, 6).alias("month"))
        wrapped = F.concat(F.lit('{"code":0,"data":'), F.col("body"), F.lit("}"))
        even = F.col("month").cast("int") % 2 == 0
        return packed.select("month", F.when(even, wrapped).otherwise(F.col("body")).alias("payload"))

    @cached_property
    def payloads_by_code(self) -> DataFrame:
        """One payload per code; its items are bounded by the days of the calendar."""
        return self._packed(F.col("ts_code")).select("ts_code", F.col("body").alias("payload"))

    @cached_property
    def raw_statements(self) -> DataFrame:
        """Statements as upstream text columns with bad and blank cells."""
        status, order = F.col("o_orderstatus"), F.col("o_orderpriority")
        day, moment = F.col("o_orderdate").cast("date"), F.col("o_orderdate")
        price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        spelled_day = (
            F.when(order == "1-URGENT", day_text(day)).when(order == "2-HIGH", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
            .when(order == "3-MEDIUM", F.date_format(day, "yyyy/MM/dd")).when(order == "5-LOW", F.lit("00000000"))
            .otherwise(F.concat(F.lit("19600"), F.substring(F.date_format(day, "MMdd"), 2, 3)))
        )
        spelled_moment = (
            F.when(order == "1-URGENT", day_text(day)).when(order == "2-HIGH", F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
            .when(order == "3-MEDIUM", F.date_format(moment, "yyyy/MM/dd HH:mm:ss"))
            .when(order == "5-LOW", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z"))).otherwise("soon")
        )
        return self.raw("orders").select(
            F.col("o_orderkey"), security_code(F.col("o_custkey")).alias("ts_code"),
            spelled_day.alias("ann_date"), spelled_day.alias("f_ann_date"), spelled_moment.alias("update_time"),
            F.when(status == "P", "n/a").otherwise(price).alias("total_revenue"),
            F.when(status == "F", " ").otherwise(price).alias("n_income"),
            price.alias("total_share"), price.alias("float_share"),
            F.when(status == "O", F.lit(None)).otherwise(order).alias("holder_name"),
            F.when(status == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("holder_num"),
        )

    SOURCE_YEARS = (1995, 1996, 1997, 1998, 1999, 2000)

    @cached_property
    def source_rows(self) -> DataFrame:
        """Source-side statement rows with audit columns; missing update times on open orders."""
        urgent = F.col("o_orderpriority") == "1-URGENT"
        return self.raw("orders").select(
            security_code(F.col("o_custkey")).alias("ts_code"), F.col("o_orderdate").cast("date").alias("trade_date"),
            F.col("o_orderkey").alias("record_id"),
            F.col("o_totalprice").alias("amount"), F.when(urgent, F.lit(None)).otherwise(F.round(F.col("o_totalprice") / 7, 2)).alias("vol"),
            F.col("o_orderpriority").alias("grade"), F.col("o_orderdate").alias("created_at"),
            F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("interval 36 hours")).alias("updated_at"),
        )

    @cached_property
    def source_parts(self) -> dict[str, DataFrame]:
        """Yearly parts plus a default part: other years, and urgent pending orders once more."""
        year = F.year("trade_date")
        parts = {f"source_{y}": self.source_rows.filter(year == y) for y in self.SOURCE_YEARS}
        parts["source_1998"] = parts["source_1998"].drop("vol")
        pending = (F.col("grade") == "1-URGENT") & F.col("updated_at").isNull()
        parts["source_default"] = self.source_rows.filter(~year.isin(*self.SOURCE_YEARS) | pending)
        return parts

    @cached_property
    def target_rows(self) -> DataFrame:
        """Target-side rows: amounts scaled, low-grade volumes off by one, medium grades relabelled, urgent
        rows of January not yet loaded."""
        from ..functions.units import SCALE

        late = (F.col("grade") == "1-URGENT") & (F.month("trade_date") == 1)
        low, medium = F.col("grade") == "5-LOW", F.col("grade") == "3-MEDIUM"
        return self.source_rows.filter(~late).select(
            "ts_code", "trade_date", "record_id", (F.col("amount") * SCALE).alias("amount"),
            F.when(low, F.col("vol") + 100).otherwise(F.col("vol")).alias("vol"),
            F.when(medium, "3").otherwise(F.col("grade")).alias("grade"), F.col("record_id").alias("_version"),
        )
