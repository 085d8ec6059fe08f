"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once timed, into the noop sink. The `point_*` and `count_*` entries
read a warehouse table written beforehand (month folders, rows clustered by key), which is how a lookup
of one code runs in practice; writing it is timed apart as `load_*`.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quotemill.model import ADJ_FACTOR, BARS
from quotemill.operators import market, versions
from quotemill.plans import QUERIES, run
from quotemill.session import local_session, scratch_path
from quotemill.sources import tables
from quotemill.sources.domain import Domain

HEADLINE = (
    "q1_ohlcv_raw", "q2_ohlcv_qfq", "q3_ohlcv_hfq", "q4_financials", "q5_index_components", "q6_moneyflow", "q11_coverage_report",
    "d1_current", "d5_duplicate_ratio", "d6_version_history", "a3_status_pivot", "a10_table_fingerprint", "a11_latency_p99",
    "a15_error_classes", "a20_table_profile", "w2_trailing_rate", "n1_flexible_dates", "n8_rejected_cells", "n9_type_inference",
    "s2_payload_rows", "p8_expected_units", "p10_resume_summary", "v1_trading_day_gaps", "v2_period_gaps", "v4_fingerprint_audit",
    "v5_write_check", "v9_cell_compare", "v10_sum_check", "d2_compact", "r6_stream_upsert",
)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_SHUFFLE", "8")))
    seconds: dict[str, float] = {}
    for name in names or HEADLINE:
        if name in QUERIES:
            noop(run(name, spark, folder))
            seconds[name] = timed(lambda: noop(run(name, spark, folder)))
    if not names:
        t = Domain(spark, folder)
        bars, factors = scratch_path(spark, "bars"), scratch_path(spark, "factors")
        seconds["load_bars"] = timed(lambda: tables.append(t.bars, bars, BARS))
        seconds["load_adj_factor"] = timed(lambda: tables.append(t.adj_factor, factors, ADJ_FACTOR))
        code, start, end = "000042.SH", "19980101", "19981231"

        bar_table, factor_table = tables.open_table(spark, bars), tables.open_table(spark, factors)

        def point():
            own = tables.scan(bar_table, code, start, end)
            market.ohlcv(own, tables.scan(factor_table, code), code, start, end, "qfq").collect()

        for _ in range(3):
            point()
        seconds["point_ohlcv_qfq_one_code_one_year"] = timed(point)
        bar_table.count()
        seconds["count_bars"] = timed(bar_table.count)
        seconds["compact_bars"] = timed(lambda: versions.compact(spark, bar_table, BARS.keys, tables.MONTH))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
