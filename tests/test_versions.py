import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quotemill.model import BARS, TableSpec
from quotemill.operators import versions
from quotemill.sources import tables

from .conftest import rows

LOG = [("a", 1, "x", 10), ("a", 1, "y", 20), ("a", 2, "z", 5), ("b", 1, "w", 7), ("b", 1, "v", 7)]
SCHEMA = "k string, d int, val string, _version bigint"


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, SCHEMA)


def test_newest_version_wins_and_ties_are_stable(spark, log):
    first = rows(versions.current(log, ["k", "d"]))
    assert [r[:3] for r in first][:2] == [("a", 1, "y"), ("a", 2, "z")] and len(first) == 3
    for seed in range(3):
        shuffled = LOG[:]
        random.Random(seed).shuffle(shuffled)
        assert rows(versions.current(spark.createDataFrame(shuffled, SCHEMA).repartition(3), ["k", "d"])) == first


def test_filters_on_other_columns_do_not_revive_old_versions(log):
    assert versions.current(log, ["k", "d"]).filter("val = 'x'").count() == 0


def test_key_filter_reaches_the_scan(spark, log, tmp_path):
    log.write.parquet(str(tmp_path / "t"))
    df = versions.current(spark.read.parquet(str(tmp_path / "t")), ["k", "d"]).filter("k = 'a' AND val = 'y'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "EqualTo(k,a)" in pushed and "val" not in pushed
    assert "WindowGroupLimit" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 2), st.integers(0, 2**40)), min_size=1, max_size=40, unique_by=lambda r: (r[0], r[2])))
def test_current_and_history_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, val int, _version bigint")
    best = {}
    for k, val, ver in data:
        if k not in best or ver > best[k][1]:
            best[k] = (val, ver)
    assert rows(versions.current(df, ["k"])) == sorted((k, *v) for k, v in best.items())
    ranked = {(r["k"], r["_version"]): r["version_rank"] for r in versions.history(df, ["k"]).collect()}
    for k, _, ver in data:
        assert ranked[k, ver] == 1 + sum(1 for r in data if r[0] == k and r[2] > ver)


def test_replaying_rows_changes_nothing_but_versions(log):
    replay = versions.with_version(log.filter("k = 'a' AND val <> 'x'"), F.lit(99))
    assert versions.replay_changes(log, replay, ["k", "d"]).count() == 0
    assert versions.replay_changes(log, replay.withColumn("val", F.lit("new")), ["k", "d"]).count() == 2


def test_version_column_is_replaced_not_doubled(log):
    assert versions.with_version(log, 5).columns.count("_version") == 1


def test_row_version_precedence(spark):
    df = spark.sql("""SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 08:00:00', TIMESTAMP_NTZ '2023-01-01 08:00:00'),
      (NULL, TIMESTAMP_NTZ '2023-01-01 08:00:00'), (NULL, NULL) AS t(u, c)""")
    loaded = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    got = [r[0] for r in df.select(versions.row_version(F.col("u"), F.col("c"), loaded)).collect()]
    assert got == [1704067200000, 1672531200000, 1717200000000]


def test_scope_deletes(spark):
    data = spark.sql("""SELECT * FROM VALUES ('A', DATE '2024-03-31', DATE '2024-04-20'), ('A', DATE '2024-06-30', DATE '2024-07-20'),
      ('B', DATE '2024-03-30', DATE '2024-04-20') AS t(ts_code, end_date, ann_date)""")
    def left(*scopes):
        df = spark.createDataFrame(scopes, "ts_code string, ann_date string, period string").withColumn("ann_date", F.col("ann_date").cast("date"))
        return [(r[0], r[1].month) for r in versions.delete_scopes(data, df).orderBy("ts_code", "end_date").collect()]

    assert left((None, None, None)) == [("A", 3), ("A", 6), ("B", 3)]
    assert left(("A", None, None)) == [("B", 3)]
    assert left((None, None, "20240331")) == [("A", 6)]
    assert left(("A", None, "20240331")) == [("A", 6), ("B", 3)]
    assert left((None, "2024-04-20", None), ("A", "2024-07-20", None)) == []


def test_scope_deletes_use_the_first_date_set(spark):
    data = spark.sql("SELECT 'A' AS ts_code, DATE '2024-01-02' AS trade_date, DATE '2024-05-05' AS ann_date")
    scope = spark.sql("SELECT CAST(NULL AS string) AS ts_code, DATE '2024-01-02' AS trade_date, DATE '1999-01-01' AS ann_date")
    assert versions.delete_scopes(data, scope).count() == 0


def test_scopes_of_all_shapes_take_one_join_of_the_table(spark):
    import itertools

    codes, days = ["A", "B", None], [dt.date(2024, 1, 31), dt.date(2024, 2, 29), None]
    data = [(c, a, b) for c in codes for a in days for b in days]
    table = spark.createDataFrame(data, "ts_code string, end_date date, ann_date date")
    scopes = [("A", None, days[0], None), (None, days[1], None, None), ("B", None, None, "20240115"), (None, None, None, None), (None, days[0], days[1], "20240201")]
    for chosen in itertools.combinations(scopes, 2):
        def hit(row):
            for code, end, ann, period in chosen:
                end_first = end if end is not None else None
                named = [row[0] == code] if code else []
                named += [row[1] == end_first] if end else [row[2] == ann] if ann else []
                named += [row[1] is not None and row[1].strftime("%Y%m") == period[:6]] if period else []
                if named and all(named):
                    return True
            return False

        df = spark.createDataFrame(chosen, "ts_code string, end_date date, ann_date date, period string")
        kept = versions.delete_scopes(table, df)
        assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in data if not hit(r)), key=str)
        assert sorted(map(tuple, versions.within_scopes(table, df).collect()), key=str) == sorted((r for r in data if hit(r)), key=str)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1


def test_only_touched_months_are_compacted(spark, tmp_path):
    path = str(tmp_path / "bars")
    day = lambda s: F.lit(s).cast("date")
    base = spark.range(3).select(F.concat(F.lit("00000"), F.col("id"), F.lit(".SH")).alias("ts_code"), F.col("id").cast("double").alias("close"))
    for when in ("2024-01-02", "2024-02-05"):
        tables.append(base.withColumn("trade_date", day(when)), path, BARS, 1)
    assert versions.compact_months(spark, path, BARS.keys, tables.MONTH, 0) == [202401, 202402]
    untouched = sorted(p.name for p in (tmp_path / "bars" / "_month=202401").iterdir())
    tables.append(base.withColumn("trade_date", day("2024-02-05")), path, BARS, 2)
    tables.append(base.withColumn("trade_date", day("2024-03-05")), path, BARS, 3)
    assert versions.compact_months(spark, path, BARS.keys, tables.MONTH, 1) == [202402, 202403]
    assert sorted(p.name for p in (tmp_path / "bars" / "_month=202401").iterdir()) == untouched
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).groupBy("_month").agg(F.count("*"), F.min("_version"))) == [(202401, 3, 1), (202402, 3, 2), (202403, 3, 3)]
    assert versions.compact_months(spark, path, BARS.keys, tables.MONTH, 3) == []


def test_expired_days_go_without_being_read(spark, tmp_path):
    path = str(tmp_path / "calls")
    log = spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-01 10:00:00' + make_dt_interval(CAST(id AS INT)) AS started_at FROM range(6)")
    assert tables.append_by_day(log, path, "started_at") == 6
    assert tables.drop_before(spark, path, "_day", "2024-01-04") == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert rows(spark.read.parquet(path).select("id")) == [(3,), (4,), (5,)] and tables.drop_before(spark, path, "_day", "2024-01-04") == []


def test_a_write_reads_its_input_once_and_keeps_months(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.sql("SELECT CAST(id % 7 AS STRING) AS k, date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS d, id AS v FROM range(900)")
    once = df.mapInArrow(count, df.schema)
    out = tables.rewrite(spark, once, ["k", "d"], {"v": "w"}, path=str(tmp_path / "w"), date_column="d")
    assert seen.value == 900 and out.count() == 900 and sorted(p.name for p in (tmp_path / "w").glob("_month=*")) == ["_month=202401", "_month=202402", "_month=202403"]
    again = tables.rebuild(spark, out, ["d", "k"], str(tmp_path / "b"), "d")
    assert rows(again.drop("_month")) == rows(out.drop("_month"))


def test_duplicate_ratio_of_an_empty_table_is_null(log):
    got = versions.duplicate_ratio({"t": (log, ["k", "d"]), "none": (log.filter("false"), ["k"])}).orderBy("table_name").collect()
    assert [tuple(r) for r in got] == [("none", 0, 0, None), ("t", 5, 3, 5 / 3)]


def test_append_scan_and_compact(spark, tmp_path):
    path = str(tmp_path / "bars")
    day = lambda s: F.lit(s).cast("date")
    base = spark.range(4).select(F.concat(F.lit("00000"), F.col("id"), F.lit(".SH")).alias("ts_code"), F.col("id").cast("double").alias("close"))
    for when, version in (("2024-01-02", 1), ("2024-01-02", 2), ("2024-02-05", 3)):
        assert tables.append(base.withColumn("trade_date", day(when)), path, BARS, version)
    assert not tables.append(base.filter("false").withColumn("trade_date", day("2024-01-02")), path, BARS, 4)
    log = tables.read(spark, path)
    assert log.count() == 12 and versions.current(log, BARS.keys).count() == 8
    scan = tables.scan(tables.open_table(spark, path), "000002.SH", "20240201", "20240228")
    assert [r["_version"] for r in scan.collect()] == [3]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan and "EqualTo(ts_code,000002.SH)" in plan
    small = versions.compact(spark, spark.read.parquet(path), BARS.keys, tables.MONTH, str(tmp_path / "compacted"))
    assert small.count() == 8 and small.agg(F.min("_version")).first()[0] == 2


def test_undated_table_stays_unpartitioned(spark, tmp_path):
    spec = TableSpec("basic", ("ts_code",), "list_date")
    path = str(tmp_path / "basic")
    tables.append(spark.sql("SELECT 'A' AS ts_code"), path, spec, 1)
    assert tables.MONTH not in spark.read.parquet(path).columns


def test_row_version_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("SELECT 'A' AS k, TIMESTAMP_NTZ '2024-01-01 08:00:00' AS updated_at")
    tables.append_with_row_version(df, path, TableSpec("t", ("k",)), F.lit("2024-06-01").cast("timestamp_ntz"))
    assert rows(spark.read.parquet(path).select("k", "_version")) == [("A", 1704067200000)]


def test_rewrite_and_rebuild(spark, log, tmp_path):
    out = tables.rewrite(spark, log, ["k"], {"val": "text"}, {"d": "string", "text": "int"}, {"note": "string"}, str(tmp_path / "w"))
    assert dict(out.dtypes) == {"k": "string", "d": "string", "text": "int", "_version": "bigint", "note": "string"}
    assert out.count() == 5 and tables.rebuild(spark, log, ["d", "k"], str(tmp_path / "b")).count() == 5


def test_exports(spark, log, tmp_path):
    got = tables.json_records(spark.sql("SELECT 'A' AS a, DATE '2024-01-02' AS d, CAST(NULL AS int) AS n")).first()[0]
    assert got == '{"a":"A","d":"2024-01-02","n":null}'
    tables.export(log, str(tmp_path / "j"))
    tables.export(log, str(tmp_path / "p"), "parquet")
    assert spark.read.json(str(tmp_path / "j")).count() == spark.read.parquet(str(tmp_path / "p")).count() == 5
    with pytest.raises(ValueError):
        tables.export(log, str(tmp_path / "x"), "csv")


def test_select_where(log):
    assert [tuple(r) for r in tables.select_where(log, ["k", "val"], "d = 1", ["val"]).collect()] == [("b", "v"), ("b", "w"), ("a", "x"), ("a", "y")]


def test_delete_where_keeps_unknowns(spark):
    df = spark.createDataFrame([("a", "failed"), ("b", None), ("c", "done")], "interface string, status string")
    kept, doomed = versions.delete_where(df, F.col("status") == "failed")
    assert rows(kept.select("interface")) == [("b",), ("c",)] and rows(doomed) == [("failed", 1)]


def test_bucketed_tables_resolve_and_join_without_a_shuffle(spark, tmp_path):
    spec, other = TableSpec("left", ("k", "d"), None), TableSpec("right", ("k", "d"), None)
    hot = spark.range(4000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 90)) k", "cast(IF(id % 3 = 0, 1, id % 7) AS int) d", "id val", "id % 1000 _version")
    names = [f"bucketed_{tmp_path.name.replace('-', '_')}_{x}" for x in "ab"]
    for batch in (hot.filter("id < 2500"), hot.filter("id >= 2500"), hot.limit(0)):
        left = tables.append_bucketed(batch, names[0], spec, 4, str(tmp_path / "a"))
    right = tables.append_bucketed(hot.selectExpr("k", "d", "-val AS other", "_version"), names[1], other, 4, str(tmp_path / "b"))
    assert left.filter("k = 'hot'").count() == 2  # one row of a batch
    resolved = versions.current(left, spec.keys)
    assert rows(resolved) == rows(versions.current(hot, spec.keys))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = resolved.drop("_version").join(versions.current(right, other.keys).drop("_version"), ["k", "d"])
        assert joined.count() == resolved.count()
        for df in (resolved, joined):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_compaction_writes_a_file_a_task_aside(spark, tmp_path, monkeypatch):
    path, aside = str(tmp_path / "bars"), tmp_path / "aside"
    monkeypatch.setattr(versions, "scratch_path", lambda _, name: str(aside))
    log = spark.sql("SELECT CAST(id % 9 AS STRING) AS ts_code, date_add(DATE '2020-01-01', CAST(id % 700 AS INT)) AS trade_date, id AS close, id AS _version FROM range(6300)")
    tables.append(log, path, BARS)
    assert len(versions.compact_months(spark, path, BARS.keys, tables.MONTH, -1)) == 23
    assert len([*aside.rglob("*.parquet")]) <= 8  # not one for each month of each task
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).select("ts_code", "trade_date", "_version")) == rows(versions.current(log, BARS.keys).select("ts_code", "trade_date", "_version"))
