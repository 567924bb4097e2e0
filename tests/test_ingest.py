from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metadata as M
from tidemark.operators.load import DuplicateSourceKey
from tidemark.plans import ingest as plan

DAY = datetime(2024, 1, 10)
SPECS = [M.ColumnSpec("TIME", "INT64", "time"), M.ColumnSpec("PRICEUSD", "FLOAT64", "price_usd")]
ms = lambda moment: int((moment - datetime(1970, 1, 1)).total_seconds() * 1000)


def config(**changes):
    base = dict(
        connection_name="API", database_schema="HIST", table_name="BTC", load_type="INCR",
        primary_key_column="TIME", incremental_date_column="TIME", accepted_encoding="gzip",
    )
    return plan.TableConfig(**{**base, **changes})


def series(spark, start, hours, price):
    return spark.createDataFrame(
        [(str(ms(start + timedelta(hours=h))), str(price)) for h in range(hours)], "time string, priceUsd string"
    )


@pytest.fixture()
def warehouse(spark, tmp_path):
    ticks = iter(DAY + timedelta(minutes=m) for m in range(1000))
    return plan.Warehouse(spark, str(tmp_path / "wh"), clock=lambda: next(ticks), user="me")


def test_first_pull_looks_back_three_days_then_follows_the_watermark(spark, warehouse):
    windows = []

    def source(start, end):
        windows.append((start, end))
        return series(spark, DAY - timedelta(days=5), 200, len(windows)).filter(
            F.col("time").cast("bigint").between(start, end - 1)
        )

    first = plan.ingest(warehouse, config(), SPECS, source, DAY)
    second = plan.ingest(warehouse, config(), SPECS, source, DAY + timedelta(hours=5))
    assert windows[0] == (ms(DAY - timedelta(days=3)), ms(DAY))
    # The start is inclusive: the row at the watermark comes again and is updated.
    assert windows[1] == (ms(DAY - timedelta(hours=1)), ms(DAY + timedelta(hours=5)))
    assert (first.action, first.record_cnt_before, first.record_cnt_after) == ("create", 0, 72)
    assert (second.action, second.record_cnt_before, second.record_cnt_after) == ("merge", 72, 77)
    table = warehouse.table(config()).read()
    assert table.filter("price_usd = 2").count() == 6 and table.select("time").distinct().count() == 77

    audit = warehouse.audit().orderBy("audit_id").collect()
    assert [(r["record_cnt_before"], r["record_cnt_after"], r["delta"]) for r in audit] == [(0, 72, 72.0), (72, 77, 5.0)]
    assert audit[1]["delta_avg"] == 38.5 and audit[1]["delta_variance"] == 33.5**2
    assert audit[1]["delta_std_deviation"] == 2 * 33.5**2
    assert [r["execution_status"] for r in warehouse.actions().orderBy("action_id").collect()] == [1, 1]
    assert {r["executed_by"] for r in warehouse.actions().collect()} == {"me"}
    # The landing of the first run is in the archive.
    assert spark.read.parquet(warehouse.archive(config())).count() == 72


def test_dataframe_source_is_filtered_to_the_window(spark, warehouse):
    text = series(spark, DAY - timedelta(days=10), 400, 1)
    assert plan.ingest(warehouse, config(), SPECS, text, DAY).record_cnt_after == 72


def test_override_beats_the_configuration(spark, warehouse):
    rows = series(spark, DAY, 3, 1)
    files = config(ingestion_type="S3")
    plan.ingest(warehouse, files, SPECS, rows, DAY)
    result = plan.ingest(warehouse, files, SPECS, rows.limit(2), DAY, load_type_override="FULL")
    assert (result.action, result.record_cnt_before, result.record_cnt_after) == ("full_refresh", 3, 2)


@pytest.mark.parametrize(
    "change, specs, problem",
    [
        ({"primary_key_column": None}, SPECS, ValueError),
        ({"load_type": "SNAP"}, SPECS, ValueError),
        ({}, [*SPECS, M.ColumnSpec("TIME", "STRING", "price_usd")], ValueError),
        ({}, [*SPECS, M.ColumnSpec("NOT_THERE", "STRING", "x")], ValueError),
    ],
)
def test_failure_is_recorded_and_changes_nothing(spark, warehouse, change, specs, problem):
    files = config(ingestion_type="S3")
    plan.ingest(warehouse, files, SPECS, series(spark, DAY, 3, 1), DAY)
    with pytest.raises(problem):
        plan.ingest(warehouse, config(ingestion_type="S3", **change), specs, series(spark, DAY, 3, 2), DAY)
    assert [r["execution_status"] for r in warehouse.actions().orderBy("action_id").collect()] == [1, -1]
    assert warehouse.table(files).read().filter("price_usd = 2").count() == 0


def test_duplicate_keys_in_a_batch(spark, warehouse):
    files = config(ingestion_type="S3")
    rows = series(spark, DAY, 3, 1)
    plan.ingest(warehouse, files, SPECS, rows, DAY)
    with pytest.raises(DuplicateSourceKey):
        plan.ingest(warehouse, files, SPECS, rows.unionByName(series(spark, DAY, 1, 2)), DAY)
    failed = warehouse.audit().orderBy(F.desc("audit_id")).first()
    assert (failed["record_cnt_before"], failed["record_cnt_after"], failed["delta"]) == (3, None, None)
    again = plan.ingest(
        warehouse, files, SPECS, rows.unionByName(series(spark, DAY, 1, 2)), DAY, on_duplicate="latest", latest_by=["price_usd"]
    )
    assert again.record_cnt_after == 3


def test_one_bad_table_does_not_stop_the_others(spark, warehouse):
    rows = series(spark, DAY, 3, 1)
    good, bad = config(ingestion_type="S3"), config(ingestion_type="S3", table_name="BAD", accepted_encoding="nonsense")
    results = plan.ingest_many(warehouse, [(bad, SPECS, rows), (good, SPECS, rows)], DAY)
    assert isinstance(results[bad.path], Exception)
    assert results[good.path].record_cnt_after == 3


def test_config_from_a_lookup_row(spark):
    row = spark.createDataFrame([("API", "HIST", "BTC", "FULL", "x")], "connection_name string, database_schema string, table_name string, load_type string, bucket string").first()
    assert plan.TableConfig.from_row(row).path == "hist/btc"


def metadata(spark, uri, ingestion_type, **more):
    from tidemark.sources.files import one_row

    key = dict(project_id="P", database_schema="HIST", table_name="BTC")
    connection = dict(connection_name="API", connection_url=str(uri))
    row = dict(
        key, connection_name="API", ingestion_type=ingestion_type, source_schema_table_name="in", primary_key_column="TIME",
        incremental_date_column="TIME", load_type="INCR", **more,
    )
    return (
        one_row(spark, M.CONNECTION_INFO, [connection.get(c) for c in M.CONNECTION_INFO.fieldNames()]),
        one_row(spark, M.INGESTION_CONFIG, [row.get(c) for c in M.INGESTION_CONFIG.fieldNames()]),
        M.specs_of(spark, [("TIME", "INT64", "TIME"), ("PRICEUSD", "FLOAT64", "PRICE_USD")], **key),
    )


def test_landed_responses_are_loaded_by_name(spark, warehouse, tmp_path):
    (tmp_path / "in").mkdir()
    for page, (first, price) in enumerate([(0, 1), (60, 2)]):
        records = [f'{{"priceUsd": "{price}", "time": {ms(DAY - timedelta(hours=100 - first - h))}}}' for h in range(60)]
        (tmp_path / "in" / f"{page}.json").write_text('{"data": [%s]}' % ",".join(records))
    tables = metadata(spark, tmp_path, "REQUEST")
    result = plan.ingest_named(warehouse, tables, "API", "BTC", section="REQUEST", as_of=DAY)
    # 120 hours were landed, the last 72 before the run are in its window.
    assert (result.action, result.record_cnt_after) == ("create", 72)
    assert warehouse.table(config()).read().columns[:2] == ["time", "price_usd"]
    full = plan.ingest_named(warehouse, tables, "API", "BTC", as_of=DAY, load_type_override="FULL")
    assert full.action == "full_refresh"


def test_lookup_problems(spark, tmp_path):
    tables = metadata(spark, tmp_path, "S3", partitioned_by="day")
    assert plan.find_table(*tables, "API", "BTC", "S3")[0].partitioned_by == "day"
    for arguments in (("API", "NONE"), ("OTHER", "BTC"), ("API", "BTC", "REQUEST")):
        with pytest.raises(ValueError):
            plan.find_table(*tables, *arguments)


def test_rows_whose_watermark_cannot_be_read_are_loaded(spark, warehouse):
    rows = spark.createDataFrame([(str(ms(DAY) - 1000), "1"), ("not a time", "2"), (None, "3")], "time string, priceUsd string")
    assert plan.ingest(warehouse, config(), SPECS, rows, DAY).record_cnt_after == 3


def test_partition_column_in_upper_case(spark, warehouse):
    rows = series(spark, DAY - timedelta(hours=3), 2, 1)
    specs = [*SPECS, M.ColumnSpec("TIME", "INT64", "day")]
    assert plan.ingest(warehouse, config(partitioned_by="DAY"), specs, rows, DAY).record_cnt_after == 2


# -- text watermarks, intervals, destinations ----------------------------------------------

ISO = [M.ColumnSpec("ID", "INT64", "id"), M.ColumnSpec("CHANGED", "STRING", "changed"), M.ColumnSpec("V", "INT64", "v")]


def test_text_watermark_is_read_as_a_time(spark, warehouse):
    windows = []
    text = dict(primary_key_column="ID", incremental_date_column="CHANGED")
    rows = spark.createDataFrame(
        [(1, "2024-01-09T10:00:00Z", 1), (2, "2024-01-10T00:00:00Z", 1), (3, "soon", 1), (4, None, 1), (5, "2024-01-01T00:00:00Z", 1)],
        "id bigint, changed string, v bigint",
    )

    def source(start, end):
        windows.append((start, end))
        return rows

    plan.ingest(warehouse, config(**text), ISO, source, DAY)
    assert windows == [(ms(DAY - timedelta(days=3)), ms(DAY))]
    plan.ingest(warehouse, config(**text), ISO, source, DAY + timedelta(days=1))
    # The greatest text is "soon"; the greatest time counts.
    assert windows[1] == (ms(DAY), ms(DAY + timedelta(days=1)))
    newer = rows.unionByName(spark.createDataFrame([(6, "2024-01-10T05:00:00Z", 2), (7, "2024-01-12T00:00:00Z", 2)], rows.schema))
    result = plan.ingest(warehouse, config(**text), ISO, newer, DAY + timedelta(days=1))
    # 6 lies in the window, 7 after it; what cannot be read comes again.
    assert (result.record_cnt_before, result.record_cnt_after) == (5, 6)
    assert warehouse.table(config()).read().filter("id = 6").count() == 1


OBSERVED = [M.ColumnSpec("COIN", "STRING", "coin"), M.ColumnSpec("ID", "INT64", "id"), M.ColumnSpec("AT", "DATETIME", "at"), M.ColumnSpec("PRICE", "FLOAT64", "price")]
SERIES = plan.Series(("coin",), "at", "price", "id")


def observations(spark, seed, n=300):
    import random

    rng = random.Random(seed)
    rows = [(rng.choice("abc"), seed * 1000 + i, DAY + timedelta(minutes=rng.randrange(600)), float(rng.randrange(50))) for i in range(n)]
    return spark.createDataFrame(rows, "coin string, id bigint, at timestamp_ntz, price double")


def buckets(df):
    return sorted((r["coin"], r["bucket"], r["price"], r["observations"]) for r in df.collect())


def test_series_of_late_batches_equals_a_resample_from_scratch(spark, warehouse):
    files = config(ingestion_type="S3", extra_parameters="m30")
    parts = [observations(spark, i) for i in range(3)]
    for part in parts:
        plan.ingest(warehouse, files, OBSERVED, part, DAY, series=SERIES)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    from tidemark.operators import extract as X

    assert buckets(warehouse.table(files).read()) == buckets(X.resample(whole, ["coin"], "at", "price", "id", "30 minutes"))
    assert {r["execution_status"] for r in warehouse.actions().collect()} == {1}


def test_series_with_a_window_counts_its_open_bucket_anew(spark, warehouse):
    from tidemark.operators import extract as X

    pulled = config(extra_parameters="h1", incremental_date_column="AT")
    rows = observations(spark, 4)
    for hour in (3, 5, 5, 11):
        plan.ingest(warehouse, pulled, OBSERVED, rows, DAY + timedelta(hours=hour, minutes=20), series=SERIES)
    assert buckets(warehouse.table(pulled).read()) == buckets(X.resample(rows, ["coin"], "at", "price", "id"))


def test_interval_codes_and_keys(spark, warehouse):
    from tidemark.operators import extract as X

    assert [X.interval_width(c) for c in ("m15", "h1", " D1 ")] == ["15 minutes", "1 hours", "1 days"]
    for code in (None, "", "w1", "h0", "h"):
        with pytest.raises(ValueError, match="interval"):
            X.interval_width(code)
    nameless = spark.createDataFrame([(None, 1, DAY, 1.0)], "coin string, id bigint, at timestamp_ntz, price double")
    with pytest.raises(Exception, match="NULL in the series key coin"):
        plan.ingest(warehouse, config(ingestion_type="S3", extra_parameters="h1"), OBSERVED, nameless, DAY, series=SERIES)


def test_a_source_is_asked_for_the_interval(spark, warehouse):
    asked = []

    def source(start, end, interval):
        asked.append(interval)
        return series(spark, DAY - timedelta(hours=5), 3, 1)

    plan.ingest(warehouse, config(extra_parameters="h1"), SPECS, source, DAY)
    assert asked == ["h1"]


def test_destinations_of_the_configuration(spark, warehouse, tmp_path):
    placed = config(ingestion_type="S3", bucket=f"{tmp_path}/bucket", bucket_destination="in/coins/", archive_destination="old/coins")
    rows = series(spark, DAY, 3, 1)
    plan.ingest(warehouse, placed, SPECS, rows, DAY)
    plan.ingest(warehouse, placed, SPECS, rows.limit(2), DAY)
    assert spark.read.parquet(f"{tmp_path}/bucket/in/coins/btc").count() == 2
    kept = spark.read.parquet(f"{tmp_path}/bucket/old/coins/btc")
    assert kept.count() == 3 and "archived_at" in kept.columns
    # A file that stays what it is has no landing of its own.
    as_is = config(ingestion_type="S3", table_name="ASIS", to_parquet=False)
    plan.ingest(warehouse, as_is, SPECS, rows, DAY)
    assert files_below(warehouse.landing(as_is)) == [] and warehouse.table(as_is).row_count() == 3


def files_below(path):
    import glob

    return glob.glob(f"{path}/**/*", recursive=True)


def test_the_archive_is_moved_not_written_again(spark, warehouse):
    files = config(ingestion_type="S3")
    rows = series(spark, DAY, 3, 1)
    plan.ingest(warehouse, files, SPECS, rows, DAY)
    names = {f.rsplit("/", 1)[1] for f in files_below(warehouse.landing(files)) if f.endswith(".parquet")}
    plan.ingest(warehouse, files, SPECS, rows, DAY)
    assert names and names == {f.rsplit("/", 1)[1] for f in files_below(warehouse.archive(files)) if f.endswith(".parquet")}


# -- dependent runs ---------------------------------------------------------------------------


def load(spark, name, after=(), **changes):
    specs = changes.pop("specs", SPECS)
    return plan.Load(config(ingestion_type="S3", table_name=name, **changes), specs, series(spark, DAY, 3, 1), after)


def test_a_failed_table_skips_only_what_depends_on_it(spark, warehouse):
    bad = [*SPECS, M.ColumnSpec("NOT_THERE", "STRING", "x")]
    steps = [
        load(spark, "C", ("hist/b",)), load(spark, "A"), load(spark, "B", specs=bad), load(spark, "D", ("hist/a",)),
        plan.Step("count", lambda: warehouse.table(config(table_name="D")).read().count(), ("hist/d",)),
        plan.Step("never", lambda: 1 / 0, ("hist/c", "count")),
    ]
    assert [[s.name for s in w] for w in plan.waves(steps)] == [["hist/a", "hist/b"], ["hist/c", "hist/d"], ["count"], ["never"]]
    results = plan.run_dependent(warehouse, steps, DAY)
    assert results["hist/a"].record_cnt_after == results["hist/d"].record_cnt_after == results["count"] == 3
    assert isinstance(results["hist/b"], ValueError)
    assert isinstance(results["hist/c"], plan.Skipped) and isinstance(results["never"], plan.Skipped)
    status = {r["table_name"]: r["execution_status"] for r in warehouse.actions().collect()}
    assert status == {"A": 1, "B": -1, "D": 1}
    assert sorted(r["table_name"] for r in warehouse.audit().collect()) == ["A", "D"]
    # One append of the history per wave: the loads of the first one share their files.
    started = files_below(f"{warehouse.root}/history/actions")
    assert len([f for f in started if f.endswith(".parquet")]) == 2


def test_steps_of_a_wave_run_side_by_side_with_tags_and_pools(spark, warehouse):
    import threading

    meet, seen = threading.Barrier(2, timeout=30), []

    def work(name):
        meet.wait()
        seen.append((name, spark.sparkContext.getLocalProperty("spark.scheduler.pool"), len(spark.sparkContext.getJobTags())))
        return name

    results = plan.run_dependent(warehouse, [plan.Step(n, lambda n=n: work(n)) for n in ("x", "y")], DAY)
    assert results == {"x": "x", "y": "y"} and sorted(seen) == [("x", "x", 1), ("y", "y", 1)]


def test_a_failure_can_cancel_the_other_jobs(spark, warehouse):
    import time

    def slow():
        return spark.range(4, numPartitions=4).select(F.expr("java_method('java.lang.Thread', 'sleep', 30000L)")).collect()

    def fails():
        time.sleep(3)
        raise RuntimeError("lost")

    begin = time.time()
    steps = [plan.Step("slow", slow), plan.Step("fails", fails), plan.Step("later", lambda: 1, ("fails",)), plan.Step("free", lambda: 2, ("slow",))]
    results = plan.run_dependent(warehouse, steps, DAY, stop_on_failure=True)
    assert time.time() - begin < 25
    assert isinstance(results["fails"], RuntimeError) and isinstance(results["slow"], Exception)
    assert isinstance(results["later"], plan.Skipped) and isinstance(results["free"], plan.Skipped)


def test_orders_that_cannot_be(spark):
    step = lambda n, *after: plan.Step(n, lambda: n, after)
    with pytest.raises(ValueError, match="wait for each other: a, b"):
        plan.waves([step("a", "b"), step("b", "a"), step("c")])
    with pytest.raises(ValueError, match="unknown"):
        plan.waves([step("a", "z")])
    with pytest.raises(ValueError, match="one name"):
        plan.waves([step("a"), step("a")])


def test_statistics_of_loads_side_by_side(spark, warehouse):
    rows = series(spark, DAY, 10, 1)
    for n in (4, 6, 9):
        jobs = [(config(ingestion_type="S3", table_name=t), SPECS, rows.limit(n + k)) for k, t in enumerate(("X", "Y"))]
        plan.ingest_many(warehouse, jobs, DAY)
    audit = warehouse.audit().filter("table_name = 'X'").orderBy("audit_id").collect()
    assert [r["delta"] for r in audit] == [4.0, 2.0, 3.0] and [r["delta_avg"] for r in audit] == [4.0, 3.0, 3.0]
    assert sorted(r["audit_id"] for r in warehouse.audit().collect()) == [1, 2, 3, 4, 5, 6]


# -- packing of the history -------------------------------------------------------------------


def parquet_below(folder):
    return [f for f in files_below(folder) if f.endswith(".parquet")]


def test_packed_history_keeps_every_row(spark, tmp_path):
    """Six waves with a failure, packed after every second: the same rows as without, in few files."""
    bad = [*SPECS, M.ColumnSpec("NOT_THERE", "STRING", "x")]
    trails = {}
    for after in (2, 1000):
        ticks = iter(DAY + timedelta(minutes=m) for m in range(1000))
        warehouse = plan.Warehouse(spark, str(tmp_path / f"wh{after}"), clock=lambda: next(ticks), user="me", compact_after=after)
        for n in range(6):
            jobs = [(config(ingestion_type="S3", table_name=t), bad if (t, n) == ("Y", 3) else SPECS, series(spark, DAY, n + 2, n)) for t in "XY"]
            plan.ingest_many(warehouse, jobs, DAY, parallel=1)
        actions = sorted(map(tuple, warehouse.actions().collect()))
        audit = sorted(map(tuple, warehouse.audit().collect()))
        trails[after] = (actions, audit)
    assert trails[2] == trails[1000]
    assert [a[-1] for a in trails[2][0]].count(-1) == 1 and len(trails[2][0]) == 12 and len(trails[2][1]) == 11
    root = str(tmp_path / "wh2")
    assert plan.Warehouse(spark, root)._generation() == 3
    # The last packing came after the last wave: a file of actions, one of audit rows per table, no changes.
    assert len(parquet_below(f"{root}/history-3/actions")) == 1 and len(parquet_below(f"{root}/history-3/audit")) == 2
    assert not parquet_below(f"{root}/history-3/changes")


def test_open_action_and_failed_packing(spark, warehouse, monkeypatch):
    """An action that is open while the history is packed ends afterwards; what a failed packing leaves is not read."""
    files = config(ingestion_type="S3")
    plan.ingest(warehouse, files, SPECS, series(spark, DAY, 3, 1), DAY)
    run = warehouse.open_actions([files])[0]
    real = plan.files.mark
    monkeypatch.setattr(plan.files, "mark", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.compact_history()
    assert warehouse._generation() == 0 and warehouse.actions().count() == 2
    monkeypatch.setattr(plan.files, "mark", real)
    seen_before = warehouse.audit()
    assert warehouse.compact_history() == 1
    assert {r["action_id"]: r["execution_status"] for r in warehouse.actions().collect()} == {1: 1, 2: 0}
    run.ended, run.status = DAY, -1
    warehouse.close_actions([run])
    assert {r["action_id"]: r["execution_status"] for r in warehouse.actions().collect()} == {1: 1, 2: -1}
    # Ids go on, also for another writer; readers from before keep their files.
    assert plan.ingest(plan.Warehouse(spark, warehouse.root), files, SPECS, series(spark, DAY, 4, 2), DAY).action_id == 3
    assert seen_before.count() == 1 and warehouse.audit().count() == 2


def test_loads_stand_when_packing_fails(spark, tmp_path, monkeypatch):
    warehouse = plan.Warehouse(spark, str(tmp_path / "wh"), compact_after=1)
    monkeypatch.setattr(plan.files, "mark", lambda *_: 1 / 0)
    with pytest.warns(UserWarning, match="not packed"):
        result = plan.ingest(warehouse, config(ingestion_type="S3"), SPECS, series(spark, DAY, 3, 1), DAY)
    assert result.record_cnt_after == 3 and warehouse.audit().count() == 1


def test_empty_history_can_be_packed(spark, warehouse):
    assert warehouse.compact_history() == 1
    assert warehouse.actions().count() == 0 and warehouse.audit().count() == 0
