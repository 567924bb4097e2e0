"""The registered queries. Each takes ``(spark, sf_dir)`` and reads whole tables.

Points in time are fixed, so results repeat; nothing depends on the clock.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import protect, scalar
from tidemark.functions.types import struct_of
from tidemark.operators import audit, extract, load, metadata as meta, regression as reg, staging
from tidemark.operators.metadata import ColumnSpec
from tidemark.plans import ingest as plan
from tidemark.session import prepare, scratch
from tidemark.sources import files
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.incremental import stream_merge

Query = Callable[[SparkSession, str], DataFrame]

EARLIER = datetime(2024, 1, 20)
AS_OF = datetime(2024, 2, 1)
ORDERS_KNOWN_UNTIL = datetime(2000, 1, 1)
ORDERS_CHANGED_SINCE = datetime(1999, 7, 1)
EVENTS_CHANGED_SINCE = datetime(2024, 1, 17)
KEY_16 = "sixteen byte key"
KEY_32 = "a key that is thirty-two bytes.."

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _REGISTRY[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def specs_from(df: DataFrame, **renamed: str) -> list[ColumnSpec]:
    """Column metadata that keeps a frame's own types."""
    names = {"bigint": "INT64", "int": "INT64", "double": "FLOAT64", "string": "STRING", "timestamp_ntz": "DATETIME", "date": "DATE"}
    return [ColumnSpec(c, names[t], renamed.get(c, c)) for c, t in df.dtypes]


# -- sources --------------------------------------------------------------------


@query
def src_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated file -> text columns -> declared types."""
    orders, path = table(spark, sf_dir, "orders"), scratch(spark, "src_delimited")
    orders.select([F.col(c).cast("string") for c in orders.columns]).write.csv(path, sep="\t", header=True)
    return _typed(files.read_landing(spark, path, "TSV"), specs_from(orders))


@query
def src_delimited_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted values with separators, quotes and line breaks inside."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    path = scratch(spark, "src_delimited_quoted")
    docs.select([F.col(c).cast("string") for c in docs.columns]).write.csv(
        path, sep="|", header=True, quote='"', escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return _typed(files.read_landing(spark, path, "DAT", sep="|", quote='"'), specs_from(docs))


def _lines(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The documents as delimited lines that escape quotes by a backslash. One in five has a surplus value,
    one in seven lacks the last. Every third line of work lies in another file."""
    docs, path = table(spark, sf_dir, "documents"), scratch(spark, label)
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    told = F.concat(F.lit('said "'), F.coalesce("source", F.lit("")), F.lit('"\n, "'), F.coalesce("lang", F.lit("")), F.lit('"'))
    broken = F.when(F.col("doc_id") % 3 == 0, told).otherwise(F.coalesce("lang", F.lit("")))
    tail = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("|"), "n_chars", F.lit("|surplus"))).when(F.col("doc_id") % 7 != 0, F.concat(F.lit("|"), "n_chars")).otherwise("")
    line = F.concat(F.col("doc_id").cast("string"), F.lit("|"), quoted(broken), tail)
    for part in (0, 1):
        inside = docs.filter((F.col("doc_id") % 3 == 0) if part == 0 else (F.col("doc_id") % 3 != 0))
        inside.select(line.alias("value")).write.mode("append").text(path)
    return path


_LINE = dict(sep="|", quote='"', escape="\\", header="none", columns=["doc_id", "told", "n_chars"])


@query
def src_delimited_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escaped quotes and line breaks inside values; records of another length are told apart."""
    path = _lines(spark, sf_dir, "src_delimited_escaped")
    good = files.read_delimited(spark, path, null_markers=(), on_surplus="reject", **_LINE)
    return _typed(good, [ColumnSpec("doc_id", "INT64", "doc_id"), ColumnSpec("told", "STRING", "told"), ColumnSpec("n_chars", "INT64", "n_chars")])


@query
def src_delimited_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with surplus values, as they stand in the files."""
    path = _lines(spark, sf_dir, "src_delimited_rejects")
    return files.rejected_records(spark, path, **_LINE).select(F.regexp_replace("record", r"\n\z", "").alias("record"))


def _typed(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    return df.select(*staging.projection(df, specs))


@query
def src_json_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API responses (500 records in a ``data`` array each) -> declared types."""
    events, path = table(spark, sf_dir, "events"), scratch(spark, "src_json_response")
    record = F.struct(
        F.col("event_id").alias("eventId"), F.col("ts").cast("string").alias("TS"), F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"), "value", F.from_json("props", "k bigint").alias("props"),
    )
    pages = events.groupBy(F.floor(F.col("event_id") / 500).alias("page")).agg(F.collect_list(record).alias("data"))
    pages.select(F.to_json(F.struct("data"))).write.text(path)
    columns = ["EVENTID", "TS", "USERID", "EVENTTYPE", "VALUE", "PROPS"]
    raw = files.read_json_response(spark, path, columns, multiline=False)
    return _typed(
        raw,
        [
            ColumnSpec("eventid", "INT64", "event_id"), ColumnSpec("ts", "DATETIME", "ts"),
            ColumnSpec("userid", "INT64", "user_id"), ColumnSpec("eventtype", "STRING", "event_type"),
            ColumnSpec("value", "FLOAT64", "value"), ColumnSpec("props", "STRING", "props"),
        ],
    )


@query
def src_json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose records differ in names and types, read without any column list."""
    events, path = table(spark, sf_dir, "events"), scratch(spark, "src_json_variant")
    kind = F.col("event_id") % 4
    # A value that is NULL is not written, so the records have different names.
    record = F.to_json(F.struct(
        F.col("event_id").alias("eventId"), F.when(kind != 1, F.col("event_type")).alias("event type"),
        F.when(kind == 2, F.col("value")).alias("value"), F.when(kind == 3, F.from_json("props", "k bigint")).alias("props"),
        F.when(kind == 0, F.col("user_id")).alias("user"),
    ))
    # A name that holds numbers in one half of the records and text in the other.
    mixed = F.when(kind < 2, F.concat(F.lit(',"mixed":'), F.col("event_id").cast("string"))).otherwise(F.concat(F.lit(',"mixed":"n'), F.col("event_id").cast("string"), F.lit('"')))
    line = F.concat(F.regexp_replace(record, "}$", ""), mixed, F.lit("}"))
    pages = events.groupBy(F.floor(F.col("event_id") / 500).alias("page")).agg(F.array_join(F.collect_list(line), ",").alias("data"))
    pages.select(F.concat(F.lit('{"data":['), "data", F.lit("]}"))).write.text(path)
    read = files.read_variant_response(spark, path, multiline=False)
    return read.select(
        F.col("eventId").alias("event_id"), F.col("event type").alias("event_type"), "value", "props", F.col("user").alias("user_id"), "mixed",
    )


@query
def src_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-lines file under a given schema."""
    part, path = table(spark, sf_dir, "part"), scratch(spark, "src_json_lines")
    part.write.json(path)
    return files.read_landing(spark, path, "JSON", schema=part.schema)


@query
def src_nested_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested column staged as its JSON text, and one value read back from it."""
    nested = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("props"))
    text = _typed(nested, [ColumnSpec("event_id", "INT64", "event_id"), ColumnSpec("props", "STRING", "props_text")])
    return text.withColumn("k", F.get_json_object("props_text", "$.k").try_cast("bigint"))


@query
def src_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over a view that reads the files in place."""
    files.external_view(spark, "external_part", f"{sf_dir}/part.parquet")
    return spark.sql(
        "SELECT p_brand, count(*) AS parts, round(avg(p_retailprice), 4) AS avg_price, max(p_size) AS max_size "
        "FROM external_part GROUP BY p_brand"
    )


@query
def src_table_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns of a table under an explicit schema."""
    return files.read_typed(
        table(spark, sf_dir, "lineitem"), {"l_orderkey": "string", "l_extendedprice": "double", "l_quantity": "bigint"}
    )


@query
def src_limit10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest orders."""
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
    )


# -- extraction -----------------------------------------------------------------


def _fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the tables of a fleet, finished orders as their published rows."""
    configs = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("database_schema"),
        F.col("c_custkey").alias("table_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "FULL").otherwise("INCR").alias("load_type"),
        F.when(F.col("c_acctbal") >= 0, F.lit("ID")).alias("primary_key_column"),
        F.when(F.col("c_acctbal") > 9000, F.lit("FULL")).alias("load_type_override"),
    )
    finished = F.col("o_orderstatus") == "F"
    state = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("table_id")).agg(
        F.max(finished.cast("int")).alias("table_exists"),
        F.max(F.when(finished, F.col("o_orderdate"))).alias("watermark"),
        F.count_if(finished).alias("record_count"),
    )
    return load.load_plan(configs, state, ["table_id"])


@query
def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, refresh, merge or reject - for all tables in one pass."""
    return _fleet(spark, sf_dir).select("table_id", "database_schema", "table_exists", "effective_load_type", "action")


@query
def extract_window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end of the next pull of every table."""
    return extract.window_plan(_fleet(spark, sf_dir), AS_OF).select("table_id", "action", "window_start", "window_end")


@query
def extract_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest event time per type, as epoch milliseconds."""
    marks = extract.watermarks(table(spark, sf_dir, "events"), ["event_type"], "ts")
    return marks.select("event_type", scalar.millis(F.col("value")).alias("watermark_ms"))


@query
def extract_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from three days before the watermark up to a fixed end."""
    events = table(spark, sf_dir, "events")
    start = extract.watermark(events, F.col("ts") - F.make_dt_interval(days=F.lit(extract.LOOK_BACK_DAYS)))
    return extract.incremental(events, "ts", start, AS_OF)


@query
def extract_resample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last value per type and hour."""
    return extract.resample(table(spark, sf_dir, "events"), ["event_type"], "ts", "value", "event_id")


@query
def extract_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text -> epoch milliseconds; other text gives NULL."""
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", scalar.ISO_SECONDS)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", scalar.epoch_ms(text).alias("ms"))


# -- metadata -------------------------------------------------------------------


def _connections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as connections, the parts they ship as the tables fed by them."""
    connections = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("connection_name"),
        F.concat(F.lit("https://nation-"), "s_nationkey", F.lit("/")).alias("connection_url"),
    )
    configs = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("connection_name"),
        F.concat(F.lit("PART_"), "l_partkey").alias("table_name"),
        F.when(F.col("l_linestatus") == "F", "FULL").otherwise("INCR").alias("load_type"),
    )
    return connections, configs


@query
def meta_connection_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections joined to their tables, without repeats."""
    return meta.connection_details(*_connections(spark, sf_dir), ["connection_url"], ["table_name", "load_type"])


@query
def meta_connection_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables with one load type of one connection."""
    connections, configs = _connections(spark, sf_dir)
    wanted = {"connection_name": "Supplier#000000001"}
    return meta.connection_details(
        meta.lookup(connections, **wanted), meta.lookup(configs, load_type="INCR", **wanted),
        ["connection_url"], ["table_name", "load_type"],
    )


@query
def meta_lookup_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup that ignores case."""
    return meta.lookup_ci(table(spark, sf_dir, "customer"), "c_mktsegment", "Building")


@query
def meta_column_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column lists of a fleet of tables: parts as columns, forty to a table."""
    kind = F.element_at(F.array(*map(F.lit, ["INT64", "FLOAT64", "STRING", "BOOL"])), (F.col("p_size") % 4 + 1).cast("int"))
    details = table(spark, sf_dir, "part").select(
        F.upper(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), "p_partkey")).alias("column_name"),
        kind.alias("datatype"),
        (F.col("p_partkey") % 40 + 1).alias("ordinal_position"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("COL_"), "p_partkey")).alias("mapping_column"),
        F.lit("P").alias("project_id"),
        F.lit("S").alias("database_schema"),
        F.concat(F.lit("T_"), F.floor(F.col("p_partkey") / 40)).alias("table_name"),
    )
    return meta.column_specs(details)


@query
def meta_replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two segments replaced by new ones."""
    old = table(spark, sf_dir, "customer")
    new = old.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 0)).withColumn(
        "c_acctbal", F.col("c_acctbal") + 1
    )
    return meta.replace_by_key(old, new, ["c_mktsegment"])


# -- staging --------------------------------------------------------------------


@query
def stage_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, cast and stamp in one projection."""
    return staging.stage(
        table(spark, sf_dir, "events"),
        [
            ColumnSpec("EVENT_ID", "INT64", "id"), ColumnSpec("TS", "DATETIME", "occurred_at"),
            ColumnSpec("TS", "DATE", "occurred_on"), ColumnSpec("USER_ID", "VARCHAR(50)", "user_ref"),
            ColumnSpec("EVENT_TYPE", "STRING", "kind"), ColumnSpec("VALUE", "FLOAT64", "price_usd"),
            ColumnSpec("VALUE", "INT64", "price_rounded"),
        ],
        AS_OF,
    )


@query
def stage_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no number, flag or time turns into NULL; the row stays."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type",
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_no"),
        F.concat(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.when(F.col("p_size") % 2 == 0, "x").otherwise("")).alias("price_text"),
        F.when(F.col("p_size") > 25, "TRUE").when(F.col("p_size") > 10, "false").otherwise("yes").alias("flag_text"),
    )
    return _typed(
        part,
        [
            ColumnSpec("P_PARTKEY", "INT64", "p_partkey"), ColumnSpec("P_NAME", "INT64", "name_as_int"),
            ColumnSpec("P_TYPE", "DATETIME", "type_as_time"), ColumnSpec("BRAND_NO", "INT64", "brand_no"),
            ColumnSpec("PRICE_TEXT", "FLOAT64", "price"), ColumnSpec("FLAG_TEXT", "BOOL", "flag"),
        ],
    )


# -- loads ----------------------------------------------------------------------


def _orders_before_and_changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Known orders as the target; later and recently changed ones as the source."""
    orders = table(spark, sf_dir, "orders")
    known = orders.filter(F.col("o_orderdate").isNull() | (F.col("o_orderdate") < scalar.ts_lit(ORDERS_KNOWN_UNTIL)))
    changed = extract.incremental(orders, "o_orderdate", ORDERS_CHANGED_SINCE)
    return staging.stamp(known, EARLIER), changed.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query
def load_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table replaced as a whole."""
    customer = table(spark, sf_dir, "customer")
    target = SnapshotTable(spark, scratch(spark, "load_full_refresh"))
    plan.load_reference(target, customer.filter("c_acctbal >= 0"), "create", EARLIER)
    plan.load_reference(target, customer, "full_refresh", AS_OF)
    return target.read()


@query
def load_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-based upsert."""
    return load.merge_upsert(*_orders_before_and_changed(spark, sf_dir), "o_orderkey", AS_OF)


@query
def load_merge_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert for a source too large to broadcast; load time renewed on update."""
    return load.merge_upsert(
        *_orders_before_and_changed(spark, sf_dir), "o_orderkey", AS_OF, touch_load_ts=True, broadcast_bytes=0
    )


@query
def load_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of both sides has no key: kept on the left, inserted from the right."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    target, source = (df.withColumn("o_orderkey", key) for df in _orders_before_and_changed(spark, sf_dir))
    return load.merge_upsert(target, source, "o_orderkey", AS_OF, broadcast_bytes=0)


@query
def load_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with many rows per key: the newest one counts."""
    items = table(spark, sf_dir, "lineitem")
    newest = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    earlier = F.col("l_shipdate").isNull() | (F.col("l_shipdate") < scalar.ts_lit(ORDERS_KNOWN_UNTIL))
    known = load.latest_per_key(items.filter(earlier), ["l_orderkey"], newest)
    later = extract.incremental(items, "l_shipdate", ORDERS_KNOWN_UNTIL)
    return load.merge_upsert(
        staging.stamp(known, EARLIER), later, "l_orderkey", AS_OF, on_duplicate="latest", latest_by=newest
    )


@query
def load_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a published table that rewrites the partitions of the batch only."""
    known, changed = (
        df.withColumn("o_year", F.year("o_orderdate")) for df in _orders_before_and_changed(spark, sf_dir)
    )
    target = SnapshotTable(spark, scratch(spark, "load_merge_partitioned"), partitioned_by="o_year")
    plan.load_reference(target, known, "create", EARLIER)
    plan.load_reference(target, changed, "merge", AS_OF, "o_orderkey")
    return target.read()


@query
def load_merge_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into an unpartitioned published table: only loads that hold a key are rewritten."""
    events = table(spark, sf_dir, "events")
    target = SnapshotTable(spark, scratch(spark, "load_merge_series"))
    known = staging.stage(events.filter(F.col("ts") < scalar.ts_lit(EARLIER)), _EVENT_SPECS, EARLIER)
    changed = extract.incremental(events, "ts", EVENTS_CHANGED_SINCE).withColumn("value", F.col("value") + 1)
    plan.load_reference(target, known, "create", EARLIER, watermark="event_id")
    plan.load_reference(target, staging.stage(changed, _EVENT_SPECS, AS_OF), "merge", AS_OF, "event_id", watermark="event_id")
    return target.read()


@query
def load_merge_moved_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert by key alone: changed orders move to the year after, where their key does not lie."""
    known, changed = (
        df.withColumn("o_year", F.year("o_orderdate")) for df in _orders_before_and_changed(spark, sf_dir)
    )
    target = SnapshotTable(spark, scratch(spark, "load_merge_moved_key"), partitioned_by="o_year")
    plan.load_reference(target, known, "create", EARLIER, watermark="o_orderkey")
    moved = changed.withColumn("o_year", F.col("o_year") + 1)
    plan.load_reference(target, moved, "merge", AS_OF, "o_orderkey", watermark="o_orderkey")
    return target.read()


# -- audit ----------------------------------------------------------------------


@query
def audit_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event type."""
    return extract.record_counts(table(spark, sf_dir, "events"), ["event_type"]).withColumnRenamed("value", "record_count")


@query
def audit_action_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids for a batch of new actions, continuing at 1000."""
    runs = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("table_name"), F.col("o_orderdate").alias("execution_start_datetime")
    )
    return audit.open_actions(runs, "o_orderkey", base=1000)


def _sparse(key: str) -> Column:
    """A unique whole number whose values lie in clusters with wide gaps between them."""
    return F.when(F.col(key) % 3 == 0, F.col(key)).otherwise(F.col(key) * 1_000_003 + (F.col(key) % 97) * 10**13)


@query
def audit_action_ids_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids in the order of numbers that lie far apart."""
    runs = table(spark, sf_dir, "lineitem").select(_sparse("l_orderkey").alias("batch"), "l_orderkey").distinct()
    return audit.assign_ids(runs, "batch", base=5000, name="action_id")


@query
def audit_action_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as actions, their items as status changes; the last change counts."""
    actions = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("action_id"), F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderdate").alias("execution_start_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("execution_end_datetime"), F.lit(0).cast("bigint").alias("execution_status"),
    )
    status = F.when(F.col("l_returnflag") == "A", -1).when(F.col("l_returnflag") == "R", 1).otherwise(0)
    changes = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("action_id"), F.col("l_linenumber").alias("seq"),
        F.col("l_shipdate").alias("execution_end_datetime"), status.cast("bigint").alias("execution_status"),
    )
    return audit.current_actions(actions, changes)


def _audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs; items on order count before a run, all items after it."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.col("l_linestatus") == "O").alias("record_cnt_before"), F.count(F.lit(1)).alias("record_cnt_after")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("audit_id"), F.col("o_orderkey").alias("action_id"),
        F.col("o_orderstatus").alias("database_schema"), F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderdate").alias("execution_start_datetime"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_custkey") * 30)).alias("execution_end_datetime"),
    )
    return orders.join(items.withColumnRenamed("l_orderkey", "action_id"), "action_id", "left")


@query
def audit_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End, duration, counts and delta written to open audit rows."""
    runs = _audit_runs(spark, sf_dir)
    opened = runs.select("audit_id", "action_id", "table_name", "execution_start_datetime", "record_cnt_before")
    actions = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("action_id"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_custkey") * 30)).alias("execution_end_datetime"),
    )
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("action_id")).agg(
        F.count(F.lit(1)).alias("record_cnt_after")
    )
    return audit.finalize(opened, actions, counts)


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = (F.col("record_cnt_after") - F.col("record_cnt_before")).cast("double")
    return _audit_runs(spark, sf_dir).select("database_schema", "table_name", "audit_id", delta.alias("delta"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("delta_")})


@query
def audit_delta_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the last seven deltas, as of every run."""
    return _rounded(audit.delta_stats(_deltas(spark, sf_dir)))


@query
def audit_delta_stats_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where ids lie far apart and one table owns nearly all runs."""
    runs = _deltas(spark, sf_dir).select(
        F.lit("W").alias("database_schema"),
        F.when(F.col("audit_id") % 50 == 0, F.col("table_name")).otherwise("HOT").alias("table_name"),
        _sparse("audit_id").alias("audit_id"), "delta",
    )
    return _rounded(audit.delta_stats(runs, width=1000))


@query
def audit_latest7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the newest seven deltas of every table."""
    return _rounded(audit.latest_stats(_deltas(spark, sf_dir)))


# -- sinks ----------------------------------------------------------------------


def _per_segment(df: DataFrame, *also: str) -> DataFrame:
    return df.groupBy("c_mktsegment", *also).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query
def sink_parquet_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet written with a named codec."""
    path = scratch(spark, "sink_parquet_codec")
    files.write_parquet(table(spark, sf_dir, "customer"), path, "gzip")
    return _per_segment(spark.read.parquet(path))


@query
def sink_append_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, replace, then append under a declared schema."""
    customer, path = table(spark, sf_dir, "customer"), scratch(spark, "sink_append_replace")
    schema = struct_of("c_custkey bigint, c_mktsegment string, c_acctbal double")
    files.write_table(customer, path, schema, "fail")
    files.write_table(customer.filter("c_acctbal >= 0"), path, schema, "replace")
    files.write_table(customer, path, schema, "append")
    return _per_segment(spark.read.parquet(path))


@query
def sink_archive_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous landing is kept in the archive when a new one arrives."""
    customer, root = table(spark, sf_dir, "customer"), scratch(spark, "sink_archive")
    landing, archive = f"{root}/landing", f"{root}/archive"
    for stamp, rows in (("20240120000000", customer.filter("c_acctbal < 0")), ("20240201000000", customer)):
        files.archive_landing(spark, landing, archive, stamp)
        files.write_parquet(rows, landing, mode="overwrite")
    kept = spark.read.parquet(archive).select("c_mktsegment", "c_acctbal", F.col("archived_at").cast("string"))
    new = spark.read.parquet(landing).select("c_mktsegment", "c_acctbal", F.lit("current").alias("archived_at"))
    return _per_segment(kept.unionByName(new), "archived_at")


# -- regression -----------------------------------------------------------------


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as a price series: an epoch time with hours, a price and a supply."""
    hours = (F.col("l_suppkey") % 24) * 3_600_000
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (scalar.millis(F.col("l_shipdate")) + hours).alias("time"),
        F.col("l_extendedprice").alias("price_usd"), F.col("l_quantity").alias("circulating_supply"),
    )


def _item_key() -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])


@query
def feat_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts of an epoch column."""
    events = table(spark, sf_dir, "events").select("event_id", scalar.millis(F.col("ts")).alias("epoch_ms"), "value")
    return reg.calendar_features(events, "epoch_ms")


@query
def lr_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on each side of the split, per return flag."""
    items = table(spark, sf_dir, "lineitem")
    return reg.split(items, _item_key()).groupBy("l_returnflag", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query
def lr_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-squares coefficients of all six features."""
    features = reg.feature_columns("circulating_supply")
    data = reg.split(reg.calendar_features(_priced(spark, sf_dir), "time"), _item_key())
    model = reg.fit(data.filter("is_train"), "price_usd", features)
    rows = [("intercept", model.intercept), *zip(features, model.coefficients)]
    return spark.createDataFrame(rows, "feature string, coefficient double").withColumn(
        "coefficient", F.round("coefficient", 3)
    )


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return plan.fit_and_score(
        _priced(spark, sf_dir), "time", "price_usd", ["circulating_supply"], _item_key(), AS_OF
    )


@query
def lr_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted prices of the test side."""
    return _scored(spark, sf_dir)[0].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "price_usd", F.round("prediction", 1).alias("prediction")
    )


@query
def lr_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root mean squared error on the test side."""
    return _scored(spark, sf_dir)[1].select(F.round("rmse", 4).alias("rmse"))


@query
def lr_metric_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric table after two runs."""
    path, schema = scratch(spark, "lr_metric"), struct_of("created_date timestamp_ntz, rmse double")
    # One value, so the rows are scored once for both runs.
    value = _scored(spark, sf_dir)[1].first()["rmse"]
    for created in (AS_OF, EARLIER):
        files.write_table(files.one_row(spark, schema, (created, value)), path, schema, "append")
    return spark.read.parquet(path).withColumn("rmse", F.round("rmse", 4))


# -- protection -----------------------------------------------------------------


@query
def protect_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted and decrypted columns, and whether the cipher text hid the value."""
    closed = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", protect.encrypt(F.col("c_name"), KEY_32).alias("name_hex"),
        protect.encrypt(F.col("c_acctbal"), KEY_16).alias("balance_hex"),
    )
    return closed.select(
        "c_custkey", protect.decrypt(F.col("name_hex"), KEY_32).alias("c_name"),
        protect.decrypt(F.col("balance_hex"), KEY_16).cast("double").alias("c_acctbal"),
        (F.unhex("name_hex").contains(F.col("c_name").cast("binary"))).alias("readable"),
    )


@query
def protect_fixed_iv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored credential format, over texts of every length and language."""
    closed = table(spark, sf_dir, "documents").select("doc_id", protect.encrypt_fixed_iv(F.col("text"), KEY_32).alias("hex"))
    return closed.select(
        "doc_id", F.length("hex").cast("bigint").alias("hex_length"), protect.decrypt_fixed_iv(F.col("hex"), KEY_32).alias("text")
    )


@query
def protect_map_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of a map encrypted and decrypted."""
    entries = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    closed = table(spark, sf_dir, "customer").select(
        "c_custkey", protect.map_values(entries, lambda v: protect.encrypt(v, KEY_16)).alias("m")
    )
    opened = closed.withColumn("m", protect.map_values(F.col("m"), lambda v: protect.decrypt(v, KEY_16)))
    return opened.select("c_custkey", F.col("m")["name"].alias("c_name"), F.col("m")["segment"].alias("c_mktsegment"))


# -- end to end -----------------------------------------------------------------

_EVENT_SPECS = [
    ColumnSpec("event_id", "INT64", "event_id"), ColumnSpec("ts", "DATETIME", "event_time"),
    ColumnSpec("ts", "DATE", "event_day"), ColumnSpec("user_id", "INT64", "user_id"),
    ColumnSpec("event_type", "STRING", "event_type"), ColumnSpec("value", "FLOAT64", "value"),
    ColumnSpec("props", "STRING", "props"),
]


def _ingest_events(
    spark: SparkSession, sf_dir: str, compact_after: int = plan.COMPACT_AFTER
) -> tuple[plan.Warehouse, plan.TableConfig]:
    """A first load from files, then an incremental pull from the watermark on."""
    events = table(spark, sf_dir, "events")
    ticks = iter([datetime(2024, 1, 20, 1, 0, 0), datetime(2024, 1, 20, 1, 2, 30), datetime(2024, 2, 1, 1, 0, 0), datetime(2024, 2, 1, 1, 1, 30)])
    warehouse = plan.Warehouse(
        spark, scratch(spark, "ingest"), clock=lambda: next(ticks), user="tester", compact_after=compact_after
    )
    common = dict(
        connection_name="API", database_schema="WEB", table_name="EVENTS", load_type="INCR",
        primary_key_column="EVENT_ID", incremental_date_column="EVENT_TIME", partitioned_by="event_day", accepted_encoding="gzip",
    )
    first = plan.TableConfig(ingestion_type="GCS", **common)
    later = plan.TableConfig(ingestion_type=plan.REQUEST, **common)
    plan.ingest(warehouse, first, _EVENT_SPECS, events.filter(F.col("ts") < scalar.ts_lit(EARLIER)), EARLIER)
    plan.ingest(warehouse, later, _EVENT_SPECS, events.withColumn("value", F.col("value") + 1), AS_OF)
    return warehouse, later


@query
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference table after a first load and an incremental one."""
    warehouse, config = _ingest_events(spark, sf_dir)
    return warehouse.table(config).read()


def _audit_trail(warehouse: plan.Warehouse) -> DataFrame:
    actions = warehouse.actions().select("action_id", "executed_by", "execution_status")
    return warehouse.audit().join(actions, "action_id").select(
        "action_id", "audit_id", "executed_by", "execution_status", "execution_start_datetime", "execution_end_datetime",
        "execution_duration", "record_cnt_before", "record_cnt_after", "delta", "delta_avg", "delta_variance", "delta_std_deviation",
    )


@query
def ingest_audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action history and audit rows of the same two runs."""
    return _audit_trail(_ingest_events(spark, sf_dir)[0])


@query
def ingest_compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the history packed after every run."""
    return _audit_trail(_ingest_events(spark, sf_dir, compact_after=1)[0])


@query
def ingest_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files loaded by table name, everything else from metadata tables."""
    orders, root = table(spark, sf_dir, "orders"), scratch(spark, "ingest_named")
    orders.select([F.col(c).cast("string") for c in orders.columns]).write.csv(f"{root}/files/orders", sep="\t", header=True)
    key = dict(project_id="P", database_schema="SALES", table_name="ORDERS")
    connection = dict(connection_name="FILES", connection_url=f"{root}/files")
    config = dict(
        key, connection_name="FILES", ingestion_type="S3", source_schema_table_name="orders", primary_key_column="O_ORDERKEY",
        load_type="INCR", file_format="TSV", delimiter="\t", quote_characters='"', accepted_encoding="gzip",
    )
    metadata = (
        files.one_row(spark, meta.CONNECTION_INFO, [connection.get(c) for c in meta.CONNECTION_INFO.fieldNames()]),
        files.one_row(spark, meta.INGESTION_CONFIG, [config.get(c) for c in meta.INGESTION_CONFIG.fieldNames()]),
        meta.specs_of(spark, [(s.source.upper(), s.datatype, s.target.upper()) for s in specs_from(orders)], **key),
    )
    warehouse = plan.Warehouse(spark, root, clock=lambda: AS_OF, user="tester")
    for _ in range(2):  # created, then merged with itself
        plan.ingest_named(warehouse, metadata, "FILES", "ORDERS", section="S3", as_of=AS_OF)
    return warehouse.table(plan.TableConfig("FILES", "SALES", "ORDERS", "INCR")).read()


@query
def ingest_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables loaded, then the regression over one of them."""
    warehouse = plan.Warehouse(spark, scratch(spark, "ingest_many"), clock=lambda: AS_OF, user="tester")
    jobs = []
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey")):
        df = table(spark, sf_dir, name)
        config = plan.TableConfig("FILES", "SALES", name, "FULL", ingestion_type="S3", primary_key_column=key)
        jobs.append((config, specs_from(df), df))
    results = plan.ingest_many(warehouse, jobs, AS_OF)
    for result in results.values():
        if isinstance(result, Exception):
            raise result
    orders = warehouse.table(jobs[1][0]).read().withColumn(
        "time", scalar.millis(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * 3_600_000
    )
    _, metric = plan.fit_and_score(orders, "time", "o_totalprice", ["o_custkey"], F.col("o_orderkey"), AS_OF)
    loads = warehouse.audit().select(
        "table_name", "record_cnt_before", "record_cnt_after", "delta", F.lit(None).cast("double").alias("rmse")
    )
    return loads.unionByName(
        metric.select(F.lit("regression").alias("table_name"), F.round("rmse", 3).alias("rmse")), allowMissingColumns=True
    )


@query
def ingest_dependent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and a regression in waves: one table fails, and only what depends on it is skipped."""
    warehouse = plan.Warehouse(spark, scratch(spark, "ingest_dependent"), clock=lambda: AS_OF, user="tester")
    after = {"orders": ["customer"], "lineitem": ["part"], "supplier": ["orders"], "nation": ["lineitem", "customer"]}
    steps: list[plan.Load | plan.Step] = []
    for name in ("nation", "supplier", "lineitem", "orders", "part", "customer"):
        df = table(spark, sf_dir, name)
        specs = specs_from(df) + ([ColumnSpec("no_such_column", "STRING", "x")] if name == "part" else [])
        config = plan.TableConfig("FILES", "SALES", name, "FULL", ingestion_type="S3")
        steps.append(plan.Load(config, specs, df, tuple(f"sales/{a}" for a in after.get(name, ()))))

    def regression() -> float:
        orders = warehouse.table(next(s.config for s in steps if s.name == "sales/orders")).read().withColumn(
            "time", scalar.millis(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * 3_600_000
        )
        return plan.fit_and_score(orders, "time", "o_totalprice", ["o_custkey"], F.col("o_orderkey"), AS_OF)[1].first()["rmse"]

    results = plan.run_dependent(warehouse, [plan.Step("regression", regression, ("sales/orders",)), *steps], AS_OF)
    outcome = [
        (name.rsplit("/", 1)[-1], "skipped" if isinstance(r, plan.Skipped) else "failed" if isinstance(r, Exception) else "done", r if isinstance(r, float) else None)
        for name, r in results.items()
    ]
    told = spark.createDataFrame(outcome, "table_name string, outcome string, rmse double")
    history = warehouse.actions().select("table_name", "execution_status").join(warehouse.audit().select("table_name", "record_cnt_after"), "table_name", "left")
    return told.join(history, "table_name", "left").withColumn("rmse", F.round("rmse", 3))


@query
def ingest_text_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load and a pull behind a watermark that is ISO text; other text comes every time."""
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("week "), F.date_format("ts", "D"))).otherwise(F.date_format("ts", scalar.ISO_SECONDS))
    told = events.select("event_id", text.alias("changed"), "value")
    specs = [ColumnSpec("event_id", "INT64", "event_id"), ColumnSpec("changed", "STRING", "changed"), ColumnSpec("value", "FLOAT64", "value")]
    warehouse = plan.Warehouse(spark, scratch(spark, "ingest_text"), clock=lambda: AS_OF, user="tester")
    common = dict(connection_name="API", database_schema="WEB", table_name="EVENTS", load_type="INCR", primary_key_column="EVENT_ID", incremental_date_column="CHANGED")
    first = told.filter(events["ts"] < scalar.ts_lit(EARLIER))
    plan.ingest(warehouse, plan.TableConfig(ingestion_type="S3", **common), specs, first, EARLIER)
    config = plan.TableConfig(ingestion_type=plan.REQUEST, **common)
    plan.ingest(warehouse, config, specs, told.withColumn("value", F.col("value") + 1), AS_OF)
    return warehouse.table(config).read()


@query
def ingest_hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly buckets from a first load, a late one into the same buckets, and a pull."""
    events = table(spark, sf_dir, "events")
    warehouse = plan.Warehouse(spark, scratch(spark, "ingest_series"), clock=lambda: AS_OF, user="tester")
    series = plan.Series(("event_type",), "event_time", "value", "event_id")
    common = dict(connection_name="API", database_schema="WEB", table_name="HOURS", load_type="INCR", primary_key_column="BUCKET", incremental_date_column="EVENT_TIME", extra_parameters="h1")
    before, third = F.col("ts") < scalar.ts_lit(EARLIER), F.col("event_id") % 3 == 0
    landed = plan.TableConfig(ingestion_type="S3", **common)
    plan.ingest(warehouse, landed, _EVENT_SPECS, events.filter(before & ~third), EARLIER, series=series)
    plan.ingest(warehouse, landed, _EVENT_SPECS, events.filter(before & third), EARLIER, series=series)
    pulled = plan.TableConfig(ingestion_type=plan.REQUEST, **common)
    plan.ingest(warehouse, pulled, _EVENT_SPECS, events, AS_OF, series=series)
    return warehouse.table(pulled).read().drop(*staging.AUDIT_COLUMNS)


@query
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files merged as a stream, then changed ones merged by a second run."""
    root = scratch(spark, "stream")
    events = table(spark, sf_dir, "events")
    target = SnapshotTable(spark, f"{root}/ref", partitioned_by="event_day")

    def run(rows: DataFrame, load_ts: datetime) -> None:
        files.write_parquet(rows.repartition(4), f"{root}/landing", mode="append")
        stream_merge(
            spark, f"{root}/landing", events.schema, target, _EVENT_SPECS, "event_id", load_ts,
            f"{root}/checkpoint", files_per_batch=2,
        )

    run(events.filter(F.col("ts") < scalar.ts_lit(EARLIER)), EARLIER)
    changed = extract.incremental(events, "ts", EVENTS_CHANGED_SINCE)
    run(changed.withColumn("value", F.col("value") + 1), AS_OF)
    return target.read()
