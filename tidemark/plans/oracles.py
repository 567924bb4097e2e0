"""For every registered query the same result as plain SQL over the same tables."""

from __future__ import annotations

from tidemark.sources.files import NULL_MARKERS

_STAMPED = "FALSE AS is_deleted, FALSE AS is_hard_delete, {ts} AS dw_create_datetime, {ts} AS dw_load_datetime"
_EARLIER = "TIMESTAMP '2024-01-20 00:00:00'"
_AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def _stamped(ts: str) -> str:
    return _STAMPED.format(ts=ts)


# -- sources --------------------------------------------------------------------

_MARKERS = ", ".join(f"'{m}'" for m in NULL_MARKERS)

_TOLD = """
    CASE WHEN doc_id % 3 = 0 THEN 'said "' || coalesce(source, '') || '"' || chr(10) || ', "' || coalesce(lang, '') || '"'
         ELSE coalesce(lang, '') END"""

_SOURCES = {
    "src_delimited_escaped": f"""
        SELECT doc_id, nullif({_TOLD}, '') AS told, CASE WHEN doc_id % 7 <> 0 THEN CAST(n_chars AS BIGINT) END AS n_chars
        FROM documents WHERE doc_id % 5 <> 0""",
    "src_delimited_rejects": f"""
        SELECT doc_id || '|"' || replace({_TOLD}, '"', chr(92) || '"') || '"|' || n_chars || '|surplus' AS record
        FROM documents WHERE doc_id % 5 = 0""",
    "src_delimited": "SELECT * FROM orders",
    "src_delimited_quoted": f"""
        SELECT doc_id,
               CASE WHEN text IN ({_MARKERS}) THEN NULL ELSE text END AS text,
               CASE WHEN lang IN ({_MARKERS}) THEN NULL ELSE lang END AS lang,
               CASE WHEN source IN ({_MARKERS}) THEN NULL ELSE source END AS source
        FROM documents""",
    "src_json_response": """
        SELECT event_id, ts, user_id, event_type, value,
               '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS props
        FROM events""",
    "src_json_variant": """
        SELECT event_id, CASE WHEN event_id % 4 <> 1 THEN event_type END AS event_type,
               CASE WHEN event_id % 4 = 2 THEN value END AS value,
               CASE WHEN event_id % 4 = 3 THEN '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' END AS props,
               CASE WHEN event_id % 4 = 0 THEN user_id END AS user_id,
               CASE WHEN event_id % 4 < 2 THEN CAST(event_id AS VARCHAR) ELSE 'n' || event_id END AS mixed
        FROM events""",
    "src_json_lines": "SELECT * FROM part",
    "src_nested_as_text": """
        SELECT event_id,
               '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS props_text,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "src_external_table": """
        SELECT p_brand, count(*) AS parts, round(avg(p_retailprice), 4) AS avg_price, max(p_size) AS max_size
        FROM part GROUP BY p_brand""",
    "src_table_typed": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_extendedprice, CAST(l_quantity AS BIGINT) AS l_quantity
        FROM lineitem""",
    "src_limit10": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
}

# -- extraction -----------------------------------------------------------------

_FLEET = """
    WITH state AS (
        SELECT o_custkey AS table_id, max(o_orderdate) FILTER (WHERE o_orderstatus = 'F') AS watermark,
               max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS table_exists
        FROM orders GROUP BY o_custkey
    ), fleet AS (
        SELECT c_custkey AS table_id, c_mktsegment AS database_schema, watermark,
               coalesce(state.table_exists, 0) AS table_exists,
               CASE WHEN c_acctbal > 9000 THEN 'FULL' WHEN c_nationkey % 2 = 0 THEN 'FULL' ELSE 'INCR' END
                   AS effective_load_type,
               c_acctbal >= 0 AS has_key
        FROM customer LEFT JOIN state ON c_custkey = state.table_id
    ), plan AS (
        SELECT *, CASE WHEN effective_load_type = 'INCR' AND NOT has_key THEN 'reject'
                       WHEN table_exists = 0 THEN 'create'
                       WHEN effective_load_type = 'FULL' THEN 'full_refresh' ELSE 'merge' END AS action
        FROM fleet
    )"""

_EXTRACTION = {
    "load_plan": f"{_FLEET} SELECT table_id, database_schema, table_exists, effective_load_type, action FROM plan",
    "extract_window_plan": f"""{_FLEET}
        SELECT table_id, action,
               CASE WHEN action = 'merge' THEN watermark ELSE {_AS_OF} - INTERVAL 3 DAY END AS window_start,
               {_AS_OF} AS window_end
        FROM plan""",
    "extract_watermark": "SELECT event_type, epoch_us(max(ts)) // 1000 AS watermark_ms FROM events GROUP BY event_type",
    "extract_incremental": f"""
        SELECT * FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY AND ts < {_AS_OF}""",
    "extract_resample_hourly": """
        SELECT event_type, bucket, value, observations FROM (
            SELECT event_type, date_trunc('hour', ts) AS bucket, value,
                   count(*) OVER (PARTITION BY event_type, date_trunc('hour', ts)) AS observations,
                   row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
                                      ORDER BY ts DESC, event_id DESC) AS rn
            FROM events)
        WHERE rn = 1""",
    "extract_epoch_ms": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE epoch_ms(o_orderdate) END AS ms FROM orders""",
}

# -- metadata -------------------------------------------------------------------

_CONNECTED = """
    SELECT DISTINCT s_name AS connection_name, 'https://nation-' || s_nationkey || '/' AS connection_url,
           'PART_' || l_partkey AS table_name, CASE WHEN l_linestatus = 'F' THEN 'FULL' ELSE 'INCR' END AS load_type
    FROM supplier JOIN lineitem ON s_name = 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"""


def _listed(text: str) -> str:
    return f"string_agg({text}, ', ' ORDER BY ordinal_position)"


_METADATA = {
    "meta_connection_details": _CONNECTED,
    "meta_connection_lookup": f"{_CONNECTED} WHERE s_name = 'Supplier#000000001' AND l_linestatus <> 'F'",
    "meta_lookup_ci": "SELECT * FROM customer WHERE upper(c_mktsegment) = upper('Building')",
    "meta_column_specs": f"""
        WITH details AS (
            SELECT lower(replace(p_name, ' ', '_') || '_' || p_partkey) AS source,
                   CASE p_size % 4 WHEN 0 THEN 'INT64' WHEN 1 THEN 'FLOAT64' WHEN 2 THEN 'STRING' ELSE 'BOOL' END AS datatype,
                   p_partkey % 40 + 1 AS ordinal_position,
                   CASE WHEN p_type <> 'PROMO' THEN 'col_' || p_partkey END AS target,
                   'T_' || (p_partkey // 40) AS table_name
            FROM part)
        SELECT 'P' AS project_id, 'S' AS database_schema, table_name,
               {_listed("target || ' ' || datatype")} AS create_columns,
               {_listed("'SAFE_CAST(' || source || ' AS ' || datatype || ') AS ' || target")} AS cast_columns,
               {_listed("source")} AS source_columns,
               {_listed("target")} AS target_columns
        FROM details GROUP BY table_name""",
    "meta_replace_by_key": """
        SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0""",
}

# -- staging and loads ----------------------------------------------------------

_STAGING = {
    "stage_typed": f"""
        SELECT event_id AS id, ts AS occurred_at, CAST(ts AS DATE) AS occurred_on, CAST(user_id AS VARCHAR) AS user_ref,
               event_type AS kind, value AS price_usd, CAST(round(value) AS BIGINT) AS price_rounded, {_stamped(_AS_OF)}
        FROM events""",
    "stage_bad_values": """
        SELECT p_partkey, CAST(NULL AS BIGINT) AS name_as_int, CAST(NULL AS TIMESTAMP) AS type_as_time,
               TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_no,
               TRY_CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN 'x' ELSE '' END
                        AS DOUBLE) AS price,
               CASE WHEN p_size > 25 THEN TRUE WHEN p_size > 10 THEN FALSE END AS flag
        FROM part""",
}


def _merge(
    target: str, source: str, key: str, columns: str, touch: bool = False, extra: str = ""
) -> str:
    """Target rows with the source's values where the key matches, then the rest of the source."""
    names = [c.strip() for c in columns.split(",")]
    picked = ", ".join(f"CASE WHEN s.hit THEN s.{c} ELSE t.{c} END AS {c}" for c in names)
    loaded = f"CASE WHEN s.hit THEN {_AS_OF} ELSE {_EARLIER} END" if touch else _EARLIER
    return f"""
        WITH {extra} t AS ({target}), s AS (SELECT *, TRUE AS hit FROM ({source}))
        SELECT {picked}, FALSE AS is_deleted, FALSE AS is_hard_delete,
               {_EARLIER} AS dw_create_datetime, {loaded} AS dw_load_datetime
        FROM t LEFT JOIN s ON t.{key} = s.{key}
        UNION ALL
        SELECT {", ".join(f"s.{c}" for c in names)}, {_stamped(_AS_OF)}
        FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.{key} = s.{key})"""


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _orders(key: str = "o_orderkey", more: str = "") -> tuple[str, str]:
    rest = "o_custkey, o_orderstatus, {price} AS o_totalprice, o_orderdate, o_orderpriority" + more
    known = f"SELECT {key} AS o_orderkey, {rest.format(price='o_totalprice')} FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderdate IS NULL"
    changed = f"SELECT {key} AS o_orderkey, {rest.format(price='o_totalprice + 1')} FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'"
    return known, changed


_ITEM_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def _newest_items(where: str) -> str:
    return f"""
        SELECT {_ITEM_COLUMNS} FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
                l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                l_linestatus DESC) AS rn
            FROM lineitem WHERE {where}) WHERE rn = 1"""


_YEAR = ", CAST(year(o_orderdate) AS INTEGER) AS o_year"
_NULLED = "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END"

_LOADS = {
    "load_full_refresh": f"SELECT *, {_stamped(_AS_OF)} FROM customer",
    "load_merge": _merge(*_orders(), "o_orderkey", _ORDER_COLUMNS),
    "load_merge_shuffle": _merge(*_orders(), "o_orderkey", _ORDER_COLUMNS, touch=True),
    "load_merge_null_keys": _merge(*_orders(_NULLED), "o_orderkey", _ORDER_COLUMNS),
    "load_merge_latest": _merge(
        _newest_items("(l_shipdate < TIMESTAMP '2000-01-01' OR l_shipdate IS NULL)"),
        _newest_items("l_shipdate >= TIMESTAMP '2000-01-01'"),
        "l_orderkey",
        _ITEM_COLUMNS,
    ),
    "load_merge_partitioned": _merge(*_orders(more=_YEAR), "o_orderkey", _ORDER_COLUMNS + ", o_year"),
    "load_merge_moved_key": _merge(
        _orders(more=_YEAR)[0], _orders(more=f"{_YEAR[:-10]} + 1 AS o_year")[1], "o_orderkey", _ORDER_COLUMNS + ", o_year"
    ),
}

# -- audit ----------------------------------------------------------------------

_RUNS = """
    WITH items AS (
        SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'O') AS record_cnt_before, count(*) AS record_cnt_after
        FROM lineitem GROUP BY l_orderkey
    ), runs AS (
        SELECT o_orderkey AS audit_id, o_orderstatus AS database_schema, o_orderpriority AS table_name,
               o_orderdate AS execution_start_datetime, o_orderdate + to_seconds(o_custkey * 30) AS execution_end_datetime,
               record_cnt_before, record_cnt_after,
               CAST(record_cnt_after - record_cnt_before AS DOUBLE) AS delta
        FROM orders LEFT JOIN items ON o_orderkey = l_orderkey
    )"""


def _delta_columns(over: str = "") -> str:
    n, mean = f"count(d) {over}", f"avg(d) {over}"
    population = f"var_pop(d) {over}"
    spread = f"CASE WHEN {n} = 1 THEN {population} ELSE var_samp(d) {over} END"
    return (
        f"round({mean}, 6) AS delta_avg, round({population}, 6) AS delta_variance, "
        f"round({spread}, 6) AS delta_std_deviation, round(sqrt({spread}), 6) AS delta_stddev_sqrt"
    )


_TABLES = "PARTITION BY database_schema, table_name ORDER BY audit_id"


def _sparse(key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN {key} ELSE {key} * 1000003 + ({key} % 97) * 10000000000000 END"


_AUDIT = {
    "audit_record_count": "SELECT event_type, count(*) AS record_count FROM events GROUP BY event_type",
    "audit_action_ids": """
        SELECT o_orderkey, o_orderpriority AS table_name, o_orderdate AS execution_start_datetime,
               1000 + row_number() OVER (ORDER BY o_orderkey) AS action_id,
               CAST(NULL AS TIMESTAMP) AS execution_end_datetime, CAST(0 AS BIGINT) AS execution_status
        FROM orders""",
    "audit_action_ids_sparse": f"""
        SELECT batch, l_orderkey, 5000 + row_number() OVER (ORDER BY batch) AS action_id
        FROM (SELECT DISTINCT {_sparse("l_orderkey")} AS batch, l_orderkey FROM lineitem)""",
    "audit_delta_stats_sparse": f"""{_RUNS}
        SELECT database_schema, table_name, audit_id,
               {_delta_columns(f"OVER ({_TABLES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")}
        FROM (SELECT 'W' AS database_schema, CASE WHEN audit_id % 50 = 0 THEN table_name ELSE 'HOT' END AS table_name,
                     {_sparse("audit_id")} AS audit_id, coalesce(delta, 0.0) AS d FROM runs)""",
    "audit_action_history": """
        WITH changes AS (
            SELECT l_orderkey, l_shipdate,
                   CASE l_returnflag WHEN 'A' THEN -1 WHEN 'R' THEN 1 ELSE 0 END AS status,
                   row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC,
                       CASE l_returnflag WHEN 'A' THEN -1 WHEN 'R' THEN 1 ELSE 0 END DESC) AS rn
            FROM lineitem)
        SELECT o_orderkey AS action_id, o_orderpriority AS table_name, o_orderdate AS execution_start_datetime,
               l_shipdate AS execution_end_datetime, CAST(coalesce(status, 0) AS BIGINT) AS execution_status
        FROM orders LEFT JOIN changes ON o_orderkey = l_orderkey AND rn = 1""",
    "audit_finalize": f"""{_RUNS}
        SELECT audit_id, audit_id AS action_id, table_name, execution_start_datetime, record_cnt_before,
               execution_end_datetime, record_cnt_after,
               CAST(round_even((epoch_us(execution_end_datetime) - epoch_us(execution_start_datetime)) / 6e7, 0) AS BIGINT)
                   AS execution_duration,
               delta
        FROM runs""",
    "audit_delta_stats": f"""{_RUNS}
        SELECT database_schema, table_name, audit_id,
               {_delta_columns(f"OVER ({_TABLES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")}
        FROM (SELECT *, coalesce(delta, 0.0) AS d FROM runs)""",
    "audit_latest7": f"""{_RUNS}
        SELECT database_schema, table_name, max(audit_id) AS audit_id, count(*) AS runs, {_delta_columns()}
        FROM (SELECT *, coalesce(delta, 0.0) AS d, row_number() OVER ({_TABLES} DESC) AS rn FROM runs)
        WHERE rn <= 7 GROUP BY database_schema, table_name""",
}

# -- sinks ----------------------------------------------------------------------

_PER_SEGMENT = "count(*) AS customers, round(sum(c_acctbal), 2) AS balance"

_SINKS = {
    "sink_parquet_codec": f"SELECT c_mktsegment, {_PER_SEGMENT} FROM customer GROUP BY c_mktsegment",
    "sink_append_replace": f"""
        SELECT c_mktsegment, {_PER_SEGMENT} FROM (
            SELECT * FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT * FROM customer) GROUP BY c_mktsegment""",
    "sink_archive_snapshot": f"""
        SELECT c_mktsegment, archived_at, {_PER_SEGMENT} FROM (
            SELECT *, '20240201000000' AS archived_at FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT *, 'current' AS archived_at FROM customer)
        GROUP BY c_mktsegment, archived_at""",
}

# -- regression -----------------------------------------------------------------


def _calendar(ts: str) -> str:
    return (
        f"CAST(hour({ts}) AS INTEGER) AS hour, CAST(dayofweek({ts}) + 1 AS INTEGER) AS dayofweek, "
        f"CAST(day({ts}) AS INTEGER) AS dayofmonth, CAST(month({ts}) AS INTEGER) AS month, CAST(year({ts}) AS INTEGER) AS year"
    )


def _is_train(key: str) -> str:
    return f"md5({key}) < 'cccccccd'"  # four fifths of all digests


_KEY = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
_FEATURES = ["hour", "dayofweek", "dayofmonth", "month", "year", "circulating_supply"]

_PRICED = f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, price_usd AS y, {_calendar("moment")}, circulating_supply, is_train
    FROM (SELECT *, l_shipdate + to_hours(CAST(l_suppkey % 24 AS INTEGER)) AS moment, l_extendedprice AS price_usd,
                 l_quantity AS circulating_supply, {_is_train(_KEY)} AS is_train
          FROM lineitem)"""


def _least_squares(base: str, features: list[str]) -> str:
    """Least squares by removing one feature after the other from the rest.

    After the last step ``y`` is the residual of every row; ``f<k>`` holds the slopes of
    step k, from which the coefficients follow backwards.
    """
    n = len(features)
    centred = ", ".join(f"{x} - avg({x}) FILTER (WHERE is_train) OVER () AS x{i}" for i, x in enumerate(features))
    keep = "l.* EXCLUDE (y, " + ", ".join(f"x{i}" for i in range(n)) + ")"
    steps = [
        f"base AS MATERIALIZED ({base})",
        f"l0 AS MATERIALIZED (SELECT * EXCLUDE (y), y AS actual, y - avg(y) FILTER (WHERE is_train) OVER () AS y, {centred} FROM base)",
    ]
    for k in range(n):
        later = range(k + 1, n)
        norm = f"sum(x{k} * x{k}) FILTER (WHERE is_train)"
        slopes = [f"sum(x{k} * y) FILTER (WHERE is_train) / {norm} AS g{k}"]
        slopes += [f"sum(x{k} * x{j}) FILTER (WHERE is_train) / {norm} AS r{k}_{j}" for j in later]
        steps.append(f"f{k} AS MATERIALIZED (SELECT {', '.join(slopes)} FROM l{k})")
        moved = [f"y - g{k} * x{k} AS y"] + [f"x{j} - r{k}_{j} * x{k} AS x{j}" for j in later]
        moved += [f"x{j}" for j in range(k + 1)]
        steps.append(f"l{k + 1} AS MATERIALIZED (SELECT {keep}, {', '.join(moved)} FROM l{k} l CROSS JOIN f{k})")
    return "WITH " + ",\n".join(steps)


def _coefficients(features: list[str]) -> str:
    n = len(features)
    slopes = " CROSS JOIN ".join(f"f{k}" for k in range(n))
    steps, source = [], slopes
    for k in reversed(range(n)):
        value = f"g{k}" + "".join(f" - r{k}_{j} * b{j}" for j in range(k + 1, n))
        steps.append(f"c{k} AS (SELECT *, {value} AS b{k} FROM {source})")
        source = f"c{k}"
    means = ", ".join(f"avg({x}) AS m{i}" for i, x in enumerate(features))
    steps.append(f"means AS (SELECT avg(y) AS my, {means} FROM base WHERE is_train)")
    intercept = "my" + "".join(f" - b{i} * m{i}" for i in range(n))
    rows = [f"SELECT 'intercept' AS feature, round({intercept}, 3) AS coefficient FROM c0 CROSS JOIN means"]
    rows += [f"SELECT '{x}', round(b{i}, 3) FROM c0" for i, x in enumerate(features)]
    return ", " + ",\n".join(steps) + "\n" + " UNION ALL ".join(rows)


_FITTED = _least_squares(_PRICED, _FEATURES)
_RMSE = "sqrt(avg(y * y) FILTER (WHERE NOT is_train))"

_REGRESSION = {
    "feat_calendar": f"SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, value, {_calendar('ts')} FROM events",
    "lr_split": f"""
        SELECT l_returnflag, is_train, count(*) AS n
        FROM (SELECT l_returnflag, {_is_train(_KEY)} AS is_train FROM lineitem) GROUP BY l_returnflag, is_train""",
    "lr_coefficients": _FITTED + _coefficients(_FEATURES),
    "lr_predictions": f"""{_FITTED}
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, actual AS price_usd, round(actual - y, 1) AS prediction
        FROM l6 WHERE NOT is_train""",
    "lr_rmse": f"{_FITTED} SELECT round({_RMSE}, 4) AS rmse FROM l6",
    "lr_metric_append": f"""{_FITTED}
        SELECT created_date, rmse FROM (SELECT round({_RMSE}, 4) AS rmse FROM l6)
        CROSS JOIN (VALUES ({_AS_OF}), ({_EARLIER})) v(created_date)""",
}

# -- protection -----------------------------------------------------------------

_PROTECTION = {
    "protect_roundtrip": "SELECT c_custkey, c_name, c_acctbal, FALSE AS readable FROM customer",
    "protect_fixed_iv_roundtrip": """
        SELECT doc_id, (strlen(text) // 16 + 1) * 32 AS hex_length, text FROM documents""",
    "protect_map_roundtrip": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
}

# -- end to end -----------------------------------------------------------------

_EVENT_COLUMNS = "event_id, event_time, event_day, user_id, event_type, value, props"


def _events(value: str, where: str) -> str:
    return f"""SELECT event_id, ts AS event_time, CAST(ts AS DATE) AS event_day, user_id, event_type, {value} AS value, props
               FROM events WHERE {where}"""


_FIRST = f"ts < {_EARLIER}"
_PULLED = f"ts >= (SELECT max(ts) FROM events WHERE {_FIRST}) AND ts < {_AS_OF}"

_TEXT_TIME = """
    CASE WHEN event_id % 50 = 0 THEN 'week ' || dayofyear(ts) ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END"""

_CHANGED_EVENTS = _merge(
    _events("value", _FIRST), _events("value + 1", "ts >= TIMESTAMP '2024-01-17'"), "event_id", _EVENT_COLUMNS
)

_AUDIT_TRAIL = f"""
    WITH c AS (SELECT count(*) FILTER (WHERE {_FIRST}) AS a, count(*) FILTER (WHERE ts < {_AS_OF}) AS b FROM events),
    d AS (SELECT *, CAST(a AS DOUBLE) AS d1, CAST(b - a AS DOUBLE) AS d2 FROM c)
    SELECT 1::BIGINT AS action_id, 1::BIGINT AS audit_id, 'tester' AS executed_by, 1::BIGINT AS execution_status,
           TIMESTAMP '2024-01-20 01:00:00' AS execution_start_datetime, TIMESTAMP '2024-01-20 01:02:30' AS execution_end_datetime,
           2::BIGINT AS execution_duration, 0::BIGINT AS record_cnt_before, a AS record_cnt_after, d1 AS delta,
           d1 AS delta_avg, 0.0::DOUBLE AS delta_variance, 0.0::DOUBLE AS delta_std_deviation FROM d
    UNION ALL
    SELECT 2, 2, 'tester', 1, TIMESTAMP '2024-02-01 01:00:00', TIMESTAMP '2024-02-01 01:01:30', 2, a, b, d2,
           (d1 + d2) / 2, (d1 - d2) * (d1 - d2) / 4, (d1 - d2) * (d1 - d2) / 2 FROM d"""

_END_TO_END = {
    "ingest_incremental": _merge(_events("value", _FIRST), _events("value + 1", _PULLED), "event_id", _EVENT_COLUMNS),
    "ingest_audit_trail": _AUDIT_TRAIL,
    # Packing the history changes no row of it.
    "ingest_compacted_history": _AUDIT_TRAIL,
    "ingest_named_files": f"SELECT *, {_stamped(_AS_OF)} FROM orders",
    "ingest_multi_table": _least_squares(
        f"""SELECT y, {_calendar("moment")}, o_custkey, is_train FROM (
                SELECT o_totalprice AS y, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS moment, o_custkey,
                       {_is_train("CAST(o_orderkey AS VARCHAR)")} AS is_train FROM orders)""",
        ["hour", "dayofweek", "dayofmonth", "month", "year", "o_custkey"],
    )
    + "".join(
        f"""
        SELECT '{t}' AS table_name, 0::BIGINT AS record_cnt_before, count(*) AS record_cnt_after, CAST(count(*) AS DOUBLE) AS delta,
               CAST(NULL AS DOUBLE) AS rmse FROM {t} UNION ALL"""
        for t in ("customer", "orders", "part")
    )
    + f" SELECT 'regression', NULL, NULL, NULL, round({_RMSE}, 3) FROM l6",
    "ingest_dependent": _least_squares(
        f"""SELECT y, {_calendar("moment")}, o_custkey, is_train FROM (
                SELECT o_totalprice AS y, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS moment, o_custkey,
                       {_is_train("CAST(o_orderkey AS VARCHAR)")} AS is_train FROM orders)""",
        ["hour", "dayofweek", "dayofmonth", "month", "year", "o_custkey"],
    )
    + "".join(
        f"""
        SELECT '{t}' AS table_name, 'done' AS outcome, CAST(NULL AS DOUBLE) AS rmse, 1::BIGINT AS execution_status,
               count(*) AS record_cnt_after FROM {t} UNION ALL"""
        for t in ("customer", "orders", "supplier")
    )
    + f"""
        SELECT 'part', 'failed', NULL, -1, NULL UNION ALL SELECT 'lineitem', 'skipped', NULL, NULL, NULL
        UNION ALL SELECT 'nation', 'skipped', NULL, NULL, NULL
        UNION ALL SELECT 'regression', 'done', round({_RMSE}, 3), NULL, NULL FROM l6""",
    "ingest_text_watermark": _merge(
        f"SELECT event_id, {_TEXT_TIME} AS changed, value FROM events WHERE {_FIRST}",
        f"""SELECT event_id, {_TEXT_TIME} AS changed, value + 1 AS value FROM events
            WHERE event_id % 50 = 0 OR (ts < {_AS_OF}
              AND date_trunc('second', ts) >= (SELECT max(date_trunc('second', ts)) FROM events WHERE {_FIRST} AND event_id % 50 <> 0))""",
        "event_id",
        "event_id, changed, value",
    ),
    "ingest_hourly_series": f"""
        SELECT event_type, bucket, observed_at, observed_id, value, observations FROM (
            SELECT event_type, date_trunc('hour', ts) AS bucket, ts AS observed_at, event_id AS observed_id, value,
                   count(*) OVER (PARTITION BY event_type, date_trunc('hour', ts)) AS observations,
                   row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
            FROM events WHERE ts < {_AS_OF})
        WHERE rn = 1""",
    "load_merge_series": _CHANGED_EVENTS,
    "stream_available_now": _CHANGED_EVENTS,
}


def oracle_sql() -> dict[str, str]:
    return {
        **_SOURCES, **_EXTRACTION, **_METADATA, **_STAGING, **_LOADS, **_AUDIT, **_SINKS, **_REGRESSION,
        **_PROTECTION, **_END_TO_END,
    }
