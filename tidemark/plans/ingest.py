"""The ingestion plan: window, land, stage, load, audit - and the regression on top."""

from __future__ import annotations

import os
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field, fields
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.functions.scalar import epoch_ms
from tidemark.functions.sizes import broadcast_if_small
from tidemark.functions.types import struct_of
from tidemark.operators import audit as A, extract as X, load as L, metadata as M, regression as R
from tidemark.operators.staging import projection, stage
from tidemark.sources import files
from tidemark.sources.snapshots import SnapshotTable

REQUEST = "REQUEST"
CHANGES = struct_of(
    "action_id bigint, seq bigint, execution_end_datetime timestamp_ntz, execution_status bigint"
)
Source = DataFrame | Callable[..., DataFrame]
#: Tables of a wave that are loaded at the same time.
PARALLEL = 8
#: Waves after which the run history is packed into few files.
COMPACT_AFTER = 200
#: Audit rows lie in a folder per table.
AUDIT_FOLDERS = ("database_schema", "table_name")


@dataclass(frozen=True)
class TableConfig:
    """The part of a configuration row that a load uses."""

    connection_name: str
    database_schema: str
    table_name: str
    load_type: str
    ingestion_type: str = REQUEST
    project_id: str | None = None
    primary_key_column: str | None = None
    incremental_date_column: str | None = None
    partitioned_by: str | None = None
    file_format: str | None = "PARQUET"
    header: str | None = None
    delimiter: str | None = None
    quote_characters: str | None = None
    escape_characters: str | None = None
    accepted_encoding: str | None = None
    extra_parameters: str | None = None
    to_parquet: bool | None = None
    bucket: str | None = None
    bucket_destination: str | None = None
    archive_destination: str | None = None

    @classmethod
    def from_row(cls, row: Row) -> TableConfig:
        """From a row of the configuration table or of the connection lookup."""
        have = row.asDict()
        return cls(**{f.name: have[f.name] for f in fields(cls) if f.name in have})

    @property
    def path(self) -> str:
        return f"{self.database_schema.lower()}/{self.table_name.lower()}"

    def place(self, root: str, destination: str | None, otherwise: str) -> str:
        """Where the configured destination lies: in the bucket, or below ``root`` without one."""
        if not destination:
            return f"{root}/{otherwise}/{self.path}"
        parts = [(self.bucket or root).rstrip("/"), destination.strip("/"), self.table_name.lower()]
        return "/".join(p for p in parts if p)

    def file_source(self, spark: SparkSession, uri: str, columns: Sequence[str] | None = None) -> DataFrame:
        """The configured file as a DataFrame."""
        options: dict[str, Any] = {}
        if (self.file_format or "").upper() in files.SEPARATORS:
            given = {
                "header": self.header,
                "sep": self.delimiter,
                "quote": self.quote_characters,
                "escape": self.escape_characters,
            }
            options = {k: v for k, v in given.items() if v is not None}
        return files.read_landing(spark, uri, self.file_format or "PARQUET", columns, **options)


@dataclass(frozen=True)
class Series:
    """How raw observations become the buckets of a table: its last value per ``keys`` and interval.

    The names are target columns. ``tie_break`` decides between observations of one time. The
    interval comes from the configuration (``extra_parameters``).
    """

    keys: tuple[str, ...]
    time: str
    value: str
    tie_break: str


@dataclass(frozen=True)
class IngestResult:
    action_id: int
    action: str
    version: int
    record_cnt_before: int
    record_cnt_after: int


class Warehouse:
    """Folders of landing files, published tables and the run history below one root.

    One driver writes the history of a warehouse; ids are given out by it. Every wave of loads
    appends small files to the history; after ``compact_after`` waves it is packed anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        clock: Callable[[], datetime] | None = None,
        user: str | None = None,
        compact_after: int = COMPACT_AFTER,
    ):
        self.spark, self.root, self.compact_after = spark, root.rstrip("/"), compact_after
        self.clock = clock or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))
        self.user = user or os.environ.get("USER", "unknown")
        self._last_ids: dict[str, int] = {}

    def table(self, config: TableConfig) -> SnapshotTable:
        return SnapshotTable(
            self.spark,
            f"{self.root}/ref/{config.path}",
            config.partitioned_by.lower() if config.partitioned_by else None,
            config.accepted_encoding,
        )

    def landing(self, config: TableConfig) -> str:
        return config.place(self.root, config.bucket_destination, "landing")

    def archive(self, config: TableConfig) -> str:
        return config.place(self.root, config.archive_destination, "archive")

    def _generation(self) -> int:
        """The number of the history's packings so far; only names are listed."""
        return max(map(int, files.names_in(self.spark, f"{self.root}/history-generations")), default=0)

    def _history_path(self, name: str, generation: int | None = None) -> str:
        number = self._generation() if generation is None else generation
        return f"{self.root}/history{f'-{number}' if number else ''}/{name}"

    def _history(self, name: str, schema: T.StructType) -> DataFrame:
        found = files.read_if_present(self.spark, self._history_path(name), schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def _append(self, name: str, schema: T.StructType, rows: list[tuple] | DataFrame, partition_by: Sequence[str] = ()) -> None:
        df = rows if isinstance(rows, DataFrame) else files.few_rows(self.spark, schema, rows)
        files.write_table(df.coalesce(1), self._history_path(name), schema, "append", partition_by)

    def compact_history(self) -> int:
        """Pack the history into files of useful size; returns the number of this packing.

        Every row stays: actions take over their last change, so the log of changes begins
        anew, and audit rows lie together per table. The packed files go to folders of their own,
        which count once the number is noted; before that, readers see the earlier ones, and
        what a failed attempt left there is replaced by the next one.
        """
        number = self._generation() + 1
        for name, schema, rows, by in (
            ("actions", M.ACTION_HISTORY, self.actions(), ()),
            ("audit", M.AUDIT_DETAILS, self.audit(), AUDIT_FOLDERS),
        ):
            packed = rows.hint("rebalance", *by)
            files.write_table(packed, self._history_path(name, number), schema, "replace", by)
        files.mark(self.spark, f"{self.root}/history-generations/{number}")
        return number

    def _due(self) -> bool:
        """Whether as many waves as allowed have ended since the last packing: one file each."""
        names = files.names_in(self.spark, self._history_path("changes"))
        return sum(n.endswith(".parquet") for n in names) >= self.compact_after

    def _next_ids(self, history: DataFrame, column: str, n: int) -> list[int]:
        """The next ids; the history is asked once, then this writer counts on."""
        if column not in self._last_ids:
            self._last_ids[column] = X.watermark(history, column) or 0
        first = self._last_ids[column] + 1
        self._last_ids[column] += n
        return list(range(first, first + n))

    def actions(self) -> DataFrame:
        """The action history with the current status of every action."""
        return A.current_actions(
            self._history("actions", M.ACTION_HISTORY), self._history("changes", CHANGES)
        )

    def audit(self) -> DataFrame:
        """The audit rows, one per finished run."""
        return self._history("audit", M.AUDIT_DETAILS).select(*M.AUDIT_DETAILS.fieldNames())

    def open_actions(self, configs: Sequence[TableConfig]) -> list[Run]:
        """Note the start of several loads, in one append."""
        ids = self._next_ids(self._history("actions", M.ACTION_HISTORY), "action_id", len(configs))
        runs = [Run(config, action_id, self.clock()) for config, action_id in zip(configs, ids)]
        self._append(
            "actions",
            M.ACTION_HISTORY,
            [
                (r.action_id, r.config.connection_name, r.config.database_schema, r.config.table_name, self.user, r.started, None, A.IN_PROGRESS)
                for r in runs
            ],
        )
        return runs

    def close_actions(self, runs: Sequence[Run]) -> None:
        """Note the ends of several loads, in one append each for their status and audit rows."""
        self._append("changes", CHANGES, [(r.action_id, 1, r.ended, r.status) for r in runs])
        counted = [r for r in runs if r.before is not None]
        if counted:
            self._close_audits(counted)
        if self._due():
            try:
                self.compact_history()
            except Exception as problem:
                # The loads and their notes are complete without it; the next wave tries again.
                warnings.warn(f"the run history was not packed: {problem}", stacklevel=2)

    def _close_audits(self, runs: Sequence[Run]) -> None:
        """Append audit rows with the statistics that include them.

        The rows lie in one folder per table, so only those of these tables are read, and of
        them the newest of every table.
        """
        history = self.audit()
        ids = self._next_ids(history, "audit_id", len(runs))
        rows = [
            (
                audit_id, r.action_id, r.config.connection_name, r.config.database_schema, r.config.table_name,
                r.started, r.ended, None, r.before, r.after, r.delta, None, None, None,
            )
            for audit_id, r in zip(ids, runs)
        ]
        own = files.few_rows(self.spark, M.AUDIT_DETAILS, rows)
        table = list(AUDIT_FOLDERS)
        mine = history.filter(
            F.col(table[0]).isin([r.config.database_schema for r in runs]) & F.col(table[1]).isin([r.config.table_name for r in runs])
        )
        stats = A.latest_stats(mine.select(*table, "audit_id", "delta").unionByName(own.select(*table, "audit_id", "delta")))
        computed = ("delta_avg", "delta_variance", "delta_std_deviation")
        minutes = A.duration_minutes(F.col("execution_start_datetime"), F.col("execution_end_datetime"))
        # As many rows as tables in this append.
        full = own.drop(*computed).join(F.broadcast(stats.select(*table, *computed)), table).withColumn("execution_duration", minutes)
        self._append("audit", M.AUDIT_DETAILS, full, table)


@dataclass
class Run:
    """One load of one table, from its action row to its audit row."""

    config: TableConfig
    action_id: int
    started: datetime
    ended: datetime | None = None
    status: int = A.IN_PROGRESS
    before: int | None = None
    after: int | None = None

    @property
    def delta(self) -> float | None:
        return None if self.before is None or self.after is None else float(self.after - self.before)


@dataclass(frozen=True)
class Pull:
    """The window of a pull: ``start <= value < end``, in the terms of the source."""

    spec: M.ColumnSpec
    start: Any
    end: Any

    def value(self, df: DataFrame) -> Column:
        """What the bounds are compared with."""
        staged = projection(df, [self.spec])[0]
        return epoch_ms(staged) if isinstance(self.spec.type, T.StringType) else staged


def resolve_window(
    table: SnapshotTable,
    config: TableConfig,
    specs: Sequence[M.ColumnSpec],
    action: str,
    as_of: datetime,
    series: Series | None = None,
) -> Pull | None:
    """Column, start and end of the pull; None when the source is not windowed.

    Bounds are moments for a time column and epoch milliseconds for a number. The ISO text
    of a text column is read as epoch milliseconds as well; other text is no watermark. A
    series starts at the beginning of its newest bucket, which is then counted anew.
    """
    if config.ingestion_type != REQUEST or not config.incremental_date_column:
        return None
    target = config.incremental_date_column.lower()
    spec = next((s for s in specs if s.target == target), None)
    if spec is None:
        raise ValueError(f"incremental column {target!r} is not in the column metadata")
    as_epoch = not isinstance(spec.type, (T.TimestampNTZType, T.DateType))

    def point(moment: datetime) -> Any:
        return int(moment.replace(tzinfo=timezone.utc).timestamp() * 1000) if as_epoch else moment

    start = None
    if action == "merge" and series is not None:
        start = table.watermark("bucket")
    elif action == "merge" and isinstance(spec.type, T.StringType):
        start = table.read().agg(F.max(epoch_ms(F.col(target)))).first()[0]
    elif action == "merge":
        start = table.watermark(target)
    if start is None:
        start = point(as_of - timedelta(days=X.LOOK_BACK_DAYS))
    return Pull(spec, start, point(as_of))


def load_reference(
    table: SnapshotTable,
    staged: DataFrame,
    action: str,
    load_ts: datetime,
    keys: str | Sequence[str] | None = None,
    watermark: str | None = None,
    tag: str | None = None,
    combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    **merge_options: Any,
) -> int:
    """Publish the next version of a reference table.

    A merge finds its keys wherever they lie, also in another partition than the source
    names, and writes the files that hold them anew; all others stay in place. A row whose
    partition value changes moves. The rows it inserts go to a folder of their own, so a
    series that grows at its end rewrites no more than the end of its last load.

    ``combine`` makes the rows to merge from the published rows with the source's keys and the
    source, for tables that hold states.
    """
    if action in ("create", "full_refresh"):
        return table.publish(L.full_refresh(staged, load_ts), watermark=watermark, tag=tag)
    keys = [keys] if isinstance(keys, str) else list(keys)
    touched, matched = table.holding(staged, keys)
    held = table.read(folders=touched)
    if combine is not None:
        known, _ = broadcast_if_small(matched)
        staged = combine(held.join(known, keys, "left_semi"), staged)
    kept, inserted = L.merge_parts(held, staged, keys, load_ts, matched=matched, **merge_options)
    if table.partitioned_by:
        frames = [kept.unionByName(inserted) if touched else inserted]
    else:
        frames = [kept, inserted] if touched else [inserted]
    return table.publish(*frames, replace=touched, watermark=watermark, tag=tag)


def _load(
    warehouse: Warehouse,
    run: Run,
    specs: Sequence[M.ColumnSpec],
    source: Source,
    as_of: datetime,
    load_type_override: str | None = None,
    series: Series | None = None,
    **merge_options: Any,
) -> IngestResult:
    """The work of one load between its two notes in the history."""
    spark, config = warehouse.spark, run.config
    table = warehouse.table(config)
    specs = M.check_specs(specs)
    key = config.primary_key_column.lower() if config.primary_key_column else None
    action = L.route(table.exists(), config.load_type, key, load_type_override)
    window = resolve_window(table, config, specs, action, as_of, series)
    start, end = (None, None) if window is None else (window.start, window.end)
    if callable(source):
        # A source that is asked for an interval resamples by itself.
        asked = {} if series is not None or not config.extra_parameters else {"interval": config.extra_parameters}
        pulled = source(start, end, **asked)
    elif window is None:
        pulled = source
    else:
        pulled = X.incremental(source, window.value(source), start, end, keep_null=True)

    if config.to_parquet is not False:
        landing = warehouse.landing(config)
        files.archive_landing(spark, landing, warehouse.archive(config), f"{as_of:%Y%m%d%H%M%S}-{run.action_id}")
        files.write_parquet(pulled, landing, config.accepted_encoding, mode="overwrite")
        pulled = spark.read.schema(pulled.schema).parquet(landing)
    staged = stage(pulled, specs, as_of)

    run.before = table.row_count()
    mark = config.incremental_date_column.lower() if config.incremental_date_column else None
    if series is not None:
        width = X.interval_width(config.extra_parameters)
        staged = X.observed(staged, series.keys, series.time, series.value, series.tie_break, width)
        key, mark = [*series.keys, "bucket"], "bucket"
        if window is None:
            # Late observations join what is published; a window holds its buckets whole.
            merge_options["combine"] = lambda held, new: X.joined_states(held, new, series.keys, series.value)
    version = load_reference(table, staged, action, as_of, key, mark, **merge_options)
    run.after = table.row_count()
    return IngestResult(run.action_id, action, version, run.before, run.after)


def ingest(
    warehouse: Warehouse,
    config: TableConfig,
    specs: Sequence[M.ColumnSpec],
    source: Source,
    as_of: datetime | None = None,
    load_type_override: str | None = None,
    **options: Any,
) -> IngestResult:
    """One run for one table. A failure leaves status -1 and is raised again.

    ``source`` is a DataFrame, or a function of the window (start, end) that gives
    one; a DataFrame is filtered to the window when the configuration has one. A function
    also gets ``interval`` where the configuration has ``extra_parameters``. With ``series``
    (:class:`Series`) the load resamples to that interval itself.
    """
    as_of = as_of or warehouse.clock()
    load = Load(config, specs, source, options={"load_type_override": load_type_override, **options})
    result = _wave(warehouse, [load], as_of, 1, False)[load.name]
    if isinstance(result, BaseException):
        raise result
    return result


class Skipped(Exception):
    """A step that did not run, as one it depends on failed."""


@dataclass(frozen=True)
class Load:
    """A table to load; ``after`` names the steps that must have succeeded before."""

    config: TableConfig
    specs: Sequence[M.ColumnSpec]
    source: Source
    after: tuple[str, ...] = ()
    options: Mapping[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.config.path


@dataclass(frozen=True)
class Step:
    """Any other work of a dependent run, such as a fit over a loaded table."""

    name: str
    run: Callable[[], Any]
    after: tuple[str, ...] = ()


def waves(steps: Sequence[Load | Step]) -> list[list[Load | Step]]:
    """The steps in order of their dependencies; those of a wave need nothing of each other."""
    names = [s.name for s in steps]
    if len(set(names)) < len(names):
        raise ValueError("two steps have one name")
    unknown = {a for s in steps for a in s.after} - set(names)
    if unknown:
        raise ValueError(f"steps after unknown ones: {', '.join(sorted(unknown))}")
    out: list[list[Load | Step]] = []
    left, done = list(steps), set()
    while left:
        ready = [s for s in left if done.issuperset(s.after)]
        if not ready:
            raise ValueError(f"steps wait for each other: {', '.join(sorted(s.name for s in left))}")
        out.append(ready)
        done.update(s.name for s in ready)
        left = [s for s in left if s.name not in done]
    return out


def run_dependent(
    warehouse: Warehouse,
    steps: Sequence[Load | Step],
    as_of: datetime | None = None,
    parallel: int = PARALLEL,
    stop_on_failure: bool = False,
) -> dict[str, Any]:
    """Run loads and other steps, each after those it depends on.

    The steps of a wave run at the same time, each in a scheduler pool of its own (shared out
    evenly where the session's scheduler mode is FAIR). The history gets one append per wave
    for starts and one for ends. A step that fails leaves its exception in the result, and only
    what depends on it is skipped (:class:`Skipped`). ``stop_on_failure`` also cancels the jobs
    of the other steps of its wave, by their job tags, and skips all later ones; so does an
    interruption of the driver.
    """
    as_of = as_of or warehouse.clock()
    results: dict[str, Any] = {}
    for wave in waves(steps):
        for step in wave:
            lost = [a for a in step.after if isinstance(results[a], BaseException)]
            if not lost and stop_on_failure:
                lost = [n for n, r in results.items() if isinstance(r, BaseException)]
            if lost:
                results[step.name] = Skipped(f"{step.name}: {', '.join(lost)} failed or did not run")
        results.update(_wave(warehouse, [s for s in wave if s.name not in results], as_of, parallel, stop_on_failure))
    return results


def _wave(
    warehouse: Warehouse, steps: Sequence[Load | Step], as_of: datetime, parallel: int, stop_on_failure: bool
) -> dict[str, Any]:
    """Run steps that need nothing of each other; results and exceptions by name."""
    context = warehouse.spark.sparkContext
    loads = [s for s in steps if isinstance(s, Load)]
    runs = dict(zip((s.name for s in loads), warehouse.open_actions([s.config for s in loads]) if loads else []))
    tags = {s.name: f"tidemark-{uuid.uuid4().hex}" for s in steps}

    def work(step: Load | Step) -> Any:
        # Pools and tags belong to the thread that submits the jobs.
        context.setLocalProperty("spark.scheduler.pool", step.name)
        context.addJobTag(tags[step.name])
        try:
            if isinstance(step, Step):
                return step.run()
            return _load(warehouse, runs[step.name], step.specs, step.source, as_of, **step.options)
        finally:
            context.removeJobTag(tags[step.name])
            context.setLocalProperty("spark.scheduler.pool", None)

    results: dict[str, Any] = {}

    def note(name: str, future: Future) -> None:
        problem = future.exception()
        results[name] = future.result() if problem is None else problem
        if name in runs:
            runs[name].ended = warehouse.clock()
            runs[name].status = A.COMPLETE if problem is None else A.FAILED
        if problem is not None and stop_on_failure:
            for other, tag in tags.items():
                if other not in results:
                    context.cancelJobsWithTag(tag)

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(steps)))) as pool:
        futures = {pool.submit(work, s): s.name for s in steps}
        try:
            for future in as_completed(futures):
                note(futures[future], future)
        except BaseException:
            for future in futures:
                future.cancel()
            for tag in tags.values():
                context.cancelJobsWithTag(tag)
            raise
    if runs:
        warehouse.close_actions(list(runs.values()))
    return results


def find_table(
    connections: DataFrame,
    configs: DataFrame,
    details: DataFrame,
    connection_name: str,
    table_name: str,
    section: str | None = None,
) -> tuple[TableConfig, list[M.ColumnSpec], str]:
    """Configuration, column specs and source URI of one table from the metadata tables.

    ``section`` is the kind of source the caller means to load; another kind in the
    configuration is an error.
    """
    found = M.connection_details(
        M.lookup(connections, connection_name=connection_name),
        M.lookup(configs, connection_name=connection_name, table_name=table_name),
        from_config=(*M.FROM_CONFIG, "partitioned_by"),
    ).take(2)
    if len(found) != 1:
        problem = "no" if not found else "more than one"
        raise ValueError(f"{problem} configuration for {connection_name}.{table_name}")
    row = found[0]
    if section is not None and row["ingestion_type"] != section:
        raise ValueError(f"{table_name} is configured as {row['ingestion_type']}, not {section}")
    specs = M.compile_columns(details, **{k: row[k] for k in M.TABLE_KEY})
    return TableConfig.from_row(row), specs, f"{row['connection_url'].rstrip('/')}/{row['source_schema_table_name']}"


def ingest_named(
    warehouse: Warehouse,
    metadata: tuple[DataFrame, DataFrame, DataFrame],
    connection_name: str,
    table_name: str,
    source: Source | None = None,
    section: str | None = None,
    as_of: datetime | None = None,
    load_type_override: str | None = None,
    **merge_options: Any,
) -> IngestResult:
    """Load a table by its name: everything else comes from the metadata tables
    (connections, configurations, column details).

    Without ``source`` the files at the configured URI are read: landed API responses
    for a REQUEST, files of the configured format otherwise.
    """
    config, specs, uri = find_table(*metadata, connection_name, table_name, section)
    if source is None:
        if config.ingestion_type == REQUEST:
            source = files.read_json_response(warehouse.spark, uri, list(dict.fromkeys(s.source for s in specs)))
        else:
            source = config.file_source(warehouse.spark, uri)
    return ingest(warehouse, config, specs, source, as_of, load_type_override, **merge_options)


def ingest_many(
    warehouse: Warehouse,
    jobs: Sequence[tuple[TableConfig, Sequence[M.ColumnSpec], Source]],
    as_of: datetime | None = None,
    parallel: int = PARALLEL,
    **options: Any,
) -> dict[str, IngestResult | Exception]:
    """Load several tables side by side; a failed one does not stop the rest."""
    return run_dependent(warehouse, [Load(*job, options=options) for job in jobs], as_of, parallel)


def fit_and_score(
    df: DataFrame,
    epoch: str,
    label: str,
    extra: Sequence[str],
    key: Column,
    as_of: datetime,
    per_second: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """``(predictions on the test side, metric row)`` of the regression job."""
    features = R.feature_columns(*extra)
    data = R.split(R.calendar_features(df, epoch, per_second), key)
    model = R.fit(data.filter("is_train"), label, features)
    predictions = R.predict(model, data.filter("NOT is_train"), features)
    return predictions, R.metric_row(R.rmse(predictions, label), as_of)
