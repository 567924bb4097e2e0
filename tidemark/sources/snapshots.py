"""Published tables: Parquet folders plus one small list per version.

A version is published by writing its list, after its data. Readers see the previous
version or the new one, never a half. An entry of the list is a folder, which is a partition
of one load or for an unpartitioned table the whole load, or it is one file that a merge left in
place when it wrote others of its folder anew. A version writes what changed and lists
the rest where it already is, so an upsert costs the files it touches. The list also
carries row counts and the highest watermark, which makes both a metadata read, and in its
first line the schema and the last batch of every stream (the ledger).

One writer per table. A writer that dies leaves files that no list names.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.functions.scalar import ts_lit
from tidemark.functions.sizes import BROADCAST_BYTES, broadcast_if_small
from tidemark.session import scratch

_LOAD = "tidemark_load"
_ENTRY = (
    "path string, part string, row_count bigint, watermark_column string, watermark string, "
    "schema string, ledger map<string,bigint>"
)
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_PARSE = {
    T.LongType: int,
    T.DoubleType: float,
    T.TimestampNTZType: datetime.fromisoformat,
    T.DateType: date.fromisoformat,
}
_PART_TYPES = (T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _place() -> Column:
    """Where a row's file lies below ``data``, as an entry names it."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"({_LOAD}=[^/]+/.+)$", 1)


def _bound(value: Any) -> Column:
    return ts_lit(value) if isinstance(value, datetime) else F.lit(value)


@dataclass(frozen=True)
class Version:
    number: int
    head: Row
    entries: list[Row]

    @classmethod
    def of(cls, number: int, rows: list[Row]) -> Version:
        return cls(number, next(r for r in rows if r["schema"]), [r for r in rows if r["path"]])

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.head["schema"]))

    @property
    def folders(self) -> list[str]:
        return [e["path"] for e in self.entries]

    @property
    def row_count(self) -> int:
        return sum(e["row_count"] for e in self.entries)

    @property
    def ledger(self) -> dict[str, int]:
        """The last batch that each stream has published, by its checkpoint."""
        return dict(self.head["ledger"] or {})

    def has_batch(self, tag: str) -> bool:
        """Whether the batch ``checkpoint#number`` is part of this or an earlier version."""
        stream, number = tag.rsplit("#", 1)
        return self.ledger.get(stream, -1) >= int(number)


class SnapshotTable:
    """A versioned table below ``root``, optionally partitioned by a date or whole number."""

    def __init__(self, spark: SparkSession, root: str, partitioned_by: str | None = None, codec: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.partitioned_by, self.codec = partitioned_by, codec
        self._known: Version | None = None

    # -- versions ---------------------------------------------------------------

    def latest(self) -> int | None:
        """Number of the published version; only names are listed."""
        try:
            listed = self.spark.read.format("binaryFile").load(f"{self.root}/versions")
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        if "v" not in listed.columns:
            return None
        return listed.agg(F.max("v").alias("v")).first()["v"]

    def exists(self) -> bool:
        return self.version() is not None

    def refresh(self) -> None:
        """Forget the version seen so far, so that the next use looks again."""
        self._known = None

    def version(self, number: int | None = None) -> Version | None:
        """A version's list. Without a number it is the one current at the first use of
        this object, or the one it published since."""
        if number is None:
            if self._known is None:
                latest = self.latest()
                self._known = None if latest is None else self.version(latest)
            return self._known
        # One entry per partition of the table.
        rows = self.spark.read.schema(_ENTRY).json(f"{self.root}/versions/v={number}").collect()
        return Version.of(number, rows)

    def row_count(self) -> int:
        """Rows of the published version, from its list."""
        version = self.version()
        return 0 if version is None else version.row_count

    def watermark(self, column: str):
        """Highest value of a column: from the list where it was noted for every folder,
        else from the rows."""
        version = self.version()
        if version is None:
            return None
        parse = _PARSE.get(type(version.schema[column].dataType))
        if parse is None or any(e["watermark_column"] != column for e in version.entries):
            return self.read().agg(F.max(column)).first()[0]
        return max((parse(e["watermark"]) for e in version.entries if e["watermark"] is not None), default=None)

    # -- reading ----------------------------------------------------------------

    def read(self, number: int | None = None, folders: Iterable[str] | None = None) -> DataFrame:
        """A version's rows, or those of some of its folders and files."""
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"nothing published at {self.root}")
        return self._open(version, folders).select(*version.schema.fieldNames())

    def _open(self, version: Version, folders: Iterable[str] | None = None) -> DataFrame:
        """The rows with the name of their load."""
        paths = version.folders if folders is None else sorted(set(folders))
        schema = T.StructType([*version.schema.fields, T.StructField(_LOAD, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (
            self.spark.read.schema(schema)
            .option("basePath", f"{self.root}/data")
            .parquet(*[f"{self.root}/data/{p}" for p in paths])
        )

    def touched_by(self, source: DataFrame, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> list[str]:
        """The current files that hold a key of the source, wherever they lie."""
        return self.holding(source, keys, broadcast_bytes)[0]

    def holding(
        self, source: DataFrame, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
    ) -> tuple[list[str], DataFrame]:
        """``(files with a key of the source, the keys found)``.

        One scan of the key columns answers both: which files a merge writes anew and which rows
        of the source are new. The range of the source's keys is pushed to that scan, so row
        groups out of reach are not read. What is found is written, as both answers use it.
        """
        version = self.version()
        low, high = self._key_range(source, keys)
        reach = self._within_reach(version, keys, low)
        if not reach:
            return [], self.spark.createDataFrame([], T.StructType([version.schema[k] for k in keys]))
        held = self._open(version, reach).select(*keys, _place().alias("_place"))
        if low is not None:
            held = held.filter(F.col(keys[0]).between(_bound(low), _bound(high)))
        wanted, _ = broadcast_if_small(source.select(*keys).dropna().distinct(), broadcast_bytes)
        path = scratch(self.spark, "merge-keys")
        held.join(wanted, list(keys), "left_semi").distinct().write.parquet(path)
        types = [*[version.schema[k] for k in keys], T.StructField("_place", T.StringType())]
        found = self.spark.read.schema(T.StructType(types)).parquet(path)
        # One name per touched file.
        files = sorted(r["_place"] for r in found.select("_place").distinct().collect())
        return files, found.select(*keys).distinct()

    def _key_range(self, source: DataFrame, keys: Sequence[str]) -> tuple[Any, Any]:
        """Least and greatest value of the source's first key, where a scan can use them."""
        if type(self.version().schema[keys[0]].dataType) not in _PARSE:
            return None, None
        return tuple(source.agg(F.min(keys[0]), F.max(keys[0])).first())

    def _within_reach(self, version: Version, keys: Sequence[str], low: Any) -> list[str]:
        """Entries that may hold a key from ``low`` on. When the key is the watermark
        column, those that end before are out of reach."""
        parse = _PARSE.get(type(version.schema[keys[0]].dataType)) if len(keys) == 1 else None
        if parse is None or low is None:
            return version.folders
        noted = [e for e in version.entries if e["watermark_column"] == keys[0] and e["watermark"] is not None]
        passed = {e["path"] for e in noted if parse(e["watermark"]) < low}
        return [p for p in version.folders if p not in passed]

    # -- writing ----------------------------------------------------------------

    def publish(
        self,
        *frames: DataFrame,
        replace: Iterable[str] | None = None,
        watermark: str | None = None,
        tag: str | None = None,
    ) -> int:
        """Write the frames and publish them as the next version; returns its number.

        ``replace`` names the folders or files whose rows the frames hold anew; all else is
        taken over from the current version. None replaces the whole table. ``tag`` is
        ``checkpoint#number`` of a stream's batch; every later version keeps it in its ledger.
        """
        current = self.version()
        number = 1 if current is None else current.number + 1
        ledger = {} if current is None else current.ledger
        if tag is not None:
            stream, batch = tag.rsplit("#", 1)
            ledger[stream] = int(batch)
        written = [row for df in frames for row in self._write(df, number, watermark)]
        kept = [] if replace is None or current is None else self._without(current, set(replace), watermark)
        head = (None, None, 0, None, None, frames[0].schema.json(), ledger)
        names = [c.split()[0] for c in _ENTRY.split(", ")]
        rows = [dict(zip(names, e)) for e in (head, *((*w, None, None) for w in (*kept, *written)))]
        listed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{_ENTRY}>>")
        self.spark.range(1, numPartitions=1).select(F.inline(listed)).write.mode("errorifexists").json(
            f"{self.root}/versions/v={number}"
        )
        self._known = Version.of(number, [Row(**r) for r in rows])
        return number

    def _without(self, version: Version, gone: set[str], watermark: str | None) -> list[tuple]:
        """The entries that stay. A folder of which only some files go is listed by those left."""
        fields = ("path", "part", "row_count", "watermark_column", "watermark")
        stay = [e for e in version.entries if e["path"] not in gone]
        broken = {e["path"]: e for e in stay if any(g.startswith(f"{e['path']}/") for g in gone)}
        kept = [tuple(e[n] for n in fields) for e in stay if e["path"] not in broken]
        if broken:
            # Listed by name only; a folder that nobody has touched is never opened.
            names = {f"{_LOAD}=" + f.rsplit(f"/{_LOAD}=", 1)[1] for f in self._open(version, broken).inputFiles()}
            left = {n: next(e for p, e in broken.items() if n.startswith(f"{p}/")) for n in sorted(names - gone)}
            if left:
                marks = F.max(watermark).cast("string") if watermark else F.lit(None).cast("string")
                counts = self._open(version, left).groupBy(_place().alias("f")).agg(F.count(F.lit(1)), marks).collect()
                kept += [(f, left[f]["part"], n, watermark, high) for f, n, high in counts]
        return kept

    def compact(self, below_rows: int, watermark: str | None = None) -> int | None:
        """Rewrite folders and files with fewer rows: into one, or into one per partition."""
        small = [e for e in self.version().entries if e["row_count"] < below_rows]
        per_part = Counter(e["part"] for e in small)
        paths = [e["path"] for e in small if per_part[e["part"]] > 1]
        if not paths:
            return None
        return self.publish(self.read(folders=paths), replace=paths, watermark=watermark)

    def _write(self, df: DataFrame, number: int, watermark: str | None) -> list[tuple]:
        """Write one frame into a fresh load folder and describe what is there."""
        load = f"{_LOAD}={number}-{uuid.uuid4().hex[:12]}"
        path, part = f"{self.root}/data/{load}", self.partitioned_by
        if part is not None and not isinstance(df.schema[part].dataType, _PART_TYPES):
            raise ValueError(f"partition column {part!r} must be a date or a whole number")
        # Adaptive execution cuts a large partition into several files and packs small
        # ones, without one task per partition.
        out = df if part is None else df.hint("rebalance", part)
        writer = out.write.mode("errorifexists")
        if self.codec:
            writer = writer.option("compression", self.codec.lower())
        (writer if part is None else writer.partitionBy(part)).parquet(path)
        return self._written(path, load, df.schema, watermark)

    def _written(self, path: str, load: str, schema: T.StructType, watermark: str | None) -> list[tuple]:
        """Path, partition, rows and watermark of what a write left behind.

        Counted from the files, not during the write: a task that ran twice counts once.
        """
        part = self.partitioned_by
        mark = F.max(watermark).cast("string") if watermark else F.lit(None).cast("string")
        df = self.spark.read.schema(schema).parquet(path)
        if part is None:
            rows, high = df.agg(F.count(F.lit(1)), mark).first()
            return [(load, None, rows, watermark, high)] if rows else []
        found = df.groupBy(F.col(part).cast("string")).agg(F.count(F.lit(1)), mark).collect()
        return [
            (f"{load}/{part}={_NULL_PARTITION if value is None else value}", value, rows, watermark, high)
            for value, rows, high in found
        ]
