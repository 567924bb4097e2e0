"""Column expressions on texts that several operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

#: Fixed values of the word rule: words are runs of anything but these.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: str | Column) -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    return F.array_remove(F.split(whole(text), SPACE_RUN), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD_RUN)).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of the text are among ``chars``."""
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("bigint")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where they would not find it by themselves."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if root not in map(os.path.abspath, known) and context.applicationId not in _SHIPPED:
        package = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tidemark"), "zip", root, "tidemark")
        context.addPyFile(package)
        _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def written(df: DataFrame, spark: SparkSession, label: str, measure: bool = False) -> DataFrame:
    """The rows as a table in the shared folder, which cuts the lineage. With ``measure`` they are
    counted and measured as they are written, so that neither takes a job of its own."""
    from tidemark.functions.sizes import row_bytes
    from tidemark.session import scratch

    path, seen = scratch(spark, label), Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")) if measure else df
    rows.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._tidemark_path = path
    if measure:
        table._tidemark_rows, table._tidemark_bytes = seen.get["rows"], seen.get["bytes"] or 0
    return table


def release(spark: SparkSession) -> None:
    """Let go of the broadcasts and shuffle files of finished rounds: they stay until the driver
    collects its garbage, which it does by itself only when its heap has grown."""
    spark._jvm.System.gc()


def drop(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._tidemark_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
