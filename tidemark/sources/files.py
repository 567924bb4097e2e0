"""Landing-file readers and writers. Any URI Spark can read will do (s3a, gs, hdfs, file)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from tidemark.functions.scalar import ts_lit

# Text that a delimited file means as "no value".
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Separators of the delimited formats when the configuration has none.
SEPARATORS = {"CSV": ",", "TSV": "\t", "DAT": ","}
DELIMITED = tuple(SEPARATORS)


_RAW, _FILE = "_tidemark_record", "_tidemark_file"


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    header: str | None = None,
    sep: str = ",",
    quote: str | None = '"',
    escape: str | None = None,
    encoding: str = "UTF-8",
    multiline: bool | None = None,
    columns: Sequence[str] | None = None,
    null_markers: Sequence[str] = NULL_MARKERS,
    on_surplus: str = "fail",
) -> DataFrame:
    """A delimited file as text columns; typing is the staging step's work.

    ``header`` None or "infer" takes names from the first line, "none" has no names
    (then give ``columns``). Files of one load must have the same header.

    A file whose quoted values contain line breaks cannot be cut into pieces;
    ``multiline=None`` looks for such values and reads those files alone as a whole.

    A record with fewer values than columns has NULL for the rest. One with more fails the
    query, or with ``on_surplus="reject"`` is left out; :func:`rejected_records` has it then.
    """
    if on_surplus not in ("fail", "reject"):
        raise ValueError("on_surplus must be 'fail' or 'reject'")
    df, names = _parsed(spark, path, header, sep, quote, escape, encoding, multiline, columns)
    surplus = _surplus(len(names), sep, quote, escape)
    if on_surplus == "reject":
        df = df.filter(~surplus & _reads(names[0]))
        failed = None
    else:
        failed = F.raise_error(F.concat(F.lit(f"more than {len(names)} values in a record: "), F.col(_RAW)))
    out = []
    for name in names:
        value = F.col(f"`{name}`")
        if null_markers:
            value = F.when(~value.isin(list(null_markers)), value)
        if failed is not None:
            value = F.when(surplus, failed.cast("string")).otherwise(value)
        out.append(value.alias(name))
    return df.select(*out)


def rejected_records(
    spark: SparkSession,
    path: str | Sequence[str],
    header: str | None = None,
    sep: str = ",",
    quote: str | None = '"',
    escape: str | None = None,
    encoding: str = "UTF-8",
    multiline: bool | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``file, record``: the records that ``read_delimited(on_surplus="reject")`` leaves out, as
    they stand in the file."""
    df, names = _parsed(spark, path, header, sep, quote, escape, encoding, multiline, columns)
    left_out = df.filter(_surplus(len(names), sep, quote, escape) & _reads(names[0]))
    return left_out.select(F.col(_FILE).alias("file"), F.col(_RAW).alias("record"))


def _parsed(
    spark: SparkSession, path: str | Sequence[str], header: str | None, sep: str, quote: str | None,
    escape: str | None, encoding: str, multiline: bool | None, columns: Sequence[str] | None,
) -> tuple[DataFrame, list[str]]:
    """The parsed columns with the raw text of every record of another length, and their names."""
    with_header = (header or "infer").lower() not in ("none", "false")
    files = spark.read.text(path).inputFiles()
    if multiline is None:
        whole = set(_quoted_breaks(spark, path, quote, encoding, escape)) if quote else set()
    else:
        whole = set(files) if multiline else set()

    def reader(as_a_whole: bool) -> DataFrameReader:
        return (
            spark.read.option("header", with_header)
            .option("sep", sep)
            .option("quote", quote or "")
            .option("escape", escape or quote or "\\")
            .option("encoding", encoding)
            .option("multiLine", as_a_whole)
            .option("mode", "PERMISSIVE")
            .option("inferSchema", False)
        )

    names = list(columns) if columns is not None else reader(bool(whole)).csv(path).columns
    fields = [T.StructField(c, T.StringType()) for c in (*names, _RAW)]
    parts = []
    for as_a_whole, some in ((False, [f for f in files if f not in whole]), (True, sorted(whole))):
        if some:
            part = (
                reader(as_a_whole)
                .schema(T.StructType(fields))
                .option("columnNameOfCorruptRecord", _RAW)
                # The number of values of a record is only known when all of it is parsed.
                .option("columnPruning", False)
                .option("enforceSchema", len(files) == 1 or columns is not None)
                .csv(some if parts or len(some) < len(files) else path)
            )
            parts.append(part.select(*[f"`{f.name}`" for f in fields], F.col("_metadata.file_path").alias(_FILE)))
    if not parts:
        return spark.createDataFrame([], T.StructType([*fields, T.StructField(_FILE, T.StringType())])), names
    return reduce(DataFrame.unionByName, parts), names


def _reads(name: str) -> Column:
    """True for every row; the reader refuses queries of the raw record alone, so this reads a column."""
    return F.length(F.concat_ws("", F.col(f"`{name}`"))) >= 0


def _surplus(width: int, sep: str, quote: str | None, escape: str | None) -> Column:
    """Whether a record holds more than ``width`` values. Records of the right width have no raw text."""
    raw = F.col(_RAW)
    if quote:
        q, e, s = (re.escape(c) for c in (quote, escape or quote, sep))
        inside = f"(?:[^{q}]|{q}{q})*" if e == q else f"(?:[^{q}{e}]|{e}.|{q}{q})*"
        raw = F.regexp_replace(raw, f"(?s)(^|{s}){q}{inside}{q}", "$1")
    separators = (F.length(raw) - F.length(F.replace(raw, F.lit(sep)))) / F.lit(len(sep))
    return F.coalesce(separators >= width, F.lit(False))


def _quoted_breaks(
    spark: SparkSession, path: str | Sequence[str], quote: str, encoding: str, escape: str | None = None
) -> list[str]:
    """The files in which some line leaves a quote open, so that a value goes on.

    A quote that is escaped does not count; a doubled one leaves the parity as it is. Only
    the names of such files reach the driver.
    """
    lines = spark.read.text(path)
    if encoding.upper() not in ("UTF-8", "UTF8", "US-ASCII"):
        return lines.inputFiles()
    text = F.col("value")
    if escape and escape != quote:
        text = F.regexp_replace(text, f"{re.escape(escape)}.", "")
    quotes = F.length(text) - F.length(F.replace(text, F.lit(quote)))
    found = lines.filter(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    open_ended = {_plain(r["f"]) for r in found}
    return [f for f in lines.inputFiles() if _plain(f) in open_ended] if open_ended else []


def _plain(uri: str) -> str:
    """``file:///a`` and ``file:/a`` name one file."""
    return re.sub(r"^([\w+.-]+):/+", r"\1:/", uri)


def read_json_response(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Rows of the ``data`` array of API responses, one document per file (or per line
    with ``multiline=False``).

    With ``columns`` (the source names of the metadata) nothing is inferred: every
    value arrives as text, a nested one as its JSON text, a missing one as NULL, and
    names match without case. Without, one pass infers the union of all names.
    A document without ``data`` fails the query.
    """
    reader = spark.read.option("multiLine", multiline).option("mode", "FAILFAST")
    if columns is None:
        df = reader.json(path)
        if "data" not in df.columns:
            raise ValueError("response has no data array")
        return df.select(F.explode(_present(F.col("data"))).alias("r")).select("r.*")
    raw = reader.schema("data array<map<string,string>>").json(path)
    lower = F.transform_keys("r", lambda k, _: F.lower(k))
    return (
        raw.select(F.explode(_present(F.col("data"))).alias("r"))
        .select(lower.alias("r"))
        .select(*[F.element_at("r", F.lit(c.lower())).alias(c.lower()) for c in columns])
    )


def read_variant_response(
    spark: SparkSession, path: str | Sequence[str], multiline: bool = True, shape: T.StructType | None = None
) -> DataFrame:
    """Rows of the ``data`` array of responses of unknown shape, with the union of all names.

    Records are kept as VARIANT, so a name may hold a number here, text there and an object
    elsewhere. One aggregate over the records merges their schemas; give ``shape`` to do without. A name
    whose values share a plain type has that type, any other has their text (an object or array its JSON
    text). What a record lacks is NULL, as is a JSON null. A document without ``data`` fails
    the query; names that differ only by case are an error.
    """
    lines = spark.read.option("wholetext", multiline).text(path)
    if not multiline:
        lines = lines.filter(F.trim("value") != "")
    data = F.variant_get(F.parse_json("value"), "$.data", "array<variant>")
    records = lines.select(F.explode(_present(data)).alias("r"))
    if shape is None:
        shape = variant_shape(records, "r")
    return records.select(*[_variant_field("r", f).alias(f.name) for f in shape.fields])


def variant_shape(records: DataFrame, column: str) -> T.StructType:
    """Names and types over all objects of a VARIANT column; only the merged schema reaches the driver."""
    merged = records.agg(F.schema_of_variant_agg(column).alias("s")).first()["s"]
    if merged in (None, "VOID"):
        return T.StructType()
    if not merged.startswith("OBJECT<"):
        raise ValueError(f"records are no objects but {merged}")
    # Nested values become text, so their own fields do not matter here.
    plain = T.StructType([T.StructField(n, _PLAIN_TYPES.get(t, T.StringType())) for n, t in _object_fields(merged)])
    if len({f.name.lower() for f in plain.fields}) < len(plain.fields):
        raise ValueError("names of the response differ only by case")
    return plain


_PLAIN_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType()}


def _object_fields(merged: str) -> list[tuple[str, str]]:
    """``OBJECT<a: BIGINT, `b c`: ARRAY<...>>`` -> names and the outermost words of their types."""
    out, rest = [], merged[len("OBJECT<") : -1]
    while rest:
        named = re.match(r"(?:`((?:[^`]|``)*)`|([^:`]+)): ", rest)
        name, rest = (named.group(1) or "").replace("``", "`") if named.group(2) is None else named.group(2), rest[named.end() :]
        depth, end, quoted = 0, len(rest), False
        for at, c in enumerate(rest):
            quoted ^= c == "`"
            depth += 0 if quoted else (c in "<(") - (c in ">)")
            if c == "," and depth == 0 and not quoted:
                end = at
                break
        kind, rest = rest[:end], rest[end + 2 :]
        out.append((name, "DOUBLE" if kind.startswith("DECIMAL") else kind))
    return out


def _variant_field(column: str, field: T.StructField) -> Column:
    # A path has no escapes; a name with both kinds of quotes is found in the record's map.
    quote = next((q for q in "\"'" if q not in field.name), None)
    if quote:
        value = F.variant_get(column, f"$[{quote}{field.name}{quote}]", "variant")
    else:
        value = F.try_element_at(F.variant_get(column, "$", "map<string,variant>"), F.lit(field.name))
    if not isinstance(field.dataType, T.StringType):
        return F.try_variant_get(value, "$", field.dataType.simpleString())
    nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return F.when(nested, F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))


def _present(data: Column) -> Column:
    return F.when(data.isNotNull(), data).otherwise(
        F.raise_error(F.lit("response has no data array")).cast("void")
    )


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON object per line. Give a schema; inferring one reads the data twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_avro(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Avro files; needs Spark's avro module on the class path."""
    return spark.read.format("avro").load(path)


def read_landing(spark: SparkSession, path: str, file_format: str, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Read a file by the format named in the configuration."""
    kind = (file_format or "PARQUET").upper()
    if kind in SEPARATORS:
        options.setdefault("sep", SEPARATORS[kind])
        return read_delimited(spark, path, **options)
    if kind == "RESPONSE":
        return read_json_response(spark, path, columns, **options)
    if kind == "JSON":
        return read_json_lines(spark, path, **options)
    if kind == "AVRO":
        return read_avro(spark, path)
    if kind == "PARQUET":
        return spark.read.parquet(path)
    raise ValueError(f"unknown file format {file_format!r}")


def external_view(spark: SparkSession, name: str, path: str, file_format: str = "parquet") -> DataFrame:
    """Create or replace a view that reads the files in place."""
    spark.read.format(file_format.lower()).load(path).createOrReplaceTempView(name)
    return spark.table(name)


def read_typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Chosen columns cast to the given types; a value that does not fit is NULL."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()])


def read_metadata_jdbc(spark: SparkSession, url: str, table: str, schema: T.StructType, **properties: str) -> DataFrame:
    """A metadata table from a relational database; filters are pushed to it."""
    df = spark.read.jdbc(url, table, properties=properties)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str | None = None,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Parquet with the codec of ``accepted_encoding`` (gzip, snappy, zstd, none)."""
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec.lower())
    writer.parquet(path)


def constants(schema: T.StructType, values: Sequence, leave_out: Sequence[str] = ()) -> list[Column]:
    """Literal columns of a schema."""
    return [
        (ts_lit(v) if isinstance(v, datetime) else F.lit(v)).cast(f.dataType).alias(f.name)
        for f, v in zip(schema.fields, values, strict=True)
        if f.name not in leave_out
    ]


def one_row(spark: SparkSession, schema: T.StructType, values: Sequence) -> DataFrame:
    """A single row of constants."""
    return spark.range(1, numPartitions=1).select(*constants(schema, values))


def few_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence]) -> DataFrame:
    """Rows of constants."""
    structs = [F.struct(*constants(schema, values)) for values in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def write_table(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    if_exists: str = "fail",
    partition_by: Sequence[str] = (),
) -> None:
    """Write under a declared schema; ``if_exists`` is append, replace or fail."""
    modes = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
    if if_exists not in modes:
        raise ValueError(f"if_exists must be one of {sorted(modes)}")
    cast = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    write_parquet(cast, path, mode=modes[if_exists], partition_by=partition_by)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet files at ``path``, or None when there are none."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _file_system(spark: SparkSession, at: str) -> tuple[Any, Any]:
    """The file system of a path, and the path in its terms."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names directly below a folder; none where there is no such folder."""
    fs, path = _file_system(spark, folder)
    return [found.getPath().getName() for found in fs.listStatus(path)] if fs.exists(path) else []


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file at ``path``; one that is there already is an error."""
    fs, at = _file_system(spark, path)
    fs.create(at, False).close()


def archive_landing(spark: SparkSession, landing: str, archive: str, stamp: str) -> bool:
    """Move the previous landing to ``archive/archived_at=<stamp>``.

    The files stay as they are; only where landing and archive lie in different stores are
    they copied, by Spark. Returns False when there was none, which is no error.
    """
    target = f"{archive}/archived_at={stamp}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    source_fs, target_fs = path(landing).getFileSystem(conf), path(target).getFileSystem(conf)
    if not source_fs.exists(path(landing)):
        return False
    if source_fs.getUri().equals(target_fs.getUri()):
        target_fs.mkdirs(path(archive))
        if not target_fs.rename(path(landing), path(target)):
            raise OSError(f"could not move {landing} to {target}")
        return True
    previous = read_if_present(spark, landing)
    if previous is None:
        return False
    write_parquet(previous, target)
    return True
