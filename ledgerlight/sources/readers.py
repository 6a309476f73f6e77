"""Readers for landed report files.

All readers take an explicit schema (never inference) and return lazy
DataFrames; files are split across tasks by Spark's file source.

Files with a header are bound by name: the driver reads the header of each file
(it lists the files anyway), files with the same column order are read
together, and a file with an unknown, missing or repeated name is refused.

A line that does not fit (too few or too many fields, a cell that does not
parse, torn JSON) never becomes data. The plain readers fail the job on it; the
``*_lanes`` readers return it in a second result, ``Landed.refused``, with the
name of its file and its text.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .sinks import stage

CORRUPT = "__corrupt"
FILE_NAME = "__file_name"


class Landed(NamedTuple):
    """Rows of landed files, and the lines that are none: (file_name, line)."""
    rows: DataFrame
    refused: DataFrame


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _whole(columns: Sequence[str]) -> Column:
    """Always true, and reads every column: Spark parses only the columns a query needs, and a bad cell must
    count whatever is selected.  (A line never equals itself with more behind it, nor null a text.)"""
    every = [F.col(f"`{c}`").cast("string") for c in columns]
    return ~F.col(CORRUPT).eqNullSafe(F.concat_ws("", F.col(CORRUPT), *every, F.lit(".")))


Keep = Callable[[DataFrame], DataFrame]     # stores the parsed lines of both lanes, so that one parse serves both


def _lanes(raw: DataFrame, columns: Sequence[str], keep: Keep | None = None) -> Landed:
    """Splits rows read with a corrupt-record column."""
    torn = F.col(CORRUPT).isNotNull()
    raw = raw.filter(_whole(columns)).select(*[F.col(f"`{c}`") for c in columns], F.when(torn, F.col("_metadata.file_name")).alias(FILE_NAME), CORRUPT)
    return _split(keep(raw) if keep else raw, columns)


def _split(parsed: DataFrame, columns: Sequence[str]) -> Landed:
    return Landed(parsed.filter(F.col(CORRUPT).isNull()).select(*[F.col(f"`{c}`") for c in columns]),
                  parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(FILE_NAME).alias("file_name"), F.col(CORRUPT).alias("line")))


# ---------------------------------------------------------------------------
# S1 nested analytics report
# ---------------------------------------------------------------------------
REPORT_SCHEMA = T.StructType([
    T.StructField("reports", T.ArrayType(T.StructType([
        T.StructField("columnHeader", T.StructType([
            T.StructField("dimensions", T.ArrayType(T.StringType())),
            T.StructField("metricHeader", T.StructType([
                T.StructField("metricHeaderEntries", T.ArrayType(T.StructType([
                    T.StructField("name", T.StringType())]))),
            ])),
        ])),
        T.StructField("data", T.StructType([
            T.StructField("rows", T.ArrayType(T.StructType([
                T.StructField("dimensions", T.ArrayType(T.StringType())),
                T.StructField("metrics", T.ArrayType(T.StructType([
                    T.StructField("values", T.ArrayType(T.StringType()))]))),
            ]))),
        ])),
    ]))),
])

PREFIX_LEN = 3  # the API's "ga:" prefix on every header name


def flatten_report(spark: SparkSession, paths: str | Sequence[str], header: Sequence[str],
                   multi_line: bool = False) -> DataFrame:
    """One row per ``data.rows[]``, columns = dimensions then metric names.

    Values come from ``metrics[0]`` only (a second date range is ignored).
    Header names lose their 3-character prefix.  A report whose header differs
    from ``header`` fails the job (``raise_error``), instead of silently
    mis-aligning columns.  Documents are JSON lines, so large landings split;
    ``multi_line`` reads one pretty-printed document (or an array of them) per
    file.  A file of the other kind fails the job instead of reading as no rows.
    """
    raw = spark.read.schema(REPORT_SCHEMA).option("multiLine", multi_line).option("mode", "FAILFAST").json(paths)
    rep = raw.select(F.explode("reports").alias("r"))
    names = F.transform(
        F.concat(F.col("r.columnHeader.dimensions"),
                 F.transform(F.col("r.columnHeader.metricHeader.metricHeaderEntries"), lambda e: e["name"])),
        lambda h: F.substr(h, F.lit(PREFIX_LEN + 1)))
    expected = F.array(*[F.lit(h) for h in header])
    rows = rep.select(
        F.when(names == expected, F.lit(True))
         .otherwise(F.raise_error(F.lit("analytics report header differs from the expected columns")))
         .alias("__ok"),
        F.explode("r.data.rows").alias("row"))
    values = F.concat(F.col("row.dimensions"), F.col("row.metrics").getItem(0)["values"])
    return rows.filter("__ok").select(*[F.get(values, i).alias(h) for i, h in enumerate(header)])


# ---------------------------------------------------------------------------
# S2 repeated-header CSV extracts
# ---------------------------------------------------------------------------
def _multi_csv(spark: SparkSession, paths, schema: T.StructType, sep: str, mode: str) -> DataFrame:
    # Without column pruning every line's fields are counted, whatever columns a query reads.
    return (spark.read.schema(schema).option("header", False).option("sep", sep).option("escape", '"').option("mode", mode)
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(paths))


def read_multi_csv(spark: SparkSession, paths, columns: Sequence[str], key_column: str | None = None,
                   sep: str = ",") -> DataFrame:
    """Concatenated extracts whose header line repeats: read every line as
    data (all strings) and drop the repeated header lines (``key != 'key'``; an
    empty key is not the header and stays).  A line with too few or too many
    fields fails the job."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    key = key_column or columns[0]
    return _multi_csv(spark, paths, schema, sep, "FAILFAST").filter(~F.col(f"`{key}`").eqNullSafe(F.lit(key)))


def multi_csv_lanes(spark: SparkSession, paths, columns: Sequence[str], key_column: str | None = None,
                    sep: str = ",", only: Column | None = None, keep: Keep | None = None) -> Landed:
    """S2 with a lane for lines that have too few or too many fields.

    ``only``: a filter on the partition columns of the landed folder; folders that it rules out are not read."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    key = key_column or columns[0]
    raw = _multi_csv(spark, paths, _with_corrupt(schema), sep, "PERMISSIVE")
    landed = _lanes(raw if only is None else raw.filter(only), columns, keep)
    return landed._replace(rows=landed.rows.filter(~F.col(f"`{key}`").eqNullSafe(F.lit(key))))


# ---------------------------------------------------------------------------
# S3 positional sheet: header + skipped rows + data + footer
# ---------------------------------------------------------------------------
def numbered_lines(spark: SparkSession, paths, scratch: str | None = None) -> DataFrame:
    """(file_name, value, line_no, line_count) of every line: numbers from 0 in its file, and the file's
    number of lines, trailing blank ones left out.

    A file may lie in several splits and a split in any task.  The lines are
    stored once with their place in the scan (two scans could split otherwise);
    the counts per split, added up along each file, give every split the number
    of its first line.  ``scratch``: a folder to store them in, which the caller clears.
    """
    at = (lambda name: f"{scratch}/{name}") if scratch else (lambda name: scratch_path(spark, name))
    lines = spark.read.schema("value string").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")
    lines = stage(spark, lines, at("sheet-lines"))
    filled = F.when(F.col("value") != "", F.col("at"))
    splits = lines.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max(filled).alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    splits = stage(spark, splits.withColumn("line_count", F.coalesce(F.max(F.col("last") + F.col("offset") + 1).over(Window.partitionBy("file")), F.lit(0)))
                   .select("file", "split", "offset", "line_count"), at("sheet-splits"))
    return lines.join(splits, ["file", "split"]).select("file_name", "value", (F.col("at") + F.col("offset")).alias("line_no"), "line_count")


def parse_sheet(lines: DataFrame, head: int, tail: int, schema: T.StructType, sep: str = ",", corrupt: str | None = None) -> DataFrame:
    """``file_name`` and the columns of ``schema`` of the lines between head and footer of each file.

    A line that does not parse fails the job, or lands in the ``corrupt`` column if one is named."""
    body = lines.filter((F.col("line_no") >= head) & (F.col("line_no") < F.col("line_count") - tail))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "escape": '"', "mode": "FAILFAST"}
    if corrupt:
        ddl += f", `{corrupt}` string"
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    return body.select("file_name", F.from_csv(F.col("value"), ddl, options).alias("r")).select("file_name", "r.*")


def read_trimmed(spark: SparkSession, paths, head: int, tail: int, schema: T.StructType,
                 sep: str = ",") -> DataFrame:
    """S3: per file, drop the first ``head`` lines and the last ``tail`` lines,
    then parse the rest positionally with ``schema``.

    Line positions are per file; a sheet of any size is split over tasks
    (``numbered_lines``).  Trailing blank lines are not counted as footer.
    """
    return parse_sheet(numbered_lines(spark, paths), head, tail, schema, sep).drop("file_name")


def sheet_lanes(spark: SparkSession, paths, head: int, tail: int, schema: T.StructType, sep: str = ",", keep: Keep | None = None,
                scratch: str | None = None) -> Landed:
    """S3 with a lane for lines that do not fit."""
    parsed = parse_sheet(numbered_lines(spark, paths, scratch), head, tail, schema, sep, CORRUPT)
    parsed = parsed.select(*[F.col(f"`{c}`") for c in schema.fieldNames()], F.when(F.col(CORRUPT).isNotNull(), F.col("file_name")).alias(FILE_NAME), CORRUPT)
    return _split(keep(parsed) if keep else parsed, schema.fieldNames())


# ---------------------------------------------------------------------------
# S4 / S5 delimited reports, bound by their header
# ---------------------------------------------------------------------------
class BadHeader(ValueError):
    """A file whose header does not name exactly the expected columns."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _header(spark: SparkSession, path: str, sep: str, encoding: str) -> tuple[str, ...] | None:
    """Names in the first record of a file, or None if it has no line; reads no further than that record."""
    jvm, jpath, fs = _hadoop(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(jpath)
    stream = fs.open(jpath)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
    try:
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        if line is None:
            return None
        while line.count('"') % 2 and (more := reader.readLine()) is not None:       # a quoted line break
            line += "\n" + more
        return tuple(next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep)))
    finally:
        reader.close()


def landed_files(spark: SparkSession, paths) -> list[str]:
    """Every file below ``paths``, as Spark's file source lists them."""
    uri = spark.sparkContext._jvm.java.net.URI
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [path(uri(f)).toString() for f in spark.read.schema("value string").text(paths).inputFiles()]


def header_problem(header: Sequence[str], names: Sequence[str]) -> str | None:
    """What is wrong with a file's header, or None."""
    said = [(word, sorted(found)) for word, found in (
        ("unknown", set(header) - set(names)), ("missing", set(names) - set(header)), ("repeated", {h for h in header if list(header).count(h) > 1})) if found]
    return "; ".join(f"{word}: {', '.join(found)}" for word, found in said) or None


def header_layouts(spark: SparkSession, files: Sequence[str], names: Sequence[str], sep: str = ",",
                   encoding: str = "utf-8") -> tuple[dict[tuple[str, ...], list[str]], dict[str, str], list[str]]:
    """(files by column order, problem by refused file, files without a line).

    One short read per file, several at a time, beside the listing that the driver does anyway."""
    layouts, refused, blank = {}, {}, []
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _header(spark, f, sep, encoding), files))
    for file, header in zip(files, headers):
        if header is None:
            blank.append(file)
        elif problem := header_problem(header, names):
            refused[file] = problem
        else:
            layouts.setdefault(header, []).append(file)
    return layouts, refused, blank


def read_layouts(spark: SparkSession, layouts: dict[tuple[str, ...], list[str]], schema: T.StructType, sep: str = ",",
                 encoding: str = "utf-8", multi_line: bool = True, lanes: bool = False) -> DataFrame:
    """Files of each column order read with that order, then the columns of ``schema`` by name.

    ``enforceSchema=False`` has every task compare the header it skips as well.
    With ``lanes`` there is a corrupt-record column, else a bad line fails the job."""
    reads = []
    for order, files in layouts.items():
        of_file = T.StructType([schema[name] for name in order])
        reads.append(spark.read.schema(_with_corrupt(of_file) if lanes else of_file).option("header", True).option("enforceSchema", False)
                     .option("sep", sep).option("encoding", encoding).option("escape", '"').option("multiLine", multi_line)
                     .option("mode", "PERMISSIVE" if lanes else "FAILFAST").option("columnNameOfCorruptRecord", CORRUPT)
                     .option("columnPruning", False).csv(files)
                     .select(*[F.col(f"`{n}`") for n in schema.fieldNames()], *([CORRUPT] if lanes else []), "_metadata"))
    if not reads:
        empty = _with_corrupt(schema) if lanes else schema
        return spark.createDataFrame([], empty).withColumn("_metadata", F.struct(F.lit("").alias("file_name"), F.lit("").alias("file_path")))
    out = reads[0].select("*", F.struct("_metadata.file_name", "_metadata.file_path").alias("__m")).drop("_metadata")
    for r in reads[1:]:
        out = out.unionByName(r.select("*", F.struct("_metadata.file_name", "_metadata.file_path").alias("__m")).drop("_metadata"))
    return out.withColumnRenamed("__m", "_metadata")


def _by_name(spark: SparkSession, paths, schema: T.StructType, sep: str, encoding: str, multi_line: bool, lanes: bool) -> DataFrame:
    layouts, refused, _ = header_layouts(spark, landed_files(spark, paths), schema.fieldNames(), sep, encoding)
    if refused:
        raise BadHeader("; ".join(f"{file}: {problem}" for file, problem in sorted(refused.items())))
    return read_layouts(spark, layouts, schema, sep, encoding, multi_line, lanes)


def read_delimited(spark: SparkSession, paths, schema: T.StructType, sep: str = ";",
                   encoding: str = "utf-8", multi_line: bool = True) -> DataFrame | None:
    """Delimited files with a header, columns bound by name.  An empty landing
    returns None (the source stops the run); the check reads at most one row.  A
    cell that does not parse fails the job, as the source's cast does.

    Quoted line breaks are read, for which a file is one task; files known to
    hold none split with ``multi_line=False``."""
    df = _by_name(spark, paths, schema, sep, encoding, multi_line, False).drop("_metadata")
    return None if df.isEmpty() else df


def delimited_lanes(spark: SparkSession, paths, schema: T.StructType, sep: str = ";", encoding: str = "utf-8",
                    multi_line: bool = True, keep: Keep | None = None) -> Landed:
    """S4 with a lane for lines with too few or too many fields or a cell that does not parse."""
    return _lanes(_by_name(spark, paths, schema, sep, encoding, multi_line, True), schema.fieldNames(), keep)


def read_report(spark: SparkSession, paths, schema: T.StructType, spend_col: str = "Spend", multi_line: bool = True) -> DataFrame:
    """CSV report, bound by name, keeping rows with positive spend (filter reaches the scan)."""
    df = _by_name(spark, paths, schema, ",", "utf-8", multi_line, False).drop("_metadata")
    return df.filter(F.col(f"`{spend_col}`") > 0)


def report_lanes(spark: SparkSession, paths, schema: T.StructType, spend_col: str = "Spend", multi_line: bool = True,
                 keep: Keep | None = None) -> Landed:
    """S5 with a lane for lines that do not fit."""
    landed = _lanes(_by_name(spark, paths, schema, ",", "utf-8", multi_line, True), schema.fieldNames(), keep)
    return landed._replace(rows=landed.rows.filter(F.col(f"`{spend_col}`") > 0))


# ---------------------------------------------------------------------------
# S6 records with optional keys
# ---------------------------------------------------------------------------
def _optional(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{f}`"), F.lit("")).alias(f) for f in fields])


def read_records(spark: SparkSession, paths, fields: Sequence[str]) -> DataFrame:
    """JSON records where any key may be missing; a missing key reads as ''.
    Several accounts are simply several paths.  A torn record fails the job."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return _optional(spark.read.schema(schema).option("mode", "FAILFAST").json(paths), fields)


def record_lanes(spark: SparkSession, paths, fields: Sequence[str], keep: Keep | None = None) -> Landed:
    """S6 with a lane for torn records."""
    schema = _with_corrupt(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    landed = _lanes(spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(paths), fields, keep)
    return landed._replace(rows=_optional(landed.rows, fields))


# ---------------------------------------------------------------------------
# S7 drop-file name gate
# ---------------------------------------------------------------------------
def file_stem(name) -> Column:
    """File name without its last extension (``os.path.splitext``)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.when(c.rlike(r"^.+\.[^./]*$"), F.regexp_extract(c, r"^(.+)\.[^./]*$", 1)).otherwise(c)


def valid_drop_file(stem, feed: str) -> Column:
    """``yyyymmdd_<feed>`` exactly, with a real calendar date."""
    c = F.col(stem) if isinstance(stem, str) else stem
    shape = c.rlike("^[0-9]{8}_" + feed + "$")
    return shape & F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd").isNotNull()


def drop_glob(feed: str) -> str:
    """Name shape as a file-source glob: bad names never enter the stream."""
    return "[0-9]" * 8 + f"_{feed}.*"
