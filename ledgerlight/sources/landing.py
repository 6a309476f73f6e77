"""Write landed report files from the fixture views (test and query inputs).

These produce files in the shapes the feeds receive (nested report JSON,
repeated-header CSV extracts, trimmed sheets, ';' CSV, optional-key JSON,
dated drop files).  Every writer is a distributed Spark write; page and file
grouping uses bounded groups only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_ROWS = 1000  # rows per report document (the API pages its responses)
PART_ROWS = 200_000  # rows per CSV extract
SHEET_ROWS = 200_000  # rows per exported sheet
PACKED = "gzip"   # of extracts, sheets and reports: their files are bounded, so that none has to split


def _page_key(df: DataFrame) -> DataFrame:
    """Bounded page id per row: (partition, row index within partition // PAGE_ROWS)."""
    pid = F.spark_partition_id()
    idx = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return df.withColumn("__page", F.concat_ws("-", pid.cast("string"), F.floor(idx / PAGE_ROWS).cast("string")))


def write_analytics_reports(df: DataFrame, path: str, dimensions: Sequence[str], metrics: Sequence[str],
                            prefix: str = "ga:") -> str:
    """Nested report documents, one JSON line per page of at most PAGE_ROWS rows.

    Rows are grouped into pages as their JSON text, a fraction of the nested row."""
    rows = _page_key(df).select(
        "__page",
        F.to_json(F.struct(F.array(*[F.col(d).cast("string") for d in dimensions]).alias("dimensions"),
                           F.array(F.struct(F.array(*[F.col(m).cast("string") for m in metrics]).alias("values")))
                           .alias("metrics"))).alias("row"))
    header = F.struct(F.array(*[F.lit(prefix + d) for d in dimensions]).alias("dimensions"),
                      F.struct(F.array(*[F.struct(F.lit(prefix + m).alias("name")) for m in metrics])
                               .alias("metricHeaderEntries")).alias("metricHeader"))
    docs = rows.groupBy("__page").agg(F.collect_list("row").alias("rows")).select(F.concat(
        F.lit('{"reports":[{"columnHeader":'), F.to_json(header), F.lit(',"data":{"rows":['), F.array_join("rows", ","), F.lit("]}}]}")).alias("value"))
    docs.write.mode("overwrite").option("maxRecordsPerFile", PART_ROWS // PAGE_ROWS).option("compression", PACKED).text(path)
    return path


def write_csv_parts(df: DataFrame, path: str, sep: str = ",", by: str | None = None) -> str:
    """CSV extracts of bounded size with a header in every part file (the repeated header).

    ``by``: a column whose values are folders of the landing instead."""
    writer = df.write if by is None else df.repartition(by).write.partitionBy(by)
    writer.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"') \
        .option("maxRecordsPerFile", PART_ROWS).option("compression", PACKED).csv(path)
    return path


def write_sheets(df: DataFrame, path: str, header: Sequence[str], head_junk: int = 9, footer: int = 3,
                 rows: int = SHEET_ROWS, packed: bool = False) -> str:
    """Sheets exported as text: header, ``head_junk`` report lines, data, ``footer`` lines.

    A sheet holds about ``rows`` lines, however many sheets that takes; each
    is a value ``sheet`` of the partition column below ``path``.  ``packed`` sheets are gzipped.
    """
    lines = df.select(F.to_csv(F.struct(*[F.col(c) for c in df.columns]), {"escape": '"'}).alias("value"))
    sheets = F.greatest(F.lit(1), F.ceil(df.agg(F.count("*").alias("n")).scalar() / rows))
    lines = lines.withColumn("sheet", F.pmod(F.xxhash64("value"), sheets).cast("int"))
    frame = [(0, i, v) for i, v in enumerate([",".join(header)] + [f"Report line {i + 1}" for i in range(head_junk)])]
    frame += [(2, i, v) for i, v in enumerate(["Total", "Generated by export", "Confidential"][:footer])]
    around = df.sparkSession.createDataFrame(frame, "part int, pos int, value string")
    every = around.withColumn("sheet", F.explode(F.sequence(F.lit(0), (sheets - 1).cast("int"))))       # a fixed dozen of lines per sheet
    out = lines.select("sheet", F.lit(1).alias("part"), F.lit(0).alias("pos"), "value").unionByName(
        every.select("sheet", "part", "pos", "value"))
    (out.repartition("sheet").sortWithinPartitions("sheet", "part", "pos").select("sheet", "value")
     .write.mode("overwrite").partitionBy("sheet").option("compression", PACKED if packed else "none").text(path))
    return path


def write_lines(df: DataFrame, path: str, line) -> str:
    """Lines as they come, well-formed or not, added to what is below ``path``."""
    df.select(line.alias("value")).write.mode("append").text(path)
    return path


def write_records(df: DataFrame, path: str) -> str:
    """JSON records; null fields are omitted, so keys are optional per record."""
    df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) \
        .write.mode("overwrite").option("ignoreNullFields", True).option("maxRecordsPerFile", PART_ROWS).option("compression", PACKED).json(path)
    return path


def write_drop_files(spark: SparkSession, df: DataFrame, date_col: str, staging: str, inbox: str,
                     feed: str, sep: str = ";", extra: dict | None = None) -> list[str]:
    """One dated drop file per calendar month of ``date_col`` (``{yyyymm}01_{feed}.csv``), each its own
    write task, plus optional extra files given as {file name: DataFrame of a few rows}."""
    def write(rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").partitionBy("__file").option("header", True).option("sep", sep).option("escape", '"').csv(path)

    month = F.date_format(F.col(date_col).cast("date"), "yyyyMM")
    write(df.withColumn("__file", F.concat(month, F.lit(f"01_{feed}.csv"))).repartition("__file"), staging)
    for i, (name, rows) in enumerate((extra or {}).items()):
        write(rows.withColumn("__file", F.lit(name)).repartition(1), f"{staging}-extra/{i}")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(inbox))
    names = []
    for root in [staging, *[f"{staging}-extra/{i}" for i in range(len(extra or {}))]]:
        for folder in fs.listStatus(path(root)):
            name = folder.getPath().getName().partition("__file=")[2]
            for f in fs.listStatus(folder.getPath()) if name else []:
                if f.getPath().getName().endswith(".csv"):
                    if name in names or not fs.rename(f.getPath(), path(f"{inbox}/{name}")):
                        raise OSError(f"{name} is there already: a month must be one file")
                    names.append(name)
    return names
