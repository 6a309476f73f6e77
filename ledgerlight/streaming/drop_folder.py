"""Drop-folder ingestion on the Structured Streaming file source.

The source lists a bucket folder, checks each file name, loads it, then moves
it to ``processados/`` or, if it fails, to ``erros/`` and goes on.  Here:

* the stream is one of arrivals: the file source lists names and sizes, no
  content; its checkpoint records which were seen, so a restarted job neither
  skips nor repeats a file;
* the name shape goes into ``pathGlobFilter``, so badly named files never
  enter the stream and stay where they are;
* the files of a micro-batch are read together, columns bound by each file's
  header.  A file is refused whole, with its reason in the log, if its name has
  an impossible date, its header other names, one of its lines does not
  fit, or ``valid`` refuses a row.  A file without rows is logged as empty and
  stays;
* fine files are loaded in waves: files whose date spans do not overlap replace
  their slices in one write, a file that overlaps an earlier one (by name)
  waits for the next wave, so the table is as if they had loaded one by one;
* after its wave a loaded file is moved to the archive, and a refused one to
  the errors folder; it then lies nowhere else.

A replayed micro-batch finds the files that it had not moved yet, and loads
them again; reloading a slice gives the same table.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.canonical import FILE_TAG
from ..operators.slices import DATE_COL, reload_spans
from ..sources.readers import CORRUPT, drop_glob, file_stem, header_layouts, numbered_lines, parse_sheet, read_layouts, valid_drop_file

LOG = "file string, outcome string, reason string, row_count long, dt_min date, dt_max date, wave int"
LOADED, REFUSED, EMPTY = "loaded", "refused", "empty"


def _move(spark: SparkSession, path: str, folder: str) -> None:
    """Rename within the file system; a file of that name there is replaced, one that is gone was moved before."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(folder)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(src):
        return
    fs.mkdirs(dst)
    to = jvm.org.apache.hadoop.fs.Path(dst, src.getName())
    fs.delete(to, False)
    if not fs.rename(src, to):
        raise OSError(f"{path} could not be moved to {folder}")


def waves(spans: Sequence[tuple[_dt.date | None, _dt.date | None]]) -> list[int]:
    """Wave of each file, in order: one behind the last earlier file whose span overlaps its own.

    Files of a wave have disjoint spans; overlapping files keep their order.  Undated files are only added, so they overlap none."""
    out: list[int] = []
    for i, (lo, hi) in enumerate(spans):
        before = [out[j] for j in range(i) if lo is not None and spans[j][0] is not None and lo <= spans[j][1] and spans[j][0] <= hi]
        out.append(1 + max(before, default=-1))
    return out


def ingest_drop(spark: SparkSession, inbox: str, archive: str, checkpoint: str, table_dir: str,
                errors_dir: str, feed: str, schema: T.StructType,
                transform: Callable[[DataFrame], DataFrame], source: str,
                disciplines: Sequence[str] | None = None, sep: str = ",",
                files_per_batch: int = 64, fmt: str = "csv", sheet_head: int = 10, sheet_tail: int = 3,
                valid: Column | None = None, unit: str = "day", multi_line: bool = True, together: bool = False) -> DataFrame:
    """Runs until the inbox holds no new file and returns the log of this checkpoint, a row per file seen.

    ``fmt='csv'``: delimited files with a header.  ``fmt='sheet'``: exported
    sheets, trimmed by line position per file (header + skipped rows, footer).
    ``valid``: what every row of a file must meet, besides parsing.  ``unit``:
    the table's partition period.  A micro-batch takes ``files_per_batch`` files.
    ``together``: ``transform`` carries the column FILE_TAG along, as the feeds' loads do, so it is
    called on the rows of all files at once; else it gets the rows of one file at a time.
    """
    log_dir = f"{checkpoint.rstrip('/')}-log"

    def read(files: list[str]) -> tuple[DataFrame, dict[str, str]]:
        """Rows of all files with their file's name and the corrupt-record column, and the files whose header is refused."""
        if fmt == "sheet":
            rows = parse_sheet(numbered_lines(spark, files), sheet_head, sheet_tail, schema, sep, CORRUPT)
            return rows.withColumnRenamed("file_name", FILE_TAG), {}
        layouts, refused, _ = header_layouts(spark, files, schema.fieldNames(), sep)
        rows = read_layouts(spark, layouts, schema, sep, multi_line=multi_line, lanes=True)
        return rows.withColumn(FILE_TAG, F.col("_metadata.file_name")).drop("_metadata"), {_name(f): p for f, p in refused.items()}

    def load_batch(arrived: DataFrame, batch_id: int) -> None:
        files = arrived.select("path", file_stem(F.element_at(F.split("path", "/"), -1)).alias("stem"))
        paths = {_name(r["path"]): r for r in files.withColumn("fine", valid_drop_file("stem", feed)).collect()}      # files of one batch
        log = {f: (REFUSED, "the name has no calendar date", None, None, None, None) for f, r in paths.items() if not r["fine"]}
        named = sorted(set(paths) - set(log))
        if named:
            rows, badly_headed = read([paths[f]["path"] for f in named])
            log |= {f: (REFUSED, f"header: {problem}", None, None, None, None) for f, problem in badly_headed.items()}
            rows = rows.persist()           # parsed once; lost blocks are parsed again
            log |= load(rows, [f for f in named if f not in log])
            rows.unpersist()
        # Written before any file moves; a replay of the batch writes its rows again.
        spark.createDataFrame([(f, *entry) for f, entry in sorted(log.items())], LOG).coalesce(1).write.mode("overwrite").json(f"{log_dir}/batch={batch_id}")
        for f, (outcome, *_) in log.items():
            if outcome != EMPTY:
                _move(spark, paths[f]["path"], archive if outcome == LOADED else errors_dir)

    def load(rows: DataFrame, files: list[str]) -> dict[str, tuple]:
        """Loads the fine ones of ``files``, wave by wave; the log entry of each."""
        torn = F.col(CORRUPT).isNotNull()
        wrong = F.lit(False) if valid is None else ~F.coalesce(valid, F.lit(False))
        counts = {r[FILE_TAG]: r for r in rows.groupBy(FILE_TAG).agg(
            F.count("*").alias("n"), F.count_if(torn).alias("torn"), F.count_if(~torn & wrong).alias("wrong")).collect()}
        log = {f: (EMPTY, "no rows", 0, None, None, None) for f in files if f not in counts}
        log |= {f: (REFUSED, f"{r['torn']} lines do not fit, {r['wrong']} rows are not valid", r["n"], None, None, None)
                for f, r in counts.items() if r["torn"] or r["wrong"]}
        fine = [f for f in files if f not in log]
        if not fine:
            return log
        rows = rows.drop(CORRUPT)
        groups = [fine] if together else [[f] for f in fine]
        ready = [transform(of if together else of.drop(FILE_TAG)) for of in (rows.filter(F.col(FILE_TAG).isin(group)) for group in groups)]
        if not together:
            ready = [of.withColumn(FILE_TAG, F.lit(f)) for of, f in zip(ready, fine)]
        # The span of a file is that of its rows after the transformation, as the slice is.
        spans = {r[FILE_TAG]: r for of in ready for r in of.groupBy(FILE_TAG).agg(
            F.min(DATE_COL).alias("lo"), F.max(DATE_COL).alias("hi"), F.count("*").alias("n"), F.count(DATE_COL).alias("dated")).collect()}
        left = [f for f in fine if f in spans]
        log |= {f: (LOADED, "no row of the feed", 0, None, None, None) for f in fine if f not in spans}
        wave_of = dict(zip(left, waves([(spans[f]["lo"], spans[f]["hi"]) for f in left])))
        for wave in range(max(wave_of.values(), default=-1) + 1):
            here = [f for f in left if wave_of[f] == wave]
            slices = [(spans[f]["lo"], spans[f]["hi"]) for f in here if spans[f]["dated"]]
            undated = any(spans[f]["dated"] < spans[f]["n"] for f in here)
            of_wave = [of.filter(F.col(FILE_TAG).isin(here)) for of, group in zip(ready, groups) if set(group) & set(here)]
            batch = reduce(DataFrame.unionByName, of_wave).drop(FILE_TAG)
            # A file read by one task is a run of neighbouring days as it lies there; only files that split are brought together.
            reload_spans(spark, table_dir, batch, source, slices, disciplines, unit, undated, None, multi_line and fmt == "csv")
            log |= {f: (LOADED, None, spans[f]["n"], spans[f]["lo"], spans[f]["hi"], wave) for f in here}
        return log

    stream = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", drop_glob(feed)).option("maxFilesPerTrigger", files_per_batch)
              .option("ignoreMissingFiles", True).load(inbox).select("path", "length"))
    q = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return drop_log(spark, checkpoint)


def _name(path: str) -> str:
    """File name of a path; names within an inbox are unique."""
    return path.rsplit("/", 1)[-1]


def drop_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(file, outcome, reason, row_count, dt_min, dt_max, wave) of every file that the checkpoint's runs saw."""
    log_dir = f"{checkpoint.rstrip('/')}-log"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(log_dir)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).json(f"{log_dir}/batch=*")
