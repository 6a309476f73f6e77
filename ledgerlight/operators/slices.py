"""Slice maintenance of the canonical table.

The source deletes a (source, date range[, discipline]) slice, appends the new
batch, then runs UPDATEs.  Here the rows after the reload are computed as

    kept  = target rows outside the slice   (anti-filter, literal bounds)
    new   = kept UNION ALL batch            (batch already classified)

for the (source, period) partitions that the slice touches.  Literal bounds
prune the read to those.  The new partitions are written once, to a staged
folder inside the table (hidden from readers by its name), and then published
one by one from a list that is stored before the first of them moves: a load
that fails before the list leaves the table as it was, one that fails behind it
is completed by the next load, or by ``recover``.  Publishing is atomic per
partition, not per table.  Stored files of which the slice deletes no row are not
written again: they move into the partition that replaces theirs.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from typing import Callable, Mapping, NamedTuple, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookups import unique_lookup

DATE_COL = "DAT_REFERENCIA"
SOURCE_COL = "NOM_ORIGEM_DADOS"
DISCIPLINE_COL = "NOM_DISCIPLINA"


def batch_span(batch: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """One-row min and max reference date of a batch."""
    return batch.agg(F.min(date_col).alias("dt_min"), F.max(date_col).alias("dt_max"))


def span_values(batch: DataFrame, date_col: str = DATE_COL):
    """The span as driver literals (one aggregate row)."""
    r = batch_span(batch, date_col).first()
    return r["dt_min"], r["dt_max"]


def slice_predicate(source: str, lo, hi, disciplines: Sequence[str] | None = None) -> Column:
    pred = F.col(DATE_COL).between(F.lit(lo), F.lit(hi)) & (F.col(SOURCE_COL) == F.lit(source))
    if disciplines:
        pred = pred & F.col(DISCIPLINE_COL).isin(list(disciplines))
    return pred


def delete_slice(target: DataFrame, source: str, lo, hi, disciplines: Sequence[str] | None = None) -> DataFrame:
    """Rows that survive the DELETE (an unknown predicate keeps the row)."""
    return target.filter(~F.coalesce(slice_predicate(source, lo, hi, disciplines), F.lit(False)))


def replace_slice(target: DataFrame | None, batch: DataFrame, source: str,
                  disciplines: Sequence[str] | None = None, span=None) -> DataFrame:
    """Kept target rows plus the batch.  ``target=None`` is the first load
    (the table does not exist yet, nothing to delete).  A batch without any
    date has no span: nothing is deleted, its rows (if any) are added."""
    if span is None:
        span = span_values(batch)
    lo, hi = span
    if target is None:
        return batch
    if lo is None:
        return target.unionByName(batch)
    return delete_slice(target, source, lo, hi, disciplines).unionByName(batch)


def update_slice(target: DataFrame, source: str, lo, hi, disciplines: Sequence[str] | None = None,
                 device: bool = True, advertiser: bool = True, vehicle: bool = False, names: Mapping[str, str] | None = None) -> DataFrame:
    """The class-function UPDATE restricted to one slice of an existing table; ``names`` as in ``apply_class_functions``."""
    from ..plans.feeds import apply_class_functions
    return apply_class_functions(target, device=device, advertiser=advertiser, vehicle=vehicle, names=names,
                                 where=F.coalesce(slice_predicate(source, lo, hi, disciplines), F.lit(False)))


class Initiatives(NamedTuple):
    """The initiative lookup, one row per upper-cased URL and initiative, stored; ``small``: it fits any task."""
    rows: DataFrame
    small: bool


SMALL_LOOKUP = 4 * 1024 * 1024             # bytes of the stored lookup


def store_initiatives(spark: SparkSession, initiatives: DataFrame, path: str) -> Initiatives:
    """Stores the lookup of J11 once for all updates of a load.  How large it is tells its file, not the table it is
    derived from: the stored rows are shuffled for it only if it is large."""
    from ..sources.sinks import stage
    cols = {c.lower(): c for c in initiatives.columns}
    url, name = F.upper(F.col(cols["url"])), F.upper(F.col(cols["iniciativa"]))
    # A URL that comes twice stays there twice, whatever its initiatives: it fails the rows that meet it.
    lookup = (initiatives.filter(url.isNotNull()).groupBy(url.alias("URL")).agg(F.count("*").alias("n"), F.min(name).alias("INICIATIVA"))
              .select("URL", "INICIATIVA", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(2)))).alias("n")).drop("n"))
    stored = stage(spark, lookup, path)
    fs, root = _fs(spark, path)
    return Initiatives(stored, fs.getContentSummary(root).getLength() <= SMALL_LOOKUP)


def update_initiative(target: DataFrame, initiatives: DataFrame | Initiatives, url_col: str = "URL",
                      initiative_col: str = "INICIATIVA") -> DataFrame:
    """``SET NOM_INICIATIVA = UPPER(INICIATIVA) WHERE NOM_URL = UPPER(URL)``
    over the whole table.  The lookup must be unique on ``UPPER(URL)``; a target
    row that meets a duplicated key fails the job."""
    initiatives, small = initiatives if isinstance(initiatives, Initiatives) else (initiatives, False)
    cols = {c.lower(): c for c in initiatives.columns}
    lk = initiatives.select(F.upper(F.col(cols[url_col.lower()])).alias("__url"),
                            F.upper(F.col(cols[initiative_col.lower()])).alias("__ini"))
    j = unique_lookup(target, "NOM_URL", lk, "__url", ["__ini"],
                      "UPDATE/MERGE must match at most one source row for each target row", small)
    out = [F.when(F.col("__matched"), F.col("__ini")).otherwise(F.col(c)).alias(c) if c == "NOM_INICIATIVA"
           else F.col(c) for c in target.columns]
    return j.select(*out)


def high_water_mark(target: DataFrame, source: str | None = None, days: int = 7,
                    default: str = "1900-01-01") -> Column:
    """S17 as an aggregate expression: max date of a source minus ``days``,
    or ``default`` when there is none.  Use inside ``target.agg(...)``."""
    d = F.col(DATE_COL)
    if source is not None:
        d = F.when(F.col(SOURCE_COL) == F.lit(source), d)
    return F.coalesce(F.date_sub(F.max(d), days), F.lit(default).cast("date"))


# ---------------------------------------------------------------------------
# The stored table, partitioned by (source, period)
# ---------------------------------------------------------------------------
# A period is a day, for feeds that reload a few days at a time, or a month,
# for loads of whole histories; a table keeps one unit.
PERIOD_COL = "PERIODO"                     # first day of the reference date's period
PARTITION_COLS = (SOURCE_COL, PERIOD_COL)
DAY, MONTH = "day", "month"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def with_period(df: DataFrame, unit: str = DAY) -> DataFrame:
    return df.withColumn(PERIOD_COL, _period(F.col(DATE_COL), unit))


def _period(day: Column, unit: str) -> Column:
    return F.trunc(day, "month") if unit == MONTH else day


def _has_partitions(fs, root) -> bool:
    """True when the table folder holds at least one source partition (first-load guard)."""
    if not fs.exists(root):
        return False
    return any(st.getPath().getName().startswith(f"{SOURCE_COL}=") for st in fs.listStatus(root))


def _table(spark: SparkSession, table_dir: str, columns: Sequence[str] | None = None) -> DataFrame | None:
    """The stored rows with their period as a date, or None before the first load."""
    fs, root = _fs(spark, table_dir)
    if not _has_partitions(fs, root):
        return None
    stored = spark.read.parquet(table_dir)
    return stored.select(*[F.col(c).cast("date").alias(c) if c == PERIOD_COL else F.col(c) for c in columns or stored.columns])


# ---------------------------------------------------------------------------
# Staged write and publication
# ---------------------------------------------------------------------------
STAGED = "_staged"                         # file sources skip names that begin with an underscore
PUBLISH_LIST = "publish.json"


def _partition_dirs(fs, root) -> list[str]:
    """(source, period) folders below ``root``, relative to it."""
    out = []
    if not fs.exists(root):
        return out
    for src in fs.listStatus(root):
        if src.getPath().getName().startswith(f"{SOURCE_COL}="):
            out += [f"{src.getPath().getName()}/{p.getPath().getName()}" for p in fs.listStatus(src.getPath())
                    if p.getPath().getName().startswith(f"{PERIOD_COL}=")]
    return out


OPEN_WRITERS = 32                          # partitions that a task writes side by side; rows of more are sorted first


@contextmanager
def _side_by_side(spark: SparkSession):
    """Tasks that hold few partitions write them as they come, instead of sorting their wide rows by partition."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, OPEN_WRITERS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _together(rows: DataFrame, clustered: bool) -> DataFrame:
    """Rows that are not ``clustered`` yet, brought together by partition; the rebalance hint lets AQE split a hot period."""
    return rows if clustered else rows.hint("rebalance", *PARTITION_COLS)


def _write(rows: DataFrame, path: str, mode: str = "append") -> None:
    with _side_by_side(rows.sparkSession):
        rows.write.mode(mode).partitionBy(*PARTITION_COLS).parquet(path)


def clustered_by_period(df: DataFrame, date_col: str, unit: str = DAY) -> DataFrame:
    """Rows of a landing with those of a period together, while they are narrow: text that is no date goes anywhere,
    as the load decides on it.  The canonical rows of the result need no shuffle before they are written."""
    day = F.col(f"`{date_col}`").cast("string")
    period = _period(F.coalesce(day.try_cast("date"), F.try_to_date(day, "yyyyMMdd")), unit)
    return df.withColumn("__period", period).hint("rebalance", "__period").drop("__period")


def _write_staged(spark: SparkSession, rows: DataFrame, table_dir: str) -> str:
    """Write the new partitions once, beside the ones they will replace."""
    staged = f"{table_dir.rstrip('/')}/{STAGED}/{uuid.uuid4().hex[:12]}"
    _write(rows, staged, "error")
    return staged


SMALL_FILE = 64 * 1024                     # bytes; smaller files are written again with the batch, or each load would leave more of them


class Stored(NamedTuple):
    """Files of a slice by partition folder: those that stay as they are, and the others."""
    spared: dict[str, list[str]]
    read: dict[str, list[str]]


def _stored_files(touched: DataFrame, gone: Column) -> tuple[Stored, list[str]]:
    """The files below ``touched``, and the paths of the spared ones: no row of them is ``gone``, and they are not small.

    Reads the columns of ``gone``; the driver gets one row per file of the slice."""
    files = touched.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).agg(F.count_if(gone).alias("gone")).collect()
    of, spared = Stored({}, {}), []
    for r in files:
        source, period, name = unquote(r["path"]).rsplit("/", 3)[1:]
        stays = not r["gone"] and r["size"] >= SMALL_FILE
        (of.spared if stays else of.read).setdefault(f"{source}/{period}", []).append(name)
        if stays:
            spared.append(r["path"])
    return of, spared


def _publish(spark: SparkSession, table_dir: str, staged: str, emptied: Sequence[str], files: Stored = Stored({}, {})) -> None:
    """Store the list of partitions to replace and to drop, then work it off.

    The list holds one name per partition of the slice, as the driver's listing of the table does, and one per spared file."""
    fs, root = _fs(spark, table_dir)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    replace = _partition_dirs(fs, path(staged))
    todo = {"replace": sorted(replace), "drop": sorted(set(emptied) - set(replace) - set(files.spared)),
            "carry": {name: files.spared[name] for name in replace if name in files.spared},
            "remove": [f"{name}/{f}" for name in files.spared if name not in replace for f in files.read.get(name, [])]}
    part = path(staged, PUBLISH_LIST + ".part")
    out = fs.create(part, True)
    out.write(json.dumps(todo).encode())
    out.close()
    if not fs.rename(part, path(staged, PUBLISH_LIST)):
        raise OSError(f"{staged}: the publish list could not be stored")
    _work_off(spark, table_dir, staged, todo)


def _work_off(spark: SparkSession, table_dir: str, staged: str, todo: dict) -> None:
    """Move every staged partition that is still there over the stored one; a rerun goes on where a failure stopped."""
    fs, root = _fs(spark, table_dir)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in todo["replace"]:
        new, old = path(staged, name), path(root, name)
        if fs.exists(new):                 # else it was published before the failure
            for f in todo.get("carry", {}).get(name, []):
                if fs.exists(path(old, f)) and not fs.rename(path(old, f), path(new, f)):
                    raise OSError(f"{name}/{f} could not be carried over")
            fs.delete(old, True)
            fs.mkdirs(old.getParent())
            if not fs.rename(new, old):
                raise OSError(f"{name} could not be published")
    for name in [*todo["drop"], *todo.get("remove", [])]:
        fs.delete(path(root, name), True)
    fs.delete(path(staged), True)


def recover(spark: SparkSession, table_dir: str) -> int:
    """Complete the publications that a failure stopped, and clear staged writes that never had a list.

    Every load begins with it.  A table takes one load at a time.  Returns the number of publications completed."""
    fs, root = _fs(spark, table_dir)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here, done = path(root, STAGED), 0
    if not fs.exists(here):
        return 0
    for st in fs.listStatus(here):
        listed = path(st.getPath(), PUBLISH_LIST)
        if fs.exists(listed):
            todo = json.loads("\n".join(r.value for r in spark.read.text(listed.toString()).collect()))
            _work_off(spark, table_dir, st.getPath().toString(), todo)
            done += 1
        else:
            fs.delete(st.getPath(), True)
    return done


def append_rows(rows: DataFrame, table_dir: str, unit: str = DAY, clustered: bool = False) -> None:
    """A plain append; nothing that is stored is read or rewritten."""
    _write(_together(with_period(rows, unit), clustered), table_dir)


def reload_slice(spark: SparkSession, table_dir: str, batch: DataFrame, source: str,
                 disciplines: Sequence[str] | None = None, unit: str = DAY, finish: Callable[[DataFrame], DataFrame] | None = None,
                 clustered: bool = False) -> tuple | None:
    """S14 on the table partitioned by (NOM_ORIGEM_DADOS, period): ``reload_spans`` for the batch's own span.

    Returns the span, or None for an empty batch; the span of a batch without
    any date is (None, None) and its rows are only added.
    """
    r = batch.agg(F.min(DATE_COL).alias("lo"), F.max(DATE_COL).alias("hi"), F.count("*").alias("n"), F.count(DATE_COL).alias("dated"),
                  F.count_if(~F.col(SOURCE_COL).eqNullSafe(F.lit(source))).alias("strange")).first()
    if r["strange"]:
        raise ValueError(f"{r['strange']} rows of the batch are not of source {source}")
    if not r["n"]:
        recover(spark, table_dir)
        return None
    spans = [(r["lo"], r["hi"])] if r["lo"] is not None else []
    reload_spans(spark, table_dir, batch, source, spans, disciplines, unit, undated=r["dated"] < r["n"], finish=finish, clustered=clustered)
    return r["lo"], r["hi"]


def reload_spans(spark: SparkSession, table_dir: str, batch: DataFrame, source: str, spans: Sequence[tuple],
                 disciplines: Sequence[str] | None = None, unit: str = DAY, undated: bool = True,
                 finish: Callable[[DataFrame], DataFrame] | None = None, clustered: bool = False) -> None:
    """Replace the slices of ``spans``, which must not overlap, by the rows of ``batch``, in one write.

    ``finish``: an update of the stored rows that the written partitions, kept rows and batch, get in the same write.
    ``clustered``: the batch's rows of a period lie together already (``clustered_by_period``) and ``finish`` leaves
    them so, so nothing is shuffled: the kept rows lie together as they are stored.

    Work is proportional to the slices, not the table: only the partitions of
    ``source`` inside the spans (and the undated one, if the batch has undated
    rows) are read, and every row is written once.  Files that no DELETE hits
    (other disciplines of a partner, as a rule) are neither read in full nor written,
    unless they are small, or ``finish`` may change their rows.

    1. read the touched partitions (partition pruning on literal bounds) and
       keep the rows that no DELETE hits (other disciplines, other days of a
       month, undated rows: an unknown predicate deletes nothing);
    2. write kept + batch to a staged folder; nothing that is read is replaced;
    3. publish its partitions, and drop the touched ones that got no row.

    A rerun after a failure at any step converges to the same dated rows.
    """
    recover(spark, table_dir)
    batch = with_period(batch, unit)
    target, out, stored, files = _table(spark, table_dir, batch.columns), batch, [], Stored({}, {})
    if target is not None:
        here = F.lit(False)
        for lo, hi in spans:
            here = here | F.col(PERIOD_COL).between(_period(F.lit(lo), unit), F.lit(hi))
        if undated:
            here = here | F.col(PERIOD_COL).isNull()
        kept = target.filter((F.col(SOURCE_COL) == F.lit(source)) & here)
        if finish is None:
            gone = F.lit(False)
            for lo, hi in spans:
                gone = gone | F.coalesce(slice_predicate(source, lo, hi, disciplines), F.lit(False))
            files, spared = _stored_files(kept, gone)
            if spared:                     # a filter on the listing: these files are not opened
                kept = kept.filter(~F.col("_metadata.file_path").isin(spared))
        for lo, hi in spans:
            kept = delete_slice(kept, source, lo, hi, disciplines)
        out = kept.unionByName(batch)
        fs, root = _fs(spark, table_dir)
        first = [(f"{lo:%Y-%m}-01" if unit == MONTH else f"{lo}", f"{hi}") for lo, hi in spans]
        for name in _partition_dirs(fs, root):
            src, _, day = unquote(name).removeprefix(f"{SOURCE_COL}=").partition(f"/{PERIOD_COL}=")
            if src == source and any(lo <= day <= hi for lo, hi in first):
                stored.append(name)
    _publish(spark, table_dir, _write_staged(spark, _together(finish(out) if finish else out, clustered), table_dir), stored, files)


def reload_initiative(spark: SparkSession, table_dir: str, initiatives: DataFrame | Initiatives) -> int:
    """J11 on the stored table; returns the number of partitions rewritten.

    The partitions with a changed row are found from two columns (URL and
    initiative); only they are then read with all their columns, updated, and
    written once.  Their list, one (source, period) each, is a literal filter,
    so the wide read is pruned to them.
    """
    recover(spark, table_dir)
    target = _table(spark, table_dir)
    narrow = target.select(*PARTITION_COLS, "NOM_URL", "NOM_INICIATIVA", F.col("NOM_INICIATIVA").alias("__old"))
    changed = (update_initiative(narrow, initiatives).filter(~F.col("NOM_INICIATIVA").eqNullSafe(F.col("__old")))
               .select(*PARTITION_COLS).distinct().collect())          # one row a partition
    if not changed:
        return 0
    periods: dict = {}
    for r in changed:
        periods.setdefault(r[SOURCE_COL], []).append(r[PERIOD_COL])
    touched = F.lit(False)
    for source, days in periods.items():
        at = F.col(PERIOD_COL).isin([d for d in days if d is not None])
        at = at | F.col(PERIOD_COL).isNull() if None in days else at
        touched = touched | (F.col(SOURCE_COL).eqNullSafe(F.lit(source)) & at)
    rows = update_initiative(target.filter(touched), initiatives)
    # Stored rows lie together by partition; only the join with a large lookup scatters them.
    clustered = isinstance(initiatives, Initiatives) and initiatives.small
    _publish(spark, table_dir, _write_staged(spark, _together(rows, clustered), table_dir), [])
    return len(changed)


def read_table(spark: SparkSession, table_dir: str, columns: Sequence[str] | None = None) -> DataFrame | None:
    fs, root = _fs(spark, table_dir)
    if not _has_partitions(fs, root):
        return None
    df = spark.read.parquet(table_dir)
    return df.select(*columns) if columns else df.drop(PERIOD_COL)
