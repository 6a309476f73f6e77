"""Small helpers shared by the operators of this subpackage.

Input rules used by every operator: only the named columns of an input are
read, so extra columns may carry any name; a null text is an empty text; an
empty table gives an empty result of the same schema; repeated rows are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table: A-Z to a-z, all else unchanged (UTF-8 safe).
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: One word: a maximal run without \x20 and \x09-\x0D.
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table in the shared folder and read it back."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Bound what one Arrow batch of whole texts holds in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def utf8_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls; offsets[0] is 0."""
    texts = texts.cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw, off - (off[0] if len(off) else 0)
