"""Canonical advertising table: align, prefix-driven cast, upper-case, stamp."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The canonical column list, in the target table's order.
CANONICAL_COLUMNS = (
    "NOM_ORIGEM_DADOS", "DAT_REFERENCIA", "NOM_ANUNCIANTE", "NOM_SITE", "NOM_AD", "NOM_DISCIPLINA",
    "NOM_CAMPANHA", "NOM_CAMPANHA_LP", "NOM_ORIGEM", "NOM_MIDIA", "NOM_INICIATIVA", "TIP_CANAL",
    "TIP_COMPRA", "TIP_ESTRATEGIA", "TIP_FORMATO", "NOM_CRIATIVO", "NOM_SEGMENTACAO", "NOM_PILAR",
    "TIP_DEVICE", "QTD_IMPRESSOES", "QTD_CLIQUES", "QTD_VISITAS", "QTD_NOVOS_USUARIOS", "QTD_REJEICOES",
    "QTD_TEMPO_SESSAO", "QTD_PAGEVIEWS", "QTD_TRECHOS", "QTD_TRANSACOES", "VAL_VENDA",
    "VAL_INVESTIMENTO", "VAL_INVEST_DESEMBOLSADO", "QTD_BUSCAS", "QTD_VIEWS_PLAY", "QTD_VIEWS_25",
    "QTD_VIEWS_50", "QTD_VIEWS_75", "QTD_VIEWS_100", "VAL_GA_VENDAS", "QTD_GA_TRECHOS",
    "QTD_GA_TRANSACOES", "NOM_GRUPO_ANUNCIO", "NOM_PALAVRA_CHAVE", "HOR_REFERENCIA", "NOM_REGIAO",
    "QTD_ALCANCE", "QTD_IMPRESSOES_VISIVEIS", "QTD_IMPRESSOES_MENSURAVEIS", "NOM_DOMINIO_VEICULADO",
    "NOM_URL",
)
LOAD_STAMP = "DAT_INSERCAO"


def column_type(name: str) -> T.DataType:
    """Type of a canonical column, decided by its name prefix."""
    p = name[:3]
    if p == "QTD":
        return T.LongType()
    if p == "VAL":
        return T.DoubleType()
    if p == "DAT":
        return T.DateType()
    if p == "HOR":
        return T.TimestampNTZType()
    return T.StringType()


CANONICAL_SCHEMA = T.StructType([T.StructField(c, column_type(c), True) for c in CANONICAL_COLUMNS])


def align(exprs: Mapping[str, Column]) -> list[Column]:
    """One expression per canonical column; absent columns are typed nulls."""
    out = []
    for name in CANONICAL_COLUMNS:
        e = exprs.get(name)
        out.append((e if e is not None else F.lit(None)).alias(name))
    return out


def _to_date(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    s = c.cast("string")
    # ISO text takes the plain cast; compact yyyyMMdd text is parsed only when that fails.
    # Text that is no date fails the job, as the source's cast does; blank text is no value.
    bad = F.when(F.trim(s) != "", F.raise_error(F.concat(F.lit("not a date: "), s)))
    return F.coalesce(s.try_cast("date"), F.try_to_date(s, "yyyyMMdd"), bad.cast("date"))


def _to_time(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return c.cast("timestamp_ntz")
    s = c.cast("string")
    return F.to_timestamp_ntz(F.concat(F.lit("1900-01-01 "), s), F.lit("yyyy-MM-dd HH:mm"))


#: Name of the file a landed row came from, carried through a load that takes several files at once.
FILE_TAG = "__file"


def _to_count(c: Column, dtype: T.DataType) -> Column:
    """Whole numbers keep all digits; others truncate toward zero."""
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    whole = c.try_cast("long") if isinstance(dtype, T.StringType) else F.lit(None).cast("long")
    return F.coalesce(whole, c.cast("double").cast("long"), F.lit(0).cast("long"))


def cast_by_prefix(df: DataFrame) -> DataFrame:
    """P2+P3: prefix-driven fill and cast, then upper-case every text column.

    ``QTD*`` -> long, null -> 0, fractional values truncate toward zero;
    ``VAL*`` -> double, null -> 0.0; ``DAT*`` -> date (``yyyy-MM-dd`` or
    ``yyyyMMdd``); ``HOR*`` -> time of day on 1900-01-01; text -> upper case.
    One projection; no shuffle.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in df.columns:
        c, dt = F.col(name), types[name]
        p = name[:3]
        if name == FILE_TAG:
            e = c
        elif p == "QTD":
            e = _to_count(c, dt)
        elif p == "VAL":
            e = F.coalesce(c.cast("double"), F.lit(0.0))
        elif p == "DAT" and name != LOAD_STAMP:
            e = _to_date(c, dt)
        elif p == "HOR":
            e = _to_time(c, dt)
        elif isinstance(dt, (T.StringType, T.NullType)):
            e = F.upper(c.cast("string"))
        else:
            e = c
        cols.append(e.alias(name))
    return df.select(*cols)


def stamp(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Add the load timestamp (pass a literal to keep runs reproducible)."""
    return df.withColumn(LOAD_STAMP, ts if ts is not None else F.localtimestamp())


def canonicalize(exprs: Mapping[str, Column], source: DataFrame) -> DataFrame:
    """Align + cast + upper in one narrow projection over ``source``; a file tag is carried along."""
    carried = [F.col(FILE_TAG)] if FILE_TAG in source.columns else []
    return cast_by_prefix(source.select(*align(exprs), *carried))
