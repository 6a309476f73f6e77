"""Secret scan with corpus-wide ownership frequency (operator 6), in DataFrame functions only.

Patterns find candidates. The hash of each candidate's value is counted over
the corpus by distinct owners (sources) and, within an owner, by distinct
repositories (different texts; exact copies are one). A value that COPIED_OWNERS
owners hold, or that COPIED_REPOSITORIES repositories of one owner hold, is a
widely copied example: no credential is pasted into so many different texts.
One that fewer hold and that looks random is live-looking. Spans of the
contract's own patterns are always reported; those of the further token formats
only if live-looking.

Match positions come from the engine's own regular expressions: matches are
fenced with \\x01 (a \\x01 of the text counts as \\x02, which no pattern
knows), the text is split at the fences, and lengths before a match add up.

Defined results: a null or empty text has no span and the hash of an empty
string; very long texts are scanned whole; of matches that start together the
kind listed first comes first; repeated rows each get a row and count as one
repository; a null source is an owner; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, text_of

# The contract's kinds, in order: (kind, pattern, group with the value, least length of that group).
BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
# Public token formats that the method adds, one kind.
FORMATS = (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----|(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{30,}|"
           r"xox[abprs]-[A-Za-z0-9-]{16,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|"
           r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})")
KINDS = [k for k, *_ in BASE] + ["format"]
COPIED_OWNERS = 3       # a value held by so many owners is a copied example
COPIED_REPOSITORIES = 20    # and one that so many different texts of an owner hold
LEAST_SYMBOLS = 8       # distinct characters of a live-looking value
SALTS = 16
FENCE = "\x01"


def _bound(x: Column, use) -> Column:
    """use(x) with x evaluated once."""
    return F.get(F.transform(F.array(x), use), 0)


def _running(values: Column, merge, use) -> Column:
    """use(before), where before(k) merges the first k values; block by block, so n calls take n * sqrt-like steps."""
    zero = F.lit(0)

    def over(v: Column) -> Column:
        blocks = F.transform(F.sequence(zero, F.shiftright(F.size(v), 8)), lambda b: F.aggregate(F.slice(v, b * 256 + 1, 256), zero, merge))
        heads = F.aggregate(blocks, F.array(zero), lambda a, x: F.concat(a, F.array(merge(F.element_at(a, -1), x))))
        return _bound(heads, lambda h: use(lambda k: merge(
            F.get(h, F.shiftright(k, 8)), F.aggregate(F.slice(v, k - k % 256 + 1, k % 256), zero, merge))))
    return _bound(values, over)


def _spans(text: Column, no: int, pattern: str, group: int, least: int) -> Column:
    """array<(start, end, kind, h, symbols)> of one kind's matches, in code points, end exclusive."""
    parts = F.split(F.regexp_replace(text, pattern, FENCE + "$0" + FENCE), FENCE, -1)

    def each(parts: Column) -> Column:
        def span(k: Column, start: Column) -> Column:
            seg = F.get(parts, k)
            value = F.regexp_extract(seg, pattern, group) if group else seg
            return F.struct(start.alias("start"), (start + F.length(seg)).alias("end"), F.lit(no).alias("kind"),
                            F.xxhash64(value).alias("h"), F.length(value).alias("n"),
                            F.size(F.array_distinct(F.split(value, ""))).alias("symbols"))
        odd = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: k % 2 == 1)
        return F.filter(_running(F.transform(parts, F.length), lambda a, x: a + x, lambda before: F.transform(odd, lambda k: span(k, before(k)))),
                        lambda s: s["n"] >= least)
    return _bound(parts, each)


def candidates(text: Column) -> Column:
    """All candidates of a text: base kinds, then the added formats; sorted by start, then kind."""
    clean = F.when(F.instr(text, FENCE) > 0, F.translate(text, FENCE, "\x02")).otherwise(text)
    kinds = [_spans(clean, i, p, g, n) for i, (_, p, g, n) in enumerate(BASE)] + [_spans(clean, len(BASE), FORMATS, 0, 1)]
    return F.array_sort(F.concat(*kinds))


def copied_values(found: DataFrame, owners: int = COPIED_OWNERS, repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """(h): values that at least so many distinct owners, or repositories of one owner, hold, from (rid, owner, repo, spans)."""
    held = found.select("owner", "repo", F.explode(F.array_distinct(F.col("spans.h"))).alias("h")).distinct()
    by_owner = held.groupBy("h", "owner").agg(F.count("*").alias("repositories"))       # partial sums keep a hot value small
    held_by = by_owner.groupBy("h").agg(F.count("*").alias("owners"), F.max("repositories").alias("repositories"))
    return held_by.filter((F.col("owners") >= owners) | (F.col("repositories") >= repositories))


def with_copied(found: DataFrame, owners: int = COPIED_OWNERS) -> DataFrame:
    """``found`` with ``copied``: the hashes of its copied values (null if none). Hot values are salted."""
    salted = copied_values(found, owners).select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    held = found.select("rid", F.explode(F.array_distinct(F.col("spans.h"))).alias("h")).withColumn("salt", (F.col("rid") % SALTS).cast("int"))
    return found.join(held.join(salted, ["h", "salt"]).groupBy("rid").agg(F.collect_list("h").alias("copied")), "rid", "left")


def _live(s: Column) -> Column:
    return (s["symbols"] >= LEAST_SYMBOLS) & ~F.coalesce(F.array_contains(F.col("copied"), s["h"]), F.lit(False))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(spark: SparkSession, docs: DataFrame, owner_col: str = "source", owners: int = COPIED_OWNERS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied) for every row of ``docs``."""
    found = stored(spark, docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col(f"`{owner_col}`").cast("string").alias("owner"),
                                      F.xxhash64(text_of()).alias("repo"), candidates(text_of()).alias("spans")), "secret-spans")
    rows = with_copied(found, owners)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)], F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.filter("spans", lambda s: (s["kind"] < len(BASE)) | _live(s))).alias("spans"),
        F.size(F.filter("spans", _live)).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: F.coalesce(F.array_contains(F.col("copied"), s["h"]), F.lit(False)))).cast("long").alias("n_copied"))


def _without(text: Column, spans: Column, mask: str) -> Column:
    """Text with the spans (sorted by start, overlaps allowed) replaced by the mask."""
    def piece(s: Column, done: Column) -> Column:
        return F.when(s["start"] >= done, F.concat(F.substr(text, done + 1, s["start"] - done), F.lit(mask))).otherwise("")
    ends = F.transform(spans, lambda x: x["end"])
    pieces = _running(ends, lambda a, x: F.greatest(a, x), lambda done: F.transform(spans, lambda s, k: piece(s, done(k))))
    return F.concat(F.array_join(pieces, ""), F.substr(text, F.array_max(ends) + 1))


def redact_live(spark: SparkSession, docs: DataFrame, owner_col: str = "source", owners: int = COPIED_OWNERS,
                mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live-looking secret masked; n_chars, where there is one, follows the new text."""
    cols = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    found = stored(spark, docs.select(F.monotonically_increasing_id().alias("rid"), row.alias("d"), F.col(f"`{owner_col}`").cast("string").alias("owner"),
                                      F.xxhash64(text_of()).alias("repo"), candidates(text_of()).alias("spans")), "secret-docs")
    some = with_copied(found.filter(F.size("spans") > 0), owners).withColumn("live", F.filter("spans", _live))
    text = F.when(F.size("live") > 0, _without(F.col("d.text"), F.col("live"), mask)).otherwise(F.col("d.text"))
    new = {"text": F.col("new"), **({"n_chars": F.when(F.size("live") > 0, F.length("new")).otherwise(F.col("d.n_chars")).cast(docs.schema["n_chars"].dataType)}
                                    if "n_chars" in cols else {})}
    out = some.withColumn("new", text).select(*[new.get(c, F.col(f"d.`{c}`")).alias(c) for c in cols])
    return found.filter(F.size("spans") == 0).select("d.*").unionByName(out)
