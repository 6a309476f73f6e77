"""URL filter with a path-template tree (operator 7), in DataFrame functions only.

Rules decide first; the longest rule that fits wins. The pages a rule decides
are the labelled rows of the method (or a label table given instead). Per host
the paths form a tree: segments with a digit become wildcards, rare children
of a wide node become wildcards, and branches whose labelled purity does not
differ from their siblings' are merged into the wildcard. A template is
rejected if its smoothed share of blocked pages is high and the lower
confidence bound of the share itself is above LOWER, which takes four labelled
pages at least.

The tree is grown over distinct path shapes with counts, not over pages, so a
host that holds a third of all pages is rows of its shapes. A round skips what
all paths of a node share and branches at the first segment that differs, so
rounds go with the branchings, not with the length of paths. A node is grown as
long as it has both labelled and other pages, or pages of both labels, and its
paths differ: a template never joins a blocked branch and an unlabelled one, at
whatever depth they part. Nodes without any label are grown for NAMED rounds, so
that their pages get a telling template; their verdict is allow however they are cut.

Defined results: a null url or one without `://` has an empty host and path,
no rule and verdict allow; very long paths are read whole; of rules that fit
equally long ones cannot differ; repeated rows each get a row and count as
pages of their own; pages of a node that is not grown share the template that
ends in `/**`; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, stored

# Fixed values: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
WIDE = 16           # children of a node from which rare ones become a wildcard
RARE = 0.02         # share of the node's pages below which a child is rare
SIMILAR_Z = 1.96    # branches that differ by less are similar
PRIOR = 4.0         # pages of prior weight in a smoothed purity
REJECT = 0.8        # smoothed purity of a template that is rejected
NAMED = 8           # branchings to which pages without labels are told apart
LOWER = 0.5         # and what the lower bound of its purity must exceed


def host_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)


def rule_columns(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return rule, verdict


def _shared(lo: Column, hi: Column) -> Column:
    """Number of leading segments that two arrays share; of the smallest and largest of several, that all share."""
    same = F.zip_with(F.slice(lo, 1, F.least(F.size(lo), F.size(hi))), F.slice(hi, 1, F.least(F.size(lo), F.size(hi))), lambda x, y: x == y)
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _rest(left: Column, start: Column) -> Column:
    """Segments of ``left`` from ``start`` (from 0) on."""
    return F.when(start < F.size(left), F.slice(left, start + 1, F.size(left))).otherwise(F.array().cast("array<string>"))


def _grow(spark: SparkSession, shapes: DataFrame) -> DataFrame:
    """Adds ``template`` to (host, shape, n, labelled, bad) rows, one branching of the tree at a time."""
    cur = shapes.withColumn("template", F.lit("")).withColumn("left", F.slice(F.split("shape", "/"), 2, F.size(F.split("shape", "/"))))
    for turn in itertools.count():
        node = cur.groupBy("host", "template").agg(*[F.sum(c).alias(f"p_{c}") for c in ("n", "labelled", "bad")], F.min("left").alias("lo"), F.max("left").alias("hi"))
        uniform = (F.col("p_labelled") == F.col("p_n")) & F.col("p_bad").isin(0, F.col("p_labelled"))
        if turn >= NAMED:
            uniform = uniform | (F.col("p_labelled") == 0)
        grown = node.filter(~uniform & (F.col("lo") != F.col("hi"))).withColumn("skip", _shared(F.col("lo"), F.col("hi"))).drop("lo", "hi")
        grown = stored(spark, grown, "url-nodes")
        if grown.isEmpty():
            break
        cut = cur.join(grown, ["host", "template"], "left")
        cut = cut.withColumn("base", F.when(F.col("skip") > 0, F.concat("template", F.lit("/"), F.array_join(F.slice("left", 1, F.greatest("skip", F.lit(0))), "/"))).otherwise(F.col("template")))
        cut = stored(spark, cut.withColumn("seg", F.get("left", F.col("skip"))), "url-cut")
        child = cut.filter("seg is not null").groupBy("host", "template", "seg", "p_n", "p_labelled", "p_bad").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
        kids = child.groupBy("host", "template").agg(F.count("*").alias("kids"))
        c = child.join(kids, ["host", "template"])
        rest = F.col("p_labelled") - F.col("labelled")
        pooled = F.col("p_bad") / F.greatest("p_labelled", F.lit(1))
        gap = F.abs(F.col("bad") / F.greatest("labelled", F.lit(1)) - (F.col("p_bad") - F.col("bad")) / F.greatest(rest, F.lit(1)))
        similar = ((F.col("labelled") >= PRIOR) & (rest >= PRIOR)
                   & (gap <= SIMILAR_Z * F.sqrt(pooled * (1 - pooled) * (1 / F.greatest("labelled", F.lit(1)) + 1 / F.greatest(rest, F.lit(1))))))
        rare = (F.col("kids") > WIDE) & (F.col("n") < RARE * F.col("p_n"))
        token = c.select("host", "template", "seg", F.when((F.col("seg") == "*") | similar | rare, "*").otherwise(F.col("seg")).alias("token"))
        cur = stored(spark, cut.join(token, ["host", "template", "seg"], "left").select(
            "host", "shape", "n", "labelled", "bad",
            F.when(F.col("token").isNull(), F.col("base")).otherwise(F.concat("base", F.lit("/"), "token")).alias("template"),
            F.when(F.col("skip").isNull(), F.col("left")).otherwise(_rest(F.col("left"), F.col("skip") + 1)).alias("left")), "url-tree")
    # What all paths of a node still share ends its template, and ** stands for what they do not.
    ends = cur.groupBy("host", "template").agg(F.min("left").alias("lo"), F.max("left").alias("hi"))
    shared = F.slice("lo", 1, _shared(F.col("lo"), F.col("hi")))
    tail = F.concat(F.when(F.size(shared) > 0, F.concat(F.lit("/"), F.array_join(shared, "/"))).otherwise(""), F.when(F.col("lo") != F.col("hi"), "/**").otherwise(""))
    ends = ends.select("host", "template", tail.alias("tail"))
    return cur.join(ends, ["host", "template"]).select("host", "shape", "n", "labelled", "bad", F.concat("template", "tail").alias("template"))


def lower_bound(bad: Column, labelled: Column) -> Column:
    """Lower end of the 95 % interval (Wilson) of a share; null of none."""
    z2 = SIMILAR_Z * SIMILAR_Z
    share = bad / labelled
    return (share + z2 / (2 * labelled) - SIMILAR_Z * F.sqrt(share * (1 - share) / labelled + z2 / (4 * labelled * labelled))) / (1 + z2 / labelled)


def judge(spark: SparkSession, pages: DataFrame, labels: DataFrame | None = None, url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of ``pages``.

    ``labels``: optional (page_id, bad boolean) used instead of the rules' own decisions.
    """
    host, path = host_path(F.col(f"`{url_col}`"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"))
    p = p.select("*", rule.alias("rule"), verdict.alias("ruled"))
    shape = F.array_join(F.transform(F.split(F.regexp_replace("path", "/+$", ""), "/"), lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s)), "/")
    p = stored(spark, p.withColumn("shape", shape), "url-pages")
    if labels is None:
        seen = p.withColumn("mark", F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("long")))
    else:
        own = labels.filter("page_id is not null and bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("mark"))
        seen = p.join(own, "page_id", "left")
    shapes = stored(spark, seen.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("mark").alias("labelled"),
                                                             F.coalesce(F.sum("mark"), F.lit(0)).alias("bad")), "url-shapes")
    tree = stored(spark, _grow(spark, shapes), "url-templates")
    all_ = tree.agg(F.sum("bad"), F.sum("labelled")).first()
    prior = (all_[0] or 0) / max(all_[1] or 0, 1)
    of_host = tree.groupBy("host").agg(((F.sum("bad") + PRIOR * F.lit(prior)) / (F.sum("labelled") + PRIOR)).alias("host_purity"))
    of_template = tree.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).join(of_host, "host")
    purity = (F.col("bad") + PRIOR * F.col("host_purity")) / (F.col("labelled") + PRIOR)
    sure = (F.col("labelled") > 0) & (lower_bound(F.col("bad"), F.greatest("labelled", F.lit(1))) > LOWER)
    judged = of_template.select("host", "template", purity.alias("purity"), ((purity >= REJECT) & sure).alias("rejected"))
    known = tree.select("host", "shape", "template").join(judged, ["host", "template"])
    out = p.join(known, ["host", "shape"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("ruled", F.when((F.col("host") != "") & F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "purity")
