"""Personal data by weak supervision (operator 2).

Every candidate span gets the votes of four labelers: the strict pattern, a
gazetteer of public prefixes and endings, cue words before it, and its shape.
Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is, without labels. The posteriors train the final span
classifier, a logistic regression per kind over features of the span (length,
digits, separators) and of its context (the characters around it, how near a cue
word for or against stands) beside the votes. Spans of the contract's patterns
are always kept; looser candidates only if the classifier says so.

The corpus enters both as counts of patterns (kind, votes, features), each with
few values, of which there is a fixed number, so any number of documents is
summed by Spark.

Defined results: a null or empty text has no span and the hash of an empty
string; very long texts are searched whole; spans that start together are
written by kind; repeated rows each get a row and count in the estimate; no
candidates at all leave the base spans, which then are none; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, stored, text_of

KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63})+")
DIGITS = re.compile(r"[^0-9]+")

# Gazetteers of public endings and prefixes, and cue words.
ENDINGS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info"}
ISSUERS = ("4", "51", "52", "53", "54", "55", "2221", "2720", "34", "37", "36", "38", "6011", "65", "35", "62")
COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
             "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "98")
CUES = {"email": re.compile(r"mail|contact|write|@", re.I), "ip": re.compile(r"\bip\b|host|server|address|login", re.I),
        "card": re.compile(r"card|visa|master|credit|payment|account", re.I), "phone": re.compile(r"phone|call|tel|mobile|fax|contact", re.I)}
AGAINST = re.compile(r"version|isbn|order|invoice|serial|build|v\.?\s*$", re.I)
BEFORE = 32            # characters before a span that may hold a cue
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()), T.StructField("votes", T.StringType()),
                                 T.StructField("features", T.StringType())]))
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.string()),
                                ("features", pa.string())]))


def emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _ip_ok(s: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in s.split("."))


def _card_ok(s: str) -> bool:
    d = DIGITS.sub("", s)
    return 16 <= len(d) <= 19 and luhn(d)


def spans_of(text: str) -> list[dict]:
    """All candidates of a text by kind, then start: the base spans and the looser ones beside them, with their votes."""
    found: list[tuple[int, int, int, bool]] = [(0, a, b, True) for a, b in emails(text)] if "@" in text else []
    loose: list[tuple[int, int, int, bool]] = []
    for m in IP.finditer(text):
        if _ip_ok(m.group()):
            found.append((1, m.start(), m.end(), True))
    for m in CARD.finditer(text):
        n = m.end() - m.start()
        if n >= 13:
            d = DIGITS.sub("", m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                found.append((2, m.start(), m.end(), True))
            elif 13 <= len(d) <= 19:
                loose.append((2, m.start(), m.end(), False))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGITS.sub("", m.group())) <= 15:
                found.append((3, m.start(), m.end(), True))
    loose += [(3, m.start(), m.end(), False) for m in LOOSE_PHONE.finditer(text)]
    if "dot)" in text or "dot]" in text:
        loose += [(0, m.start(), m.end(), False) for m in LOOSE_EMAIL.finditer(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    if loose and taken:
        starts = np.array([a for a, _ in taken])
        far = np.maximum.accumulate(np.array([b for _, b in taken]))
        loose = [x for x in loose if not ((i := int(np.searchsorted(starts, x[2]))) and far[i - 1] > x[1])]
    return [{"kind": k, "start": a, "end": b, "base": ok, "votes": votes(k, text[a:b], text[max(0, a - BEFORE):a], ok),
             "features": features(k, text[a:b], text[max(0, a - BEFORE):a], text[b:b + 1])}
            for k, a, b, ok in sorted(found + loose)]


def votes(kind: int, span: str, before: str, strict: bool) -> str:
    """One character a labeler: + for, - against, 0 no opinion."""
    d = DIGITS.sub("", span)
    if kind == 0:
        gazetteer = "+" if span.rstrip(".").rpartition(".")[2].lower() in ENDINGS else "0" if strict else "-"
        shape = "+" if 6 <= len(span) <= 80 else "-"
    elif kind == 1:
        first = int(span.split(".")[0].lstrip("0")[:3] or "0")
        gazetteer = "-" if first in (0, 127) or first > 239 else "+"
        shape = "+" if len(span) >= 9 else "0"
    elif kind == 2:
        gazetteer = "+" if d.startswith(ISSUERS) else "-"
        shape = "+" if len(d) in (15, 16) and luhn(d) else "-"
    else:
        gazetteer = "+" if strict and d.startswith(COUNTRIES) else "0" if not strict else "-"
        shape = "+" if re.search(r"[ ().-]", span) else "-"
    cue = "-" if AGAINST.search(before) else "+" if CUES[KINDS[kind]].search(before) else "0"
    return ("+" if strict else "-") + gazetteer + cue + shape


NEAR = 12              # characters to a near cue


def _edge(c: str) -> str:
    """Class of a character beside a span: none or blank, letter, digit, closing mark, other."""
    return "s" if not c or c.isspace() else "l" if c.isalpha() else "d" if c.isdigit() else "p" if c in ",.;:!?)]}>\"'" else "o"


def features(kind: int, span: str, before: str, after: str) -> str:
    """One character a feature: length, share of digits, kinds of separators, the characters around, the nearest cue."""
    digits = sum(c.isdigit() for c in span)
    marks = len({c for c in span if not c.isalnum()})
    cue, place = "0", -1
    for sign, pattern in (("+", CUES[KINDS[kind]]), ("-", AGAINST)):
        at = max((m.end() for m in pattern.finditer(before)), default=-1)
        if at > place:
            place, cue = at, ("n" if len(before) - at <= NEAR else "f") if sign == "+" else "a"
    length = "0123"[min(3, len(span) // 8)]
    return length + "0123"[min(3, 4 * digits // max(1, len(span)))] + "0123"[min(3, marks)] + _edge(before[-1:]) + _edge(after) + cue


def spans_column() -> Column:
    @F.arrow_udf(SPAN)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([spans_of(t or "") for t in texts.to_pylist()], SPAN_ARROW)
    return spans(text_of())


def reliabilities(patterns: list[tuple[int, str, int]], rounds: int = 50) -> dict[tuple[int, str], float]:
    """EM per kind over vote patterns: the posterior that a span with these votes is personal data."""
    out: dict[tuple[int, str], float] = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [(v, n) for k, v, n in patterns if k == kind]
        x = np.array([["-0+".index(c) for c in v] for v, _ in rows])
        n = np.array([c for _, c in rows], float)
        p = 1 / (1 + np.exp(-1.5 * (x - 1).sum(axis=1)))               # majority of the votes to begin with
        for _ in range(rounds):
            prior = (n @ p + 1) / (n.sum() + 2)
            log_odds = np.full(len(x), np.log(prior / (1 - prior)))
            for j in range(x.shape[1]):
                said = np.array([1.0, 0.0, 1.0])                       # no opinion is no evidence
                yes = np.bincount(x[:, j], weights=n * p, minlength=3) * said + np.array([0.5, 0.0, 1.0])
                no = np.bincount(x[:, j], weights=n * (1 - p), minlength=3) * said + np.array([1.0, 0.0, 0.5])
                odds = np.log((yes / yes.sum())[[0, 2]]) - np.log((no / no.sum())[[0, 2]])
                log_odds += np.array([odds[0], 0.0, odds[1]])[x[:, j]]
            p = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        out |= {(kind, v): float(q) for (v, _), q in zip(rows, p)}
    return out


def span_classifier(patterns: list[tuple[int, str, str, int]], soft: dict, rounds: int = 400) -> dict[tuple[int, str, str], float]:
    """Logistic regression over votes and, by kind, the features, trained on the posteriors; its probability for every pattern seen."""
    if not patterns:
        return {}
    names: dict[tuple, int] = {}
    hot = [[names.setdefault(x, len(names)) for x in [("kind", k), *(("vote", j, c) for j, c in enumerate(v)), *((k, j, c) for j, c in enumerate(f))]]
           for k, v, f, _ in patterns]
    x = np.zeros((len(patterns), len(names)))
    for i, at in enumerate(hot):
        x[i, at] = 1
    n = np.sqrt(np.array([c for *_, c in patterns], float))            # large patterns count more, without drowning the rest
    y = np.array([soft[(k, v)] for k, v, *_ in patterns])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (n * (y - p)) - 0.05 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return {(k, v, f): float(q) for (k, v, f, _), q in zip(patterns, 1 / (1 + np.exp(-(x @ w))))}


def classifier(patterns: list[tuple[int, str, int]], soft: dict) -> dict[tuple[int, str], float]:
    """The span classifier for spans of which only the votes are known."""
    judged = span_classifier([(k, v, "", n) for k, v, n in patterns], soft)
    return {(k, v): p for (k, v, _), p in judged.items()}


def find(spark: SparkSession, docs: DataFrame, sure: float = 0.75) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``."""
    small_batches(spark)
    found = stored(spark, docs.select("doc_id", spans_column().alias("spans")), "pii-spans")
    # At most 4 kinds x 3^4 votes x the values of the features, whatever the number of documents; some hundreds in practice.
    seen = found.select(F.inline("spans")).groupBy("kind", "votes", "features").agg(F.count("*").alias("n"), F.bool_or(~F.col("base")).alias("loose")).collect()
    patterns = sorted((r["kind"], r["votes"], r["features"], r["n"]) for r in seen)
    by_votes: dict[tuple, int] = {}
    for k, v, _, n in patterns:
        by_votes[(k, v)] = by_votes.get((k, v), 0) + n
    loose = {(r["kind"], r["votes"], r["features"]) for r in seen if r["loose"]}
    judged = span_classifier(patterns, reliabilities([(k, v, n) for (k, v), n in sorted(by_votes.items())]))
    trusted = [f"{k}{v}{f}" for (k, v, f), p in judged.items() if p >= sure and (k, v, f) in loose]
    names = F.array(*[F.lit(k) for k in KINDS])
    written = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    count = lambda i: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == i))).cast("long")
    good = F.filter("spans", lambda s: s["base"] | F.concat(s["kind"].cast("string"), s["votes"], s["features"]).isin(trusted))
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(written(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), written(good).alias("spans"))
