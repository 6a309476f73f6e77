"""Operators that SQL can say, against their SQL: the test tables and rows made to be awkward."""

import random

import duckdb
import pandas as pd
import pytest

from ledgerlight.llm import queries

ROOT = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages")


def awkward_texts(rng, n=400):
    pieces = ["token", "Secret", "ſecret", "to\u212aen", "=", ": ", "'", '"', "abc", "d34db33f" * 2, "AKIA", "ABCDEF12", " ", "\x01", "\x02", "𝄞", "api_key=",
              "password", "ghp_" + "a1B2c3D4" * 5, "xoxb-" + "1a2B" * 5, "-----BEGIN RSA PRIVATE KEY-----", "sk_live_" + "9zY8xW7v" * 3, "eyJhbGciOi.eyJzdWIiOi.s5Hx_Qw-12",
              "hunter2example", "MIT", "mit ", "License", "license ", "general ", "public ", "released under the ", "apache ", "lesser ", "gnu ", "é", "-", "\n",
              "copy modify ", "Redistribution and use in source and binary forms, with or without modification, are permitted "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(50))) for _ in range(n)]
    from ledgerlight.llm.licenses import TEMPLATES
    notices = [". ".join(t for _, t, _ in TEMPLATES), *[t for _, t, _ in TEMPLATES], "We ship binary forms daily", "copy modify that line", "all rights hereby granted"]
    return [None, "", " ", "é" * 40, *notices, "mit license " * 3000, "token=" + "x9" * 4 + " " + "f" * 70_000, *texts, *texts[:20]]


def awkward_urls(rng, n=1500):
    hosts = ["a.net", "example.net", "x.example.net", "example.com", "b.org", "org", "notorg", "Mixed.Example.COM", "c.org:80", ""]
    segs = ["en", "de", "fr", "spam", "news", "p1", "2024", "*", "", "é"] + [f"s{chr(97 + i)}" for i in range(26)]
    urls = [f"http://{rng.choice(hosts)}" + "".join("/" + rng.choice(segs) for _ in range(rng.randrange(9))) + rng.choice(["", "/", "?a=/de/", "#x", "//"]) for _ in range(n)]
    return [None, "", "no scheme", "x://", "://", "a://b://c/de/", *urls, *urls[:30]]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, repeated rows and extra columns."""
    rng, out = random.Random(5), str(tmp_path_factory.mktemp("made"))
    text = awkward_texts(rng)
    docs = [(None if i == 7 else i // 2, t, rng.choice(["s1", "s2", "s3", "s4", None]), f"w{i}",
             rng.choice(["en", "en", "en", "de", "", None]), None if i % 9 == 0 else i) for i, t in enumerate(text)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, words string, lang string, n_chars long").write.parquet(f"{out}/documents.parquet")
    html = [None, "", "\r\n\r\n" * 600, "é" * 500, "é" * 499, "a" * 1000, "b" * 70_000, "WARC/1.1\r\n"]
    pages = [(None if i % 97 == 5 else i // 2 if i % 50 < 4 else i, u, "x", rng.choice(html) if i % 3 else f"page {i}") for i, u in enumerate(awkward_urls(rng))]
    spark.createDataFrame(pages, "page_id long, url string, shape string, html string").write.parquet(f"{out}/pages.parquet")
    vec = lambda: [float(rng.randrange(-9, 10)) for _ in range(4)]
    vecs = [(i, vec()) for i in range(300)] + [(400 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]
    vecs += [(500, None), (520, []), (540, [0.0] * 4), (560, [1.0, None, 2.0, 3.0]), (580, [float("nan")] * 4), (600, [float("inf")] * 4), (620, [1.0]), (None, vec()), vecs[20]]
    vecs += [(700, [0.5, 0.5, 0.5, 0.5]), vecs[50], vecs[50], (2100, []), (2101, []), (2150, [70000.0, 0.0, 0.0, 0.0]), (1, [])]
    spark.createDataFrame([(*v, 1, None if i % 23 == 7 else rng.randrange(3)) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>, ids int, label int").write.parquet(f"{out}/embeddings.parquet")
    return out


@pytest.fixture(scope="module")
def empty(spark, made, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{made}/{t}.parquet").limit(0).write.parquet(f"{out}/{t}.parquet")
    return out


def written(df):
    """Rows as sorted texts: numbers to six places, nulls alike."""
    def one(v):
        if pd.isna(v):
            return ""
        return f"{float(v):.6f}" if not isinstance(v, str) else v
    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("folder", ["made", "empty", "root"])
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_says_what_its_sql_says(spark, request, name, folder):
    where = ROOT if folder == "root" else request.getfixturevalue(folder)
    con = duckdb.connect()
    for t in TABLES:
        files = f"{where}/{t}.parquet" if folder == "root" else f"{where}/{t}.parquet/*.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files}')")
    got, want = queries.QUERIES[name](spark, where).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert written(got) == written(want)
