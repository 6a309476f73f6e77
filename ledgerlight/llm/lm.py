"""Word language model with deleted interpolation (operator 9).

Bigram, unigram and uniform estimates are mixed by the frequency bucket of the
context; the mixture weights come from expectation-maximisation over one fold
of the training documents, each token's own occurrence deleted from the counts.

The counts live in Spark, not in a model file: a batch of texts is cut into
words once and stored as number streams; each batch asks for the counts of the
distinct unigrams and bigrams it holds, a shuffle by hash range adds up what
all batches contribute, and the sums go back to the batches that asked. A
frequent word thus travels once per batch, never once per occurrence. N-grams
are identified by 64-bit hashes.

Defined results: a null text counts as empty (one end token); a null doc_id is
a training row; with no training row every count is 0 and N = V = 0. Very long
texts are scored whole; repeated rows each get a row and each count; a model has
no ties to break; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_crc, small_batches, stored, text_of

BATCH_BYTES = 4 << 20          # text in one batch
BUCKET_BYTES = 8 << 20         # text per hash range
FOLDS, HELD_OUT, EM_FOLD = 7, 2, 3
END, START = b" ", b"  "       # no word holds a space
STEP = 4                       # histogram cells per factor of two

STREAMS = "batch long, em boolean, doc_ids array<long>, held array<boolean>, lens binary, vocab binary, ids binary"
REQUESTS = "batch long, bucket int, uni binary, uni_n binary, bi binary, bi_n binary"
REPLIES = "batch long, bucket int, uni_n binary, bi_n binary, total long, types long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _planes(a: np.ndarray) -> bytes:
    """Bytes of an array with equal byte positions side by side, which compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _unplanes(b: bytes, kind) -> np.ndarray:
    k = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(k, -1).T).reshape(-1).view(kind)


def _hash(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + ((b << np.uint64(31)) | (b >> np.uint64(33)))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (part, doc_id, fold, text): one row per batch of texts, as local word numbers."""
    kept: dict[bool, list] = {False: [], True: []}
    size = {False: 0, True: 0}
    made = 0

    def flush(em: bool) -> pa.RecordBatch:
        nonlocal made
        part = pa.concat_arrays([x[0] for x in kept[em]])[0].as_py()
        ids, fold, text = (pa.concat_arrays([x[i] for x in kept[em]]) for i in (1, 2, 3))
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(text.cast(pa.large_string()))))
        flat = split.flatten()
        full = pc.greater(pc.binary_length(flat), 0)
        lens = np.diff(np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False)))) [split.offsets.to_numpy() - split.offsets[0].as_py()])
        words = flat.filter(full).dictionary_encode()
        vocab = _hash([w.encode() for w in words.dictionary.to_pylist()] + [END, START])
        row = {"batch": [(part << 24) + made], "em": [em], "doc_ids": [ids.to_pylist()],
               "held": [(fold.to_numpy() == HELD_OUT).tolist()], "lens": [lens.astype(np.uint32).tobytes()],
               "vocab": [vocab.tobytes()], "ids": [_planes(words.indices.to_numpy().astype(np.uint32))]}
        made += 1
        kept[em], size[em] = [], 0
        return pa.RecordBatch.from_pydict(row, pa.schema([
            ("batch", pa.int64()), ("em", pa.bool_()), ("doc_ids", pa.list_(pa.int64())),
            ("held", pa.list_(pa.bool_())), ("lens", pa.binary()), ("vocab", pa.binary()), ("ids", pa.binary())]))

    for b in batches:
        fold = b.column(2).to_numpy()
        for em in (False, True):
            own = b.filter(pa.array((fold == EM_FOLD) == em))
            if own.num_rows:
                kept[em].append(own.columns)
                size[em] += own.column(3).nbytes
                if size[em] >= BATCH_BYTES:
                    yield flush(em)
                    pa.default_memory_pool().release_unused()
    for em in (False, True):
        if kept[em]:
            yield flush(em)


class Stream:
    """One batch read back: token stream, distinct n-grams in hash order, and where each token's n-grams are."""

    def __init__(self, held, lens: bytes, vocab: bytes, ids: bytes):
        self.vocab = np.frombuffer(vocab, np.uint64)
        n, start = len(self.vocab) - 2, len(self.vocab) - 1
        words = np.frombuffer(lens, np.uint32).astype(np.int64)
        self.tokens = words + 1
        ends = np.cumsum(self.tokens) - 1
        cur = np.full(int(self.tokens.sum()), n, np.int64)
        inside = np.ones(len(cur), bool)
        inside[ends] = False
        cur[inside] = _unplanes(ids, np.uint32)
        prev = np.concatenate(([start], cur[:-1]))
        prev[ends[:-1] + 1] = start
        self.doc = np.repeat(np.arange(len(words)), self.tokens)
        self.train = ~np.asarray(held, bool)[self.doc]
        pairs, self.bi_at = np.unique(prev * (start + 1) + cur, return_inverse=True)
        bi = _pair_hash(self.vocab[pairs // (start + 1)], self.vocab[pairs % (start + 1)])
        self.cur, self.prev = cur, prev
        self.uni_order, self.bi_order = np.argsort(self.vocab), np.argsort(bi)
        self.uni, self.bi = self.vocab[self.uni_order], bi[self.bi_order]

    def requests(self, batch: int, buckets: int) -> Iterator[tuple]:
        uni_n = np.bincount(self.cur[self.train], minlength=len(self.vocab))
        uni_n[-1] = np.bincount(self.prev[self.train], minlength=len(self.vocab))[-1]     # texts begun
        bi_n = np.bincount(self.bi_at[self.train], minlength=len(self.bi))
        uni_n, bi_n = uni_n[self.uni_order].astype(np.uint32), bi_n[self.bi_order].astype(np.uint32)
        of = [((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64) for h in (self.uni, self.bi)]
        asked = np.unique(np.concatenate(of))                     # only ranges this batch needs, however many there are
        lo, hi = ([np.searchsorted(o, asked, side) for o in of] for side in ("left", "right"))
        for i, b in enumerate(asked.tolist()):
            u, v = slice(lo[0][i], hi[0][i]), slice(lo[1][i], hi[1][i])
            yield (batch, b, _planes(self.uni[u]), _planes(uni_n[u]), _planes(self.bi[v]), _planes(bi_n[v]))

    def counts(self, replies: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Corpus counts by word number and by distinct bigram of this batch."""
        replies = replies.sort_values("bucket")
        out = []
        for col, order in (("uni_n", self.uni_order), ("bi_n", self.bi_order)):
            got = np.concatenate([_unplanes(b, np.uint64) for b in replies[col]])
            back = np.empty(len(order), np.int64)
            back[order] = got
            out.append(back)
        return out[0], out[1]


def _requests(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("uni", pa.binary()), ("uni_n", pa.binary()),
                            ("bi", pa.binary()), ("bi_n", pa.binary())])
        for rb in batches:
            for r in rb.to_pylist():
                rows = list(Stream(r["held"], r["lens"], r["vocab"], r["ids"]).requests(r["batch"], buckets))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
    return run


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    """All requests of one hash range: the sums, cut as they were asked for, and the range's totals (batch -1)."""
    out = {"batch": list(group.batch) + [-1], "bucket": int(group.bucket.iloc[0])}
    special = {int(h) for h in _hash([START])}
    total = types = 0
    for name in ("uni", "bi"):
        hashes = [_unplanes(b, np.uint64) for b in group[name]]
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        n = np.concatenate([_unplanes(b, np.uint32) for b in group[f"{name}_n"]])
        sums = np.bincount(at, weights=n, minlength=len(distinct)).astype(np.uint64)      # a corpus count may pass 2^32
        cuts = np.cumsum([len(h) for h in hashes])[:-1]
        out[f"{name}_n"] = [_planes(x) for x in np.split(sums[at], cuts)] + [b""]
        if name == "uni":
            word = ~np.isin(distinct, np.array(list(special), np.uint64))
            total, types = int(sums[word].sum(dtype=np.int64)), int((sums[word] > 0).sum())
    return pd.DataFrame(out).assign(total=total, types=types)[["batch", "bucket", "uni_n", "bi_n", "total", "types"]]


def _context_bucket(c: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(c + 1)).astype(np.int64)


def _parts(s: Stream, uni: np.ndarray, bi: np.ndarray, total: int, deleted: int):
    """Per token: context bucket, bigram and unigram estimate, the token's own count taken out if deleted is 1."""
    c1, c2, c = uni[s.prev] - deleted, bi[s.bi_at] - deleted, uni[s.cur] - deleted
    return _context_bucket(c1), np.where(c1 > 0, c2 / np.maximum(c1, 1), 0.0), c / max(total - deleted, 1)


def _histogram(total: int):
    """cogroup of one EM-fold batch and its counts: tokens per (context bucket, bigram cell, unigram cell)."""
    def run(streams: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for r in streams.itertuples():
            s = Stream(r.held, r.lens, r.vocab, r.ids)
            k, p2, p1 = _parts(s, *s.counts(replies), total, 1)
            with np.errstate(divide="ignore"):
                q2, q1 = (np.where(p > 0, np.round(-STEP * np.log2(p)), -1).astype(int) for p in (p2, p1))
            frames.append(pd.DataFrame({"k": k, "q2": q2, "q1": q1}).value_counts().rename("n").reset_index())
        return pd.concat(frames) if frames else pd.DataFrame({"k": [], "q2": [], "q1": [], "n": []})
    return run


def _weights(cells: list, types: int, rounds: int = 60) -> np.ndarray:
    """EM: mixture weights (bigram, unigram, uniform) for each context bucket."""
    w = np.tile([0.0, 0.5, 0.5], (64, 1))
    by: dict[int, list] = {}
    for k, q2, q1, n in cells:
        by.setdefault(k, []).append((0.0 if q2 < 0 else 2 ** (-q2 / STEP), 0.0 if q1 < 0 else 2 ** (-q1 / STEP), n))
    for k, rows in by.items():
        a = np.array(sorted(rows))
        p = np.column_stack([a[:, 0], a[:, 1], np.full(len(a), 1 / (types + 1))])
        x = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * x
            x = (share / share.sum(axis=1, keepdims=True) * a[:, 2:]).sum(axis=0)
            x = (x + 1e-3) / (x + 1e-3).sum()
        w[k] = x
    seen = sorted(by)
    for k in range(64):                       # a bucket without held-out tokens takes the next smaller one's weights
        if k not in by and (low := [x for x in seen if x < k]):
            w[k] = w[low[-1]]
    return w


def _score(total: int, types: int, weights: np.ndarray):
    def run(streams: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for r in streams.itertuples():
            s = Stream(r.held, r.lens, r.vocab, r.ids)
            uni, bi = s.counts(replies)
            k, p2, p1 = _parts(s, uni, bi, total, 0)
            p = weights[k, 0] * p2 + weights[k, 1] * p1 + weights[k, 2] / (types + 1)
            c = uni[s.cur]
            n = len(s.tokens)
            add = lambda x: np.bincount(s.doc, weights=x, minlength=n)
            frames.append(pd.DataFrame({
                "doc_id": pd.array(r.doc_ids, "Int64"), "held_out": np.asarray(r.held, bool), "n_tokens": s.tokens,
                "n_known": add(c > 0).astype(np.int64), "base_score": add(np.log10((c + 1) / (total + types + 1))),
                "score": add(np.log10(p))}))
        return pd.concat(frames) if frames else pd.DataFrame({c.split()[0]: [] for c in SCORES.split(", ")})
    return run


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``."""
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    buckets = max(4, -(-size // BUCKET_BYTES))
    streams = stored(spark, docs.select(F.spark_partition_id().cast("long").alias("part"), F.col("doc_id").cast("long"),
                                        F.pmod(id_crc(), F.lit(FOLDS)).cast("int").alias("fold"), text_of().alias("text"))
                     .mapInArrow(_streams, STREAMS), "lm-streams")
    replies = stored(spark, streams.mapInArrow(_requests(buckets), REQUESTS).groupBy("bucket")
                     .applyInPandas(_add_up, REPLIES), "lm-counts")
    own = replies.filter("batch = -1").agg(F.sum("total"), F.sum("types")).first()
    total, types = own[0] or 0, own[1] or 0
    answers = replies.filter("batch >= 0").select("batch", "bucket", "uni_n", "bi_n")
    cells = (streams.filter("em").groupBy("batch")
             .cogroup(answers.join(streams.filter("em").select("batch"), "batch", "left_semi").groupBy("batch"))
             .applyInPandas(_histogram(total), "k long, q2 long, q1 long, n long")
             .groupBy("k", "q2", "q1").agg(F.sum("n").alias("n")).collect())    # a fixed grid of cells
    weights = _weights([tuple(c) for c in cells], types)
    scores = streams.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(_score(total, types, weights), SCORES)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         "base_score", "score")
