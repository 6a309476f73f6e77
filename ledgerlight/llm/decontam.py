"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 5).

Texts are words `[0-9A-Za-z and all non-ASCII]+`, A-Z lower-cased. The CGK
random walk copies a word sequence symbol by symbol and steps on or stays by a
random bit of the symbol, so two sequences at small edit distance become
sequences at small Hamming distance. Locality-sensitive hashing samples
positions of the walk, repeatedly. An item gets as many walks as it takes to
find ``recall`` of simulated copies of its length that hold all the edits the
similarity allows. A found pair is verified exactly: the edit distance, in
words, between the whole item and the best matching piece of the document must
be at most ``1 - similarity`` of the item's words.

Windows hold w = L - s + 1 words (L a power of two) and start every s = L / 4
words of a document; on the item's side a window starts at every word. Whatever
place an item of at least L words is copied to, at least one such window lies
inside the copy. The walk drifts the further the longer a window is, and one
window alone may hold more than its share of the edits; so L is bounded, and
items of 16 words and more get an L of at most half their words. A longer item
only has more windows that may find it, and its recall does not fall.

The benchmark is the query set. It is scanned in blocks of bounded size, each
block against all documents, so the signature table in a task stays bounded
however large the benchmark is. A block's tables are shared by all its items of
one window shape, so a document's windows are embedded once a block.

Defined results: null or wordless documents and items match nothing; repeated
items are reported under each item_id; repeated documents each get their rows;
a null item_id is reported as null. Very long texts and items are searched
whole; of matches with equal distance the one that ends first is reported; empty
tables give an empty result, or every document; extra columns are carried or not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_of, utf8_buffer

SAMPLES = 4        # position samples of each walk
BITS = 4           # positions in a sample
RECALL = 0.995     # share of the simulated copies that the walks have to find
MOST_WALKS = 12    # CGK walks an item may get at most
TRIALS = 500       # simulated copies of a length, 1024 at most
EASY = 64          # items of more words are found more often than those of so many
BLOCK_WORDS = 200_000
LONGEST = 16       # words that the windows of the longest items are made for
CHUNK = 1 << 15    # windows embedded at a time
SEED = 11
HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("item_words", T.IntegerType()),
                                T.StructField("distance", T.IntegerType()), T.StructField("start_word", T.IntegerType()),
                                T.StructField("n_words", T.IntegerType())]))
HIT_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("item_words", pa.int32()), ("distance", pa.int32()),
                                ("start_word", pa.int32()), ("n_words", pa.int32())]))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte is part of a word; random value of each byte, A-Z as a-z; random odd factors by place in the word."""
    rng = np.random.default_rng(SEED)
    word = np.zeros(256, bool)
    word[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
    word[128:] = True
    value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    value[65:91] = value[97:123]
    return word, value, rng.integers(1, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hash of every word, first word of each text and the end)."""
    raw, off = utf8_buffer(texts)
    word, value, factor = _tables()
    inside = word[raw]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[off[:-1][off[:-1] < len(raw)]] = False                  # words end with their text
    first = np.flatnonzero(inside & ~before)
    if not len(first):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    at = np.flatnonzero(inside)
    starts = np.searchsorted(at, first)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    h = np.add.reduceat(value[raw[at]] * factor[place & 1023], starts)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.maximum(h >> np.uint64(32), 1).astype(np.uint32), np.searchsorted(first, off)


def window_shape(words: int) -> tuple[int, int]:
    """(window, step) in words for items of that many words; from 16 words on, a copy holds four windows or more."""
    size = 1 << (words.bit_length() - 1)
    if size >= 16:
        size = min(size // 2, LONGEST)
    step = max(1, size // 4)
    return size - step + 1, step


def _signatures(h: np.ndarray, start: np.ndarray, w: int, walks: range) -> np.ndarray:
    """Signatures (repetition x window): CGK walks of 2w steps over each window, sampled at BITS places each."""
    steps = 2 * w
    out = np.zeros((len(walks) * SAMPLES, len(start)), np.uint64)
    h = np.append(h, np.uint32(0))
    for place, walk in enumerate(walks):
        rng = np.random.default_rng((SEED, w, walk))
        factor = rng.integers(0, 1 << 31, steps, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        places: dict[int, list] = {}
        for s in range(SAMPLES):
            for part in np.array_split(np.arange(steps), min(BITS, steps)):
                j = int(rng.choice(part))
                places.setdefault(j, []).append((place * SAMPLES + s, rng.integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))
        last = max(places)
        for lo in range(0, len(start), CHUNK):
            at = start[lo:lo + CHUNK].copy()
            end = at + w
            for j in range(last + 1):
                sym = h[np.minimum(at, len(h) - 1)]
                if j >= w:
                    sym = np.where(at < end, sym, np.uint32(0))
                for row, f in places.get(j, ()):
                    out[row, lo:lo + CHUNK] += sym * f
                at += (sym * factor[j]) >> np.uint32(31)
    return out ^ (out >> np.uint64(31))


def _edited(x: np.ndarray, edits: int, mixed: bool, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many edits: substitutions at different places or, mixed, also words dropped and put in."""
    if not mixed:
        y = x.copy()
        y[rng.choice(len(x), edits, replace=False)] = rng.integers(1, 1 << 32, edits, dtype=np.uint32)
        return y
    y, new = x.tolist(), rng.integers(1, 1 << 32, edits).tolist()
    for word, kind in zip(new, rng.integers(0, 3, edits)):
        k = int(rng.integers(0, len(y)))
        y[k:k + 1] = ([], [word], [y[k], word])[kind]
    return np.array(y, np.uint32)


@lru_cache(maxsize=None)
def walks_for(words: int, similarity: float, recall: float) -> int:
    """Walks that find the share ``recall`` of simulated copies of an item that many words long, with all allowed edits."""
    words = min(words, EASY)
    w, step = window_shape(words)
    edits = int((1 - similarity) * words + 1e-9)
    rng = np.random.default_rng((SEED, words))
    parts, item_start, doc_start, item_of, doc_of, at = [], [], [], [], [], 0
    for n in range(TRIALS):
        x = rng.integers(1, 1 << 32, words, dtype=np.uint32)
        y = np.concatenate([rng.integers(1, 1 << 32, n % step + 1, dtype=np.uint32), _edited(x, edits, n % 2 == 1, rng),
                            rng.integers(1, 1 << 32, w, dtype=np.uint32)])
        a, b = at + np.arange(words - w + 1), at + words + np.arange(0, len(y) - w + 1, step)
        for column, v in ((parts, x), (parts, y), (item_start, a), (doc_start, b), (item_of, np.full(len(a), n)), (doc_of, np.full(len(b), n))):
            column.append(v)
        at += words + len(y)
    h, start = np.concatenate(parts), np.concatenate([*item_start, *doc_start])
    item_of, doc_of = np.concatenate(item_of).astype(np.uint64), np.concatenate(doc_of).astype(np.uint64)
    found = np.zeros(TRIALS, bool)
    for walk in range(MOST_WALKS):
        for row in _signatures(h, start, w, range(walk, walk + 1)):
            # the trial's number in the low bits: windows meet within their trial only
            mine, theirs = (part & ~np.uint64(1023) | of for part, of in ((row[:len(item_of)], item_of), (row[len(item_of):], doc_of)))
            found[doc_of[np.isin(theirs, mine)].astype(np.int64)] = True
        if found.mean() >= recall:
            return walk + 1
    return MOST_WALKS


def _grain(words: int) -> int:
    """Places of an item that many words long are told apart to so many words; a repetitive item has few places a signature."""
    return max(1, words // 16)


class Index:
    """Signatures of one block of items: per window shape a table a repetition, with the items that take part in it."""

    def __init__(self, items: list[tuple], similarity: float, recall: float = RECALL):
        h, cut = word_hashes(pa.array([t or "" for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.words = [h[a:b] for a, b in zip(cut, cut[1:])]
        self.lists = [x.tolist() for x in self.words]
        self.limit = [int((1 - similarity) * len(x) + 1e-9) for x in self.words]
        self.by_window: dict[tuple, list] = {}
        shapes: dict[tuple, list] = {}
        for n, x in enumerate(self.words):
            if len(x):
                shapes.setdefault(window_shape(len(x)), []).append(n)
        for (w, step), members in shapes.items():
            start = np.concatenate([cut[n] + np.arange(len(self.words[n]) - w + 1) for n in members])
            item = np.concatenate([np.full(len(self.words[n]) - w + 1, n, np.int32) for n in members])
            grain = np.array([_grain(len(x)) for x in self.words])[item]
            offset = ((start - cut[item]) // grain * grain).astype(np.int32)
            need = np.array([walks_for(len(x), similarity, recall) if len(x) else 0 for x in self.words])[item]
            sig, tables = _signatures(h, start, w, range(need.max())), []
            for r, row in enumerate(sig):
                order = np.flatnonzero(need > r // SAMPLES)
                order = order[np.lexsort((offset[order], item[order], row[order]))]
                same = (np.diff(row[order]) == 0) & (np.diff(item[order]) == 0) & (np.diff(offset[order]) == 0)
                order = order[np.append(True, ~same)]
                seen = np.zeros(1 << max(16, len(order).bit_length() + 4), bool)
                seen[(row[order] & np.uint64(len(seen) - 1)).astype(np.int64)] = True
                tables.append((row[order], item[order], offset[order], np.packbits(seen, bitorder="little")))
            self.by_window[(w, step)] = tables

    def candidates(self, h: np.ndarray, cut: np.ndarray) -> set[tuple[int, int, int]]:
        """(document, item, word of the document where the item would begin)."""
        found: set[tuple[int, int, int]] = set()
        length = np.diff(cut)
        for (w, step), tables in self.by_window.items():
            n = np.maximum((length - w) // step + 1, 0)
            doc = np.repeat(np.arange(len(n)), n)
            if not len(doc):
                continue
            start = cut[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n))
            for lo in range(0, len(doc), CHUNK):
                part = start[lo:lo + CHUNK]
                for sig, (keys, item, offset, seen) in zip(_signatures(h, part, w, range(len(tables) // SAMPLES)), tables):
                    low = (sig & np.uint64(8 * len(seen) - 1)).astype(np.int64)
                    maybe = np.flatnonzero(seen[low >> 3] >> (low & 7).astype(np.uint8) & 1)
                    if not len(maybe):
                        continue
                    a, b = np.searchsorted(keys, sig[maybe], "left"), np.searchsorted(keys, sig[maybe], "right")
                    for m, x, y in zip(maybe[b > a], a[b > a], b[b > a]):
                        d = int(doc[lo + m])
                        found.update((d, int(item[k]), int(part[m] - cut[d] - offset[k])) for k in range(x, y))
        return found

    def hits(self, texts: pa.Array) -> list[list[dict]]:
        h, cut = word_hashes(texts)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        best: dict[tuple, tuple] = {}
        checked: set[tuple] = set()
        for d, n, begin in sorted(self.candidates(h, cut)):
            item, limit = self.words[n], self.limit[n]
            if best.get((d, n), (1,))[0] == 0 or (d, n, begin) in checked:
                continue
            slack = limit + len(item) // 4 + _grain(len(item))
            lo, hi = max(0, begin - slack), min(int(cut[d + 1] - cut[d]), begin + len(item) + slack)
            checked.update((d, n, begin + k) for k in range(-(len(item) // 4), len(item) // 4 + 1))
            piece = h[cut[d] + lo:cut[d] + hi]
            there = set(piece.tolist())
            if sum(w not in there for w in self.lists[n]) > limit:       # each absent word costs an edit
                continue
            dist, a, b = best_match(item, piece)
            if dist <= limit and dist < best.get((d, n), (limit + 1,))[0]:
                best[(d, n)] = (dist, lo + a, b - a)
        for (d, n), (dist, start, size) in sorted(best.items()):
            out[d].append({"item_id": self.ids[n], "item_words": len(self.words[n]), "distance": dist, "start_word": start, "n_words": size})
        return out


def best_match(item: np.ndarray, piece: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end): the piece's part with the smallest edit distance to the whole item, the earliest end of equals."""
    n = len(piece)
    row, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    ramp = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        sub = row[:-1] + (piece != w)
        new, org = np.empty(n + 1, np.int64), np.empty(n + 1, np.int64)
        new[0], org[0] = i, 0
        take = sub <= row[1:] + 1
        new[1:], org[1:] = np.where(take, sub, row[1:] + 1), np.where(take, origin[:-1], origin[1:])
        low = np.minimum.accumulate(new - ramp)               # skipping words of the piece
        src = np.maximum.accumulate(np.where(new - ramp == low, ramp, 0))
        row, origin = low + ramp, org[src]
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end]), end


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[list[tuple]]:
    """The items in blocks of about ``block_words`` words; each block is read on its own."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    words = rows.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    n = max(1, -(-words // block_words))
    cell = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield [(r["item_id"], r["text"]) for r in rows.filter(cell == i).collect()]


def hits_column(index: Index) -> Column:
    """array of hits of one block of items in the ``text`` column."""
    @F.arrow_udf(HIT)
    def hits(texts: pa.Array) -> pa.Array:
        return pa.array(index.hits(texts), HIT_ARROW)
    return hits(text_of())


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, item_words, distance, start_word, n_words): every document and item that match, at the best place."""
    small_batches(spark)
    out = None
    for block in item_blocks(benchmark):
        part = (docs.select("doc_id", hits_column(Index(block, similarity, recall)).alias("hits"))
                .select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*"))
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = RECALL) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay as they are."""
    small_batches(spark)
    for block in item_blocks(benchmark):
        cols = [F.col(f"`{c}`") for c in docs.columns]
        docs = (docs.select(F.struct(*cols).alias("d"), hits_column(Index(block, similarity, recall)).alias("hits"))
                .filter(F.size("hits") == 0).select("d.*"))
    return docs
