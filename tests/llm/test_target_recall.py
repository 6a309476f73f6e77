"""The number of walks follows the target recall, and items of few words reach it too."""

import random

import pyarrow as pa
import pytest

from ledgerlight.llm import decontam


@pytest.mark.parametrize("size", [5, 6, 8, 10, 12, 15])
def test_short_items_are_found_at_the_allowed_edits(size):
    rng = random.Random(size)
    fresh = lambda: f"n{rng.randrange(50_000)}"
    items, docs = [], []
    for n in range(400):
        x = [f"w{rng.randrange(50_000)}" for _ in range(size)]
        items.append(" ".join(x))
        for j in rng.sample(range(size), size // 5):
            k = rng.randrange(len(x))
            x[k:k + 1] = rng.choice([[], [fresh()], [x[k], fresh()]]) if n % 2 else [x[k]]
            if not n % 2:
                x[j] = fresh()
        docs.append(" ".join([fresh() for _ in range(rng.randrange(30))] + x + [fresh() for _ in range(rng.randrange(30))]))
    hits = decontam.Index(list(enumerate(items)), 0.8).hits(pa.array(docs))
    assert sum(any(h["item_id"] == n for h in here) for n, here in enumerate(hits)) >= 0.98 * len(docs)


def test_walks_follow_recall_and_similarity():
    assert decontam.walks_for(5, 0.8, 0.7) < decontam.walks_for(5, 0.8, 0.99)
    assert decontam.walks_for(10, 1.0, 0.999) == 1                      # no edits: one walk finds every copy
    assert decontam.walks_for(5000, 0.8, 0.99) == decontam.walks_for(decontam.EASY, 0.8, 0.99)


def test_items_of_one_shape_share_tables_by_need():
    words = [f"w{i}" for i in range(39)]
    index = decontam.Index([(0, " ".join(words[:8])), (1, " ".join(words[8:]))], 0.8)      # both have windows of 7 words
    (tables,) = index.by_window.values()
    few, many = (decontam.SAMPLES * decontam.walks_for(n, 0.8, decontam.RECALL) for n in (31, 8))
    assert len(tables) == many > few
    assert [set(item.tolist()) for _, item, *_ in tables] == [{0, 1}] * few + [{0}] * (many - few)


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    rng = random.Random(4)
    items = [(n, " ".join(f"w{rng.randrange(500)}" for _ in range(12))) for n in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(n, "x y " + t + " z") for n, t in items[::2]] + [(99, "x y z"), (None, items[1][1]), (98, None)], "doc_id long, text string")
    whole = decontam.contaminated(spark, docs, bench).collect()
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (60,))
    assert len(list(decontam.item_blocks(bench))) > 2
    assert sorted(map(str, decontam.contaminated(spark, docs, bench).collect())) == sorted(map(str, whole))
    assert {r.doc_id for r in whole} == {None, *range(0, 20, 2)}
    assert [r.doc_id for r in decontam.keep_clean(spark, docs, bench).orderBy("doc_id").collect()] == [98, 99]
