"""Items of any length are found at the promised similarity."""

import random

import pyarrow as pa
import pytest

from ledgerlight.llm import decontam


@pytest.mark.parametrize("size", [16, 32, 64, 128, 250, 500, 1000])
@pytest.mark.parametrize("mixed", [False, True])
def test_items_of_every_length_are_found_at_the_allowed_edits(size, mixed):
    rng = random.Random(size)
    fresh = lambda: f"n{rng.randrange(20_000)}"
    items, docs = [], []
    for _ in range(max(20, 4000 // size)):
        x = [f"w{rng.randrange(20_000)}" for _ in range(size)]
        items.append(" ".join(x))
        for j in rng.sample(range(size), size // 5):
            k = rng.randrange(len(x)) if mixed else j
            x[k:k + 1] = rng.choice([[], [fresh()], [x[k], fresh()]]) if mixed else [fresh()]
        docs.append(" ".join([fresh() for _ in range(rng.randrange(60))] + x + [fresh() for _ in range(rng.randrange(60))]))
    hits = decontam.Index(list(enumerate(items)), 0.8).hits(pa.array(docs))
    found = [any(h["item_id"] == n for h in here) for n, here in enumerate(hits)]
    assert sum(found) / len(found) >= 0.97
    assert all(h["item_id"] == n and h["distance"] <= size // 5 for n, here in enumerate(hits) for h in here)


def test_a_repetitive_item_has_few_places_a_signature():
    index = decontam.Index([(1, "a " * 1000)], 0.8)
    assert all(len(keys) <= 17 for tables in index.by_window.values() for keys, *_ in tables)
    (hit,), = index.hits(pa.array(["b " * 300 + "a " * 1500]))
    assert (hit["distance"], hit["n_words"]) == (0, 1000)
