"""Texts shorter than a benchmark item."""

import random

import pytest

from graphloom.llm import decontaminate


def test_texts_shorter_than_the_item(spark):
    rng = random.Random(5)
    items = [[f"w{rng.randrange(3000)}" for _ in range(n)] for n in (6, 9, 30, 31, 60, 200)]
    docs = []
    for item in items:
        docs += [item[:k] for k in range(4, len(item) + 1)] + [item[k:] for k in range(1, 12)]
        docs += [item[: len(item) // 2] + ["other"] + item[len(item) // 2 + 1 : -1]]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    expected = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            a, b = shingles(doc), shingles(item)
            if len(doc) <= len(item) and 100 * len(a & b) >= 80 * len(a | b):
                expected[d, i] = (len(a & b) / len(a | b), 0, len(doc))
    frame = lambda rows, name: spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(rows)], f"{name} long, text string")
    docs_frame, items_frame = frame(docs, "doc_id"), frame(items, "item_id")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs_frame, items_frame).collect()}
    assert got.keys() == expected.keys()
    for key, (similarity, first, n) in expected.items():
        assert (got[key].similarity, got[key].first_word, got[key].n_words) == (pytest.approx(similarity), first, n)
    kept = {r.doc_id for r in decontaminate.clean(docs_frame, items_frame).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in expected}
