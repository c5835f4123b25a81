"""Parts against brute force, and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import decontaminate, html_text, minhash, mixing
from graphloom.llm.license_rules import RULES


def test_near_duplicates_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(30):
        base = rng.choices(words, k=rng.randint(1, 120))
        for _ in range(rng.randint(1, 12)):
            copy = [rng.choice(words) if rng.random() < 0.01 else w for w in base]
            texts.append(" ".join(copy))
    sets = [frozenset(zip(*[t.split()[k:] for k in range(3)], strict=False)) or frozenset([t]) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: find(i) for i in range(len(texts))}


def test_permutation(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        side = int(np.ceil(np.sqrt(n)))
        p = mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(side).cast("long"), F.lit(1), F.lit(0))
        assert sorted(r.p for r in spark.range(n).select(p.alias("p")).collect()) == list(range(n))


def test_simhash(spark):
    rng = random.Random(0)
    for size, lane in ((1, 9), (6, 9), (33, 9), (200, 9), (33, 21)):
        h = [rng.getrandbits(64) - (1 << 63) for _ in range(size)]
        bits = [sum((x >> b) & 1 for x in h) for b in range(63)]
        expected = sum(1 << b for b, v in enumerate(bits) if v > size // 2)
        got = spark.createDataFrame([(h,)], "h array<long>").select(decontaminate.simhash(F.col("h"), lane).alias("f")).first().f
        assert got == expected, (size, lane)


def test_blocks_cover_the_fingerprint():
    blocks = decontaminate._blocks()
    assert len(blocks) == decontaminate.RADIUS + 1 and sum(n for _, n in blocks) == decontaminate.BITS
    assert all(a + n == b for (a, n), (b, _) in zip(blocks, blocks[1:], strict=False))


@pytest.mark.parametrize("edit", [0.0, 0.01, 0.02, 0.05])
def test_leaks_brute_force(spark, edit):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    items = [rng.choices(words, k=rng.randint(10, 60)) for _ in range(12)]
    docs = []
    for k in range(60):
        text = rng.choices(words, k=rng.randint(0, 300))
        at = rng.randint(0, len(text))
        text[at:at] = [rng.choice(words) if rng.random() < edit else w for w in items[k % 12]]
        docs.append(text)
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    expected = {}
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            a, b = shingles(text), shingles(item)
            best = 0.0
            for s in range(len(a) - len(b) + 1):
                common = sum(1 for x in set(b) if x in a[s : s + len(b)])
                best = max(best, common / (2 * len(b) - common))
            if best >= 0.8:
                expected[d, i] = best
    frame = lambda rows, name: spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(rows)], f"{name} long, text string")
    got = decontaminate.leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == expected


def test_rules_hold_their_keywords():
    assert len(RULES) > 200
    assert all(keyword == keyword.lower() for _, _, keyword, _, _ in RULES)


def test_extraction_of_unseen_pages():
    trees = html_text.fit()
    wrong = 0
    for seed in range(90_000, 90_100):
        page, labels = html_text.example(seed)
        keep = page.keep(trees.probability(np.array(page.features())).tolist())
        wrong += page.text(keep) != page.text([bool(x) for x in labels])
    assert wrong <= 8
