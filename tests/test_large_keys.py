"""Keys as large as those of larger tables, where the ids of parts, suppliers, customers and nations meet."""

import random

import duckdb
import pytest

from graphloom.operators import relations
from graphloom.plans import structures, wiki  # noqa: F401  they register their queries
from graphloom.plans.queries import ORACLES, QUERIES

SOURCE = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "lineitem", "events")
#: Keys of five parts; with 196 parts no article links to the five numbers after 190, so the wiki has all that its rules ask for.
LARGE = (1000003, 1000007, 1500000, 2000005, 3000004)


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    folder = tmp_path_factory.mktemp("large")
    c = duckdb.connect()
    cases = " ".join(f"WHEN {190 + k} THEN {x}" for k, x in enumerate(LARGE, 1))
    moved = lambda column: f"(CASE {column} {cases} ELSE {column} END)::BIGINT AS {column}"
    for name in TABLES:
        rows = {
            "part": f"SELECT * REPLACE ({moved('p_partkey')}) FROM t WHERE p_partkey < 196",
            "lineitem": f"SELECT * REPLACE ({moved('l_partkey')}) FROM t WHERE l_partkey < 196",
        }.get(name, "SELECT * FROM t")
        c.execute(f"COPY (WITH t AS (SELECT * FROM '{SOURCE}/{name}.parquet') {rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), c


@pytest.mark.parametrize("name", ["rel_a", "rel_c", "rel_i", "canonical", *sorted(x for x in QUERIES if x.startswith("wiki_"))])
def test_as_sql(spark, large, name):
    folder, sql = large
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = sql.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())


def brute(edges, articles):
    found = {}
    for u in {u for u, _ in edges}:
        todo, seen = [u], set()
        while todo:
            x = todo.pop()
            fresh = {b for a, b in edges if a == x} - seen
            seen |= fresh
            todo += fresh
        if seen & articles:
            found[u] = sorted(seen & articles)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_span_and_lists(spark, seed):
    rng = random.Random(seed)
    ids = [rng.randrange(-200, 10**7) for _ in range(25)] + [63, 64, 127, -1]
    edges = {(rng.choice(ids), rng.choice(ids)) for _ in range(45)} | {(63, 127)}
    articles = {i for i in ids if rng.random() < 0.5} | {127}
    frames = spark.createDataFrame(sorted(edges), "u long, v long"), spark.createDataFrame([(a,) for a in sorted(articles)], "id long")
    expected = brute(edges, articles)
    assert {tuple(r) for r in relations.canonical_span(*frames).collect()} == {(u, t) for u, ts in expected.items() for t in (ts[0], ts[-1])}
    assert dict(tuple(r) for r in relations.canonical_lists(*frames).collect()) == {u: ",".join(map(str, ts)) for u, ts in expected.items()}


def test_shared_targets_stay_packed(spark):
    """Fifty pages of a loop that all lead to 20,000 articles: a million pairs, some 16,000 rows."""
    from pyspark.sql import functions as F

    loop = spark.range(50).select((F.col("id") + 10**6).alias("u"), ((F.col("id") + 1) % 50 + 10**6).alias("v"))
    articles = spark.range(20_000)
    edges = loop.union(articles.select((F.col("id") % 50 + 10**6).alias("u"), F.col("id").alias("v")))
    closed, opened = relations.reach(edges, articles)
    assert closed.isEmpty() and opened.count() <= 50 * 20_000 // 32
    assert relations.canonical_span(edges, articles).count() == 100


def test_links_are_dealt_once(spark):
    """Of the two joins of links with the ends of pages, only the one by source deals them."""
    links = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "u long, v long")
    pages = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 4)], "id long, title string, type int")
    canon = spark.createDataFrame([(3, 1), (3, 2)], "id long, target long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = relations.relation(links, pages, canon, "A", ())
        assert found._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 1
        assert [tuple(r) for r in found.collect()] == [("a", "b", "A", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_loops_and_null_sources(spark):
    """A loop that shares its line, what leads to it and from it, an edge to itself and a source that isn't known."""
    edges = {(1, 2), (2, 3), (3, 1), (3, 10), (4, 1), (2, 5), (5, 11), (6, 6), (6, 70), (None, 4), (None, 12), (7, 13)}
    articles = {3, 5, 6, 10, 11, 12, 13, 70}
    frames = spark.createDataFrame(list(edges), "u long, v long"), spark.createDataFrame([(a,) for a in articles], "id long")
    assert {tuple(r) for r in relations.loops(frames[0].where("u IS NOT NULL")).collect()} == {(1, 3), (2, 3), (3, 3)}
    got = [tuple(r) for r in relations.canonical_lists(*frames).collect()]
    assert sorted(got, key=str) == sorted(((u, ",".join(map(str, ts))) for u, ts in brute(edges, articles).items()), key=str)


@pytest.mark.parametrize("few", [True, False])
def test_many_ends_need_no_shuffle(spark, monkeypatch, few):
    """Links to and from more pages than are broadcast, repeated ids, links without an end and loose ones: no row of a link is shuffled."""
    monkeypatch.setattr(relations, "ENDS", 10, raising=False)
    if not few:
        monkeypatch.setattr(relations, "BROADCAST_ROWS", 5)
    rng = random.Random(7)
    pages = [(i, f"t {i}#x", 1 + (i % 5 == 0)) for i in range(-50, 150)] + [(7, "twice", 1), (8, None, 4)]
    canon = [(i, i + 1) for i in range(0, 30, 3)] + [(3, 90), (200, 9), (None, 1)]
    links = [(rng.randrange(-60, 160), rng.randrange(-60, 210)) for _ in range(3000)] + [(None, 1), (1, None)]
    frames = spark.createDataFrame(links, "u long, v long"), spark.createDataFrame(pages, "id long, title string, type int"), spark.createDataFrame(canon, "id long, target long")

    def ends(i, types):
        targets = {t for s, t in canon if s == i}
        known = not types or any(x == i and k in types for x, _, k in pages)
        end = next(iter(targets), i)
        return [(end, t.split("#")[0].replace(" ", "_")) for x, t, _ in pages if x == end and t] if known and len(targets) < 2 and i is not None else []

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in confs}
    tables = {t.name for t in spark.catalog.listTables()}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        for u_types, v_types in (((1,), None), ((1,), (1,)), ((), (2,))):
            found = relations.relation(*frames, "A", u_types, v_types)
            expected = sorted((a, b, "A", 1) for u, v in links for x, a in ends(u, u_types) for y, b in ends(v, v_types) if x != y)
            assert expected and sorted(tuple(r) for r in found.collect()) == expected
            assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {t.name for t in spark.catalog.listTables()} == tables
