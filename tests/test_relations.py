"""Relations, matching, trees and sources on small inputs."""

import random

import pytest

from graphloom.operators import matching, relations, trees
from graphloom.sources import dump, sinks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_redirects(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (6, 5), (9, 5), (7, 7)], "from_id long, to_id long")
    assert rows(relations.resolve_redirects(df)) == [(1, 3), (2, 3), (5, 5), (6, 6), (7, 7), (9, 5)]


def test_canonical_is_reachability(spark):
    rng = random.Random(1)
    edges = {(rng.randrange(30), rng.randrange(30)) for _ in range(40)}
    articles = {i for i in range(30) if i % 3 == 0}
    got = relations.canonical(spark.createDataFrame(sorted(edges), "u long, v long"), spark.createDataFrame([(a,) for a in articles], "id long"))
    expected = set()
    for u in {u for u, _ in edges}:
        todo, seen = [u], set()
        while todo:
            x = todo.pop()
            for a, b in edges:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        expected |= {(u, t) for t in seen & articles}
    assert set(rows(got)) == expected


def test_title_index(spark):
    df = spark.createDataFrame([(1, "a", 3, 0), (2, "a", 1, 1), (3, "a", 1, 2), (4, "b", 3, 3), (5, "b", 3, 4)], "id long, title string, type int, position long")
    assert rows(relations.title_index(df)) == [("a", 3), ("b", 4)]


def test_matcher(spark):
    texts = spark.createDataFrame([("In New York City and new york york",), ("New York City",), ("york",), (None,), ("",), ("new_york city",)], "text string")
    heads = spark.createDataFrame([("new_york_city",), ("new_york",), ("york",), ("boston",), ("one_two_three_four_five_six",)], "headword string")
    counts = rows(matching.mention_counts(texts, heads))
    assert counts == [("boston", 0), ("new_york", 1), ("new_york_city", 2), ("one_two_three_four_five_six", 0), ("york", 2)]
    assert matching.mentions(texts, heads.limit(0)).count() == 0


def test_trees(spark):
    t = spark.createDataFrame([(1, None, 0, "r"), (2, 1, 0, "a"), (3, 1, 1, "b"), (4, 2, 0, "c")], "node_id long, parent_id long, ordinal long, name string")
    p = trees.with_paths(t)
    assert rows(p.select("node_id", "address")) == [(1, "0"), (2, "0:0"), (3, "0:1"), (4, "0:0:0")]
    assert rows(trees.depth_under(p)) == [(1, 2), (2, 1), (3, 0), (4, 0)]
    assert rows(trees.leaves(t).select("node_id")) == [(3,), (4,)]


def test_round_robin(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "k long")
    assert rows(relations.round_robin(df, 3, "k")) == [(i, (i + 1) % 3) for i in range(20)]


DUMP = """<mediawiki version="0.10"><siteinfo><sitename>W</sitename><case>first-letter</case><namespaces>
<namespace key="0"/><namespace key="14">Category</namespace></namespaces></siteinfo>
<page><title>A</title><id>1</id><revision><id>10</id><timestamp>2019-03-02T07:05:09Z</timestamp>
<contributor><ip>1.2.3.4</ip></contributor><text>[[B]]</text></revision></page>
<page><title>B</title><id>2</id><redirect title="A"/><revision><id>11</id><minor/><text>#REDIRECT [[A]]</text></revision>
<revision><id>12</id><text>x</text></revision></page></mediawiki>"""


def test_dump(spark, tmp_path):
    (tmp_path / "d.xml").write_text(DUMP)
    pages = dump.read_pages(spark, str(tmp_path / "d.xml"))
    got = dump.latest(pages).orderBy("id").collect()
    assert [(r.id, r.title, r.redirect, r.text, r.contributor) for r in got] == [(1, "A", None, "[[B]]", "1.2.3.4"), (2, "B", "A", "x", None)]
    assert dump.read_namespaces(spark, str(tmp_path / "d.xml")) == {"category": 14}
    assert dump.revisions(pages).count() == 3
    assert rows(dump.read_pages(spark, str(tmp_path / "d.xml"), fast=True)) == [("A", "[[B]]"), ("B", "#REDIRECT [[A]]")]


def test_relation_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'J R "Bob", Dobbs', 1)], "id long, title string, type int")
    sinks.write_relation(df, str(tmp_path / "page"), quote=("title",), compression="bzip2")
    assert rows(dump.read_page_relation(spark, str(tmp_path / "page"))) == rows(df)
    (tmp_path / "bad.csv").write_text("nonsense\n")
    with pytest.raises(Exception, match="malformed"):
        dump.read_page_relation(spark, str(tmp_path / "bad.csv")).collect()


def test_mysql(spark, tmp_path):
    (tmp_path / "m.sql").write_text(
        "-- MySQL dump 10\nCREATE TABLE `t` (\n  `a` int(8) NOT NULL,\n  `b` varbinary(255),\n  `c` double\n) ENGINE=x;\nINSERT INTO `t` VALUES (1,'x\\'y),(',1.5),(2,NULL,NULL);\n"
    )
    assert rows(dump.read_mysql_dump(spark, str(tmp_path / "m.sql"))) == [(1, "x'y),(", 1.5), (2, None, None)]


def test_mysql_two_tables(spark, tmp_path):
    (tmp_path / "m.sql").write_text(
        "-- MySQL dump 10\n\n" + "-- filler;\n" * 1500 + "CREATE TABLE `t` (\n  `a` int(8)\n) ENGINE=x;\nINSERT INTO `t` VALUES (1),(2);\nCREATE TABLE `langlinks` (\n  `ll_from` int,\n  `ll_lang` varbinary(20),\n  `ll_title` varbinary(255)\n);\nINSERT INTO `langlinks` VALUES (1,'es','Uno;\\nDos');\n"
    )
    path = str(tmp_path / "m.sql")
    assert rows(dump.read_mysql_dump(spark, path)) == [(1,), (2,)]
    assert rows(dump.read_langlinks(spark, path)) == [(1, "es", "Uno;\nDos")]
    with pytest.raises(ValueError, match="no CREATE TABLE"):
        dump.read_mysql_dump(spark, path, "other")


def test_edges_in_either_order(spark, tmp_path):
    (tmp_path / "e.txt").write_text("u:a v:b s:A d:1\nv:x u:y\n")
    assert rows(dump.read_edges(spark, str(tmp_path / "e.txt"))) == [("a", "b"), ("y", "x")]
    (tmp_path / "bad.txt").write_text("u:a\n")
    with pytest.raises(Exception, match="malformed"):
        dump.read_edges(spark, str(tmp_path / "bad.txt")).collect()


def test_dump_header(spark, tmp_path):
    (tmp_path / "x-pages-articles.xml").write_text(DUMP)
    path = dump.find_dump(spark, str(tmp_path))
    info = dump.read_siteinfo(spark, path).first()
    assert info.sitename == "W" and info.namespaces == {0: "", 14: "Category"}
    assert dump.check_version(spark, path) == "0.10" and dump.compare_versions("0.10", "0.9") == 1
    with pytest.raises(ValueError, match="newer"):
        dump.check_version(spark, path, "0.3")
    with pytest.raises(Exception, match="several revisions"):
        dump.compat_pages(dump.read_pages(spark, path), {"category": 14}).collect()
    (tmp_path / "y-pages-articles.xml").write_text(DUMP)
    with pytest.raises(ValueError, match="2 dumps"):
        dump.find_dump(spark, str(tmp_path))


def test_both_directions_in_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(relations, "TASK_ROWS", 5)
    df = spark.createDataFrame([(1, 2), (2, 1), (2, 1), (3, 3), (4, 5), (5, 6), (None, 1), (1, None), (None, None), (7, 1)] * 3, "u long, v long")
    found = relations.bothdirs(df)
    assert rows(found) == [(1, 2), (2, 1), (3, 3)]
    assert found.rdd.getNumPartitions() == 3  # 12 rows whose ends are on both sides
