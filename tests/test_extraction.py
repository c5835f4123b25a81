"""A small dump through all relations, canonical targets and the dictionary."""

import pytest

from graphloom.functions import languages
from graphloom.operators import extraction
from graphloom.sources import dump
from pyspark.sql import functions as F

PAGES = [
    (1, "Amber", "[[Basalt]] and [[basalt|the rock]] {{note|[[Chalk]]}} [[es:Ambar]] [[Category:Stones]] [[Nowhere]] [[File:x [[Chalk]] y]] [[Amber]]"),
    (2, "Basalt", "[[Amber#History|tale]] {| [[Chalk]] |} [[Old name]] [[ ]] [[Chalk"),
    (3, "Chalk", "}} hidden {{ [[Amber]]"),
    (4, "Old name", "#REDIRECT [[Older name|x]]"),
    (5, "Older name", "#redirect: [[:Basalt]]"),
    (6, "Loop A", "#REDIRECT [[Loop B]]"),
    (7, "Loop B", "#REDIRECT [[Loop A]]"),
    (8, "Into loop", "#REDIRECT [[Loop A]]"),
    (9, "Category:Stones", "[[Category:Things]] [[Chalk]]"),
    (10, "Stones", "{{Infobox rock\n| a=[[Amber]] {{sub|[[Chalk]]}} b=[[Amber]] c=[[Gone]]}} plain"),
    (11, "Ore", "'''Ore''' may be:\n* [[Amber]], a '''gem'''\n* Ore or [[Chalk]]\n** [[Old name|old]] thing\n* [[Lost]]\n== See also ==\n* [[Basalt]]\n{{disambig}}"),
    (12, "Not ambiguous", "{{disambiguation needed|date=May}} [[Ore]]"),
    (13, "Talk:Amber", "[[Basalt]]"),
    (14, "basalt", "#REDIRECT [[Chalk]]"),
    (15, "Mixed: case", "[[Mixed: case]] and [[Category:Stones|key]]"),
    (16, "Pick", "text [[Amber]]\n[[Category:Disambiguation pages]]\n[[de:Hacke]]\n* [[Chalk]]"),
    (17, "Category:Old stones", "#REDIRECT [[Category:Stones]]"),
    (18, "Empty", ""),
]
NAMESPACES = {"category": 14, "talk": 1, "file": 6}


@pytest.fixture(scope="module")
def got(spark):
    frame = spark.createDataFrame([(i, t, None, x, k) for k, (i, t, x) in enumerate(PAGES)], "id long, title string, redirect string, text string, position long")
    return extraction.extract(frame, NAMESPACES)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pages_and_redirects(got):
    kinds = {r.id: r.type for r in got.page.collect()}
    assert kinds == {1: 1, 2: 1, 3: 1, 4: 3, 5: 3, 6: 3, 7: 3, 8: 3, 9: 2, 10: 1, 11: 4, 12: 1, 14: 3, 15: 1, 16: 4, 17: 3, 18: 1}
    assert rows(got.stats) == [(7, 1, 7, 2)]
    assert rows(got.redirect) == [(4, 5), (5, 2), (6, 7), (7, 6), (8, 6), (14, 3), (17, 9)]


def test_links(got):
    assert rows(got.pagelink) == [
        (1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (2, 3), (3, 1), (4, 2), (6, 7), (7, 6), (8, 6), (9, 3), (11, 1), (11, 2), (11, 2), (11, 3), (12, 11), (14, 3), (15, 15), (16, 1), (16, 3),
    ]
    assert rows(got.categorylink) == [(9, 1), (9, 15), (9, 17)]
    assert rows(got.translation) == [(1, "es", "Ambar"), (16, "de", "Hacke")]
    assert rows(got.equivalence) == [(9, 10)]
    assert rows(got.infobox) == [(10, 1)]
    lost = {(r.kind, r.id, r.target) for r in got.rejects.collect()}
    assert lost == {("pagelink", 1, "Nowhere"), ("pagelink", 5, ":Basalt"), ("pagelink", 11, "Lost"), ("disambiguation", 11, "Lost"), ("infobox", 10, "Gone"), ("categorylink", 9, "Things"), ("categorylink", 16, "Disambiguation pages"), ("disambiguation", 16, "Disambiguation pages")}


def test_disambiguations_and_anchors(got):
    assert rows(got.disambiguation) == [(11, 1, 1, "Amber, a gem"), (11, 2, 2, "old thing"), (16, 1, 1, "text Amber")]
    anchors = {(r.anchor, r.target_id): r.freq for r in got.anchor.collect()}
    assert anchors["Basalt", 2] == 2 and anchors["the rock", 2] == 1 and anchors["tale", 1] == 1
    assert anchors["Old name", 2] == 1 and anchors["Older name", 2] == 0 and anchors["basalt", 3] == 0
    assert anchors["Loop A", 6] == 2 and anchors["Into loop", 6] == 0 and anchors["Mixed: case", 15] == 1


def test_canonical_and_dictionary(got):
    canon = extraction.canonical_pages(got.page, got.pagelink, got.disambiguation)
    assert set(rows(canon)) >= {(4, 2), (11, 1), (11, 2), (16, 1), (1, 1), (2, 2)} and not [r for r in rows(canon) if r[0] in (6, 7, 8)]
    words = {(r.headword, r.entity): r.weight for r in extraction.entity_dictionary(got.anchor, got.page, canon).collect()}
    assert words["the_rock", "Basalt"] == 1 and words["old_name", "Basalt"] == 2
    assert words["ore", "Amber"] == 1 and words["amber", "Amber"] == 5
    twice = got.page.unionByName(got.page.where("id = 1"))
    with pytest.raises(Exception, match="more than one type"):
        extraction.entity_dictionary(got.anchor, twice, canon).collect()


def test_written_and_read_again(got, spark, tmp_path):
    folder = str(tmp_path / "out")
    got.write(folder)
    assert len(extraction.finished(spark, folder)) == 11
    assert rows(dump.read_page_relation(spark, f"{folder}/page")) == rows(got.page)
    assert rows(dump.read_anchors(spark, f"{folder}/anchor").select(F.sum("freq"))) == rows(got.anchor.select(F.sum("freq")))


def test_languages(spark):
    texts = ["#REDIRECCIÓN [[Uno|x]]", "#birzuzendu [[Bi]]", "#REDIRECT [[Three]]", "{{DES}}", "{{des|x}}", "{{deseo}}", "{{Disambig\n}}", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    column = lambda c: [r[0] for r in df.select(c).collect()]
    assert column(languages.redirect_markup(F.col("t"), "es"))[:3] == ["Uno", None, "Three"]
    assert column(languages.redirect_markup(F.col("t"), "eu"))[:3] == [None, "Bi", "Three"]
    assert column(languages.is_disambiguation(F.col("t"), "es"))[3:6] == [True, True, False]
    assert column(languages.is_disambiguation(F.col("t")))[6:] == [True, False]
    with pytest.raises(ValueError, match="unknown language"):
        languages.settings("xx")


def test_links_to_text(spark):
    df = spark.createDataFrame([(1, "a [[B|b]] [[C]] [[File:x|y]] [[D|e|f]] end"), (2, "plain"), (3, None)], "id long, text string")
    assert rows(extraction.links_to_text(df))[:2] == [(1, "a b C  e|f end"), (2, "plain")]
