"""Column functions against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from graphloom.functions import text as X
from graphloom.functions.wikitext import infobox_links, link_markups, outside_templates

CASES = [
    (X.clean_text, ' a"b\\c ', 'a\\"b\\\\c'),
    (X.clean_text, "\nx\n", "\\nx\\n"),
    (X.clean_title, " a__b  c#d ", "a b c"),
    (X.unescape_text, 'a\\"b\\nc', 'a"b\nc'),
    (X.normalize_casing, "élan vital mcDonald's (foo)", "Élan Vital McDonald'S (Foo)"),
    (X.normalize_title, ' a\\"b c#d ', 'a"b_c'),
    (X.title_to_headword, "_Anarchism_(book)_", "anarchism"),
    (X.normalize_anchor, '"The  Book (x)#y"', "the_book"),
    (X.case_fixer, "talk:abc", "talk:Abc"),
    (X.case_fixer, "abc", "Abc"),
    (X.strip_text, "a {{x}} [[b|c]] [[d]] [[E:f]] ''g''<ref>h</ref>", "a  c d  g"),
    (X.strip_text, "[[wiktionary:dog|hound]] [[Wiktionary:cat]] x<REF name=a>y</Ref>", "hound cat x"),
    (lambda c: F.nullif(F.array_join(X.ngrams(c, 2), "/"), F.lit("")), "a b\nc a", "a/a b/b/c/c a"),
]


@pytest.mark.parametrize(("function", "given", "expected"), CASES)
def test_scalar(spark, function, given, expected):
    row = spark.createDataFrame([(given,), (None,)], "s string").select(function(F.col("s")).alias("t")).collect()
    assert [r.t for r in row] == [expected, None]


def test_structs(spark):
    df = spark.createDataFrame([("Category:X",), (":Category:X",), ("es:Título",), ("Foo|bar|baz",), ("a::b",)], "m string")
    ns = {"category": 14}
    rows = df.select(X.markup_namespace(F.col("m"), ns).alias("n"), X.markup_language(F.col("m"), ns).alias("l"), X.parse_link(F.col("m")).alias("p")).collect()
    assert [(r.n.link, r.n.key) for r in rows] == [("X", 14), (":Category:X", 0), ("es:Título", 0), ("Foo|bar|baz", 0), ("a:b", 0)]
    assert [r.l.lang for r in rows] == [None, None, "es", None, "a:"]
    assert (rows[3].p.title, rows[3].p.anchor) == ("Foo", "bar|baz")


def test_ngrams(spark):
    row = spark.createDataFrame([("a b a b",), ("",)], "s string").select(X.ngrams(F.col("s")).alias("g")).collect()
    assert sorted(row[0].g) == ["a", "a b", "a b a", "a b a b", "b", "b a", "b a b"]
    assert row[1].g == []


def test_tokens():
    assert outside_templates("a{{b{{c}}d}}e}}f{{g}}h") == "aeg"
    assert link_markups("[[a]] [[File:x|[[b]] c]] [[d|e]] [[open") == ["a", "d|e", "open"]
    assert infobox_links("{{Infobox person | a=[[x]] {{y|[[z]]}} b=[[w]] c=[[x]]}} [[out]]") == ["x", "w"]
    assert infobox_links("{{Infobox\n|a=[[x]]}}") == []
