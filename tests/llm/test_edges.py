"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

from graphloom.llm import ann, decontaminate, html_text, langid, license_scan, minhash, mixing, pii, quality, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "palabra " * 30_000


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, LONG, "es", "b", len(LONG)), (5, "mail me: x@example.com now", "en", "b", 1), (5, "mail me: x@example.com now", "en", "b", 1), (None, "the cat sat on the mat", "en", None, 5), (7, "!!! ...", "en", "c", 7)]
    return docs_frame(spark, rows)


def clash(df):
    """Extra columns named like what operators make."""
    names = ("score", "label", "n", "cid", "words", "s", "size", "hits", "lang_pred", "pii_email_", "tie", "bucket")
    return df.withColumns({x: F.lit("extra") for x in names})


def test_language(spark, odd):
    got = langid.digest(odd.select("doc_id", "text", "lang")).collect()
    assert len(got) == 8
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 7)} == {"und"}
    assert langid.digest(odd.limit(0)).count() == 0
    assert set(langid.keep_identified(clash(odd)).columns) == set(clash(odd).columns)


def test_near_duplicates(spark, odd):
    got = {r.doc_id: r for r in minhash.near_duplicates(odd).collect()}
    assert (got[1].n_shingles, got[1].component_id, got[1].kept) == (0, 1, True)
    assert got[4].n_shingles == 1 and got[2].component_id == 2 and got[3].component_id == 3
    assert minhash.near_duplicates(odd).count() == 8
    assert minhash.near_duplicates(odd.limit(0)).count() == 0
    assert minhash.deduplicate(clash(odd)).columns == clash(odd).columns


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    docs = odd.union(docs_frame(spark, [(9, "x y ONE, two three; four five six seven z", "en", "a", 1), (9, "x y ONE, two three; four five six seven z", "en", "a", 1), (10, "one two three four five nine ten", "en", "a", 1)]))
    assert [(r.doc_id, r.item_id, r.similarity, r.first_word, r.n_words) for r in decontaminate.leaks(docs, items).collect()] == [(9, 1, 1.0, 2, 7)]
    kept = decontaminate.clean(clash(docs), items)
    assert kept.count() == 9 and kept.columns == clash(docs).columns
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.leaks(docs.limit(0), items).count() == 0


def test_pii(spark, odd):
    got = {r.doc_id: r for r in pii.digest(odd).collect()}
    assert (got[5].n_email, got[5].spans) == (1, "email:9:22")
    assert got[1].spans == "" and got[4].n_card == 0
    masked = pii.redact(clash(odd))
    assert masked.columns == clash(odd).columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[5] == "mail me: [EMAIL] now" and texts[1] is None and texts[4] == LONG


def test_licenses(spark, odd):
    got = {r.doc_id: r for r in license_scan.digest(odd).collect()}
    assert (got[1].n_words, got[1].labels, got[1].score) == (0, "", 0.0)
    assert got[4].n_words == 30_000
    one = license_scan.digest(docs_frame(spark, [(1, "CC BY and (c) All Rights\nReserved", "en", "a", 1)])).first()
    assert (one.n_base, one.first_word, one.last_word, one.base_labels) == (2, 0, 4, "cc-by,reserved")


def test_mixing(spark, odd):
    got = {r.doc_id: r for r in mixing.Mix(odd, block=8).taken().collect()}
    assert mixing.Mix(odd, block=8).taken().count() == 8
    assert got[1].size == got[1].taken == 0 and got[7].taken <= 2 * got[7].size
    assert mixing.Mix(odd.limit(0)).taken().count() == 0
    again = {r.doc_id: r for r in mixing.Mix(odd.repartition(5), block=8).taken().collect()}
    assert again == got
    blocks = mixing.Mix(clash(odd).drop("size", "tie", "words", "bucket", "s", "n"), block=8).blocks().collect()
    assert sum(b.n_words for b in blocks) == sum(r.taken for r in mixing.Mix(odd, block=8).taken().collect())
    assert all(len(b.text.split(" ")) == b.n_words <= 8 for b in blocks)


def test_quality(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(3, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.digest(odd, labels).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.digest(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.digest(odd.limit(0), labels).count() == 0
    named = lambda df: df.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert quality.digest(named(odd), named(labels)).count() == 8


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>A&amp;B<p>c</article><footer>f</footer>"), (3, "u", "x <b>y"), (4, "http://A.Example.NET/es/x?y", "<" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.digest(pages).collect())
    assert got[:2] == [(1, "", 0), (2, "", 0)] and (3, "x y", 3) in got and len(got) == 5
    assert html_text.digest(pages.limit(0)).count() == 0
    judged = {(r.page_id, r.host, r.path, r.rule) for r in url_filter.judge(pages.withColumn("score", F.lit(1))).collect()}
    assert (4, "a.example.net", "/es/x", "net/es/") in judged and (2, "", "", None) in judged


def test_neighbours(spark):
    nan = float("nan")
    rows = [(0, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (100, [2.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [1.0, None]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df, share=1.0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 2**0.5), (0, 4, 100, 5**0.5), (100, 1, 3, 1.0), (100, 2, 0, 5**0.5), (100, 3, 1, 5**0.5), (100, 4, 2, 5**0.5)]
    assert ann.search(df.limit(0)).count() == 0
