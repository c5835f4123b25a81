"""Rows that share a doc_id, or have none, in near-duplicate groups."""

from graphloom.llm import minhash


def test_deduplicate_tells_rows_of_an_id_apart(spark):
    copied = "one two three four five six seven eight"
    only = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(3, copied), (5, copied), (5, only), (None, copied), (None, "an entirely different line of words stands here")]
    got = minhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == {rows[0], rows[2], rows[4]} and len(got) == 3
