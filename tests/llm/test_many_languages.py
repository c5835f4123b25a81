"""More languages than a fixed number."""

from graphloom.llm import langid


def test_every_language_is_learned(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", f"l{i % 80}") for i in range(2400)], "doc_id long, text string, lang string")
    assert {r.lang for r in langid._training_rows(docs).collect()} == {f"l{i}" for i in range(80)}
