"""The thin queries: one operator each, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import ann, decontaminate, html_text, langid, license_scan, minhash, mixing, pii, quality, url_filter
from graphloom.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).taken()


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=85)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.leaks(docs, items).drop("text_hash")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents", "doc_id", "text"))


def licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op6: words, places of the base phrases, their labels."""
    return op6_licenses(spark, sf_dir).drop("labels", "score")


def urls_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op9: host, path, rule, and the verdict where a rule fits."""
    return op9_urls(spark, sf_dir).withColumn("verdict", F.when(F.col("rule").isNotNull(), F.col("verdict")))


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op10 without offsets: the counts of the base kinds."""
    return op10_pii(spark, sf_dir).drop("base_sha256", "spans")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op1: sizes and targets; and that each source comes within 2 % of its target and no document above twice its size."""
    found = op1_mixing(spark, sf_dir)
    of_source = found.groupBy("source_size", "target").agg((F.abs(F.sum("taken") - F.first("target")) <= 0.02 * F.first("target")).alias("near"), F.bool_and(F.col("taken") <= 2 * F.col("size")).alias("bounded"))
    return of_source.select("source_size", F.round("target", 3).alias("target"), "near", "bounded")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_extraction": op2_extraction,
    "op3_language": op3_language,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_neighbours": op5_neighbours,
    "op6_licenses": op6_licenses,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_urls": op9_urls,
    "op10_pii": op10_pii,
    "licenses_base": licenses_base,
    "urls_base": urls_base,
    "pii_base": pii_base,
    "mixing_targets": mixing_targets,
}

_WORDS = r"""list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
ORACLES: dict[str, str] = {
    "op4_near_duplicates": rf"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sh AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
        n AS (SELECT doc_id, coalesce(len(s), 0) AS n, hash(list_sort(s)) AS c FROM sh),
        cls AS (SELECT c, min(doc_id) AS doc_id, any_value(n) AS n FROM n WHERE n > 0 GROUP BY c),
        post AS (SELECT doc_id, unnest(s) AS v FROM sh SEMI JOIN cls USING (doc_id)),
        pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM post a JOIN post b ON a.v = b.v AND a.doc_id < b.doc_id GROUP BY 1, 2),
        link AS (SELECT a, b FROM pair JOIN cls x ON x.doc_id = a JOIN cls y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
        both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM cls UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
        comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
        SELECT n.doc_id, n.n::BIGINT AS n_shingles, coalesce(component_id, n.doc_id) AS component_id, n.doc_id = coalesce(component_id, n.doc_id) AS kept
        FROM n LEFT JOIN cls ON cls.c = n.c AND n.n > 0 LEFT JOIN comp ON comp.a = cls.doc_id""",
    "licenses_base": r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        p AS (SELECT * FROM (VALUES ('cc-by', ['cc', 'by']), ('gpl', ['general', 'public', 'license']), ('reserved', ['all', 'rights', 'reserved'])) v(label, p)),
        hit AS (SELECT doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS i FROM t, p),
        of_doc AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hit GROUP BY 1)
        SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(labels, '') AS base_labels FROM t LEFT JOIN of_doc USING (doc_id)""",
    "urls_base": r"""WITH u AS (SELECT page_id, url, strpos(url, '://') AS k FROM pages),
        x AS (SELECT page_id, CASE WHEN k > 0 THEN regexp_extract(substr(url, k + 3), '(?s)^([^/?#]*)([^?#]*)', ['h', 'p']) END AS x FROM u),
        y AS (SELECT page_id, coalesce(translate(x.h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(x.p, '') AS path FROM x),
        r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) v(h, p, verdict)),
        m AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM y JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
        SELECT page_id, host, path, rule, verdict FROM y LEFT JOIN m USING (page_id)""",
    "pii_base": r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        x AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email, regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ip,
                     list_transform(regexp_extract_all(text, '[0-9]([\x20-]?[0-9])+'), lambda m: regexp_replace(m, '[^0-9]', '', 'g')) AS card,
                     list_transform(regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: regexp_replace(m, '[^0-9]', '', 'g')) AS phone FROM t)
        SELECT doc_id, len(email)::BIGINT AS n_email, len(list_filter(ip, lambda m: list_max(list_transform(string_split(m, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 256 ELSE p::INT END)) <= 255))::BIGINT AS n_ip,
               len(list_filter(card, lambda c: length(c) BETWEEN 16 AND 19 AND list_sum(list_transform(range(0, length(c)), lambda i: CASE WHEN i % 2 = 0 THEN c[length(c) - i]::INT WHEN c[length(c) - i]::INT > 4 THEN 2 * c[length(c) - i]::INT - 9 ELSE 2 * c[length(c) - i]::INT END)) % 10 = 0))::BIGINT AS n_card,
               len(list_filter(phone, lambda p: length(p) BETWEEN 8 AND 15))::BIGINT AS n_phone FROM x""",
    "mixing_targets": r"""WITH RECURSIVE z AS (SELECT source, sum(coalesce(len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0))::BIGINT AS size FROM documents GROUP BY 1),
        r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM z), w AS (SELECT *, [3, 1, 2][s % 3 + 1] AS weight FROM r),
        -- fill by weight until no source above its cap is left
        fill AS (SELECT 0 AS i, []::BIGINT[] AS full_, 1.5 * sum(size) / sum(weight) AS level FROM w
                 UNION ALL SELECT i + 1, f, (SELECT (1.5 * sum(size) - coalesce(sum(2.0 * size) FILTER (list_contains(f, s)), 0)) / nullif(sum(weight) FILTER (NOT list_contains(f, s)), 0) FROM w)
                 FROM (SELECT i, full_, level, (SELECT list(s) FROM w WHERE list_contains(full_, s) OR weight * level > 2.0 * size) AS f FROM fill WHERE level IS NOT NULL) q WHERE f IS NOT NULL AND len(f) > len(full_)),
        last AS (SELECT full_, level FROM fill ORDER BY i DESC LIMIT 1)
        SELECT size AS source_size, round(CASE WHEN list_contains(full_, s) THEN 2.0 * size ELSE weight * level END, 3)::DOUBLE AS target, true AS near, true AS bounded FROM w, last""",
}
