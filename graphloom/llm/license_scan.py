"""Licence scan: base phrases with word positions, and ordered signature rules.

The signature rules (:mod:`graphloom.llm.license_rules`) are hand-written
regexes in order of priority.  A text first has to hold one of a few stems that
every rule implies; then a rule runs only if its keyword occurs.  Overlapping
detections are resolved by interval containment: a detection that lies inside
one kept before it (by priority) is suppressed.  All of it is a projection of
built-in functions over array literals: no UDF, no shuffle, no join.

Defined cases: null text counts as empty (0 words, no label, score 0); an empty
table gives an empty result; repeated rows are judged alike; extra columns are
passed through by :func:`detect` and ignored by the query.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import bound, match_ends, running
from graphloom.llm.license_rules import RULES

#: Word characters after A-Z are lowered: digits, letters, everything beyond ASCII.
_W = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_NOT_W = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORDS = rf"{_W}++"
PHRASES = {"cc-by": ("cc", "by"), "gpl": ("general", "public", "license"), "reserved": ("all", "rights", "reserved")}

#: Every rule's match holds one of these (checked by a test); a blank stands for anything between two words.
STEMS = (
    "licen", "spdx", "creativ", "public", "gpl", "cc0", "cc by", "permission", "software", "copyright", "unauthorized", "no part of",
    "rights", "bsd", "propri", "apache", "redistrib", r"\.org", r"\.net", "tous droits", "vorbehalt", "reservado", "wtfpl",
)
_SEPARATORS = r"""[\s*#/"'“”-]+"""


def _any_case(stem: str) -> str:
    """A stem with A-Z of either case as character classes, which Java scans faster than a flag."""
    letters = (f"[{ch}{ch.upper()}]" if ch.isascii() and ch.isalpha() else ch for ch in stem)
    return "".join("[^a-zA-Z0-9]+" if ch == " " else ch for ch in letters)


GATE = "|".join(_any_case(s) for s in STEMS)


def _phrase(words: tuple[str, ...]) -> str:
    return rf"(?i)(?<!{_W})" + rf"{_NOT_W}++".join(words) + rf"(?!{_W})"


def _starts(text: Column, words: tuple[str, ...]) -> Column:
    """Word indices at which a phrase starts.  A phrase of distinct words can't overlap itself."""
    gaps = F.split(text, _phrase(words), -1)
    counted = F.transform(gaps, lambda g: F.regexp_count(g, F.lit(WORDS)))
    ends = running(F.transform(F.slice(counted, 1, F.size(counted) - 1), lambda n: n + len(words)), lambda x, y: x + y)
    walked = F.transform(ends, lambda e: e - len(words))
    gate = rf"(?i){words[0]}{_NOT_W}++{words[1]}"
    return F.when(text.rlike(gate), walked).otherwise(F.array().cast("array<int>"))


def _plain(keyword: str) -> str:
    return re.sub(_SEPARATORS, " ", keyword).strip()


_SPAN = "array<struct<rule:int,label:string,start:int,end:int,confidence:int>>"


def _rules_literal() -> Column:
    return F.array(
        *[
            F.struct(F.lit(n).alias("rule"), F.lit(label).alias("label"), F.lit(_plain(kw)).alias("keyword"), F.lit(rx).alias("regex"), F.lit(c).alias("confidence"))
            for n, label, kw, rx, c in RULES
        ]
    )


def _uncovered(own: Column, earlier: Column) -> Column:
    """The spans of ``own`` that lie inside none of ``earlier``.

    In the order of starts, a span is inside another if one that starts no later ends no sooner: the largest end so
    far tells.  A span that covers a suppressed one is covered by what suppressed that, so suppressed spans may count too.
    """
    kind = "array<struct<start:int,own:int,end:int,i:int>>"
    left = F.transform(earlier, lambda s: F.struct(s["start"], F.lit(0), s["end"], F.lit(0))).cast(kind)
    right = F.transform(own, lambda s, i: F.struct(s["start"], F.lit(1), s["end"], i)).cast(kind)

    def told(x: Column) -> Column:
        tops = running(F.transform(x["all"], lambda m: F.when(m["own"] == 0, m["end"]).otherwise(F.lit(0))), F.greatest)
        return bound(
            F.struct(x["all"].alias("all"), x["own"].alias("own"), tops.alias("tops")),
            lambda y: F.filter(
                F.transform(y["all"], lambda m, k: F.when((m["own"] == 1) & (F.get(y["tops"], k) < m["end"]), F.get(y["own"], m["i"]))), lambda s: s.isNotNull()
            ),
        )

    return F.when(F.size(earlier) == 0, own).otherwise(bound(F.struct(F.array_sort(F.concat(left, right)).alias("all"), own.alias("own")), told))


def _detections(text: Column) -> Column:
    """Kept spans of all rules: in order of priority, none inside one kept before."""
    folded = F.regexp_replace(F.lower(text), _SEPARATORS, " ")

    def spans(rule: Column) -> Column:
        gaps = F.split(text, rule["regex"], -1)
        matches = F.regexp_extract_all(text, rule["regex"], F.lit(0))
        one = lambda i, ends: F.struct(
            rule["rule"].alias("rule"), rule["label"].alias("label"), F.get(ends, 2 * i).alias("start"), F.get(ends, 2 * i + 1).alias("end"), rule["confidence"].alias("confidence")
        )
        spots = lambda ends: F.transform(F.filter(ends, lambda _, i: i % 2 == 0), lambda _, i: one(i, ends)).cast(_SPAN)
        return bound(match_ends(gaps, matches), spots)

    # through a one-element array, so that the folded text is made once and not once a rule
    tried = F.flatten(F.transform(F.array(folded), lambda f: F.filter(_rules_literal(), lambda r: F.contains(f, r["keyword"]))))
    kept = bound(F.transform(tried, spans), lambda lists: F.flatten(F.transform(lists, lambda own, j: _uncovered(own, F.flatten(F.slice(lists, 1, j))))))
    return F.when(text.rlike(GATE), kept).otherwise(F.array().cast(_SPAN))


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``license_<phrase>`` (word indices) and ``license_spans`` (code points, end exclusive)."""
    t = F.coalesce(F.col(text), F.lit(""))
    new = {f"license_{k}": _starts(t, words) for k, words in PHRASES.items()}
    return docs.withColumns(
        new | {"n_words": F.regexp_count(t, F.lit(WORDS)).cast("long"), "license_spans": _detections(t)}
    )


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    found = detect(docs.select("doc_id", "text"))
    starts = F.concat(*[F.col(f"license_{k}") for k in PHRASES])
    base = F.concat(*[F.when(F.size(f"license_{k}") > 0, F.array(F.lit(k))).otherwise(F.array().cast("array<string>")) for k in PHRASES])
    own = F.transform(F.col("license_spans"), lambda s: s["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.greatest(
            F.coalesce(F.array_max(F.transform(F.col("license_spans"), lambda s: s["confidence"])), F.lit(0)),
            F.when(F.size(starts) > 0, F.lit(70)).otherwise(F.lit(0)),
        ).cast("double").__truediv__(F.lit(100.0)).alias("score"),
    )
