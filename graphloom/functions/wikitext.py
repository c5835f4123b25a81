"""Nested markup, which regular expressions can't follow: Arrow-batched functions over tokens."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_BRACES, _BRACKETS = re.compile(r"(\{\{|\}\})"), re.compile(r"(\[\[|\]\])")
_TABLE = re.compile(r"\{\|.*?\|\}", re.S)


def outside_templates(text: str) -> str:
    """Text outside double braces; an unbalanced closing pair hides what follows until it is balanced again.  Tables go too."""
    depth, out = 0, []
    for token in _BRACES.split(text):
        if token == "{{":
            depth += 1
        elif token == "}}":
            depth -= 1
        elif depth == 0:
            out.append(token)
    return _TABLE.sub("", "".join(out))


def link_markups(text: str) -> list[str]:
    """What stands between a pair of double brackets, in order; a link that holds another is dropped with it, an unclosed one ends with the text."""
    out, depth, nested, inner = [], 0, False, []
    for token in _BRACKETS.split(text):
        if token == "[[":
            depth += 1
            nested |= depth > 1
            if depth == 1:
                nested, inner = False, []
        elif token == "]]":
            if depth == 1 and not nested and "".join(inner):
                out.append("".join(inner))
            depth = max(0, depth - 1)
        elif depth:
            inner.append(token)
    if depth == 1 and not nested and "".join(inner):
        out.append("".join(inner))
    return out


def infobox_links(text: str) -> list[str]:
    """Distinct links directly inside an ``Infobox`` template (not in templates nested in it)."""
    text = re.sub(r"<!--.*?-->|</?includeonly>|<(noinclude|nowiki|imagemap|gallery|source|pre)\b[^<>]*>.*?</\1>|<ref[^<>]*/>|<ref\b[^<>]*>.*?</ref>", "", text, flags=re.S | re.I)
    found: dict[str, None] = {}
    stack: list[bool] = []
    opened = False
    for token in _BRACES.split(text):
        if token == "{{":
            stack.append(False)
            opened = True
            continue
        if token == "}}":
            if stack:
                stack.pop()
        elif stack:
            if opened and token[:8].lower() == "infobox " and not any(stack[:-1]):
                stack[-1] = True
            if stack[-1]:
                found |= dict.fromkeys(link_markups(token))
        opened = False
    return list(found)


def _mapped(kind: str, function: Callable[[str], object]) -> Callable[[str | Column], Column]:
    """A column function of texts; null stays null."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else function(t) for t in texts], dtype=object)

    return lambda column: F.pandas_udf(run, kind)(column)


_strip_templates = _mapped("string", outside_templates)
_extract_links = _mapped("array<string>", link_markups)
extract_infobox_links = _mapped("array<string>", infobox_links)


def strip_templates(column: str | Column) -> Column:
    """:func:`outside_templates`; texts without double braces stay in the JVM."""
    text = F.col(column) if isinstance(column, str) else column
    # a function in Python runs on every row that it is given, so rows without braces give it nothing to do
    braces = text.contains("{{") | text.contains("}}")
    return F.when(braces, _strip_templates(F.when(braces, text))).otherwise(F.regexp_replace(text, r"(?s)\{\|.*?\|\}", ""))


def extract_links(column: str | Column) -> Column:
    """:func:`link_markups`; texts without double brackets stay in the JVM."""
    text = F.col(column) if isinstance(column, str) else column
    brackets = text.contains("[[")
    return F.when(brackets, _extract_links(F.when(brackets, text))).when(text.isNotNull(), F.array().cast("array<string>"))
