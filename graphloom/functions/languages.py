"""What differs between language editions: redirect words, disambiguation marks and the see-also heading."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Language:
    redirects: tuple[str, ...]
    templates: tuple[str, ...]
    categories: tuple[str, ...]
    see_also: str
    root_category: str


# fixed values: settings of the language editions
LANGUAGES = {
    "en": Language(
        ("#redirect",),
        ("disambiguation", "disambig", "geodis", "hndis", "airport dis", "hospital dis", "mathdab", "mountianindex", "numberdis", "roaddis", "schooldis", "shipindex", "sia"),
        ("disambiguation",), "see also", "Contents",
    ),
    "es": Language(("#redirect", "#redirección", "#redireccion"), ("desambiguación", "des"), ("wikipedia:desambiguación",), "véase también", "Artículos"),
    "eu": Language(("#redirect", "#birzuzendu"), ("argipen", "disambig"), ("wikipedia:argipen",), "ikus, gainera", "Edukiak"),
}


def settings(lang: str) -> Language:
    if lang not in LANGUAGES:
        raise ValueError(f"unknown language {lang}; known: {', '.join(LANGUAGES)}")
    return LANGUAGES[lang]


def _any(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def redirect_markup(text: Column, lang: str = "en") -> Column:
    """The link of a page that starts with a redirect word, up to its pipe; null for any other page."""
    target = F.regexp_extract(text, rf"(?iUd)^\s*{_any(settings(lang).redirects)}\s*:?\s*\[\[:*(.*?)\]\]", 1)
    return F.when(target != "", F.regexp_extract(target, r"(?s)^[^|]*", 0))


def is_disambiguation(text: Column, lang: str = "en", category: str = "category") -> Column:
    """Whether a text stands in a disambiguation category or calls a disambiguation template.

    ``{{disambiguation needed|...}}`` and the like mark a link and not a page: the first
    such template must not be followed by a word and a pipe.
    """
    known, low = settings(lang), F.lower(text)
    listed = low.rlike(rf"(?d)\[\[{re.escape(category.lower())}:{_any(known.categories)}.*?\]\]")
    template = rf"\{{\{{{_any(known.templates)}\b"
    behind = F.regexp_extract(low, rf"(?sU){template}(.*)$", 1)
    called = low.rlike(f"(?U){template}")
    other = F.regexp_extract(behind, r"(?d)^(.*?)\}\}", 1).rlike(r"(?U)^\s*[^|\s]+\s*\|")
    return F.coalesce(listed | (called & ~other), F.lit(False))
