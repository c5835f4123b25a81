"""Personal data: regexes propose spans, checksums confirm them, context words adjust the score.

Everything is a narrow projection of built-in functions (no shuffle, no UDF):
the gaps between matches (``split``) and the matches (``regexp_extract_all``)
give code-point offsets.  Each kind hides behind a cheap gate, so a text without
``@``, ``+`` or digits never meets the costly patterns.

The patterns are written possessively with a look-behind (or ``\\G``) where an
attempt that fails at the start of a run must fail inside it as well; this keeps
them linear on very long runs without changing any match.

Defined cases: null text counts as empty (no spans, the digest of the empty
string); an empty table gives an empty result; repeated rows are judged alike;
extra columns of the input are passed through by :func:`detect` and ignored by
the query; spans of a kind never overlap, spans of different kinds may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import bound, match_ends, piece, reserved, running, segments, splits_of

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
SECRET = r"(?i)(?<![A-Za-z0-9_])(?:api[_-]?key|token|secret|passw(?:or)?d)[ ]{0,3}[=:][ ]{0,3}\"[^\"\s]{8,200}\""

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_VALID = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"

#: Kinds in the order of the digest: base kinds first.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn", "secret")

#: Words that raise the score of a span when they stand within CONTEXT code points before or after it.
CONTEXT = 60
CONTEXT_WORDS = {
    "email": r"(?i)\b(?:e-?mail|contact|write|mailto|address)",
    "ip": r"(?i)\b(?:ip|host|server|address|login)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|cvv|karte|tarjeta|carte)",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone)",
    "iban": r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)",
    "ssn": r"(?i)\b(?:ssn|social security|tax id)",
    "secret": r"(?i)\b(?:token|secret|key|password)",
}
#: Score before the context is looked at; a checksum is strong evidence.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "secret": 0.8}
BONUS = 0.2
#: Extra kinds below this score are not reported (base kinds always are).
THRESHOLD = 0.5


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def _mod97(iban: Column) -> Column:
    """Whether an IBAN (blanks removed) passes mod-97: letters count 10 to 35, first four characters last."""
    s = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code < 65, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(s, "(?<=.)(?=.)"), F.lit(0), step) == 1


def _iban(m: Column) -> Column:
    """The longest part of ``m`` from its start to a blank or its end that is an IBAN, else null."""
    ends = F.filter(F.sequence(F.length(m), F.lit(15)), lambda n: (n == F.length(m)) | (F.substring(m, n + 1, F.lit(1)) == " "))
    tried = F.transform(ends, lambda n: F.substring(m, F.lit(1), n))
    bare = lambda p: F.replace(p, F.lit(" "), F.lit(""))
    return F.get(F.filter(tried, lambda p: F.length(bare(p)).between(15, 34) & ~p.endswith(" ") & _mod97(bare(p))), F.lit(0))


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(IP_VALID)
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return _iban(m).isNotNull()
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9..)|-00-|-0000$")
    return F.lit(True)


def _length(kind: str, m: Column) -> Column:
    """Code points of a confirmed match: an IBAN ends where its check does."""
    return F.length(_iban(m)) if kind == "iban" else F.length(m)


_PATTERN = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN, "secret": SECRET}
#: Linear tests without which a kind can't match.
_GATE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){15}"),
    "phone": lambda t: F.contains(t, F.lit("+")) & t.rlike(r"\+[0-9][ ().0-9-]"),
    "iban": lambda t: t.rlike(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2} ?[A-Z0-9]"),
    "ssn": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "secret": lambda t: t.rlike(r'(?i)(?:key|token|secret|passw(?:or)?d)[ ]{0,3}[=:][ ]{0,3}"'),
}
_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _spans(text: Column, kind: str) -> Column:
    gaps, matches = splits_of(text, _PATTERN[kind])

    def found(x: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            start, end = F.get(x["ends"], 2 * i), F.get(x["ends"], 2 * i + 1)
            near = F.concat(piece(x["parts"], F.greatest(F.lit(0), start - CONTEXT), start), F.lit(" "), piece(x["parts"], end, end + CONTEXT))
            bonus = F.lit(BONUS) if kind == "secret" else F.when(near.rlike(CONTEXT_WORDS[kind]), F.lit(BONUS)).otherwise(F.lit(0.0))
            score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + bonus)
            return F.when(_valid(kind, m), F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + _length(kind, m)).alias("end"), score.alias("score")))

        least = 0.0 if kind in BASE_KINDS else THRESHOLD
        return F.filter(F.transform(x["matches"], span), lambda s: s.isNotNull() & (s["score"] >= least)).cast(_SPAN)

    whole = F.struct(segments(text).alias("parts"), matches.alias("matches"), match_ends(gaps, matches).alias("ends"))
    return F.when(_GATE[kind](text), bound(whole, found)).otherwise(F.array().cast(_SPAN))


def detect(docs: DataFrame, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """``docs`` with ``<prefix><kind>`` per kind: arrays of (kind, start, end, score), offsets in code points, end exclusive.

    A column of ``docs`` that has such a name already is replaced; another ``prefix`` keeps it.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({f"{prefix}{k}": _spans(t, k) for k in (*BASE_KINDS, *EXTRA_KINDS)})


def _listed(kinds: tuple[str, ...]) -> Column:
    spans = F.concat(*[F.col(f"pii_{k}") for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: counts and digest of the base kinds, and the list of all spans."""
    found = detect(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(BASE_KINDS), 256).alias("base_sha256"),
        _listed((*BASE_KINDS, *EXTRA_KINDS)).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``[KIND]``; other columns stay, ``n_chars`` follows the text.

    Overlapping spans of different kinds become one mask, named after the span
    that starts first (of those, the longest; then by kind).  Null text stays null.
    """
    kinds = (*BASE_KINDS, *EXTRA_KINDS)
    prefix = "pii_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    t = F.col(text)
    # in one column, so that the spans are found once
    spans = F.array_sort(
        F.transform(
            F.concat(*[F.col(f"{prefix}{k}") for k in kinds]),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg_end"), s["kind"].alias("kind")),
        )
    )

    def masked(x: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(x["upto"], i - 1)).otherwise(F.lit(0))
        mask = lambda s, i: F.when(
            s["start"] >= before(i), F.concat(piece(x["parts"], before(i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        ).otherwise(F.lit(""))
        return F.concat(F.array_join(F.transform(x["spans"], mask), ""), piece(x["parts"], F.element_at(x["upto"], -1), F.length(t)))

    upto = lambda x: F.struct(x["parts"], x["spans"], running(F.transform(x["spans"], lambda s: -s["neg_end"]), F.greatest).alias("upto"))
    found = detect(docs, text, prefix)
    any_span = sum((F.size(f"{prefix}{k}") for k in kinds), F.lit(0)) > 0
    whole = bound(bound(F.struct(segments(t).alias("parts"), spans.alias("spans")), upto), masked)
    new = F.when(t.isNotNull() & any_span, whole).otherwise(t)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    name = reserved(found.columns, "__masked")
    out = found.select(*kept, new.alias(name), any_span.alias(f"{name}_any"))
    n_chars = F.when(F.col(f"{name}_any"), F.length(name).cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    replaced = {text: F.col(name), "n_chars": n_chars}
    return out.select(*(replaced[c].alias(c) if replaced.get(c) is not None else F.col(f"`{c}`") for c in docs.columns))
