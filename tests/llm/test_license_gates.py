"""What a rule's pattern matches must pass the keyword and stem gates: examples of every optional branch of every rule."""

import itertools
import re
from re import _constants as c
from re import _parser

import pytest

from graphloom.llm import license_scan
from graphloom.llm.license_rules import RULES


def examples(pattern):
    """Texts for each choice of alternatives and optional parts of a pattern."""

    def of(op, av):
        if op is c.LITERAL:
            return [chr(av)]
        if op in (c.ANY, c.NOT_LITERAL):
            return ["x"]
        if op is c.IN:
            literals = [chr(x) for o, x in av if o is c.LITERAL]
            if any(o is c.CATEGORY for o, _ in av):
                return [" "]
            return ["x"] if av[0][0] is c.NEGATE else [chr(x[0]) for o, x in av if o is c.RANGE][:1] or literals
        if op is c.BRANCH:
            return [s for one in av[1] for s in sequence(one)]
        if op is c.SUBPATTERN:
            return sequence(av[3])
        if op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, _, inner = av
            return [s * n for s in sequence(inner) for n in {low, max(low, 1)}]
        assert op in (c.AT, c.ASSERT_NOT), op
        return [""]

    def sequence(parts):
        return ["".join(x) for x in itertools.product(*[of(op, av) for op, av in parts])]

    return sequence(_parser.parse(pattern))


def cases(before):
    """(rule, text, start and end of the rule's match), in the pattern's case, in capitals, and broken over comment lines."""
    for n, _, _, pattern, _ in RULES:
        for plain in set(examples(pattern)):
            for text in (plain, re.sub("[a-z]+", lambda m: m[0].upper(), plain), plain.replace(" ", "\n * ")):
                if m := re.search(pattern, before + text):
                    yield n, before + text, m.start(), m.end()


def lost(spark, found):
    rows = spark.createDataFrame(found, "rule int, text string, start int, end int")
    return [r.text for r in license_scan.detect(rows).collect() if not any(s.start <= r.start and r.end <= s.end for s in r.license_spans)]


def test_every_match_has_its_keyword(spark):
    found = list(cases("software; "))  # a stem, so that only the keywords decide
    assert {n for n, *_ in found} == {n for n, *_ in RULES}
    assert lost(spark, found) == []


@pytest.mark.parametrize("text", ["BSD-style license", "BSD-style licence", "zlib/libpng License", "See the LICENSE.txt file", "See LICENSE.md file"])
def test_optional_parts_of_names(spark, text):
    assert lost(spark, [(0, text, 0, len(text))]) == []


def test_every_match_has_a_stem(spark):
    assert lost(spark, list(cases(""))) == []


@pytest.mark.parametrize("text", ["Unauthorized copying of this file is strictly prohibited", "No part of this book may be reproduced", "No part of this work may be reproduced", "TOUS DROITS RESERVES"])
def test_lines_that_stand_alone(spark, text):
    assert lost(spark, [(0, text, 0, len(text))]) == []
