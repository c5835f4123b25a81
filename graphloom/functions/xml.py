"""XML texts: XPath queries, regular expressions on nodes, JSON and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPTIONS = {"attributePrefix": "@", "valueTag": "$t"}


def with_variables(path: str, values: dict[str, str | float]) -> str:
    """``path`` with each ``$name`` replaced by its value as an XPath literal."""
    for name in sorted(values, key=len, reverse=True):
        value = values[name]
        if isinstance(value, str) and "'" in value and '"' in value:
            raise ValueError(f"a literal can't hold both kinds of quotes: {value}")
        literal = str(value) if not isinstance(value, str) else f"'{value}'" if "'" not in value else f'"{value}"'
        path = path.replace(f"${name}", literal)
    return path


def find_nodes(xml: Column, path: str) -> Column:
    """Text of the nodes that ``path`` (to text or attributes) finds, in document order."""
    return F.xpath(xml, F.lit(path))


def nodes_as_string(xml: Column, path: str, separator: str = "") -> Column:
    return F.array_join(find_nodes(xml, path), separator)


def find_value(xml: Column, path: str) -> Column:
    """The value of any expression as a string; of nodes, the first one's."""
    return F.xpath_string(xml, F.lit(path))


def find_number(xml: Column, path: str) -> Column:
    return F.xpath_double(xml, F.lit(path))


def exists(xml: Column, path: str) -> Column:
    return F.xpath_boolean(xml, F.lit(path))


def matches(xml: Column, path: str, pattern: str) -> Column:
    """Whether a node that ``path`` finds matches a regular expression."""
    return F.exists(find_nodes(xml, path), lambda v: v.rlike(pattern))


def rounded(number: Column) -> Column:
    """XPath's rounding: halves go up, also below zero."""
    return F.floor(number + 0.5)


def public(schema: T.StructType) -> T.StructType:
    """``schema`` without private elements and attributes (names that start with an underscore), at every depth."""

    def clean(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return public(kind)
        return T.ArrayType(clean(kind.elementType)) if isinstance(kind, T.ArrayType) else kind

    return T.StructType([T.StructField(f.name, clean(f.dataType)) for f in schema if not f.name.lstrip("@").startswith("_")])


def to_json(xml: Column, schema: str | T.StructType, sanitize: bool = False, pretty: bool = False) -> Column:
    """Objects with attributes as ``@name`` and text as ``$t``; elements that repeat are arrays where ``schema`` says so."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return F.to_json(F.from_xml(xml, public(schema) if sanitize else schema, _OPTIONS), {"pretty": str(pretty).lower()})


def from_json(json: Column, schema: str | T.StructType, root: str) -> Column:
    """The XML text of an object under one element ``root``."""
    return F.to_xml(F.from_json(json, schema), _OPTIONS | {"rowTag": root})
