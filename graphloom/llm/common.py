"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word for the size and shingle contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` of a data folder, read by Spark alone (any store Spark can open)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only where it is unset and Spark runs in one process (tests) make a folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="graphloom-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Survives the loss of any executor, unlike a local checkpoint or a cache.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def word_count(text: Column) -> Column:
    """Number of words (``WORD``) in ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; a null id counts as empty text, so it is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def splits_of(text: Column, pattern: str) -> tuple[Column, Column]:
    """(gaps, matches) of a Java regex: ``text`` is gap 0, match 0, gap 1, ... .

    ``split`` and ``regexp_extract_all`` walk the same leftmost non-overlapping
    matches, so their lengths give every match position without a UDF.
    """
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it (also inside lambdas)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``values`` (whole numbers) combined up to and with each place: ends from lengths, or the largest so far.

    ``combine`` is associative with 0 as its identity on the values.  Parts of about the square
    root of all are combined first, so the arrays that grow stay short: n ** 1.5 steps and not n ** 2.
    """
    kind = "array<int>"
    state = lambda total, out: F.struct(total.cast("int").alias("t"), out.cast(kind).alias("out"))

    def whole(x: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(x))), F.lit(1)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / width).cast("int")), lambda j: F.slice(x, j * width + 1, width))
        within = lambda p: F.aggregate(
            p, state(F.lit(0), F.array()), lambda acc, v: state(combine(acc["t"], v), F.concat(acc["out"], F.array(combine(acc["t"], v).cast("int")))), lambda acc: acc["out"]
        )
        return F.aggregate(
            F.transform(parts, within),
            state(F.lit(0), F.array()),
            lambda acc, p: state(F.when(F.size(p) > 0, combine(acc["t"], F.element_at(p, -1))).otherwise(acc["t"]), F.concat(acc["out"], F.transform(p, lambda v: combine(acc["t"], v).cast("int")))),
            lambda acc: acc["out"],
        )

    return bound(values, whole)


#: Code points of a segment, as a power of two.
_SEGMENT = 10


def segments(text: Column) -> Column:
    """``text`` in runs of 1,024 code points, so that :func:`piece` needn't walk from its start."""
    return F.regexp_extract_all(text, F.lit(r"(?s).{1,1024}"), F.lit(0))


def piece(parts: Column, a: Column, b: Column) -> Column:
    """Code points [a, b) of the text that :func:`segments` cut."""
    first = F.shiftright(a, _SEGMENT)
    joined = F.array_join(F.slice(parts, first + 1, F.shiftright(b, _SEGMENT) - first + 1), "")
    return F.substring(joined, a - F.shiftleft(first, _SEGMENT) + 1, F.greatest(b - a, F.lit(0)))


def match_ends(gaps: Column, matches: Column) -> Column:
    """Code-point end of each gap and each match, alternating: match ``i`` (from 0) is [ends[2i], ends[2i + 1])."""
    lengths = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.array(F.length(g), F.length(m)))
    return running(F.flatten(lengths), lambda x, y: x + y)


def reserved(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until it clashes with none of ``columns`` (Spark compares without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
