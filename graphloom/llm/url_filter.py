"""URL filter: allow and block rules, and a character language-model ratio for the rest.

Rules decide first (the longest that fits wins).  A url without a rule is judged
by two smoothed variable-order Markov models over characters, one of accepted
and one of rejected urls: the verdict compares the length-normalised
log-likelihood difference with a threshold calibrated on held-out urls.

The models learn from every distinct url that a rule decides: one in ``FOLDS`` (by
hash) calibrates, the others are counted.  Counts of (context, next character),
smoothing, scoring and calibration are Spark aggregations and joins, so the
statistics grow with the input and none of them passes through the driver.
Log-probabilities are added as multiples of 2**-32, so sums don't depend on order.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule and is judged on its text (null: empty text; an empty text is allowed);
if either class has no training urls every unruled url is allowed; a class of
which the hash puts all urls on one side uses all of them for both; an empty
table gives an empty result; repeated rows are judged alike; extra columns are
passed through by :func:`judge`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import cut

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
FOLDS = 5
SCALE = 2.0**32
#: Character runs that make up a larger share than 1 / HOT of all are joined by broadcast (at most HOT of them), the others by shuffle.
HOT = 50_000


def host_of(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(urls: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule (host + path of the longest rule that fits, else null) and rule_verdict."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = verdict = None
    for kind, host, path in longest_first:
        # an empty host is no domain's subdomain, and the path of a url without :// is empty
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        name = F.lit(host + path)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    found = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if rule is None:
        rule = verdict = F.lit(None).cast("string")
    return found.withColumns({"rule": rule, "rule_verdict": verdict})


def _runs(url: Column) -> Column:
    """The runs of ``ORDER`` + 1 characters of a padded url, one for each character and the end."""
    padded = F.concat(F.lit("\x02" * ORDER), url, F.lit("\x03"))

    def of(chars: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(chars) - (ORDER + 1))
        return F.transform(places, lambda i: F.concat(*[F.get(chars, i + k) for k in range(ORDER + 1)]))

    # through a one-element array, so that the text is split once and not once a place
    return F.flatten(F.transform(F.array(F.split(padded, "")), of))


def _roles(urls: DataFrame) -> DataFrame | None:
    """``urls`` (url, rule_verdict) with ``allow`` and ``block`` (1: counted for that model) and ``scored``; None if a class is empty."""
    held = F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0
    sizes = urls.where("rule_verdict is not null").groupBy("rule_verdict", held.alias("held")).count().collect()
    sides = {v: {r.held for r in sizes if r.rule_verdict == v} for v in ("allow", "block")}
    if not all(sides.values()):
        return None
    fit, scored = {}, F.col("rule_verdict").isNull()
    for verdict, found in sides.items():
        own = F.coalesce(F.col("rule_verdict") == verdict, F.lit(False))
        fit[verdict] = (own & ~held if len(found) == 2 else own).cast("int")
        scored |= own & held if len(found) == 2 else own
    return urls.withColumns(fit | {"scored": scored})


def _ratios(urls: DataFrame) -> DataFrame:
    """(run, n, ratio): each run of the scored urls, its occurrences there and log P(accepted) - log P(rejected) of its last character.

    Orders 0 to ``ORDER`` are interpolated by Witten-Bell smoothing, down to the uniform law.
    """
    sums = [F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.sum("n").alias("n")]
    counted = urls.select(F.explode(_runs(F.col("url"))).alias("run"), "allow", "block", F.col("scored").cast("int").alias("n")).groupBy("run").agg(*sums)
    tails = F.array(*[F.substring("run", -k, k) for k in range(1, ORDER + 2)])
    counted = counted.select(F.explode(tails).alias("run"), "allow", "block", "n").groupBy("run").agg(*sums)
    context = Window.partitionBy("context")
    levels = cut(
        counted.withColumns({"order": F.length("run") - 1, "context": F.expr("substring(run, 1, length(run) - 1)")})
        .withColumns({f"{v}_total": F.sum(v).over(context) for v in ("allow", "block")} | {f"{v}_kinds": F.sum((F.col(v) > 0).cast("int")).over(context) for v in ("allow", "block")})
        .drop("context")
    )
    shorter = None
    for k in range(ORDER + 1):
        level = levels.where(F.col("order") == k)
        if shorter is None:
            level = level.withColumns({"allow_p": F.lit(1 / 4096), "block_p": F.lit(1 / 4096)})
        else:
            level = level.withColumn("tail", F.substring("run", 2, k)).join(shorter, "tail")
        smoothed = {
            f"{v}_p": F.when(F.col(f"{v}_total") > 0, (F.col(v) + F.col(f"{v}_kinds") * F.col(f"{v}_p")) / (F.col(f"{v}_total") + F.col(f"{v}_kinds"))).otherwise(F.col(f"{v}_p"))
            for v in ("allow", "block")
        }
        level = level.withColumns(smoothed)
        shorter = level.select(F.col("run").alias("tail"), "allow_p", "block_p")
    ratio = F.round((F.log("allow_p") - F.log("block_p")) * SCALE).cast("long")
    return level.where("n > 0").select("run", "n", ratio.alias("ratio"))


def differences(urls: DataFrame) -> DataFrame:
    """(url, rule_verdict, difference): the difference of log-likelihoods per character of every scored url of :func:`_roles`."""
    ratios = cut(_ratios(urls))
    total = ratios.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") * HOT > total
    hot, cold = F.broadcast(ratios.where(frequent).select("run", "ratio")), ratios.where(~frequent).select("run", "ratio")
    runs = urls.where("scored").select("url", "rule_verdict", F.explode(_runs(F.col("url"))).alias("run"))
    found = runs.join(hot, "run").unionByName(runs.join(hot, "run", "left_anti").join(cold, "run"))
    per_char = F.sum("ratio") / F.lit(SCALE) / (F.length("url") + 1)
    return found.groupBy("url", "rule_verdict").agg(per_char.alias("difference"))


def _calibrate(held: DataFrame) -> float:
    """The cut with the fewest balanced errors on all held-out urls; the middle of the best gap.

    Urls are dealt by ranges of the difference.  Where the errors are least within a
    range doesn't depend on the ranges below it, so a range gives one row.
    """
    sizes = {r.rule_verdict: r["count"] for r in held.groupBy("rule_verdict").count().collect()}
    n_allow, n_block = sizes["allow"], sizes["block"]

    def of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # errors are counted in 1 / (n_allow * n_block)
        errors, least, at, following, first, last = 0, None, None, None, None, None
        for batch in batches:
            for x, accepted in zip(batch.column("difference").to_pylist(), batch.column("accepted").to_pylist(), strict=True):
                if first is None:
                    first = x
                elif x > last and (least is None or errors < least):
                    least, at, following = errors, last, x
                errors += n_block if accepted else -n_allow
                last = x
        if first is not None:
            if least is None or errors < least:
                least, at, following = errors, last, None
            row = {"first": first, "errors": errors, "least": least, "at": at, "following": following}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("first", pa.float64()), ("errors", pa.int64()), ("least", pa.int64()), ("at", pa.float64()), ("following", pa.float64())])
    dealt = held.select("difference", (F.col("rule_verdict") == "allow").alias("accepted")).repartitionByRange("difference").sortWithinPartitions("difference")
    ranges = sorted(dealt.mapInArrow(of_range, "first double, errors long, least long, at double, following double").collect())
    below, best, threshold = 0, 0, ranges[0]["first"] - 1e-9
    for i, r in enumerate(ranges):
        if below + r.least < best:
            following = r.following
            if following is None:
                following = ranges[i + 1]["first"] if i + 1 < len(ranges) else r["at"] + 2e-9
            best, threshold = below + r.least, (r["at"] + following) / 2
        below += r.errors
    return threshold


def judge(urls: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule and verdict."""
    found = ruled(urls, rules, url)
    by_rule = found.withColumn("verdict", F.coalesce("rule_verdict", F.lit("allow"))).drop("rule_verdict")
    # the models see only urls without a rule
    unruled = F.col("rule").isNull() & (F.coalesce(F.col(url), F.lit("")) != "")
    known = found.where(F.col(url).isNotNull() & (F.col("rule").isNotNull() | unruled))
    roles = _roles(cut(known.select(F.col(url).alias("url"), "rule_verdict").distinct()))
    if roles is None:
        return by_rule
    scores = cut(differences(roles))
    threshold = _calibrate(scores.where("rule_verdict is not null"))
    verdict = F.when(F.col("difference") >= threshold, "allow").otherwise("block")
    verdicts = scores.where("rule_verdict is null").select(F.col("url").alias("__url"), verdict.alias("__verdict"))
    judged = found.where(unruled).join(verdicts, F.col(url) == F.col("__url")).withColumn("verdict", F.col("__verdict"))
    return by_rule.where(~unruled).unionByName(judged.select(*by_rule.columns))
