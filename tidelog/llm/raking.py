"""Mixing sources to target weights: raking of token weights, then sampling by calibrated probabilities.

Documents are counted into cells of (source, language, topic). Iterative proportional fitting multiplies
the cells of one margin after the other by target / present token weight. A document is then drawn by
its cell's factor, scaled to a stated size: as many whole copies as the factor's whole part and one more with the chance
of its fraction. Without a size the largest factor is scaled to 1. Either way the drawn tokens have the
raked shares in expectation. DataFrame functions only; what is repeated is on cells, in the shared folder.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.rows import whole_row
from tidelog.session import written

MARGINS = ("source", "lang", "topic")
#: Rounds at least, and between two measurements of the margins.
ROUNDS = 12
#: Largest relative error of a margin's tokens at which raking ends.
TOLERANCE = 1e-4
#: Raking ends without it once a further measurement is not 10 % better, or after so many measurements.
MEASUREMENTS = 20
NONE = "(none)"

#: Targets of a margin: an exponent tempers the present shares, a mapping states shares by value.
Target = float | Mapping[str, float]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^ \t\n\r]+")).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse kind of text: ``symbols`` (over 8 % signs), ``figures`` (over 1 % digits), ``long`` (over 5,000 characters) or ``prose``."""
    size = F.length(text)
    without = lambda chars: size - F.length(F.translate(text, chars, ""))
    return (
        F.when(without("%$#*&@|<>{}=_~^+") * 100 > size * 8, "symbols")
        .when(without("0123456789") * 100 > size, "figures")
        .when(size > 5000, "long")
        .otherwise("prose")
    )


def classified(docs: DataFrame) -> DataFrame:
    """``doc_id``, the margins and ``n_tokens`` (words) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", *_cell_of(text), word_count(text).alias("n_tokens"))


def _cell_of(text: Column) -> list[Column]:
    named = [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in MARGINS[:2]]
    return [*named, topic_of(text).alias("topic")]


def targets(cells: DataFrame, margin: str, target: Target) -> DataFrame:
    """Target token weight of each value of ``margin``; they sum to the present total.

    With a mapping, a value it does not name keeps its present share, then all shares are scaled to 1.
    """
    present = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens"))
    total = present.agg(F.sum("tokens")).first()[0] or 0
    if isinstance(target, Mapping):
        natural = F.col("tokens") / F.lit(float(total or 1))
        share = F.coalesce(*[F.when(F.col(margin) == value, F.lit(float(x))) for value, x in target.items()], natural)
    else:
        share = F.pow(F.col("tokens").cast("double"), F.lit(float(target)))
    shares = present.select(margin, share.alias("share"))
    norm = shares.agg(F.sum("share")).first()[0] or 1.0
    return shares.select(margin, (F.col("share") / F.lit(norm) * F.lit(float(total))).alias("target"))


def margin_errors(cells: DataFrame, goals: Mapping[str, DataFrame]) -> DataFrame:
    """``margin``, ``value`` and ``error``: how far tokens * factor is off each target, as a part of it."""
    errors = None
    for margin, goal in goals.items():
        now = cells.groupBy(margin).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now")).join(goal, margin).where("target > 0")
        error = F.abs(F.col("now") / F.col("target") - 1)
        part = now.select(F.lit(margin).alias("margin"), F.col(margin).alias("value"), error.alias("error"))
        errors = part if errors is None else errors.union(part)
    return errors


def rake(cells: DataFrame, wanted: Mapping[str, Target], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margins, ``tokens``) with ``factor`` such that tokens * factor has the wanted margins.

    After every ``rounds`` rounds the margins are measured, until all are met up to ``TOLERANCE``. Targets that
    contradict each other cannot be met: then there is a warning that names the worst margins.
    """
    goals = {m: written(targets(cells, m, t), "rake-goals") for m, t in wanted.items()}
    cells = cells.withColumn("factor", F.lit(1.0))
    for margin, goal in goals.items():
        cells = cells.join(goal.withColumnRenamed("target", f"{margin}_target"), margin)
    before = float("inf")
    for measurement in range(MEASUREMENTS):
        for _ in range(rounds):
            for margin in goals:
                now = cells.groupBy(margin).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now"))
                step = F.when(F.col("now") > 0, F.col(f"{margin}_target") / F.col("now")).otherwise(F.lit(1.0))
                cells = cells.join(now, margin).withColumn("factor", F.col("factor") * step).drop("now")
            cells = written(cells, "rake-cells")
        worst = margin_errors(cells, goals).where(F.col("error") > TOLERANCE).orderBy(F.desc("error")).limit(10).collect()
        if not worst or worst[0].error > 0.9 * before:
            break
        before = worst[0].error
    if worst:
        named = ", ".join(f"{r.margin}={r.value} off by {r.error:.2%}" for r in worst)
        warnings.warn(f"margins not met after {(measurement + 1) * rounds} rounds of raking: {named}", stacklevel=2)
    return cells.select(*MARGINS, "tokens", "factor")


def chance(doc_id: Column) -> Column:
    """A fixed number in [0, 1) for an id."""
    digest = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(2**48))


def _rates(rows: DataFrame, wanted: Mapping[str, Target], rounds: int, size: float | None) -> DataFrame:
    """``rate``, the expected copies of a document, for each cell."""
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "rake-cells")
    raked = rake(cells, wanted, rounds)
    present, now, largest = raked.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("factor")), F.max("factor")).first()
    unit = (largest or 1.0) if size is None else (now / present if now else 1.0) / size
    return raked.select(*MARGINS, (F.col("factor") / F.lit(unit)).alias("rate"))


def _copies(rows: DataFrame, doc_id: str) -> DataFrame:
    """Each row (with ``rate`` and ``worded``) once for every copy of it that is drawn; ``probability`` is that copy's chance."""
    expected = F.when(F.col("worded"), F.col("rate")).otherwise(F.least(F.col("rate"), F.lit(1.0)))
    whole = F.floor(expected)
    rest = expected - whole
    sure = F.array_repeat(F.lit(1.0), whole.cast("int"))
    drawn = F.when(chance(F.col(doc_id)) < rest, F.concat(sure, F.array(rest))).otherwise(sure)
    return rows.withColumn("probability", F.explode(drawn))


def mix(docs: DataFrame, wanted: Mapping[str, Target], rounds: int = ROUNDS, size: float | None = None) -> DataFrame:
    """The drawn rows of ``docs`` (``doc_id``, ``text``, ``lang``, ``source``): ``doc_id``, the margins,
    ``n_tokens`` and ``probability``.

    With ``size``, that many times the present tokens are drawn in expectation, and a document whose cell has a rate over 1
    is drawn several times, a row for each copy: the whole ones with probability 1, the last with the fraction. A
    text without words counts for no share and is drawn at most once. Without ``size`` the largest factor has
    probability 1, so one small cell can make all others small.

    Null categories are the value ``(none)``, null texts are empty; a value without tokens keeps factor
    1. Rows with one id are drawn alike, by a hash of the id, so a repeated run draws the same rows.
    An empty table gives no rows; other columns are not read.
    """
    rows = written(classified(docs), "rake-rows")
    rates = _rates(rows, wanted, rounds, size)
    placed = rows.join(rates, list(MARGINS)).withColumn("worded", F.col("n_tokens") > 0)
    drawn = _copies(placed, "doc_id")
    return drawn.select("doc_id", *MARGINS, "n_tokens", "probability")


def mixed_rows(docs: DataFrame, wanted: Mapping[str, Target], rounds: int = ROUNDS, size: float | None = None) -> DataFrame:
    """The rows that :func:`mix` draws, with the columns of ``docs``, whatever their names: its rates meet the rows by their cell."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rates = _rates(classified(docs), wanted, rounds, size)
    placed = docs.select(whole_row(docs), *_cell_of(text), text.rlike(r"[^ \t\n\r]").alias("worded"))
    return _copies(placed.join(rates, list(MARGINS)), "row.doc_id").select("row.*")
