"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic). Token weights of the cells are raked: scaled in turn
so that the shares of sources, languages and topics meet their targets, a fixed number of rounds. A cell's
factor, weight over tokens, divided by the largest factor is the probability of its documents; the expected
token shares of the sample are then the raked ones. A document is drawn if a number hashed from its id is
below that probability, so a sample can be repeated.

Targets default to tempered shares: a value's share of the tokens to a power below one, normalised, so
that large sources shrink and small ones grow; a table of shares may be given instead.

One rare cell with a high factor so would shrink the whole sample. Therefore ``total``, the share of the tokens to draw,
sets the scale: cells whose probability would exceed 1 are taken whole, and the weights of the others are raked and scaled again
for what is left of targets and total. Without a total (None) the cell with the largest factor is drawn whole.

Only cells are raked, never rows of documents; the cell table is written once and has at most as many
rows as there are combinations. Columns and SQL functions only.

Defined cases: null source, language or text are values of their own (``''``; no tokens). Cells without tokens take
part with probability 1, as there is nothing to scale. Rows with the same id are drawn together within a cell. An
empty table gives an empty result. Columns not named here are handed through by ``sample``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.session import stage

from .common import clear_of, hex_unit, white_words

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 6
#: powers of the tempered targets
TEMPER: Mapping[str, float] = {"source": 0.7, "lang": 0.8, "topic": 0.8}
SEED = "mix"
#: share of the tokens that is drawn
TOTAL = 0.5
_UNIT = 4294967296


def topic_of(text: Column) -> Column:
    """A coarse topic from the shape of the text: the most telling mark in it."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.contains(" | "), F.lit("table"))
        .when(text.contains("http"), F.lit("links"))
        .when(text.contains("@"), F.lit("contacts"))
        .when(F.length(text) >= 2000, F.lit("long prose"))
        .otherwise(F.lit("prose"))
    )


def celled(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens`` of every row."""
    return docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        topic_of(F.col("text")).alias("topic"),
        F.size(white_words(F.col("text"))).cast("long").alias("n_tokens"),
    )


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").cast("double").alias("tokens"))


def raked(
    cells: DataFrame,
    targets: Mapping[str, DataFrame] | None = None,
    rounds: int = ROUNDS,
    temper: Mapping[str, float] = TEMPER,
    total: float | None = None,
) -> DataFrame:
    """``source, lang, topic, probability`` of the cells; ``targets`` has a table (value, share) per
    dimension. Values without a target are left as they are. ``total`` is the share of all tokens to draw, above 0 and
    up to 1; without it, the cell with the largest factor is drawn whole."""
    if total is not None and not 0 < total <= 1:
        raise ValueError(f"total must be above 0 and up to 1, not {total}")
    spark = cells.sparkSession
    cells = stage(cells, "cells")
    everything = Window.partitionBy(F.lit(0))
    state = cells
    for d in DIMENSIONS:
        if targets and d in targets:
            wanted = targets[d].select(F.col("value").alias(d), F.col("share").cast("double").alias(f"want_{d}"))
        else:
            wanted = cells.groupBy(d).agg(F.pow(F.sum("tokens"), F.lit(temper[d])).alias("power"))
            wanted = wanted.select(d, (F.col("power") / F.sum("power").over(everything)).alias(f"want_{d}"))
        state = state.join(wanted, d, "left")
    state = stage(state.withColumn("weight", F.col("tokens")), "rake")
    for _ in range(rounds):
        for d in DIMENSIONS:
            share = F.sum("weight").over(Window.partitionBy(d)) / F.sum("weight").over(everything)
            scaled = F.when(
                (F.col("tokens") > 0) & F.col(f"want_{d}").isNotNull(), F.col("weight") * F.col(f"want_{d}") / share
            )
            state = state.withColumn("weight", F.coalesce(scaled, "weight"))
        state = stage(state, "rake")  # short plans: each round reads the last one's table
    if total is not None:
        return stage(_to_total(state, rounds, total).select(*DIMENSIONS, "probability"), "probabilities")
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    state = state.withColumn("factor", factor)
    probability = F.coalesce(F.round(F.col("factor") / F.max("factor").over(everything), 6), F.lit(1.0))
    return stage(state.select(*DIMENSIONS, probability.alias("probability")), "probabilities")


def _to_total(state: DataFrame, rounds: int, total: float) -> DataFrame:
    """Raked cells with the ``probability`` that draws ``total`` of the tokens. Weights are scaled to the total and cut at
    the tokens of their cell, then those of cells not taken whole are raked for what whole cells leave of the targets;
    last, they are scaled to what is left of the total, exactly."""
    everything = Window.partitionBy(F.lit(0))
    tokens, weight, whole = F.col("tokens"), F.col("weight"), F.col("whole")
    wanted = total * F.sum("tokens").over(everything)

    def scaled(cells: DataFrame) -> DataFrame:
        """Weights times the one number with which they, cut at the cells' tokens, add up to what is wanted. Whole cells
        stay whole."""
        # cells in the order in which a growing number cuts them; the number that cuts none before the i-th fits
        ranked = Window.partitionBy(F.lit(0)).orderBy(whole.desc(), F.try_divide(weight, tokens).desc_nulls_last(), *DIMENSIONS)
        before = F.coalesce(F.sum("tokens").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
        cells = cells.withColumn("times", F.when(~whole & (tokens > 0) & (weight > 0), F.try_divide(wanted - before, rest)))
        fits = F.when(F.col("times") * weight <= tokens * (1 + 1e-12), F.col("times"))
        cells = cells.withColumn("times", F.max(fits).over(everything))
        cut = F.when(whole, tokens).otherwise(F.least(tokens, F.coalesce(weight * F.col("times"), tokens)))
        return cells.withColumn("weight", cut).withColumn("whole", F.col("weight") >= tokens * (1 - 1e-12)).drop("times")

    state = stage(scaled(state.withColumn("whole", F.lit(False))), "rake")
    for _ in range(rounds):
        for d in DIMENSIONS:
            mine = Window.partitionBy(d)
            taken = F.coalesce(F.sum(F.when(whole, weight)).over(mine), F.lit(0.0))
            others = F.sum(F.when(~whole, weight)).over(mine)
            left = F.greatest(F.col(f"want_{d}") * wanted - taken, F.lit(0.0))
            # a value that whole cells fill already keeps a small part of its weight
            times = F.greatest(F.try_divide(left, others), F.lit(0.01))
            state = state.withColumn("weight", F.when(~whole & F.col(f"want_{d}").isNotNull() & (others > 0), weight * times).otherwise(weight))
        state = stage(scaled(state), "rake")
    chance = F.greatest(F.lit(1e-6), F.least(F.lit(1.0), F.round(F.try_divide(weight, tokens), 6)))  # no cell is left out
    return state.withColumn("probability", F.when(tokens > 0, chance).otherwise(1.0))


def drawn(rows: DataFrame, probabilities: DataFrame) -> DataFrame:
    """``rows`` with ``probability`` and ``kept``."""
    out = rows.join(probabilities, list(DIMENSIONS), "left")
    kept = hex_unit(F.col("doc_id"), SEED) < F.col("probability") * _UNIT
    return out.withColumn("kept", kept)


def calibrated(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, total: float | None = TOTAL) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, kept`` of every row."""
    rows = stage(celled(docs), "celled")
    out = drawn(rows, raked(cells_of(rows), targets, total=total))
    return out.select("doc_id", *DIMENSIONS, "n_tokens", "probability", "kept")


def sample(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, total: float | None = TOTAL) -> DataFrame:
    """The drawn rows of ``docs``, plus their ``topic`` and ``probability`` (under other names if taken)."""
    probabilities = raked(cells_of(stage(celled(docs), "celled")), targets, total=total)
    topic, chance, s, g, t = clear_of(docs, "topic", "probability", "cell_source", "cell_lang", "cell_topic")
    marked = docs.withColumn(topic, topic_of(F.col("text")))
    cells = probabilities.select(
        F.col("source").alias(s), F.col("lang").alias(g), F.col("topic").alias(t), F.col("probability").alias(chance)
    )
    same = (
        (F.coalesce(marked["source"], F.lit("")) == cells[s])
        & (F.coalesce(marked["lang"], F.lit("")) == cells[g])
        & (marked[topic] == cells[t])
    )
    out = marked.join(cells, same).drop(s, g, t)
    return out.where(hex_unit(F.col("doc_id"), SEED) < F.col(chance) * _UNIT)
