"""Quality rules as a short-circuit cascade.

Each rule is a reject condition over the text. On a bounded sample the time and the share of
rejected rows of every rule are measured; the cascade then asks the rule with the most rejections
per second first, and a row that one rule rejects is not shown to the next. The verdict is "no
rule rejects", so it does not depend on the order; only the time does.

Everything is a column expression: no Python runs on the executors.

Defined cases: null text has no words, like empty text, and is rejected as short. Rows are judged
one by one, so repeated rows get the same verdict. An empty table keeps its columns. Columns other
than the text are not read, and may have any name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .common import WHITE_SPACE, clear_of, let, white_words

SYMBOLS = "[#*$%&|<>]"
NOT_WHITE = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets an object with the measures below as attributes."""

    name: str
    rejects: Callable[[object], Column]


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(NOT_WHITE))


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice. Most texts have none, which a hash
    set of the windows shows; the others' windows are sorted by hash, n log n steps."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def of_windows(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = let(ordered, lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(places, covered))

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(let(windows(w), of_windows))).cast("long")


class OfText:
    """Measures as expressions over a text column; each computes what it needs."""

    def __init__(self, text: Column):
        self.text = F.coalesce(text, F.lit(""))

    def _count(self, pattern: str) -> Column:
        return (F.length(self.text) - F.length(F.regexp_replace(self.text, pattern, ""))).cast("long")

    @property
    def n_words(self) -> Column:
        return F.size(white_words(self.text)).cast("long")

    @property
    def word_chars(self) -> Column:
        return F.length(F.regexp_replace(self.text, WHITE_SPACE, "")).cast("long")

    @property
    def n_symbols(self) -> Column:
        return self._count(SYMBOLS)

    @property
    def n_exclamations(self) -> Column:
        return self._count("!")

    @property
    def n_lines(self) -> Column:
        return F.size(lines_with_words(self.text)).cast("long")

    @property
    def n_dup_lines(self) -> Column:
        """Lines with a word that equal an earlier line."""
        return let(lines_with_words(self.text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")

    @property
    def n_repeat_words(self) -> Column:
        return repeat_words(white_words(self.text))


class Known:
    """Measures that are columns already; the rest is computed from the text."""

    def __init__(self, text: Column, *names: str):
        self._of_text, self._names = OfText(text), names

    def __getattr__(self, name: str) -> Column:
        return F.col(name) if name in self._names else getattr(self._of_text, name)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_measures(text: Column) -> Column:
    """Struct of the base measures of a text; its words are split once."""

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            OfText(text).n_symbols.alias("n_symbols"),
            OfText(text).n_dup_lines.alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
        )

    return let(white_words(text), of_words)


#: Few words, mostly repeated words, and thresholds between the clean and the junk texts at hand.
BASE_RULES = (
    Rule("short", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
METHOD_RULES = (
    Rule("symbols", lambda m: 100 * m.n_symbols > 30 * m.n_words),
    Rule("shouting", lambda m: 100 * m.n_exclamations > 30 * m.n_words),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 50 * m.n_lines),
    Rule("long_words", lambda m: m.word_chars > 14 * m.n_words),
)


def measure(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = 1000) -> list[Measured]:
    """Time and rejected share of every rule on a random sample of about ``sample_rows`` rows,
    sorted as the cascade should ask them. The sample only decides the order."""
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    sample = stage(docs.select(F.col(text).alias("text")).sample(share, seed=7), "quality-sample")
    rows = sample.count()
    out = []
    for rule in rules:
        counted = sample.select(F.count_if(rule.rejects(OfText(F.col("text")))).alias("n"))
        counted.first()  # the first run compiles
        started = time.perf_counter()
        rejected = counted.first()["n"]
        out.append(Measured(rule, time.perf_counter() - started, rejected / max(rows, 1)))
    return sorted(out, key=lambda m: -m.gain)


def cascade(measures: object, measured: Sequence[Measured]) -> Column:
    """Name of the first rule that rejects, in the measured order; null where none does. CASE
    evaluates a branch only if all branches before it were false."""
    verdict = F.lit(None).cast("string")
    for m in reversed(measured):
        verdict = F.when(m.rule.rejects(measures), F.lit(m.rule.name)).otherwise(verdict)
    return verdict


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base measures of every row, whether they fail it, and the verdict: ``kept`` is false for
    rows that fail the base measures, else what the cascade of the other rules says."""
    ordered = measure(docs, METHOD_RULES, text)
    t = F.col("t")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("t"))
    rows = rows.select("doc_id", "t", base_measures(t).alias("m")).select("doc_id", "t", "m.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = cascade(Known(t, *BASE), ordered)
    kept = F.when(failed, F.lit(False)).otherwise(verdict.isNull())
    return rows.select("doc_id", *BASE, failed.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = BASE_RULES + METHOD_RULES) -> DataFrame:
    """The rows that no rule rejects, unchanged."""
    (flag,) = clear_of(docs, "rejected_by")
    verdict = cascade(OfText(F.col(text)), measure(docs, rules, text))
    return docs.withColumn(flag, verdict).where(F.col(flag).isNull()).drop(flag)
