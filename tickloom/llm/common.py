"""Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE_SPACE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once per row.

    A lambda variable cannot be inlined, so an array used inside later lambdas is not computed
    again for each of their elements.
    """
    return F.transform(F.array(value), body)[0]


def white_words(text: Column) -> Column:
    """Array of the maximal runs of other characters than ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), lambda w: w != "")


def hex_unit(key: Column, seed: str) -> Column:
    """Integer from 0 to 2**32 - 1 drawn from a key, the same in every SQL engine with md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def clear_of(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``docs`` has, whatever its letter case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out
