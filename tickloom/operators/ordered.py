"""Previous row, next row and rank within a key, without putting a whole key into one task.

A window partitioned by symbol sends all rows of a symbol to one task, and one symbol may hold a
third of the data. Here each key is cut into time slices: the window runs per (key, slice), and
what crosses a slice border comes from a small table with one row per slice (its first values,
last values and row count). That table is ordered per key, which is bounded by the covered time
over the slice length and not by the number of rows.

Two kinds of input:

* raw rows, any number per slice: ``Slices.of_rows`` measures the slices first and cuts the ones
  above ``max_rows`` by ranges of the whole ordering key;
* one row per key and fixed time step (candles): ``Slices.of_steps``; a slice cannot hold more
  rows than steps, so nothing has to be measured.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.session import stage

KEY, SLICE, PART = "_key", "_slice", "_part"
CELL = [KEY, SLICE, PART]
BEFORE_ALL_TIME = -(2**62)
# Most hot slices whose names are broadcast; above it the join is left to the planner.
MAX_BROADCAST_SLICES = 100_000


class Slices:
    """A frame cut into slices. Steps return a new ``Slices``, so filters and lags can be chained
    on one partitioning; ``frame()`` gives the plain rows back."""

    def __init__(self, df: DataFrame, order: Sequence[str], edges: DataFrame | None = None):
        self._df = df
        self._order = list(order)
        self._edges = edges

    @classmethod
    def of_steps(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str], seconds: int) -> Slices:
        return cls(_cut(df, keys, order[0], seconds), order)

    @classmethod
    def of_rows(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        seconds: int,
        carry: Sequence[str],
        max_rows: int,
    ) -> Slices:
        """Measure the slices, cut the hot ones, and keep their edge values of ``carry``.

        ``df`` is read twice: give a stored table (or a stage of one) when it is costly to compute.
        """
        cut = _cut(df, keys, order[0], seconds)
        edges = stage(_edges(cut, order, carry), "edges")
        hot = edges.where(F.col("_n") > max_rows)
        n_hot, n_rows = hot.agg(F.count("*"), F.sum("_n")).first()
        if n_hot:
            cut, edges = _cut_hot(cut, edges, hot, n_hot, ceil(2 * n_rows / max_rows), order, carry)
        return cls(cut, order, edges)

    def frame(self) -> DataFrame:
        return self._df.drop(*CELL)

    @property
    def dtypes(self) -> list[tuple[str, str]]:
        return [(name, kind) for name, kind in self._df.dtypes if name not in CELL]

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.dtypes]

    def where(self, condition: Column) -> Slices:
        return Slices(self._df.where(condition), self._order)

    def with_columns(self, columns: dict[str, Column]) -> Slices:
        """Add or replace columns; edge values of replaced ones are forgotten."""
        edges = None if set(columns) & set(self.columns) else self._edges
        return Slices(self._df.withColumns(columns), self._order, edges)

    def lag(self, column: str, name: str) -> Slices:
        """``name`` = ``column`` of the previous row of the key, NULL on its first row."""
        return self._shift(column, name, F.lag, "last")

    def lead(self, column: str, name: str) -> Slices:
        """``name`` = ``column`` of the next row of the key, NULL on its last row."""
        return self._shift(column, name, F.lead, "first")

    def rolling(self, column: str, rows: int, name: str) -> Slices:
        """``name`` = the values of ``column`` on the row and up to ``rows - 1`` before it, oldest first.

        A slice hands over its last ``rows - 1`` values; what reaches a slice comes from so many slices before it at most, as
        none is empty.
        """
        before = Window.partitionBy(*CELL).orderBy(*(F.desc(c) for c in self._order))
        last = self._df.withColumn("_nth", F.row_number().over(before)).where(F.col("_nth") < max(rows, 2))
        tails = last.groupBy(*CELL).agg(F.sort_array(F.collect_list(F.struct("_nth", F.col(column).alias("value"))), False).alias("_tail"))
        reach = _slices().rowsBetween(-max(rows - 1, 1), -1)
        carried = tails.select(*CELL, F.flatten(F.collect_list("_tail").over(reach)).alias("_carried"))
        near = F.collect_list(F.struct(F.lit(0).alias("_nth"), F.col(column).alias("value"))).over(self._rows.rowsBetween(1 - rows, 0))
        frame = self._df.withColumn("_near", near).join(carried, CELL, "left")
        values = F.transform(F.concat(F.coalesce("_carried", F.slice("_near", 1, 0)), "_near"), lambda v: v["value"])
        kept = F.when(F.size("_near") + F.size(F.coalesce("_carried", F.slice("_near", 1, 0))) > rows, F.slice(values, -rows, rows)).otherwise(values)
        return Slices(frame.withColumn(name, kept).drop("_near", "_carried"), self._order, self._edges)

    def percent_rank(self, name: str) -> Slices:
        """(rank - 1) / (rows of the key - 1), 0.0 for a single row."""
        total = F.sum("_n").over(Window.partitionBy(KEY))
        return self._with_edges([])._share(F.rank().over(self._rows) - 1, total, name)

    def lead_and_share(self, column: str, lead: str, complete: Column, name: str) -> Slices:
        """``lead`` of ``column``, and in ``name`` the ``percent_rank`` a row has once only
        ``complete`` rows with a next row are kept. For one row per key and time, and a ``column``
        that is never NULL.

        The same as a lead, a filter and a ``percent_rank``, but with one table of edges, so the
        frame is computed for edges once and not once per step.
        """
        flagged = self._df.withColumn("_complete", complete)
        edges = _edges(flagged, self._order, [column, "_complete"], F.count_if("_complete"))
        key = _slices().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # the last row of a key has no next row and does not count
        total = F.sum("_n").over(key) - F.last("_last__complete").over(key).cast("int")
        earlier = self._rows.rowsBetween(Window.unboundedPreceding, -1)
        return (
            Slices(flagged, self._order, edges)
            .lead(column, lead)
            ._share(F.count_if("_complete").over(earlier), total, name)
            .where(F.col("_complete") & F.col(lead).isNotNull())
            ._drop("_complete")
        )

    @property
    def _rows(self) -> WindowSpec:
        return Window.partitionBy(*CELL).orderBy(*self._order)

    def _shift(self, column: str, name: str, step: Callable[..., Column], end: str) -> Slices:
        at_border = step(F.lit(True)).over(self._rows).isNull()
        value = F.when(F.col("_at_border"), F.col("_across")).otherwise(F.col("_near"))
        return (
            self._with_edges([column])
            .with_columns({"_near": step(column).over(self._rows), "_at_border": at_border})
            ._across({"_across": step(f"_{end}_{column}").over(_slices())})
            .with_columns({name: value})
            ._drop("_near", "_at_border", "_across")
        )

    def _share(self, inside: Column, total: Column, name: str) -> Slices:
        before = F.sum("_n").over(_slices().rowsBetween(Window.unboundedPreceding, -1))
        earlier = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_inside")
        share = F.try_divide(earlier.cast("double"), (F.col("_total") - 1).cast("double"))
        return (
            self.with_columns({"_inside": inside})
            ._across({"_before": before, "_total": total})
            .with_columns({name: F.coalesce(share, F.lit(0.0))})
            ._drop("_inside", "_before", "_total")
        )

    def _across(self, columns: dict[str, Column]) -> Slices:
        """Window expressions over the edges of a key, joined to the rows of each slice."""
        edges = self._edges.select(*CELL, *(c.alias(name) for name, c in columns.items()))
        return Slices(self._df.join(edges, CELL, "left"), self._order, self._edges)

    def _drop(self, *columns: str) -> Slices:
        return Slices(self._df.drop(*columns), self._order, self._edges)

    def _with_edges(self, carry: Sequence[str]) -> Slices:
        if self._edges is not None and {f"_last_{c}" for c in carry} <= set(self._edges.columns):
            return self
        return Slices(self._df, self._order, _edges(self._df, self._order, carry))


def _slices() -> WindowSpec:
    """The edges of a key in order."""
    return Window.partitionBy(KEY).orderBy(SLICE, PART)


def _cut(df: DataFrame, keys: Sequence[str], time: str, seconds: int) -> DataFrame:
    at = F.unix_seconds(F.col(time).cast("timestamp"))
    return df.withColumns(
        {
            # a struct is never NULL, so rows with a NULL key find their own edges in the join
            KEY: F.struct(*keys),
            SLICE: F.coalesce(F.floor(at / seconds), F.lit(BEFORE_ALL_TIME)).cast("bigint"),
            PART: F.lit(0),
        }
    )


def _edges(
    cut: DataFrame, order: Sequence[str], carry: Sequence[str], count: Column | None = None
) -> DataFrame:
    """One row per slice: its row count (or ``count``), and the carried columns of its first and
    last row."""
    if len(order) == 1:
        # a primitive ordering keeps this a hash aggregation
        at = F.coalesce(F.unix_micros(F.col(order[0]).cast("timestamp")), F.lit(BEFORE_ALL_TIME))
    else:
        at = F.struct(*order)
    rows = F.count("*") if count is None else count
    ends = [F.min_by(c, at).alias(f"_first_{c}") for c in carry]
    ends += [F.max_by(c, at).alias(f"_last_{c}") for c in carry]
    return cut.groupBy(*CELL).agg(rows.alias("_n"), *ends)


def _cut_hot(
    cut: DataFrame,
    edges: DataFrame,
    hot: DataFrame,
    n_hot: int,
    n_ranges: int,
    order: Sequence[str],
    carry: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Cut hot slices by sampled ranges of the ordering key; the rest stays as it is."""
    names = hot.select(KEY, SLICE)
    if n_hot <= MAX_BROADCAST_SLICES:
        names = F.broadcast(names)
    ranges = (
        cut.join(names, [KEY, SLICE], "left_semi")
        .repartitionByRange(n_ranges, KEY, *order)
        .withColumn(PART, F.spark_partition_id())
    )
    # sampled bounds differ from run to run: write the range numbers down before they are used
    ranges = stage(ranges, "ranges")
    cold = cut.join(names, [KEY, SLICE], "left_anti")
    cold_edges = edges.join(names, [KEY, SLICE], "left_anti")
    return (
        cold.unionByName(ranges),
        cold_edges.unionByName(_edges(ranges, order, carry)),
    )
