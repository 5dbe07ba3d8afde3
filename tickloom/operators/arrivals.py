"""First arrival per key in a stream, decided by the order of arrival, with an outcome for every row.

``dropDuplicates`` keeps any one of several rows of a key in a batch and drops late rows unseen. Here the smallest row by arrival
is kept, the others come out as duplicates, and rows behind the watermark as late ones.

The stream only says which keys are new: ``with_news`` puts one row per key that ``dropDuplicates`` lets pass beside all rows, which
go through no state. ``judged`` then decides inside a batch, in one shuffle by key. Both run in built-in operators. A key without
such a row is in the state, or late; which of them, the watermark of the batch before says, as it ended the state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEPT, DUPLICATE, LATE = "kept", "duplicate", "late"
OUTCOME = "outcome"
NEWS = "_news"


def with_news(df: DataFrame, watermark: str, keys: Sequence[str], time: str = "timestamp") -> DataFrame:
    """The rows of a stream and, marked by ``_news``, a row for each key that is neither in the state nor behind the watermark
    of the batch before. ``keys`` must hold ``time``: a key leaves the state when the watermark reaches it."""
    news = df.select(*keys).withWatermark(time, watermark).dropDuplicates(list(keys)).withColumn(NEWS, F.lit(True))
    return df.withColumn(NEWS, F.lit(False)).unionByName(news, allowMissingColumns=True)


def judged(
    batch: DataFrame, ended: int, behind: int, keys: Sequence[str], arrival: Sequence[str], time: str = "timestamp"
) -> DataFrame:
    """The rows of one batch of ``with_news`` with their ``outcome``: the first to arrive of each key is kept. ``arrival`` orders
    rows of one batch, all other columns decide ties; what an earlier batch brought was earlier. ``ended`` and ``behind``
    are the watermarks (milliseconds) of the batch before, up to which keys left the state, and of this one.
    """
    columns = [c for c in batch.columns if c != NEWS]
    order = [*arrival, *(c for c in columns if c not in arrival and c not in keys)]
    # a running frame: a key may be delivered any number of times, and none of its rows is held
    so_far = Window.partitionBy(*keys).orderBy(F.desc(NEWS), *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.unix_millis(time)
    # known up to the end of the batch whose watermark reaches it
    late = (at <= behind) & (F.col("_new") | (at <= ended))
    first = F.col("_new") & (F.col("_place") == 2)
    return (
        batch.withColumns({"_new": F.first(NEWS).over(so_far), "_place": F.row_number().over(so_far)})
        .where(~F.col(NEWS))
        .select(*columns, F.when(late, LATE).when(first, KEPT).otherwise(DUPLICATE).alias(OUTCOME))
    )
