"""Shards of equal size by sampled splitters.

Records are put into one order: by a digest of the text, so that copies stand together and neighbours are a random mix, then by
id. The order is cut into ranges small enough for a task, and shards are runs of the order:

1. A narrow table (order key, size, checksum, no text) is written once.
2. Keys are sampled with a chance in proportion to their size; quantiles of the sample are the splitters of the ranges.
3. The ranges are measured. Those overfull in rows or bytes are sampled again, more densely, and subdivided. The order key ends in
   a number of the row, so a range of one text, or of one repeated record, is divided like any other.
4. Running sums inside the ranges plus the totals of the ranges before give every record its exact place in rows and bytes,
   and the place in bytes gives the shard. The sample decides how the work is dealt out, never the result.

Law ``bytes``: a record goes to the shard its middle byte falls into. Copies of a text whose bytes together are at most
``whole_percent`` of a shard go as one record, so that a border does not part them; larger groups are parted.
Shards so differ by less than one record and two such groups.

Defined cases: a null text has no bytes and the checksum of the empty text. Null ids are ordered as empty text. Repeated rows are
records of their own. An empty table has no shards; a record larger than a shard leaves its neighbours short. Other columns
are handed through if named, else not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import stage


@dataclass(frozen=True)
class Sharding:
    shards: int = 16
    whole_percent: int = 1
    rows_per_range: int = 500_000
    least_ranges: int = 64
    #: sampled keys per range; the driver holds these keys
    sampled: int = 24
    rounds: int = 6


def described(docs: DataFrame, key: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """``id, size, text_crc32, digest, place`` and the struct ``carried``; ``place`` is unique and orders the records."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.md5(body)
    row = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return docs.select(
        F.col(key).alias("id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        digest.alias("digest"),
        F.concat_ws("-", digest, name, row).alias("place"),
        F.struct(*carry).alias("carried") if carry else F.lit(None).cast("string").alias("carried"),
    )


def _drawn(rows: DataFrame, share: Column, round_no: int) -> list[tuple[str, float]]:
    """Places drawn with the chance ``share`` of each, and what each of them stands for."""
    unit = F.shiftrightunsigned(F.xxhash64("place", F.lit(round_no)), 11) / float(1 << 53)
    chosen = rows.where(unit < share).select("place", (F.col("size") / F.least(share, F.lit(1.0))).alias("weight"))
    return sorted((r.place, r.weight) for r in chosen.collect())


def _quantiles(drawn: list[tuple[str, float]], parts: int) -> list[str]:
    total, seen, out = sum(w for _, w in drawn), 0.0, []
    for place, weight in drawn:
        if seen >= total * (len(out) + 1) / parts and len(out) < parts - 1:
            out.append(place)
        seen += weight
    return out


def range_of(splitters: list[str]) -> Column:
    """Number of the range of a place; ranges begin at splitters."""

    @F.pandas_udf("int")
    def find(places: pd.Series) -> pd.Series:
        return places.map(lambda p: bisect.bisect_right(splitters, p)).astype("int32")

    return find("place")


def ranges(rows: DataFrame, how: Sharding) -> tuple[list[str], list[tuple[int, int]]]:
    """Splitters, and rows and bytes of every range."""
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    if not totals.n:
        return [], []
    parts = max(how.least_ranges, math.ceil(totals.n / how.rows_per_range))
    share = F.col("size") * (parts * how.sampled / totals.size)
    splitters = sorted(set(_quantiles(_drawn(rows, share, 0), parts)))
    for round_no in range(1, how.rounds + 1):
        measured = _measured(rows, splitters)
        most_rows, most_bytes = 2 * how.rows_per_range, 2 * totals.size / parts
        over = [i for i, (n, size) in enumerate(measured) if n > 1 and (n > most_rows or size > most_bytes)]
        if not over or round_no == how.rounds:
            return splitters, measured
        # about `sampled` keys for every part that an overfull range is to be divided into
        needed = {i: 2 * max(measured[i][0] / most_rows, measured[i][1] / most_bytes) for i in over}
        ranged = rows.withColumn("range", range_of(splitters)).where(F.col("range").isin(over))
        rate = F.create_map(*(F.lit(x) for i in over for x in (i, needed[i] * how.sampled / max(measured[i][1], 1))))
        drawn = _drawn(ranged, F.col("size") * rate[F.col("range")], round_no)
        added: set[str] = set()
        for i in over:
            low = bisect.bisect_left(drawn, (splitters[i - 1],)) if i else 0
            high = bisect.bisect_left(drawn, (splitters[i],)) if i < len(splitters) else len(drawn)
            added |= set(_quantiles(drawn[low:high], math.ceil(needed[i])))
        if added <= set(splitters):
            return splitters, measured
        splitters = sorted(set(splitters) | added)
    return splitters, measured


def _measured(rows: DataFrame, splitters: list[str]) -> list[tuple[int, int]]:
    sums = rows.groupBy(range_of(splitters).alias("range")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    found = {r.range: (r.n, r["size"]) for r in sums.collect()}
    return [found.get(i, (0, 0)) for i in range(len(splitters) + 1)]


def _by_number(values: dict[int, int], number: Column, default: Column) -> Column:
    """A lookup in as many values as there are shards."""
    if not values:
        return default
    return F.coalesce(F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[number], default)


def placed(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), how: Sharding | None = None) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` and the columns ``carry`` of every row."""
    how = how or Sharding()
    rows = stage(described(docs, key, text, carry), "records")
    splitters, measured = ranges(rows, how)
    total = max(sum(size for _, size in measured), 1)
    before, n_before, size_before = [], 0, 0
    for i, (n, size) in enumerate(measured):
        before.append((i, n_before, size_before))
        n_before, size_before = n_before + n, size_before + size
    offsets = rows.sparkSession.createDataFrame(before, "range int, rows_before long, size_before long")
    in_range = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        rows.withColumn("range", range_of(splitters))
        .withColumns(
            {
                "rank": F.count("*").over(in_range),
                "start": F.coalesce(F.sum("size").over(in_range), F.lit(0)),
            }
        )
        # one row per range, fewer than sampled keys
        .join(F.broadcast(offsets), "range")
        .withColumns({"rank": F.col("rank") + F.col("rows_before"), "start": F.col("start") + F.col("size_before")})
    )

    def at(start: Column, size: Column) -> Column:
        middle = 2 * start.cast("long") + size
        return F.call_function("div", middle * how.shards, F.lit(2 * total).cast("long")).cast("int")

    ordered = stage(ordered.withColumn("shard", at(F.col("start"), F.col("size"))).drop("range", "rows_before", "size_before"), "ordered")
    whole = _parted_groups(ordered, total, how)
    shard = F.col("shard")
    if whole:
        groups = F.create_map(*(F.lit(x) for digest, start, size in whole for x in (digest, F.struct(F.lit(start).alias("start"), F.lit(size).alias("size")))))
        group = groups[F.col("digest")]
        shard = F.when(group.isNotNull(), at(group["start"], group["size"])).otherwise(shard)
    settled = ordered.withColumn("shard", shard)
    firsts = {r.shard: r["first"] for r in settled.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    slot = F.col("rank") - _by_number(firsts, F.col("shard"), F.lit(0).cast("long"))
    return settled.select(F.col("id").alias(key), "size", "text_crc32", "shard", slot.alias("slot"), *(["carried.*"] if carry else []))


def _parted_groups(ordered: DataFrame, total: int, how: Sharding) -> list[tuple[str, int, int]]:
    """Digest, start and bytes of the groups of copies that a border parts and that are small enough to stay
    whole: at most one per border."""
    edges = ordered.groupBy("shard").agg(F.min_by("digest", "rank").alias("first"), F.max_by("digest", "rank").alias("last"))
    by_shard = sorted((r.shard, r["first"], r["last"]) for r in edges.collect())
    parted = {a[2] for a, b in zip(by_shard, by_shard[1:]) if a[2] == b[1]}
    if not parted:
        return []
    sums = ordered.where(F.col("digest").isin(sorted(parted))).groupBy("digest")
    found = sums.agg(F.min("start").alias("start"), F.sum("size").alias("size")).collect()
    return [(r.digest, r.start, r["size"]) for r in found if r["size"] * 100 * how.shards <= how.whole_percent * total]


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", rows_per_file: int = 1_000_000, how: Sharding | None = None) -> None:
    """Parquet files of the whole rows under ``shard=N``, each holding a run of consecutive slots in order. A column of ``docs``
    named ``shard`` or ``slot`` is an error of the caller."""
    taken = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"columns in the way: {sorted(taken)}")
    keyed = docs.withColumn("_own_key", F.col(key))
    out = placed(keyed, "_own_key", text, list(docs.columns), how).select(*docs.columns, "shard", "slot")
    run = F.floor(F.col("slot") / rows_per_file)
    by_run = out.repartition("shard", run).sortWithinPartitions("shard", "slot")
    by_run.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
