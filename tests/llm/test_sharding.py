"""Shards against one sorted list, with hot texts, ties and odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.llm.sharding import Sharding, placed, write_shards


def expected(rows, how):
    """Shard and slot per row, by one pass over the sorted rows; equal rows are interchangeable."""
    digest = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode()) + 1
    order = sorted(rows, key=lambda r: f"{digest(r[1])}-{'' if r[0] is None else r[0]}-")
    total = sum(size(t) for _, t in rows)
    groups, start = {}, 0
    for _, t in order:
        first, n = groups.get(digest(t), (start, 0))
        groups[digest(t)] = (first, n + size(t))
        start += size(t)
    out, start, slots = [], 0, Counter()
    for key, t in order:
        first, n = groups[digest(t)]
        whole = n * 100 * how.shards <= how.whole_percent * total
        middle = 2 * first + n if whole else 2 * start + size(t)
        shard = middle * how.shards // (2 * total)
        out.append((key, size(t), zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        start += size(t)
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot").collect())


@pytest.mark.parametrize("rows_per_range", [20, 500_000])
def test_equals_one_sorted_list(spark, docs_of, rows_per_range):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["ä", "bc", "def", "😀"], k=rng.randrange(60))) for _ in range(400)]
    texts += ["the same text " * 3] * 300 + [None, "", "x" * 9000]
    rng.shuffle(texts)
    how = Sharding(shards=7, rows_per_range=rows_per_range, least_ranges=9)
    assert got(placed(docs_of(texts), how=how)) == expected(list(enumerate(texts)), how)


def test_small_groups_are_not_parted(docs_of):
    texts = [f"text {k // 4} " + "w" * 90 for k in range(6000)]
    how = Sharding(shards=16, whole_percent=5)
    rows = placed(docs_of(texts), how=how).select("text_crc32", "shard", "size").distinct().collect()
    assert len(rows) == 1500
    sizes = Counter()
    for r in placed(docs_of(texts), how=how).collect():
        sizes[r.shard] += r["size"]
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 2 * 4 * 110


def test_odd_rows(odd_docs):
    how = Sharding(shards=4)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    out = placed(odd_docs, carry=["shard_note", "place", "lang"] if "shard_note" in odd_docs.columns else ["place", "lang"], how=how)
    assert got(out) == expected(rows, how)
    assert {r.place for r in out.collect()} == {"own place"}


def test_one_repeated_row(spark):
    docs = spark.range(1000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("again").alias("text"))
    rows = placed(docs, how=Sharding(shards=8, rows_per_range=50)).collect()
    assert Counter(r.shard for r in rows) == {s: 125 for s in range(8)}
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(8) for k in range(125)]


def test_empty_table(docs_of):
    assert placed(docs_of(["x"]).limit(0)).count() == 0


def test_files_hold_runs_of_slots(spark, docs_of, tmp_path):
    texts = [f"text number {k} " + "w" * (k % 50) for k in range(500)]
    docs = docs_of(texts)
    path = str(tmp_path / "shards")
    write_shards(docs, path, rows_per_file=40, how=Sharding(shards=4))
    files = spark.read.parquet(path).select("doc_id", "text", "shard", "slot", F.input_file_name().alias("file")).collect()
    assert {(r.doc_id, r.text) for r in files} == set(enumerate(texts))
    by_file = {}
    for r in files:
        by_file.setdefault((r.shard, r.file), []).append(r.slot)
    assert all(slots == list(range(min(slots), min(slots) + len(slots))) and len(slots) <= 40 for slots in by_file.values())
