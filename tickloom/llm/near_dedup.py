"""Near-duplicates by the chosen-path set similarity join.

A document is the set of its five-word shingles. Documents with equal sets form a class, and classes take
part once.

1. Every class gets 128 minwise tokens. A tree starts with all classes in one node. A node picks one of the
   128 places (with probability 1 / threshold - 1 a second one) from its own key, and each class moves
   to the child named by its token there; similar sets hold the same token with the probability of their
   similarity. The trees are independent, and as many as the target recall asks for.
2. Nodes of at most LEAF classes are compared exhaustively: on 256-bit sketches first, then on full sets.
   Larger nodes branch again. Sets of a node that stays large to the last level are nearly alike: each is
   compared in blocks with the node's pivots, and those outside the node's largest component with all.
3. The first trees are compared before the others, and give each class the smallest class it is known to be
   connected with. In the other trees, classes with the same such root are not compared again, and a node with
   one root only is done.

No pair of candidates is written: tasks compare their block and return each member's root in the block.
Nodes, blocks and sets move by shuffles; nothing of a document reaches the driver.

Defined cases: texts without words, null or empty, have an empty set and no link. Fewer than five words
are one shingle. Equal ids with different texts are separate rows; a component's id is the smallest id in it
(nulls only if there is no other). Repeated rows stay repeated. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .common import clear_of
from .components import components
from .words import WHITE, Tokenizer, Words, fixed_binary, gram_hashes, gram_starts, mix, ragged_binary

TOKENS = 128
LEAF = 2000
BLOCK = 200
LEVELS = 4
FIRST_TREES = 2
_SPLIT = Tokenizer(frozenset(range(256)) - WHITE, lower=True)
_FLIP = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_SPIN = mix(_FLIP) | np.uint64(1)


@dataclass(frozen=True)
class Similarity:
    """Links need ``100 * intersection >= percent * union``; a link is missed with a chance below
    ``miss`` where nodes end on the second level."""

    percent: int = 85
    shingle: int = 5
    miss: float = 1e-6

    @property
    def trees(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** 2))

    @property
    def least_matches(self) -> float:
        """Matching two-bit lanes of two sketches at the threshold, less 4.5 standard deviations."""
        p = self.percent / 100
        p = p + (1 - p) / 4
        return TOKENS * p - 4.5 * math.sqrt(TOKENS * p * (1 - p))

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the border of each text's part."""
    fits = gram_starts(words.first, size)
    starts = np.flatnonzero(fits)
    hashes = gram_hashes(words.hashes, size)[starts]
    borders = np.searchsorted(starts, words.first)
    sets = [np.unique(hashes[a:b]) for a, b in zip(borders[:-1], borders[1:])]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < size)):
        first, n = int(words.first[i]), int(words.counts[i])
        sets[i] = gram_hashes(words.hashes[first : first + n], n) + np.uint64(n)
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum(sizes)])


def minwise_tokens(sets: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """32-bit tokens, a row per text; zeros for empty sets."""
    tokens = np.zeros((len(borders) - 1, TOKENS), np.uint32)
    full = np.flatnonzero(np.diff(borders))
    if len(full):
        for t in range(TOKENS):
            least = np.minimum.reduceat((sets ^ _FLIP[t]) * _SPIN[t], borders[full])
            tokens[full, t] = (mix(least) >> np.uint64(32)).astype(np.uint32)
    return tokens


def set_digests(sets: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Two 64-bit sums of the mixed members."""
    out = np.zeros((len(borders) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(borders))
    if len(full):
        out[full, 0] = np.add.reduceat(mix(sets), borders[full])
        out[full, 1] = np.add.reduceat(mix(sets ^ _FLIP[0]), borders[full])
    return out


def sketches(tokens: np.ndarray) -> np.ndarray:
    """Two bits of each token, packed into four 64-bit words."""
    lanes = (tokens & 3).astype(np.uint64).reshape(len(tokens), 4, 32)
    shifts = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(lanes << shifts, axis=2)


def matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal lanes of sketches whose last axis holds the four words."""
    x = a ^ b
    differ = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return TOKENS - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64)


def _shingled(how: Similarity, with_sets: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _SPLIT.groups(batch.column(1)):
                sets, borders = shingle_sets(words, how.shingle)
                part = batch.slice(int(words.rows[0]), len(words.rows))
                columns = [part.column(0), pa.array(np.diff(borders), pa.int64()), fixed_binary(set_digests(sets, borders))]
                if with_sets:
                    columns.append(ragged_binary(sets, borders))
                else:
                    columns.append(fixed_binary(minwise_tokens(sets, borders)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "data"])

    return run


def _words(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A binary column of ``width`` numbers a row."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(column), width)


_ODD = np.uint64(0x9E3779B97F4A7C15)
NODE = "tree int, key long, cls long, n long, sketch binary"


def _children(keys: np.ndarray, tokens: np.ndarray, how: Similarity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row indexes and their child keys: one child, and a second one for some nodes."""
    draw = mix(keys + _ODD)
    first = (draw % np.uint64(TOKENS)).astype(np.int64)
    second = (mix(draw) % np.uint64(TOKENS)).astype(np.int64)
    chance = 100 / how.percent - 1
    twice = ((mix(draw + _ODD) >> np.uint64(40)).astype(np.float64) / (1 << 24) < chance) & (second != first)
    rows = np.arange(len(keys))
    for pick, live in ((first, rows), (second, rows[twice])):
        place = pick[live]
        yield live, mix(keys[live] * _ODD + mix(tokens[live, place].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))))


def _nodes(trees: np.ndarray, keys: np.ndarray, cls: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(trees, pa.int32()), pa.array(keys.view(np.int64)), pa.array(cls), pa.array(n), fixed_binary(sketch)],
        ["tree", "key", "cls", "n", "sketch"],
    )


def _first_level(how: Similarity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            tokens = _words(batch.column(2), np.uint32, TOKENS)
            sketch = sketches(tokens)
            for tree in range(how.trees):
                root = np.full(len(cls), mix(np.array([tree + 1], np.uint64))[0])
                for rows, keys in _children(root, tokens, how):
                    if len(rows):
                        yield _nodes(np.full(len(rows), tree), keys, cls[rows], n[rows], sketch[rows])

    return run


def _next_level(how: Similarity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, key, cls, n = (batch.column(i).to_numpy() for i in range(4))
            tokens = _words(batch.column(4), np.uint32, TOKENS)
            sketch = sketches(tokens)
            for rows, keys in _children(key.view(np.uint64), tokens, how):
                if len(rows):
                    yield _nodes(tree[rows], keys, cls[rows], n[rows], sketch[rows])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from rows sorted by their first column, and the groups' borders."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        keys = table.column(0).to_numpy()
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        rest = table.slice(last)
        if last:
            yield (done := table.slice(0, last).combine_chunks()), _borders(done.column(0).to_numpy())
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), _borders(rest.column(0).to_numpy())


def _borders(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def _close(sketch: np.ndarray, n: np.ndarray, how: Similarity) -> np.ndarray:
    """Which pairs within groups of one size may be linked: groups x size x size."""
    near = matches(sketch[:, :, None, :], sketch[:, None, :, :]) >= how.least_matches
    low, high = np.minimum(n[:, :, None], n[:, None, :]), np.maximum(n[:, :, None], n[:, None, :])
    near &= 100 * low >= how.percent * high
    near[:, np.arange(n.shape[1]), np.arange(n.shape[1])] = False
    return near


def near_pairs(sketch: np.ndarray, n: np.ndarray, how: Similarity, step: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ordered pairs of one group that may be linked, some rows of the group at a time."""
    for at in range(0, len(n), step):
        near = matches(sketch[at : at + step, None, :], sketch[None, :, :]) >= how.least_matches
        own = n[at : at + step, None]
        near &= 100 * np.minimum(own, n) >= how.percent * np.maximum(own, n)
        left, right = np.nonzero(near)
        left += at
        yield left[left != right], right[left != right]


def _with_partner(how: Similarity) -> Callable:
    """Rows of leaves that have a partner by sketch and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in _runs(batches):
            n = table.column("n").to_numpy()
            sketch = _words(table.column("sketch").chunk(0), np.uint64, 4)
            sizes = np.diff(borders)
            keep = np.zeros(len(n), bool)
            for a, b in zip(borders[:-1][sizes > 64], borders[1:][sizes > 64]):
                for left, _ in near_pairs(sketch[a:b], n[a:b], how):
                    keep[a + left] = True
            for size in np.unique(sizes[(sizes > 1) & (sizes <= 64)]):
                starts = borders[:-1][sizes == size]
                step = max(1, 4_000_000 // int(size * size))
                for at in range(0, len(starts), step):
                    rows = starts[at : at + step, None] + np.arange(size)
                    keep[rows[_close(sketch[rows], n[rows], how).any(axis=2)]] = True
            if keep.any():
                yield from table.filter(pa.array(keep)).select(["key", "tree", "cls"]).to_batches()

    return run


def _linking(how: Similarity) -> Callable:
    """Links within blocks, by full sets: every root that turns out to be connected with a smaller
    one, and the smallest such. Classes of one root count as linked; so do classes that an earlier
    link of the block connects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in _runs(batches):
            n = table.column("n").to_numpy()
            comp, side = table.column("comp").to_numpy(), table.column("side").to_numpy()
            sketch = _words(table.column("sketch").chunk(0), np.uint64, 4)
            data = table.column("data").chunk(0)
            links: list[tuple[int, int]] = []
            for a, b in zip(borders[:-1], borders[1:]):
                if b - a < 2:
                    continue
                own, part = comp[a:b], side[a:b]
                found = []
                for left, right in near_pairs(sketch[a:b], n[a:b], how):
                    # of two sides, only pairs across them; side 0 is compared with all
                    ask = (left < right) & (own[left] != own[right])
                    ask &= (part[left] != part[right]) | (part[left] == 0)
                    found.append((left[ask], right[ask]))
                left, right = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(-matches(sketch[a + left], sketch[a + right]), kind="stable")
                roots, group = np.unique(own, return_inverse=True)
                sets: dict[int, np.ndarray] = {}
                for some in np.array_split(order, len(order) // 10_000 + 1):
                    apart = group[left[some]] != group[right[some]]
                    for i, j in zip(left[some[apart]].tolist(), right[some[apart]].tolist()):
                        p, q = sorted((group[i], group[j]))
                        if p == q:
                            continue
                        for x in (i, j):
                            if x not in sets:
                                sets[x] = np.frombuffer(data[int(a) + x].as_py(), np.uint64)
                        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if how.linked(common, len(sets[i]), len(sets[j])):
                            group[group == q] = p
                lower = roots[group] != own
                links += set(zip(own[lower].tolist(), roots[group][lower].tolist()))
            if links:
                u, v = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _by_key(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key")


class ChosenPath:
    """One join over ``docs`` (columns ``doc_id`` and ``text``)."""

    def __init__(self, docs: DataFrame, how: Similarity):
        self.docs, self.how = docs, how
        self.kind = docs.schema["doc_id"].dataType.simpleString()
        rows = docs.mapInArrow(_shingled(how, False), f"doc_id {self.kind}, n_shingles long, digest binary, data binary")
        self.rows = stage(rows, "shingled")
        classes = self.rows.where("n_shingles > 0").groupBy("digest", F.col("n_shingles").alias("n"))
        classes = classes.agg(F.min("doc_id").alias("first_doc"), F.first("data").alias("tokens"))
        # the number is written down, so that a task that runs again cannot change it
        self.classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    def leaves(self) -> tuple[DataFrame, DataFrame]:
        """``(key, tree, cls)`` of leaf members with a partner, and members of nodes that stayed large
        with the node's ``size``."""
        spark, how = self.docs.sparkSession, self.how
        tokens = self.classes.select("cls", "n", "tokens")
        nodes = tokens.mapInArrow(_first_level(how), NODE)
        found, crowds = [], None
        for level in range(1, LEVELS + 1):
            sizes = nodes.groupBy("key").count().where("count > 1")
            members = stage(nodes.join(sizes, "key"), "members")
            small = members.where(F.col("count") <= LEAF).select("key", "tree", "cls", "n", "sketch")
            found.append(stage(_by_key(small).mapInArrow(_with_partner(how), "key long, tree int, cls long"), "leaves"))
            large = members.where(F.col("count") > LEAF)
            if large.isEmpty():
                break
            if level == LEVELS:
                crowds = stage(large.select("key", "tree", "cls", F.col("count").alias("size")), "crowds")
                break
            rows = large.select("tree", "key", "cls", "n").join(tokens.select("cls", "tokens"), "cls")
            rows = rows.select("tree", "key", "cls", "n", "tokens")
            nodes = stage(rows.mapInArrow(_next_level(how), NODE), "nodes")
        leaves = found[0]
        for more in found[1:]:
            leaves = leaves.unionByName(more)
        if crowds is None:
            crowds = spark.createDataFrame([], "key long, tree int, cls long, size long")
        return leaves, crowds

    def full_sets(self, wanted: DataFrame) -> DataFrame:
        """``cls, n, sketch, data`` (sorted shingle hashes) of the wanted classes."""
        first = self.classes.join(wanted, "cls", "left_semi").select("cls", "digest", "n", "first_doc", "tokens")
        ids = first.select("first_doc").distinct()
        # as many ids as there are near-copies, which grow with the corpus: never a broadcast
        texts = self.docs.join(ids.hint("merge"), self.docs["doc_id"].eqNullSafe(ids["first_doc"]), "left_semi")
        sets = texts.mapInArrow(_shingled(self.how, True), f"doc_id {self.kind}, n_shingles long, digest binary, data binary")
        # one of several rows with the same id and set
        sets = sets.groupBy("digest", F.col("n_shingles").alias("n")).agg(F.first("data").alias("data"))
        rows = first.join(sets, ["digest", "n"]).select("cls", "n", "tokens", "data")

        def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                packed = fixed_binary(sketches(_words(b.column(2), np.uint32, TOKENS)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed, b.column(3)], ["cls", "n", "sketch", "data"])

        return stage(rows.mapInArrow(sketch, "cls long, n long, sketch binary, data binary"), "sets")

    def _links(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        """Links inside blocks ``(key, cls, comp, side)``."""
        rows = members.join(sets, "cls").select("key", "cls", "n", "comp", "side", "sketch", "data")
        return _by_key(rows).mapInArrow(_linking(self.how), "u long, v long")

    def component_of_classes(self) -> DataFrame:
        """``cls, comp`` of classes with a link."""
        leaves, crowds = self.leaves()
        sets = self.full_sets(leaves.select("cls").unionByName(crowds.select("cls")).distinct())
        alone = F.col("cls").alias("comp"), F.lit(0).alias("side")
        early = leaves.where(F.col("tree") < FIRST_TREES).select("key", "cls", *alone)
        # a crowd's blocks, each with the pivots of the node
        n_blocks = F.ceil(F.col("size") / BLOCK)
        crowded = not crowds.isEmpty()
        if crowded:
            pivots = crowds.groupBy("key").agg(
                F.array_distinct(F.array(F.min("cls"), F.min_by("cls", F.xxhash64("cls")))).alias("pivots"), F.max("size").alias("size")
            )
            pivots = pivots.select("key", F.explode("pivots").alias("cls"), F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"))
            blocks = crowds.select("key", "cls", F.pmod(F.xxhash64("cls"), n_blocks).alias("block"))
            blocks = blocks.unionByName(pivots).distinct()
            early = early.unionByName(blocks.select(F.xxhash64("key", "block").alias("key"), "cls", *alone))
        edges = stage(self._links(early, sets), "links")
        lower = edges.groupBy(F.col("u").alias("cls")).agg(F.min("v").alias("root"))
        beyond = lower.select(F.col("cls").alias("root"), F.col("root").alias("next"))
        found = stage(lower.join(beyond, "root", "left").select("cls", F.coalesce("next", "root").alias("root")), "roots")

        def with_comp(rows: DataFrame) -> DataFrame:
            return rows.join(found, "cls", "left").withColumn("comp", F.coalesce("root", "cls")).drop("root")

        late = with_comp(leaves.where(F.col("tree") >= FIRST_TREES))
        open_keys = late.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("key")
        late = late.join(open_keys, "key", "left_semi").select("key", "cls", "comp", F.lit(0).alias("side"))
        if crowded:
            late = late.unionByName(self._residue(with_comp(crowds)))
        more = stage(self._links(late, sets), "links")
        return components(edges.unionByName(more)).select(F.col("node").alias("cls"), F.col("root").alias("comp"))

    @staticmethod
    def _residue(crowds: DataFrame) -> DataFrame:
        """Blocks that compare the classes outside a node's largest component with all of the node."""
        per = crowds.groupBy("key", "comp").count()
        main = per.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("m"), F.sum("count").alias("total"))
        main = main.select("key", F.col("m.comp").alias("main"), (F.col("total") - F.col("m.count")).alias("outside"), "total")
        rows = crowds.join(main.where("outside > 0"), "key")
        n_out, n_all = F.ceil(F.col("outside") / BLOCK), F.ceil(F.col("total") / BLOCK)
        at = F.xxhash64("cls")
        outside = rows.where("comp != main").select(
            "key", "cls", "comp", F.pmod(at, n_out).alias("i"), F.explode(F.sequence(F.lit(0), n_all - 1)).alias("j"), F.lit(0).alias("side")
        )
        inside = rows.where("comp = main").select(
            "key", "cls", "comp", F.explode(F.sequence(F.lit(0), n_out - 1)).alias("i"), F.pmod(at, n_all).alias("j"), F.lit(1).alias("side")
        )
        # the outside classes among each other: block i against block j of the same
        across = rows.where("comp != main").select(
            "key", "cls", "comp", F.explode(F.sequence(F.lit(0), n_out - 1)).alias("i"), F.pmod(at, n_out).alias("j"), F.lit(1).alias("side")
        )
        own = rows.where("comp != main").select(
            "key", "cls", "comp", F.pmod(at, n_out).alias("i"), F.explode(F.sequence(F.lit(0), n_out - 1)).alias("j"), F.lit(0).alias("side")
        )
        first = outside.unionByName(inside).select(F.xxhash64(F.lit("all"), "key", "i", "j").alias("key"), "cls", "comp", "side")
        second = own.unionByName(across).select(F.xxhash64(F.lit("out"), "key", "i", "j").alias("key"), "cls", "comp", "side")
        return first.unionByName(second).distinct()

    def labelled(self) -> DataFrame:
        """``doc_id, n_shingles, component_id`` per row of ``docs``."""
        comps = self.component_of_classes()
        named = self.classes.select("cls", "digest", "n", "first_doc").join(comps, "cls", "left")
        named = stage(named.withColumn("comp", F.coalesce("comp", "cls")), "named")
        smallest = named.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
        ids = stage(named.join(smallest, "comp").select("digest", F.col("n").alias("n_shingles"), "component_id"), "ids")
        rows = self.rows.select("doc_id", "n_shingles", "digest").join(ids, ["digest", "n_shingles"], "left")
        empty = F.col("n_shingles") == 0
        return rows.select(
            "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
        )


def near_duplicates(docs: DataFrame, how: Similarity | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = ChosenPath(rows, how or Similarity()).labelled()
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, how: Similarity | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of their group. Rows that repeat a kept row's key
    and belong to its group stay with it; of rows with one key and different texts, each stays or
    goes by its own group."""
    mark, place, lost = clear_of(docs, "text_digest", "place", "lost")
    marked = docs.withColumn(mark, F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    # null keys come last, so that they give way to any other
    pair = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col(mark).alias("m"))
    dropped = near_duplicates(marked.select(pair.alias("doc_id"), F.col(text).alias("text")), how)
    # ordered by key first, so the smallest one has the smallest key
    gone = dropped.where(~F.col("doc_id.k").eqNullSafe(F.col("component_id.k"))).select(F.col("doc_id").alias(lost)).distinct()
    # as many as there are copies: never a broadcast
    keep = marked.withColumn(place, pair).join(gone.hint("merge"), F.col(place).eqNullSafe(F.col(lost)), "left_anti")
    return keep.select(*docs.columns)
