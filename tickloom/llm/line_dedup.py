"""Line deduplication by content-defined chunks of lines.

A rolling hash over the hashes of the last WINDOW lines ends a chunk where it falls into a quarter of its range.
Borders so follow the content: lines inserted or removed elsewhere do not move them. A passage that several documents
share is then cut in the same places, but for its first and last lines, which share a chunk with what stands beside
them. So there is a finest level, too: every two neighbouring lines, named by the same rolling hash.

1. Every chunk of at least two lines, and every two neighbouring lines, as (row, first line, digest). Digests that occur
   at two places are candidates; all places but the first (smallest key, then text, then line) are later ones.
2. What goes of a text: its later chunks, and its later pairs of lines extended line by line, as long as pair follows on
   pair, if such a run has over ``min_words`` words. A run of two or more copied lines is so found at any offset, to its
   last line on both sides.
3. The bytes of all lines in candidates are compared. If two differ under one digest, the search is done again with
   SHA-256 in place of MD5, so a collision of digests removes nothing.

Columns and SQL functions only. Only digests and places are grouped and joined; a chunk that very many documents hold is
one row per task before its first occurrence is found, and joins that bring the rows of a hot digest together are
ones that adaptive execution splits. Texts are moved once, to their places.

Defined cases: null text stays null and has no lines; empty text is one line without words and stays. Chunks
and pairs without any word are not removed by themselves; two neighbouring lines without a word do not end a run. Rows
with equal key and text count as one occurrence, so they keep or lose the same lines. Null keys sort first. A copied
line whose neighbours on both sides are its own is no chunk and no pair, and stays. Columns other than key and text are
handed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .common import clear_of, let, white_words

WINDOW = 2
#: first digits of the window's md5 that end a chunk: one line in four on average
ENDING = "3"
#: runs of pairs of up to so many words stay
MIN_WORDS = 50
NOT_WHITE = r"[^\x20\x09-\x0D]"


def md5(data: Column) -> Column:
    return F.md5(data.cast("binary"))


def sha256(data: Column) -> Column:
    return F.sha2(data.cast("binary"), 256)


#: names of lines and chunks, the next one only after two texts were found under one name
NAMES = (md5, sha256)


def indexes(size: Column) -> Column:
    """0 to ``size - 1``."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def chunk_ends(hashes: Column) -> Column:
    """Indexes of the last lines of all chunks, from the md5 of the lines."""

    def closes(i: Column) -> Column:
        window = F.concat(*(F.coalesce(F.get(hashes, i - k), F.lit("")) for k in reversed(range(WINDOW))))
        return (F.md5(window) < F.lit(chr(ord(ENDING) + 1))) | (i == F.size(hashes) - 1)

    return F.filter(indexes(F.size(hashes)), closes)


def spans(text: Column, name=md5) -> Column:
    """Array of ``(no, n_lines, chunk, digest)`` of a text that is not null: its multi-line chunks and its pairs of
    neighbouring lines, those with a word. A chunk of two lines is a pair with ``chunk`` true."""

    def of_lines(lines: Column) -> Column:
        def span(no: Column, size: Column, chunk: Column, names: Column) -> Column:
            digest = name(F.array_join(F.slice(names, no + 1, size), ""))
            return F.struct(no.alias("no"), size.alias("n_lines"), chunk.alias("chunk"), F.unhex(digest).alias("digest"))

        def of_names(names: Column, hashes: Column) -> Column:
            def of_ends(ends: Column) -> Column:
                def chunk(end: Column, k: Column) -> Column:
                    start = F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
                    return F.struct(start.alias("no"), (end - start + 1).alias("n_lines"))

                def of_chunks(cut: Column) -> Column:
                    twos = F.transform(F.filter(cut, lambda c: c["n_lines"] == 2), lambda c: c["no"])
                    longer = F.filter(cut, lambda c: (c["n_lines"] > 2) & worded(lines, c["no"], c["n_lines"]))
                    pairs = F.filter(indexes(F.size(lines) - 1), lambda i: worded(lines, i, F.lit(2)))
                    return F.concat(
                        F.transform(longer, lambda c: span(c["no"], c["n_lines"], F.lit(True), names)),
                        let(twos, lambda t: F.transform(pairs, lambda i: span(i, F.lit(2), F.array_contains(t, i), names))),
                    )

                return let(F.transform(ends, chunk), of_chunks)

            return let(chunk_ends(hashes), of_ends)

        hashes = F.transform(lines, md5)
        if name is md5:
            return let(hashes, lambda h: of_names(h, h))
        return let(hashes, lambda h: let(F.transform(lines, name), lambda n: of_names(n, h)))

    return let(F.split(text, "\n", -1), of_lines)


def worded(lines: Column, no: Column, size: Column) -> Column:
    return F.exists(F.slice(lines, no + 1, size), lambda x: x.rlike(NOT_WHITE))


def candidates(docs: DataFrame, key: str, text: str, name=md5) -> DataFrame:
    """``doc_id, whole, no, n_lines, chunk, later`` of all spans that occur at two places; ``whole`` tells texts of one
    key apart."""
    t = F.col(text)
    rows = docs.where(t.isNotNull()).select(F.col(key).alias("doc_id"), F.xxhash64(t).alias("whole"), F.explode(spans(t, name)).alias("s"))
    found = stage(rows.select("doc_id", "whole", "s.*"), "line-spans")
    place = F.struct("doc_id", "whole", "no")
    firsts = (
        found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first")
    )
    # as many as there are repeated spans: never a broadcast
    held = found.join(firsts.hint("merge"), "digest")
    return held.select("doc_id", "whole", "no", "n_lines", "chunk", (~place.eqNullSafe(F.col("first"))).alias("later"))


def names_of(lines: Column, spans: Column, name) -> Column:
    """``(name, meaning)`` of the lines and spans: a line by its bytes, a span by the names of its lines."""

    def of_names(names: Column) -> Column:
        numbers = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["no"], s["no"] + s["n_lines"] - 1))))
        joined = F.transform(spans, lambda s: F.array_join(F.slice(names, s["no"] + 1, s["n_lines"]), ""))
        return F.concat(
            F.transform(numbers, lambda i: F.struct(F.concat(F.lit("line:"), F.get(names, i)).alias("name"), F.get(lines, i).alias("meaning"))),
            F.transform(joined, lambda x: F.struct(F.concat(F.lit("span:"), name(x)).alias("name"), x.alias("meaning"))),
        )

    return let(F.transform(lines, name), of_names)


def names_are_clear(rows: DataFrame, text: str, spans: str, name) -> bool:
    """Whether all lines and spans of one name are equal, byte for byte."""
    named = rows.where(F.col(spans).isNotNull()).select(F.explode(names_of(F.split(text, "\n", -1), F.col(spans), name)).alias("n"))
    twice = named.select("n.*").distinct().groupBy("name").count().where("count > 1")
    return twice.isEmpty()


def gone_lines(lines: Column, spans: Column, min_words: int) -> Column:
    """Sorted indexes of the lines that go."""
    later = F.filter(spans, lambda s: s["later"])
    chunks = F.transform(
        F.filter(later, lambda s: s["chunk"]),
        lambda s: F.struct(s["no"].alias("first"), (s["no"] + s["n_lines"] - 1).alias("last")),
    )
    blank = F.filter(indexes(F.size(lines) - 1), lambda i: ~worded(lines, i, F.lit(2)))
    pairs = F.transform(F.filter(later, lambda s: s["n_lines"] == 2), lambda s: s["no"])

    def long_runs(numbers: Column) -> Column:
        pairs = F.transform(stretches(numbers), lambda x: F.struct(x["first"].alias("first"), (x["last"] + 1).alias("last")))

        def words(x: Column) -> Column:
            return F.size(white_words(F.array_join(F.slice(lines, x["first"] + 1, x["last"] - x["first"] + 1), "\n")))

        return F.filter(pairs, lambda x: words(x) > min_words)

    runs = let(F.array_sort(F.array_union(pairs, blank)), long_runs)
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.concat(chunks, runs), lambda x: F.sequence(x["first"], x["last"])))))


def stretches(numbers: Column) -> Column:
    """``(first, last)`` of the stretches of sorted numbers that follow on each other."""
    firsts = F.filter(numbers, lambda x, i: ~F.coalesce(F.get(numbers, i - 1) == x - 1, F.lit(False)))
    lasts = F.filter(numbers, lambda x, i: ~F.coalesce(F.get(numbers, i + 1) == x + 1, F.lit(False)))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated lines cut out of the text, and what was cut in a column ``cut`` (array of
    ``start, n_lines``; null where nothing was; renamed if ``docs`` has a column of that name)."""
    cut, owner, whole = clear_of(docs, "cut", "cut_from", "cut_whole")
    for name in NAMES:
        per_doc = candidates(docs, key, text, name).groupBy(F.col("doc_id").alias(owner), F.col("whole").alias(whole))
        per_doc = per_doc.agg(F.collect_set(F.struct("no", "n_lines", "chunk", "later")).alias(cut))
        same = docs[key].eqNullSafe(per_doc[owner]) & (F.xxhash64(docs[text]) == per_doc[whole])
        # as many as there are documents with candidates: never a broadcast
        joined = stage(docs.join(per_doc.hint("merge"), same, "left").drop(owner, whole), "line-candidates")
        if names_are_clear(joined, text, cut, name):
            break
    else:
        raise ValueError("two lines of one SHA-256")

    def as_cut(gone: Column) -> Column:
        return F.transform(stretches(gone), lambda x: F.struct(x["first"].alias("start"), (x["last"] - x["first"] + 1).alias("n_lines")))

    def left(lines: Column, gone: Column) -> Column:
        return F.transform(F.array_except(indexes(F.size(lines)), gone), lambda i: F.get(lines, i))

    def result(lines: Column) -> Column:
        def of_gone(gone: Column) -> Column:
            return F.when(F.size(gone) > 0, F.struct(as_cut(gone).alias("cut"), F.array_join(left(lines, gone), "\n").alias("rest")))

        return let(gone_lines(lines, F.col(cut), min_words), of_gone)

    out = joined.withColumn(cut, F.when(F.exists(cut, lambda s: s["later"]), let(F.split(text, "\n", -1), result)))
    return out.withColumns({text: F.coalesce(F.col(cut)["rest"], F.col(text)), cut: F.col(cut)["cut"]})


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: lines, removed stretches of lines and lines in them, and the digest of what is left."""
    lines = F.length(text) - F.length(F.translate(F.col(text), "\n", "")) + 1
    zero = F.lit(0).cast("long")
    n_lines = F.coalesce(lines.cast("long"), zero).alias("n_lines")
    out = without_repeats(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), n_lines))
    return out.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("cut").cast("long"), zero).alias("n_removed_runs"),
        F.coalesce(F.aggregate("cut", zero, lambda total, x: total + x["n_lines"]), zero).alias("n_removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
