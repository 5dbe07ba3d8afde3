"""Collocations against plain counting, with runs, blocks and ranges of a few entries."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tickloom.llm.collocations import Collocations, collocations

SCHEMA = "doc_id long, text string, lang string, range string, n int, words string, f int"


def expected(rows, how):
    counts = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, how.longest + 1):
                for i in range(len(words) - n + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        total = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: c for g, c in f.items() if len(g) > 1 and c >= how.least}
        gone = {g[i:j] for g, c in often.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1)
                if j - i < len(g) and 100 * c >= how.inside_percent * f[g[i:j]]}
        scored = []
        for g, a in often.items():
            if g in gone:
                continue
            score, _, l, r = min((how.scale * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[: how.top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total, -s))
    return sorted(out)


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(k, t, g, "own", 1, "own", 2) for k, (t, g) in enumerate(rows)], SCHEMA).repartition(parts)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def random_rows(seed, texts=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "new", "é", "日本", "a\x01", "a", "\x00", "a\x08b", "x-y", "\x1f", "😀", "ZÜ"]
    weights = [40, 5, 30] + [4] * 13
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "]
    rows = [("".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randrange(40))), rng.choice(["en", "en", None, "und", "de"])) for _ in range(texts)]
    return rows + [(None, "en"), ("", "fr"), (" .,\n", "fr"), ("the of the of the of", "en")] + [("one two three four", "xx")] * 12


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "how",
    [
        Collocations(least=3),
        Collocations(least=3, run_bytes=50, block=3, per_range=25),
        Collocations(least=2, longest=4, run_bytes=300, block=5, per_range=60, top=9),
        Collocations(least=5, longest=2, per_range=40, inside_percent=80),
    ],
    ids=["whole", "tiny ranges", "four words", "pairs"],
)
def test_equals_plain_counting(spark, seed, how):
    rows = random_rows(seed)
    assert got(collocations(frame(spark, rows), how=how)) == expected(rows, how)


def test_texts_longer_than_a_run(spark):
    rng = random.Random(9)
    text = " ".join(rng.choices(["aa", "bb", "cc,", "dd", "ee.", "ff"], k=3000))
    without = " ".join(rng.choices(["aa", "bb", "cc"], k=1500))
    rows = [(text, "en"), (without, "en"), (without + "." + text, "de")]
    how = Collocations(least=4, run_bytes=256, block=16, per_range=30)
    assert got(collocations(frame(spark, rows), how=how)) == expected(rows, how)


def test_one_text_repeated(spark):
    rows = [("every text holds the same words. every text", "en")] * 500
    how = Collocations(run_bytes=400, block=4, per_range=50)
    assert got(collocations(frame(spark, rows, 7), how=how)) == expected(rows, how)


def test_products_beyond_64_bits(spark):
    rows = [("very common", "en")] * 3000
    how = Collocations(scale=10**15)
    assert got(collocations(frame(spark, rows), how=how)) == [("en", 1, "very common", 3000, 3000, 3000, 6000, 10**15)]


def test_no_texts(spark):
    assert got(collocations(frame(spark, [("x", "en")]).limit(0))) == []
    assert got(collocations(frame(spark, [(None, None), ("rare words", "en")]))) == []


def test_odd_rows(odd_docs):
    how = Collocations(least=4)
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    assert got(collocations(odd_docs, how=how)) == expected(rows, how)
