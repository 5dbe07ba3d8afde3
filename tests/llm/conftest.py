import random

import pytest

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts; ids count from 0."""

    def make(texts, schema=SCHEMA):
        rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with names the operators use."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(4000)}" for _ in range(30_000)]
    passage = " ".join(words[:120])
    texts = [None, "", "   \n\t ", "one", "four words are here", passage, passage, passage + " tail", " ".join(words),
             "\n".join(" ".join(words[k : k + 9]) for k in range(0, 400, 9)), "a b c " * 500, "!!! ### $$$ " * 60, "é" * 900, "😀 ü " * 200]
    rows = [(i, t, None if i == 3 else "en", None if i == 4 else f"s{i % 3}", 7) for i, t in enumerate(texts)]
    rows += [(5, passage, "en", "s2", 7), (5, passage, "en", "s2", 7), (None, passage, "en", "s2", 7), (6, "another text of id six", "en", "s0", 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = ("cut", "cut_from", "rejected_by", "text_digest", "place", "lost", "topic", "probability", "cell_source", "t", "row", "key", "digest", "kept", "whole_text")
    return df.withColumns({name: F.lit(f"own {name}") for name in extra}).repartition(4)
