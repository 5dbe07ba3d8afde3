"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for every operator and stage."""

import hashlib

import pytest

import corpus_pipeline
from tickloom.llm import backoff, chat, decontamination, html_text, line_dedup, mixing, near_dedup, quality, substring_dedup, toxicity


def by_id(df, *columns):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return out


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [("1", "one"), ("2", None), ("3", ""), ("4", "another text of id six"), ("4", "another text of id six"), (None, "four words are here")],
        "item_id string, text string",
    )


def test_quality(odd_docs):
    out = by_id(quality.judged(odd_docs), "n_words", "base_failed", "kept")
    assert out[0] == out[1] == out[2] == [(0, True, False)]
    assert out[5] == [(120, False, True)] * 3
    assert out[10] == [(1500, True, False)]
    assert out[11] == [(180, True, False)]
    assert out[8] == [(30_000, False, True)]


def test_decontamination(odd_docs, benchmark):
    out = by_id(decontamination.overlaps(odd_docs, benchmark), "n_words", "n_hit", "items", "contaminated")
    assert out[0] == out[1] == out[2] == [(0, 0, [], False)]
    assert out[3] == [(1, 1, ["1"], True)]
    assert out[4] == [(4, 4, [], True)]
    assert sorted(out[6]) == [(5, 5, ["4"], True), (120, 0, [], False)]
    kept = decontamination.drop_contaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 3


def test_backoff(odd_docs):
    out = by_id(backoff.scored(odd_docs), "n_words", "log_score", "mean_log_score")
    assert out[0] == out[1] == [(0, 0.0, None)]
    assert len(out[5]) == 3 and len(set(out[5])) == 1
    assert all(s < 0 for _, s, _ in out[8])


def test_substrings(odd_docs):
    out = by_id(substring_dedup.repeated_spans(odd_docs), "n_bytes", "n_removed", "kept_sha256")
    none = hashlib.sha256(b"").hexdigest()
    assert out[0] == out[1] == [(0, 0, none)]
    assert all(n == gone and sha == none for n, gone, sha in out[5])
    assert out[10][0][1] == out[10][0][0] == 3000
    assert out[12] == [(1800, 1800, none)]


def test_near_duplicates(odd_docs):
    out = by_id(near_dedup.near_duplicates(odd_docs), "n_shingles", "component_id", "kept")
    assert out[0] == [(0, 0, True)] and out[3] == [(1, 3, True)]
    assert out[5] == [(116, 5, True)] * 3
    assert out[7] == [(117, 5, False)]
    assert out[None] == [(116, 5, False)]
    kept = near_dedup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None)
    assert ids == [0, 1, 2, 3, 4, 5, 5, 5, 6, 8, 9, 10, 11, 12, 13]


def test_lines(odd_docs):
    out = by_id(line_dedup.counted(odd_docs), "n_lines", "n_removed_lines")
    assert out[0] == [(0, 0)] and out[1] == [(1, 0)]
    cut = line_dedup.without_repeats(odd_docs)
    assert cut.columns == [*odd_docs.columns, "_cut"]
    assert cut.where("text IS NULL").count() == 1


def test_mixing(odd_docs):
    out = mixing.calibrated(odd_docs)
    assert out.count() == odd_docs.count()
    assert out.where("probability IS NULL OR kept IS NULL").count() == 0
    assert mixing.sample(odd_docs).columns == [*odd_docs.columns, "_topic", "_probability"]


def test_toxicity(spark, odd_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (8, 0), (9, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    out = by_id(toxicity.held_out_scores(odd_docs, labels), "score")
    assert len(out[0]) == 1 and out[0] == out[1] == out[2]
    assert out[5][0] == out[5][1] == out[5][2]
    one_kind = toxicity.held_out_scores(odd_docs, labels.where("toxic = 0"))
    assert {r.score for r in one_kind.collect()} == {0.0}


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (None, 0, "user", "q"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    rows = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "'own' AS formatted", "1 AS turns")
    made = chat.conversations_formatted(rows)
    back = {r.conv_id: chat.read_back(r.formatted, chat.Template()) for r in made.collect()}
    assert back == {1: [("user", ""), ("", "x")], None: [("user", "q")], 2: [("user", "a"), ("user", "a"), ("user", "b")]}
    assert {r.conv_id: r.n_turns for r in chat.digests(made).collect()} == {1: 2, None: 1, 2: 3}


def test_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (3, "u", "<p>Text" + " more text." * 30_000), (4, "u", "<<<>>> < & &#x41; <p"), (None, "u", "<div><p>Some text, here.</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' AS text")
    out = {r.page_id: r for r in html_text.extracted(pages).collect()}
    assert out[1].text == out[2].text == "" and out[2].n_chars == 0
    assert out[3].n_chars == 4 + 11 * 30_000 and out[None].text == "Some text, here."


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages(spark, odd_docs, small, name, step):
    out = step(spark, odd_docs, small)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert 0 < out.count() <= odd_docs.count()


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages_on_empty_tables(spark, odd_docs, small, name, step):
    assert step(spark, odd_docs.limit(0), small).count() == 0


def test_operators_on_empty_tables(spark, odd_docs, benchmark):
    docs = odd_docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert quality.judged(docs).count() == 0
    assert decontamination.overlaps(docs, benchmark).count() == 0
    assert decontamination.overlaps(odd_docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert backoff.scored(docs).count() == 0
    assert substring_dedup.repeated_spans(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert mixing.calibrated(docs).count() == 0
    assert toxicity.held_out_scores(docs, labels).count() == 0
    assert line_dedup.counted(docs).count() == 0
    rows = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.digests(chat.conversations_formatted(rows)).count() == 0
    assert html_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
