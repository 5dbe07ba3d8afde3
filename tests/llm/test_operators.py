"""Operators against brute force, exact round trips and held-out accuracy, on small made-up texts."""

import hashlib
import itertools
import random
import re
import string
import time
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import backoff, chat, components, html_text, line_dedup, mixing, near_dedup, quality, substring_dedup, toxicity
from tickloom.llm.queries import QUERIES
from tickloom.session import shared_folder

WORDS = [f"word{i}" for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def repeated_bytes(texts, length=200):
    """Removed byte ranges of every text, by comparing all strings of ``length`` bytes."""
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen.setdefault(t[s : s + length], []).append((i, s))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + length] = b"\x01" * length
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_repeated_strings_are_those_of_brute_force(spark, docs_of, seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randrange(20, 80)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 40)) for _ in range(3)]
        texts.append(" ".join(itertools.chain(*zip(parts, rng.choices(passages, k=3)))))
    texts += texts[:3] + ["ab" * 400, "x" * 199, "x" * 200, "äß" * 150, "y" * 700 + passages[0], " ".join(passages[:2] * 3)]
    for i in range(10):  # near copies
        words = texts[i].split()
        for k in rng.sample(range(len(words)), 3):
            words[k] = "edited"
        texts.append(" ".join(words))
    raw = [t.encode() for t in texts]
    gone = repeated_bytes(raw)
    got = {r.doc_id: r for r in substring_dedup.repeated_spans(docs_of(texts)).collect()}
    for i, (t, g) in enumerate(zip(raw, gone)):
        kept = bytes(b for b, x in zip(t, g) if not x)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\x01+", bytes(g))]
        assert [(s.start, s.stop) for s in got[i].spans] == spans, i
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest() and got[i].n_removed == sum(g)


def shingles(text, size=5):
    w = text.split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def smallest_ids(texts, percent):
    sets = [shingles(t) for t in texts]
    low = list(range(len(texts)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and 100 * common >= percent * len(sets[a] | sets[b]):
            p, q = find(a), find(b)
            low[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(texts))]


def edited(rng, text, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = rng.choice(WORDS)
    return " ".join(words)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_are_those_of_brute_force(docs_of, percent):
    rng = random.Random(percent)
    bases = [prose(rng, 120) for _ in range(20)]
    texts = list(bases)
    for base in bases:
        texts += [edited(rng, base, rng.randrange(0, 6)) for _ in range(rng.randrange(0, 8))]
    texts += ["alone", "alone", "", "a b c d", "a b c d e"]
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs_of(texts), near_dedup.Similarity(percent)).collect()}
    assert [got[i].component_id for i in range(len(texts))] == smallest_ids(texts, percent)
    assert [got[i].n_shingles for i in range(len(texts))] == [len(shingles(t)) for t in texts]


def test_a_crowd_of_near_copies_is_compared_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAF", 10)
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    monkeypatch.setattr(near_dedup, "LEVELS", 2)
    rng = random.Random(9)
    base = prose(rng, 150)
    texts = [edited(rng, base, rng.randrange(0, 9)) for _ in range(90)] + [prose(rng, 60) for _ in range(30)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_of(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == smallest_ids(texts, 85)


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    edges = chain + star + [(200, 201), (201, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {201: 200}


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(docs_of, order):
    rng = random.Random(order)
    few = WORDS[:12]
    texts = [" ".join(rng.choice(few) for _ in range(rng.randrange(0, 40))) for _ in range(50)]
    how = backoff.Backoff(order=order)
    count = {}
    for t in texts:
        w = t.split()
        for n in range(1, order + 1):
            for i in range(len(w) - n + 1):
                g = tuple(w[i : i + n])
                count[g] = count.get(g, 0) + 1
    total = sum(c for g, c in count.items() if len(g) == 1)

    def score(gram):
        if len(gram) == 1:
            return np.log(count[gram] / total)
        if count[gram] >= how.min_count:
            return np.log(count[gram] / count[gram[:-1]])
        return np.log(how.factor) + score(gram[1:])

    got = {r.doc_id: r for r in backoff.scored(docs_of(texts), how).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        want = sum(score(tuple(w[max(0, k - order + 1) : k + 1])) for k in range(len(w)))
        assert got[i].n_words == len(w) and got[i].log_score == pytest.approx(want, abs=1e-9)


def test_line_chunks_move_with_their_lines(docs_of):
    rng = random.Random(3)
    passage = [prose(rng, 8) for _ in range(40)]
    first = "\n".join(passage)
    shifted = "\n".join([prose(rng, 8), *passage, prose(rng, 8)])
    out = {r.doc_id: r for r in line_dedup.without_repeats(docs_of([first, shifted, prose(rng, 30)])).collect()}
    assert out[0].text == first and out[0].cut is None
    left = out[1].text.split("\n")
    assert len(left) < 15 and not set(left[6:-6]) & set(passage)


def test_passages_go_at_any_offset(docs_of):
    rng = random.Random(11)
    passages = [[prose(rng, 60 // n) for _ in range(n)] for n in (2, 3, 4, 5, 9) for _ in range(6)]
    own = iter(prose(rng, 12) for _ in range(9999))
    place = lambda p, before, after: [*itertools.islice(own, before), *p, *itertools.islice(own, after)]
    texts = [place(p, rng.randrange(4), rng.randrange(4)) for p in passages]
    texts += [place(p, i % 5, i % 3) for i, p in enumerate(passages)]
    out = {r.doc_id: r for r in line_dedup.without_repeats(docs_of(["\n".join(t) for t in texts])).collect()}
    n = len(passages)
    for i, p in enumerate(passages):
        assert out[i].text == "\n".join(texts[i]) and out[i].cut is None
        assert out[n + i].text == "\n".join(x for x in texts[n + i] if x not in p)


def plain_line_dedup(texts, min_words=50):
    """Texts without repeated lines, and the runs that are cut, compared by their bytes."""
    spans = []
    for d, text in enumerate(texts):
        lines = text.split("\n")
        h = [hashlib.md5(x.encode()).hexdigest() for x in lines]
        ends = [i for i in range(len(lines)) if hashlib.md5(((h[i - 1] if i else "") + h[i]).encode()).hexdigest()[0] <= "3" or i == len(h) - 1]
        chunks = {(a + 1, b) for a, b in zip([-1, *ends], ends) if b > a + 1}
        for a, b in chunks | {(i, i + 1) for i in range(len(lines) - 1)}:
            spans.append((d, a, b, (a, b) in chunks, "\n".join(lines[a : b + 1])))
    first = {}
    for d, a, _, _, body in sorted(spans):
        first.setdefault(body, (d, a))
    out = []
    for d, text in enumerate(texts):
        lines = text.split("\n")
        later = [s for s in spans if s[0] == d and (not s[4].split() or first[s[4]] != (d, s[1]))]
        gone = {i for _, a, b, chunk, body in later if chunk and body.split() for i in range(a, b + 1)}
        pairs = sorted(a for _, a, b, _, _ in later if b == a + 1)
        for _, run in itertools.groupby(enumerate(pairs), lambda x: x[1] - x[0]):
            run = [a for _, a in run]
            if len("\n".join(lines[run[0] : run[-1] + 2]).split()) > min_words:
                gone |= set(range(run[0], run[-1] + 2))
        starts = [i for i in sorted(gone) if i - 1 not in gone]
        cut = [(i, next(n for n in itertools.count(1) if i + n not in gone)) for i in starts]
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), cut or None))
    return out


def lines_at_random(seed):
    """Texts of few different lines, long, short and blank ones."""
    rng = random.Random(seed)
    known = ["", " ", *(prose(rng, rng.choice([1, 3, 20, 40])) for _ in range(25))]
    new = lambda: prose(rng, 15)
    some = lambda: [rng.choice(known) if rng.random() < 0.8 else new() for _ in range(rng.randrange(1, 12))]
    passages = [some() for _ in range(6)]
    return ["\n".join(x for _ in range(rng.randrange(1, 5)) for x in (rng.choice(passages) if rng.random() < 0.6 else some())) for _ in range(60)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_is_that_of_brute_force(docs_of, seed):
    texts = lines_at_random(seed)
    out = {r.doc_id: (r.text, r.cut and [tuple(c) for c in r.cut]) for r in line_dedup.without_repeats(docs_of(texts)).collect()}
    want = plain_line_dedup(texts)
    assert [out[i] for i in range(len(texts))] == want and sum(cut is not None for _, cut in want) > 20


def test_equal_names_of_other_lines_remove_nothing(docs_of, monkeypatch):
    texts = lines_at_random(4)
    asked = []

    def weak(data):
        asked.append(1)
        return F.lpad(F.hex(F.length(data) % 3), 32, "0")

    monkeypatch.setattr(line_dedup, "NAMES", (weak, line_dedup.sha256))
    out = {r.doc_id: r.text for r in line_dedup.without_repeats(docs_of(texts)).collect()}
    assert asked and [out[i] for i in range(len(texts))] == [t for t, _ in plain_line_dedup(texts)]


def test_line_step_is_that_of_brute_force(spark, docs_of):
    texts = [*lines_at_random(5), *["\n".join(["all of this is " * 20, "a copy"])] * 2, "", " "]
    docs = docs_of([*texts, None]).withColumn("n_chars", F.lit(-1).cast("long"))
    out = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_chunks(spark, docs, "").collect()}
    want = {i: (text, len(text) if cut else -1) for i, (text, cut) in enumerate(plain_line_dedup(texts)) if not cut or text.strip()}
    assert out == want | {len(texts): (None, -1)}
    assert set(range(len(texts))) - set(want) and {n for _, n in want.values()} > {-1}


def test_line_step_stores_every_text_once(spark, docs_of):
    rng = random.Random(6)
    line = lambda: "".join(rng.choices(string.ascii_letters, k=1000))
    own = [[line() for _ in range(rng.randrange(2, 9))] for _ in range(200)]
    texts = ["\n".join([*a, *rng.choice(own)]) for a in own]
    stored = lambda: sum(p.stat().st_size for p in Path(shared_folder(spark)).rglob("*.parquet"))
    before = stored()
    assert corpus_pipeline.line_chunks(spark, docs_of(texts), "").count() > 100
    assert sum(map(len, texts)) < stored() - before < 1.3 * sum(map(len, texts))


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame(
        [(s, g, t, float(100 + 37 * (i % 7))) for i, (s, g, t) in enumerate(itertools.product("abc", ("en", "de"), ("x", "y")))],
        "source string, lang string, topic string, tokens double",
    )
    shares = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.5, "y": 0.5}}
    targets = {d: spark.createDataFrame(list(v.items()), "value string, share double") for d, v in shares.items()}
    rows = mixing.raked(cells, targets, rounds=8).join(cells, ["source", "lang", "topic"]).collect()
    weight = sum(r.tokens * r.probability for r in rows)
    for d, want in shares.items():
        for value, share in want.items():
            assert sum(r.tokens * r.probability for r in rows if r[d] == value) / weight == pytest.approx(share, abs=1e-3)
    assert max(r.probability for r in rows) == 1.0


@pytest.mark.parametrize("total", [0.1, 0.9])
def test_a_rare_cell_does_not_shrink_the_sample(spark, total):
    cells = [(s, g, t, 1e6 + 1e5 * i) for i, (s, g, t) in enumerate(itertools.product("abc", ("en", "de"), ("x", "y")))]
    cells += [("rare", "xx", "z", 10.0), ("a", "none", "x", 0.0)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    rows = mixing.raked(table, total=total).join(table, ["source", "lang", "topic"]).collect()
    everything = sum(r.tokens for r in rows)
    assert len(rows) == len(cells) and all(0 < r.probability <= 1 for r in rows)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(total * everything, rel=1e-4)
    assert all(r.probability == 1.0 for r in rows if r.source == "rare" or r.tokens == 0)
    if total == 0.1:  # with room to the tokens of every other cell, the targets are met
        powers = {s: sum(r.tokens for r in rows if r.source == s) ** mixing.TEMPER["source"] for s in "abc"}
        drawn = {s: sum(r.tokens * r.probability for r in rows if r.source == s) for s in "abc"}
        for s in "abc":
            assert drawn[s] / sum(drawn.values()) == pytest.approx(powers[s] / sum(powers.values()), abs=1e-3)


def test_cascade_asks_the_best_rule_first(spark, docs_of):
    docs = docs_of(["a " * 60] * 20 + [prose(random.Random(1), 80)] * 20)
    measured = quality.measure(docs, quality.BASE_RULES + quality.METHOD_RULES)
    assert [m.gain for m in measured] == sorted((m.gain for m in measured), reverse=True)
    assert measured[0].rule.name == "repeated_words"
    plan = docs.select(quality.cascade(quality.OfText(docs["text"]), measured))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    out = QUERIES["op8_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


TEXTS = st.text(alphabet=st.sampled_from(list("\\#</turn>\n: ARole-x é")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant"]), TEXTS), TEXTS), max_size=6))
def test_chat_round_trip(turns):
    template = chat.Template()
    text, spans = chat.formatted(turns, template)
    assert chat.read_back(text, template) == turns
    assert chat.unescaped("".join(text[a:b] for a, b in spans), template) == "".join(t for r, t in turns if r == "assistant")


def test_turn_order():
    assert chat.order_error(["system", "user", "assistant"]) is None
    assert chat.order_error(["user", "user"]) == "turn 1: user after asked"
    assert chat.order_error(["assistant"]) == "turn 0: assistant after start"
    assert chat.order_error(["system"]) == "ends in open"


ARTICLE = [
    "The first paragraph has several sentences. It goes on, and on, until it ends.",
    "A second one follows; it is long enough to look like prose, with commas.",
    "Short one.",
    "The last paragraph closes the article. Nothing else belongs to it.",
]
NOISE = {
    "nav": "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About us, all of us</a></li></ul></nav>",
    "header": "<header><div>Site name, since 1990.</div></header>",
    "footer": "<footer><p>Copyright. All rights reserved, by us, for us.</p></footer>",
    "aside": "<aside><p>Related: another story, with a long teaser text. Read it now.</p></aside>",
    "sidebar": "<div class='sidebar'><p>Most read, this week. One, two, three.</p></div>",
    "ad": '<div class="ad">Buy now, pay later. It is cheap.</div>',
    "notice": "<div id='cookie-notice'><p>We use cookies, as all do. Accept them.</p></div>",
    "form": "<form><label>Name, please.</label><input><textarea>Type here.</textarea><button>Send</button></form>",
    "script": "<script>var s = '</p><p>no text</p>'; if (a < b) c();</script><style>p > a {color: red}</style>",
    "comment": "<!-- <p>hidden text, in a comment.</p> -->",
    "comments": "<section class='comments'><p>Great article, thanks. I liked it, a lot.</p></section>",
}


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div>{}</div>", "{}"])
@pytest.mark.parametrize("close", ["</p>", ""])
def test_article_without_its_surroundings(wrap, close):
    body = "".join(f"<p>{p}{close}" for p in ARTICLE)
    before = "".join(NOISE[k] for k in ("nav", "header", "ad", "script", "notice"))
    after = "".join(NOISE[k] for k in ("aside", "sidebar", "form", "comments", "comment", "footer"))
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{before}{wrap.format(body)}{after}</body></html>"
    assert html_text.main_text(page).split("\n") == ARTICLE


@pytest.mark.parametrize("inside", ["comments", "ad", "aside", "form", "script", "comment"])
def test_noise_inside_the_article(inside):
    body = f"<h1>Heading</h1><p>{ARTICLE[0]}</p>{NOISE[inside]}<p>{ARTICLE[1]}<br>next&nbsp;line &amp; &lt;b&gt;</p>"
    want = ["Heading", ARTICLE[0], f"{ARTICLE[1]} next line & <b>"]
    assert html_text.main_text(f"<html><body><article>{body}</article></body></html>").split("\n") == want


@pytest.mark.parametrize(
    "wrap",
    [
        "<main class='content with-sidebar'>{}</main>",
        "<div class='has-sidebar'>{}</div>",
        "<div class='has-sidebar'><div>{}</div></div>",
        "<article class='post category-social'>{}</article>",
        "<main><article class='post category-legal'>{}</article></main>",
        "<div class='promo-page'><article class='category-alert'>{}</article></div>",
        "<article><div class='widget-text'>{}</div></article>",
        "<div class='content-date'></div><div class='no-sidebar'>{}</div>",
    ],
)
def test_names_do_not_drop_the_article(wrap):
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    before = "".join(NOISE[k] for k in ("nav", "header", "ad", "notice"))
    after = "".join(NOISE[k] for k in ("aside", "sidebar", "comments", "footer"))
    page = f"<html><body>{before}{wrap.format(body)}{after}</body></html>"
    assert html_text.main_text(page).split("\n") == ARTICLE


@pytest.mark.parametrize(
    "wrap",
    [
        "<article><div class='content'>{}</div><section>{}</section></article>",
        "<article><section>{}</section><div class='content'>{}</div></article>",
        "<main><article class='post'>{}</article><div>{}</div></main>",
        "<div><div class='content'>{}</div><section>{}</section></div>",
        "<main><article class='a'><div class='content'>{}</div></article><article class='b'>{}</article></main>",
    ],
)
@pytest.mark.parametrize("first", [1, 2, 3, 6, 8, 9])
def test_parts_of_an_article_outside_its_largest_container(wrap, first):
    said = [f"Paragraph {i} has several sentences, with commas. It goes on, and on, until it ends." for i in range(10)]
    parts = ["".join(f"<p>{p}</p>" for p in x) for x in (said[:first], said[first:])]
    page = f"<html><body>{NOISE['nav']}{wrap.format(*parts)}{NOISE['footer']}</body></html>"
    assert html_text.main_text(page).split("\n") == said


@pytest.mark.parametrize("mark", ['"', "'"])
def test_long_quoted_values(mark):
    inner = ("<p class=~ad~ hidden> a > b, it says. </p>" * 2500).replace("~", "'" if mark == '"' else '"')
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    hidden = f"<div data-x={mark}{inner}{mark} class='comments'><p>Great article, thanks.</p></div>"
    page = f"<html><body><article data-x={mark}{inner}{mark} class='post'>{body}{hidden}</article></body></html>"
    assert len(inner) > 100_000 and html_text.main_text(page).split("\n") == ARTICLE


@pytest.mark.parametrize("tag", ['<p class="x>', "<p class='x>", '<p title="a"">', "<p it's>", '<p title="">', "<p data-x=a=b title='c='>"])
def test_quotes_without_a_partner_take_no_text(tag):
    body = "".join(f"{tag}{p} <a href='/x' class=\"y\">Link</a></p>" for p in ARTICLE)
    assert html_text.main_text(f"<article>{body}</article>").split("\n") == [f"{p} Link" for p in ARTICLE]


HIDDEN = ['<span style="display: none">{}</span>', "<span hidden>{}</span>", "<b aria-hidden=true>{}<b>{}</b></b>", "<script>{}</script>",
          "<svg><path d='M0'/><text>{}</text></svg>", "<noscript><p>{}</p></noscript>", "<button>{}</button>"]


def page_at_random(seed):
    """An article with its text, from parts that are known to be shown or not."""
    rng = random.Random(seed)

    def inline():
        shown, source = [], []
        for _ in range(rng.randrange(2, 6)):
            words = prose(rng, rng.randrange(4, 14)) + ", and."
            shown.append(words)
            tag = rng.choice(["b", "em", "a", "span", "code"])
            source.append(words if rng.random() < 0.5 else f"<{tag} class='x'>{words}</{tag}>")
            if rng.random() < 0.4:
                source.append(rng.choice(HIDDEN).replace("{}", "never shown"))
            if rng.random() < 0.2:
                shown.append("x=2")
                source.append("<math><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></math>")
        return " ".join(shown), " \n".join(source)

    def blocks(depth):
        shown, source = [], []
        for _ in range(rng.randrange(2, 5)):
            text, html = inline()
            kind = rng.randrange(6 if depth < 4 else 4)
            if kind < 3:
                close = "</p>" if rng.random() < 0.7 else ""
                shown, source = [*shown, text], [*source, f"<p>{html}{close}"]
            elif kind == 3:
                shown, source = [*shown, text], [*source, f"<ul><li>{html}</ul>"]
            else:
                texts, inner = blocks(depth + 1)
                tag = ("div", "fieldset")[kind - 4]
                shown, source = [*shown, *texts], [*source, f"<{tag}>{inner}</{tag}>"]
            if rng.random() < 0.3:
                inside = source[-1].startswith("<p>") and not source[-1].endswith("</p>")
                source.append(rng.choice([NOISE["ad"], NOISE["script"], NOISE["comment"], "" if inside else "<span class='ad'>Buy, now.</span>"]))
        return shown, "\n".join(source)

    shown, source = blocks(0)
    around = [NOISE[k] for k in ("nav", "header", "notice", "sidebar", "footer")]
    return "\n".join(shown), f"<html><body>{''.join(around[:3])}<article>{source}</article>{''.join(around[3:])}</body></html>"


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages(seed):
    want, page = page_at_random(seed)
    assert html_text.main_text(page) == want


@pytest.mark.parametrize(
    "page",
    ["<div>" * 75_000 + "a, b.", "<div>" * 20_000 + "</p>" * 50_000 + "a, b.", "<x>" * 20_000 + "<p>a, b." * 20_000,
     "<article class=ad>" * 20_000 + "a, b.", "<li>" * 20_000 + "<div>a, b." * 20_000, "<span hidden>" * 20_000 + "</span>" * 20_000 + "a, b."],
)
def test_deep_pages_take_linear_time(page):
    started = time.process_time()
    assert html_text.main_text(page).endswith("a, b.")
    assert time.process_time() - started < 3


def test_many_comments_beside_the_article_go():
    said = "<article class='comment'><p>Great article, thanks. I liked it, a lot, as always.</p></article>" * 40
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    page = f"<html><body><main><article>{body}</article><section class='comments'>{said}</section></main></body></html>"
    assert html_text.main_text(page).split("\n") == ARTICLE


def test_quality_measures_are_those_of_plain_python(docs_of):
    rng = random.Random(4)
    texts = ["\n".join(prose(rng, rng.randrange(0, 6)) for _ in range(12)) + rng.choice(["", " a b a b a b", " x" * 9, "#$%"]) for _ in range(40)]
    got = {r.doc_id: r for r in quality.judged(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        marked = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if x.strip()]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(marked))
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == want


def test_a_tiny_cell_does_not_shrink_the_sample(spark):
    rows = [("web", "en", "prose", 1e13), ("rare", "en", "prose", 1.0), ("web", "xx", "prose", 3.0), ("web", "en", "links", 10.0), ("rare", "xx", "links", 2.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    for total in (0.05, mixing.TOTAL, 0.95):
        chances = {(r.source, r.lang, r.topic): r.probability for r in mixing.raked(cells, total=total).collect()}
        assert chances["web", "en", "prose"] == pytest.approx(total, abs=2e-6)
        assert all(0 < p <= 1 for p in chances.values())
