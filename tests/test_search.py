"""Search: stems, phrases with and without tokens, predicates over terms, the stored index."""

import random
import re

import pytest
from pyspark.sql import functions as F

from boardlake.functions import search
from boardlake.operators import filters
from boardlake.plans.store import PostStore
from boardlake.plans.term_index import TermIndex

#: Pairs of the stemmer's published sample vocabulary; fixed values.
SAMPLE = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist
consistent consist consistently consist consisting consist consists consist consolation consol consolations consol consolatory consolatori
console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol
consolingly consol consols consol consonant conson consort consort consorted consort consorting consort conspicuous conspicu
conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir conspired conspir
conspiring conspir constable constabl constables constabl constance constanc constancy constanc constant constant
knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead
knee knee kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick
knif knif knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit knives knive
knob knob knobs knob knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock knopp knopp
knot knot knots knot""".split()
WORDS = "with the house houses of stone stones with, a not idiot trash the-x İx straße 12 c3po".split()
RNG = random.Random(5)
TEXTS = [" ".join(RNG.choice(WORDS) for _ in range(RNG.randint(0, 12))) for _ in range(150)] + [None, "", "With\nthe", "withthe", "with 1 the", "wİth the"]
ROWS = [("s", "b", i, f"{t[:4]}" if t and i % 3 == 0 else None, t) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(ROWS, "site string, board string, post_no long, subject string, body_text string").repartition(4)


def tokens(row, english=False):
    text = f"{row[3] or ''} {row[4] or ''}".lower()
    out = re.findall(r"[^\W_]+", re.sub("[^\\w]|̇", lambda m: m[0] if m[0] != "̇" else " ", text))
    return [None if w in search.STOP_WORDS else search.stem(w) for w in out] if english else out


def follows(have, want):
    return any(all(w is None or k + j < len(have) and have[k + j] == w for j, w in enumerate(want)) for k in range(len(have)))


def test_stems():
    for word, stem in zip(SAMPLE[::2], SAMPLE[1::2], strict=True):
        assert search.stem(word) == stem, word


@pytest.mark.parametrize("phrase", ["with the", "The", "the house", "12 c3po", "straße"])
def test_phrases(posts, phrase):
    want = {r[2] for r in ROWS if follows(tokens(r), phrase.lower().split())}
    assert want
    assert {r.post_no for r in filters.by_phrase(posts, phrase, search.SIMPLE).collect()} == want
    by_tokens = posts.filter(search.phrase_matches(search.tokens_simple(search.searched_text(F.col("subject"), F.col("body_text"))), phrase))
    assert {r.post_no for r in by_tokens.collect()} == want


def test_stemmed_phrases(posts):
    for phrase in ("houses of stone", "stone the house"):
        words = [None if w in search.STOP_WORDS else search.stem(w) for w in phrase.split()]
        want = {r[2] for r in ROWS if follows(tokens(r, True), words)}
        assert want
        assert {r.post_no for r in filters.by_phrase(posts, phrase).collect()} == want
    assert filters.by_phrase(posts, "of the").count() == 0
    assert filters.by_phrase(posts, "--", search.SIMPLE).count() == 0


def test_terms(posts):
    got = filters.by_terms(posts, lambda t: t.follow("with", "the") & ~t.word("idiot") | t.prefix("tra") | t.follow("house", "stone", gap=2), search.SIMPLE)
    keep = lambda t: follows(t, ["with", "the"]) and "idiot" not in t or any(w.startswith("tra") for w in t) or any(t[k] == "house" and t[k + 2] == "stone" for k in range(len(t) - 2))
    assert {r.post_no for r in got.collect()} == {r[2] for r in ROWS if keep(tokens(r))}
    with pytest.raises(ValueError):
        filters.by_terms(posts, lambda t: t.word("the"))


def test_index(spark, posts, tmp_path):
    for config in (search.SIMPLE, search.ENGLISH):
        index = TermIndex(spark, str(tmp_path / config.name), config).build(posts)
        rows = {(r.term, r.post_no): list(r.positions) for r in index.read().collect()}
        want = {}
        for r in ROWS:
            for at, t in enumerate(tokens(r, config.name == "english"), 1):
                if t is not None:
                    want.setdefault((t, r[2]), []).append(at)
        assert rows == want
        for phrase in ("with the", "house of stone", "trash", "of"):
            found = {r.post_no for r in PostStore(posts).search_index(index, phrase).collect()}
            assert found == {r.post_no for r in filters.by_phrase(posts, phrase, config).collect()}, phrase
        status = index.status().collect()
        assert sum(r.postings for r in status) == len(rows) and sum(r.terms for r in status) == len({t for t, _ in rows}) and all(r.bytes > 0 for r in status)
        index.drop()
        assert not (tmp_path / config.name).exists()


def random_condition(r, depth=0):
    words = ["with", "the", "house", "stone", "idiot", "trash", "x", "12", "nowhere", "st:*", "h:*", "zz:*"]
    kind = r.random()
    if depth > 2 or kind < 0.35:
        return r.choice(words)
    if kind < 0.5:
        return r.choice(words) + "".join(f" <{r.choice(['-', 1, 2, 3])}> {r.choice(words)}" for _ in range(r.randint(1, 2)))
    if kind < 0.65:
        return f"!({random_condition(r, depth + 1)})"
    return f"({random_condition(r, depth + 1)}) {r.choice('&|')} ({random_condition(r, depth + 1)})"


def plain_condition(text, have):
    """Python's own signs in place of the condition's, over the answers for its words."""

    def chain(m):
        words, gaps = re.findall(r"([a-z0-9]+)(:\*)?", re.sub("<[^>]*>", " ", m[0])), [1 if g == "-" else int(g) for g in re.findall(r"<(-|\d+)>", m[0])]
        at = [sum(gaps[:k]) for k in range(len(words))]
        fits = lambda t, w: t.startswith(w[0]) if w[1] else t == w[0]
        return str(any(all(k + a < len(have) and fits(have[k + a], w) for a, w in zip(at, words, strict=True)) for k in range(len(have))))

    text = re.sub(r"[a-z0-9]+(:\*)?( <[^>]*> [a-z0-9]+(:\*)?)*", chain, text)
    return eval(text.replace("&", " and ").replace("|", " or ").replace("!", " not "))


def test_conditions_by_scan_and_by_index(spark, posts, tmp_path):
    r = random.Random(9)
    index = TermIndex(spark, str(tmp_path / "i")).build(posts)
    for text in ["with & the | idiot", "!house", "st:* <2> house", "!(with | the)", *[random_condition(r) for _ in range(12)]]:
        want = {row[2] for row in ROWS if plain_condition(text, tokens(row))}
        assert {x.post_no for x in filters.by_condition(posts, text, search.SIMPLE).collect()} == want, text
        assert {x.post_no for x in index.find(text, posts).collect()} == want, text
    plan = index.postings(["house"], ["st"])._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(EqualTo(term,house),StringStartsWith(term,st))]" in plan


def test_conditions_that_cannot_be_read():
    for text in ("two words", "", "a &", "& a", "(a", "a)", "a) & (b", "()", "a <-> (b | c)", "!a <-> b", "a % b", "a !b", "a (b)"):
        with pytest.raises(ValueError):
            search.condition(text)
    with pytest.raises(ValueError):
        search.condition("a & the", search.ENGLISH)
    assert search.condition("houses <-> of <-> stones", search.ENGLISH).leaves == (search.Follow((("hous", False), ("stone", False)), (2,)),)


def test_stems_of_the_vocabulary(posts):
    rows = lambda df: sorted((r.term, r.post_no, tuple(r.positions)) for r in df.collect())
    assert rows(search.stemmed_index(search.inverted_index(posts))) == rows(search.inverted_index(posts, search.ENGLISH))


def test_store_with_an_index(spark, posts, tmp_path):
    rows = posts.selectExpr("*", "1 as thread_no", "cast(null as long) as ts_utc", "false as is_op")
    for config in (search.SIMPLE, search.ENGLISH):
        index = TermIndex(spark, str(tmp_path / config.name), config).build(rows)
        with_index, without = PostStore(rows, index=index), PostStore(rows)
        assert "regexp" not in with_index.search("house of stone", config=config)._jdf.queryExecution().toString()
        assert with_index.search("house of stone", config=config).collect() == without.search("house of stone", config=config).collect()
        assert {x.post_no for x in with_index.where("house & !stone", config).collect()} == {x.post_no for x in without.where("house & !stone", config).collect()}


def test_segments_are_merged_by_size(spark, posts, tmp_path, monkeypatch):
    from boardlake.plans import term_index

    monkeypatch.setattr(term_index, "PENDING", 6000)
    monkeypatch.setattr(term_index, "FANOUT", 3)
    index, written = TermIndex(spark, str(tmp_path / "i")), 0
    for k in range(7):
        before = {p for p, _ in index.segments}
        index = index.add(posts.filter(F.col("post_no") % 7 == k))
        written += sum(s for p, s in index.segments if p not in before)
        per_class = [index.size_class(s) for _, s in index.segments]
        assert all(per_class.count(c) < 3 for c in per_class)
    whole = TermIndex(spark, str(tmp_path / "w")).build(posts)
    rows = lambda i: sorted((r.term, r.post_no, tuple(r.positions)) for r in i.read().collect())
    assert rows(index) == rows(whole) == rows(TermIndex(spark, str(tmp_path / "i")))
    assert len(index.segments) < 7
    assert index.commits.sweep(["segments", "staged"], {p for p, _ in index.segments}) > 0
    assert rows(index) == rows(whole)
