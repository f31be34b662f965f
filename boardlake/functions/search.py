"""Full-text search over token arrays: tokenisers, a stemmer, phrases, and predicates to combine with & | and ~.

A token is a run of letters and digits in lower case. The "simple" configuration keeps all of them. The "english" one puts
null in place of stop words, so distances stay, and stems the others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.functions.batches import in_pieces
from boardlake.functions.columns import let

TOKEN = r"[\p{L}\p{N}]+"
#: The Snowball project's list of English stop words; fixed values.
STOP_WORDS = frozenset("""i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own same so than too very s t can
will just don should now""".split())


def searched_text(subject: Column, body: Column) -> Column:
    """Subject and body as one stream, so a phrase may span both."""
    return F.concat(F.coalesce(subject, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def tokens_simple(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


#: Whole words of the stemmer's own, endings of its steps and what some become; fixed values.
SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
SPECIAL |= {w: w for w in ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")}
STEP_2 = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful", "lessli": "less"}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
ENDINGS_2, ENDINGS_3 = frozenset((*STEP_2, "ogi", "li")), frozenset((*STEP_3, "ative"))
ENDINGS_4 = frozenset(("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion"))
ENDINGS_EED, ENDINGS_ED, LONGEST = frozenset(("eed", "eedly")), frozenset(("ed", "edly", "ing", "ingly")), 7
SHORT = re.compile("[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$")
FIRST_Y, REGION_START, REGION = re.compile("^y|(?<=[aeiouy])y"), re.compile("gener|commun|arsen"), re.compile("[aeiouy][^aeiouy]")
VOWEL, VOWEL_BEFORE_LAST, DOUBLED, LAST_Y, BEFORE_LI = re.compile("[aeiouy]"), re.compile("[aeiouy]."), re.compile("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), re.compile("[^aeiouy][yY]$"), re.compile("[cdeghkmnrt]li$")
POSSESSIVE = re.compile("('s'|'s|')$")


def _ending(word: str, options: frozenset[str]) -> str | None:
    """The longest of the endings that the word has."""
    for k in range(LONGEST, 0, -1):
        if (e := word[-k:]) in options:
            return e
    return None


def stem(word: str) -> str:
    """The Porter2 ("Snowball English") stem of a lower-case word."""
    if len(word) <= 2:
        return word
    if word in SPECIAL:
        return SPECIAL[word]
    w = FIRST_Y.sub("Y", word.lstrip("'"))
    start = REGION_START.match(w)
    r1 = start.end() if start else (m.end() if (m := REGION.search(w)) else len(w))
    r2 = m.end() if (m := REGION.search(w, r1)) else len(w)
    w = POSSESSIVE.sub("", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and VOWEL_BEFORE_LAST.search(w[:-1]):
        w = w[:-1]
    if w in {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}:
        return w
    if e := _ending(w, ENDINGS_EED):
        if len(w) - len(e) >= r1:
            w = w[: -len(e)] + "ee"
    elif (e := _ending(w, ENDINGS_ED)) and VOWEL.search(w[: -len(e)]):
        w = w[: -len(e)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif DOUBLED.search(w):
            w = w[:-1]
        elif len(w) <= r1 and SHORT.search(w):
            w += "e"
    if LAST_Y.search(w) and len(w) > 2:
        w = w[:-1] + "i"
    if e := _ending(w, ENDINGS_2):
        if len(w) - len(e) >= r1:
            if e in STEP_2:
                w = w[: -len(e)] + STEP_2[e]
            elif e == "ogi" and w.endswith("logi"):
                w = w[:-1]
            elif e == "li" and BEFORE_LI.search(w):
                w = w[:-2]
    if e := _ending(w, ENDINGS_3):
        at = len(w) - len(e)
        if e == "ative":
            w = w[:at] if at >= r2 else w
        elif at >= r1:
            w = w[:at] + STEP_3[e]
    if e := _ending(w, ENDINGS_4):
        at = len(w) - len(e)
        if at >= r2 and (e != "ion" or w[:at].endswith(("s", "t"))):
            w = w[:at]
    if w.endswith("e"):
        if len(w) - 1 >= r2 or len(w) - 1 >= r1 and not SHORT.search(w[:-1]):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


#: Stems that a worker keeps.
KEPT_STEMS = 1 << 18


@lru_cache(KEPT_STEMS)
def english(word: str) -> str | None:
    """The stem of a lower-case word, None for a stop word."""
    return None if word in STOP_WORDS else stem(word)


def stems_of(tokens: pa.ListArray) -> pa.ListArray:
    """The stems of token lists: those of the different tokens, put where the tokens were. No token of a text becomes an object of its own."""
    offsets = tokens.offsets.to_numpy()
    coded = tokens.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    stems = pa.array([None if w is None else english(w) for w in coded.dictionary.to_pylist()], pa.string())
    return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), stems.take(coded.indices), mask=tokens.is_null() if tokens.null_count else None)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stems(tokens: pa.Array) -> pa.Array:
    return stems_of(tokens)


def tokens_english(text: Column) -> Column:
    """Stems in order, null for a stop word; each distinct token of a batch is stemmed once, a frequent one once for a worker."""
    return _stems(tokens_simple(text))


@dataclass(frozen=True)
class Config:
    """How query words become lexemes: None for a word that no text holds a lexeme for."""

    name: str

    def lexeme(self, word: str) -> str | None:
        word = word.lower()
        return word if self.name == "simple" else None if word in STOP_WORDS else stem(word)

    def tokens(self, text: Column) -> Column:
        return tokens_simple(text) if self.name == "simple" else tokens_english(text)


SIMPLE, ENGLISH = Config("simple"), Config("english")


def _holds(fits, want):
    return lambda t: F.coalesce(fits(t, want), F.lit(False))


def _chain(tokens: Column, lexemes: list[tuple[str, bool]], gaps: list[int]) -> Column:
    """Whether the lexemes (text, is prefix) stand one after the other at these distances."""
    fits = lambda have, want: have.startswith(want[0]) if want[1] else have == F.lit(want[0])
    every = F.lit(True)
    for want in lexemes:
        held = F.exists(tokens, _holds(fits, want)) if want[1] else F.coalesce(F.array_contains(tokens, want[0]), F.lit(False))
        every = every & held
    if len(lexemes) == 1:
        return every
    places = [sum(gaps[:k]) for k in range(len(lexemes))]

    def at(i: Column) -> Column:
        out = F.lit(True)
        for want, p in zip(lexemes, places, strict=True):
            out = out & F.coalesce(fits(F.get(tokens, i + p), want), F.lit(False))
        return out

    return F.when(every, F.exists(F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0))), at)).otherwise(F.lit(False))


def phrase_matches(tokens: Column, phrase: str, config: Config = SIMPLE) -> Column:
    """Whether the phrase's lexemes follow one another; stop words count as distance. A phrase with no lexeme matches nothing."""
    words = [config.lexeme(w) for w in re.findall(r"[^\W_]+", phrase.lower())]
    places = [(i, w) for i, w in enumerate(words) if w is not None]
    if not places:
        return F.lit(False)
    gaps = [b - a for (a, _), (b, _) in zip(places, places[1:], strict=False)]
    return let(tokens, lambda t: _chain(t, [(w, False) for _, w in places], gaps))


def phrase_pattern(phrase: str) -> str | None:
    """A pattern for lower-case texts that hold the phrase's words one after the other; None without a word. Tokens are runs of
    letters and digits, so words follow one another where only other characters are between them."""
    words = [re.escape(w) for w in re.findall(r"[^\W_]+", phrase.lower())]
    if not words:
        return None
    # the first word stands before the test of what comes before it, so places are found by the word and not tried one by one
    words[0] += rf"(?<![\p{{L}}\p{{N}}]{words[0]})"
    return r"[^\p{L}\p{N}]+".join(words) + r"(?![\p{L}\p{N}])"


def holds_phrase(text: Column, phrase: str, config: Config = SIMPLE) -> Column:
    """Whether a text holds the phrase. Unstemmed words need no tokens: one pattern decides."""
    if config.name != "simple":
        return phrase_matches(config.tokens(text), phrase, config)
    pattern = phrase_pattern(phrase)
    return F.lower(text).rlike(pattern) if pattern else F.lit(False)


class Terms:
    """Predicates over the tokens of a row; they are columns, to be combined with &, | and ~."""

    def __init__(self, tokens: Column, config: Config):
        self.tokens, self.config = tokens, config

    def _lexeme(self, word: str) -> str:
        lexeme = self.config.lexeme(word)
        if lexeme is None:
            raise ValueError(f"{word!r} is a stop word, which no text holds a lexeme for")
        return lexeme

    def word(self, word: str) -> Column:
        return _chain(self.tokens, [(self._lexeme(word), False)], [])

    def prefix(self, word: str) -> Column:
        return _chain(self.tokens, [(self._lexeme(word), True)], [])

    def follow(self, *words: str, gap: int = 1) -> Column:
        """Whether the words come one after the other, each `gap` tokens after the one before."""
        return _chain(self.tokens, [(self._lexeme(w), False) for w in words], [gap] * (len(words) - 1))

    def phrase(self, phrase: str) -> Column:
        return phrase_matches(self.tokens, phrase, self.config)


def matches(text: Column, where: Callable[[Terms], Column], config: Config = SIMPLE) -> Column:
    """Whether a text fulfils a condition over its terms, as `lambda t: t.word("a") & ~t.prefix("b")`; the text is tokenised once."""
    return let(config.tokens(text), lambda tokens: where(Terms(tokens, config)))


@dataclass(frozen=True)
class Follow:
    """Lexemes (text, is prefix) that stand one after the other at these distances; a single one stands anywhere."""

    lexemes: tuple[tuple[str, bool], ...]
    gaps: tuple[int, ...] = ()

    @classmethod
    def of(cls, words: list[str], config: Config, prefixes: list[bool] | None = None, gaps: list[int] | None = None) -> Follow | None:
        """Stop words count as distance; None if there is nothing else."""
        at, place, kept = 0, [], []
        for k, word in enumerate(words):
            at += (gaps[k - 1] if gaps else 1) if k else 0
            lexeme = config.lexeme(word)
            if lexeme is not None:
                kept.append((lexeme, bool(prefixes and prefixes[k])))
                place.append(at)
        return cls(tuple(kept), tuple(b - a for a, b in zip(place, place[1:], strict=False))) if kept else None

    def held(self, tokens: Column) -> Column:
        return _chain(tokens, list(self.lexemes), list(self.gaps))


@dataclass(frozen=True)
class Condition:
    """A boolean condition as SQL over `_leaf0`, `_leaf1`, ..., which tell whether a post holds each of the leaves."""

    leaves: tuple[Follow, ...]
    sql: str

    def holds_without_terms(self, spark: SparkSession) -> bool:
        """Whether a post that holds no leaf fulfils it."""
        none = spark.range(1).select(*[F.lit(False).alias(f"_leaf{k}") for k in range(len(self.leaves))])
        return none.select(F.expr(self.sql)).first()[0]

    def column(self, held: list[Column]) -> Column:
        """The condition over columns that tell whether each leaf is held; `sql` has only its own names, signs and parentheses."""
        signs = re.sub(r"\b(and|or|not)\b", lambda m: {"and": "&", "or": "|", "not": "~"}[m[1]], self.sql)
        return eval(signs, {}, {f"_leaf{k}": c for k, c in enumerate(held)})

    def holds(self, text: Column, config: Config) -> Column:
        """Whether a text fulfils it; the text is tokenised once."""
        return let(config.tokens(text), lambda t: self.column([leaf.held(t) for leaf in self.leaves]))


#: Signs of search conditions and what they are in SQL, which has them in the same order of precedence; fixed values.
SIGNS = {"&": "and", "|": "or", "!": "not", "(": "(", ")": ")"}
#: Words with their distances, and the other signs.
CONDITION = re.compile(r"\s*(?:([^\W_]+(?::\*)?(?:\s*<(?:-|\d+)>\s*[^\W_]+(?::\*)?)*)|([&|!()]))")


def condition(text: str, config: Config = SIMPLE) -> Condition:
    """A condition from text: words and beginnings of words (`cat:*`), `a <-> b` and `a <3> b` for distances between words, `!`, `&`, `|`
    and parentheses, binding in this order. The signs become SQL, which Spark reads.

    An error: other signs, two words without a sign between them, distances next to parentheses or after `!`, and stop words alone.
    """
    leaves, out, at, operand, depth = [], [], 0, False, 0
    while text[at:].strip():
        m = CONDITION.match(text, at)
        if not m:
            raise ValueError(f"{text[at:]!r} can't be read in the condition {text!r}")
        at, is_open = m.end(), m[2] in ("(", "!")
        if operand == bool(m[1] or is_open):
            raise ValueError(f"a sign or a word is missing before {m[0].strip()!r} in the condition {text!r}")
        if m[1]:
            words = re.findall(r"([^\W_]+)(:\*)?", re.sub(r"<(?:-|\d+)>", " ", m[1]))
            gaps = [1 if g == "-" else int(g) for g in re.findall(r"<(-|\d+)>", m[1])]
            if gaps and out and out[-1] == "not":
                raise ValueError(f"'!' before a distance in the condition {text!r}; put parentheses")
            leaf = Follow.of([w for w, _ in words], config, [bool(p) for _, p in words], gaps)
            if leaf is None:
                raise ValueError(f"{m[1]!r} holds stop words alone, which no text holds a lexeme for")
            out.append(f"_leaf{len(leaves)}")
            leaves.append(leaf)
        else:
            out.append(SIGNS[m[2]])
            depth += {"(": 1, ")": -1}.get(m[2], 0)
            if depth < 0:
                raise ValueError(f"a parenthesis is closed that is not open in the condition {text!r}")
        operand = bool(m[1]) or m[2] == ")"
    if not operand or depth:
        raise ValueError(f"the condition {text!r} is not complete")
    return Condition(tuple(leaves), " ".join(out))


INDEX = "site string, board string, term string, post_no long, positions array<int>"


def _invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each row with their positions, from token lists: all tokens of a piece are sorted by row and term at once."""
    for batch in (piece for whole in batches for piece in in_pieces(whole)):
        lists = batch.column("tokens").cast(pa.large_list(pa.large_string()))
        offsets = lists.offsets.to_numpy()
        values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        size = np.diff(offsets)
        row = np.repeat(np.arange(len(size)), size)
        at = (np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], size) + 1).astype(np.int32)
        coded = values.dictionary_encode()
        code = coded.indices.fill_null(-1).to_numpy().astype(np.int64)
        row, at, code = row[code >= 0], at[code >= 0], code[code >= 0]
        order = np.argsort(row << 32 | code, kind="stable")
        row, at, code = row[order], at[order], code[order]
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1]))) if len(row) else np.zeros(0, np.int64)
        own = pa.array(row[first])
        positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(at))
        yield pa.RecordBatch.from_arrays([batch.column("site").take(own), batch.column("board").take(own), coded.dictionary.take(pa.array(code[first])).cast(pa.string()), batch.column("post_no").take(own), positions], names=["site", "board", "term", "post_no", "positions"])


def inverted_index(posts: DataFrame, config: Config = SIMPLE) -> DataFrame:
    """(site, board, term, post_no, positions) of every term of every post, positions from 1. A post's terms are all in its row, so nothing is shuffled."""
    tokens = config.tokens(searched_text(F.col("subject"), F.col("body_text")))
    return posts.select("site", "board", F.col("post_no").cast("long").alias("post_no"), tokens.alias("tokens")).mapInArrow(_invert, INDEX)


@F.pandas_udf(T.StringType())
def _stem_of(terms: pd.Series) -> pd.Series:
    return terms.map(english)


def stemmed_index(simple: DataFrame) -> DataFrame:
    """The english index of the posts of a simple one, without their texts: each term of the vocabulary is stemmed once, and the
    positions of terms with one stem are merged."""
    stems = simple.select("term").distinct().select("term", _stem_of("term").alias("stem")).filter("stem is not null")
    rows = simple.join(stems, "term").groupBy("site", "board", F.col("stem").alias("term"), "post_no")
    return rows.agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
