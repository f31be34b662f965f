"""Queries over all rows and whole texts, on small tables against brute force."""

import random
from datetime import date

import pytest

from boardlake.functions import texts
from boardlake.plans import catalog

COMMON = "the same sixty characters at the head of every neighbouring post, "
TEXTS = [COMMON + "kitten", COMMON + "sitting", "déjà vu", "dèjá vu", "", None, "日本語", "日本", "x" * 3000 + "a", "y" + "x" * 2990, "😀a", "a😀", *[f"post {k}" for k in range(60)]]
YEARS = [2001, 2001, 2005]


def matrix(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    docs = [(i, t, "es" if i % 3 else "fr", f"src{i % 4}") for i, t in enumerate(TEXTS)]
    orders = [(i, date(YEARS[i % 3], 1 + i % 12, 5)) for i in range(len(TEXTS)) if i % 5]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate date").write.parquet(f"file://{folder}/orders.parquet")
    return f"file://{folder}", docs, dict(orders)


def test_levenshtein_of_whole_texts(spark, tables):
    folder, docs, _ = tables
    got = {r.post_no: r.distance for r in catalog.QUERIES["levenshtein_text"](spark, folder).collect()}
    want = {i: None if t is None or docs[i + 1][1] is None else matrix(t, docs[i + 1][1]) for i, t, *_ in docs[:-1]}
    assert got == want
    assert got[0] == 3 and got[2] == 2


def test_edit_distance():
    r = random.Random(3)
    for _ in range(300):
        a, b = ("".join(r.choice("abé日") for _ in range(r.choice((0, 1, 5, 63, 64, 65, 130)))) for _ in range(2))
        assert texts.edit_distance(a, b) == matrix(a, b)


def test_years_of_all_posts_of_a_board(spark, tables):
    folder, docs, dates = tables
    years = [dates[i].year for i, _, board, _ in docs if board == "es" and i % 17 and i in dates]
    got = [(r.year, r.posts) for r in catalog.QUERIES["posts_by_year_board_filled"](spark, folder).collect()]
    assert sorted(got) == [(y, years.count(y)) for y in range(min(years), max(years) + 1)]
    assert 0 in dict(got).values() and sum(dict(got).values()) == len(years)
