import __spark_entry__ as entry
from boardlake.functions.search import stem
from boardlake.functions.times import parse_bound


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_bounds():
    assert parse_bound("2018-09", end=True) == 1538352000
    for wrong in ("2015-02-31", "2015-13", "x"):
        try:
            parse_bound(wrong)
        except ValueError:
            continue
        raise AssertionError(wrong)


def test_stems():
    assert [stem(w) for w in ("consistency", "knocking", "generous", "skies", "dying")] == ["consist", "knock", "generous", "sky", "die"]
