"""Quality rules: base counts, then robust multivariate outliers by minimum covariance determinant (MCD).

Everything is DataFrame functions. Each text that passes the base gives a vector of five transformed statistics: logs of
the number of words and of their mean length, and variance-stabilised rates of symbols, repeated lines and repeated
windows. Counts are mostly nought, so each is jittered within its unit by a hash of the text: a whole number c becomes
c + u with u from 0 to 1, which gives it a density, and the estimates need no floor set by hand.

For every language and source the estimate is the subset of 75 % of the rows whose scatter has the least determinant. It
is searched from three starts (median and median deviation; the same with the correlation of tanh scores; the same with
the spatial sign correlation) by concentration steps: keep the nearest 75 %, take their mean and covariance, repeat. After
`TRIES` steps the start with the least determinant goes on until its determinant no longer falls. The rows within the
97.5 % ellipsoid then give the final, reweighted estimate. A row is rejected if its squared Mahalanobis distance is over
`CUTOFF`. A step is one pass: each bin of an exact histogram of the distances holds the sums of its rows, so what is nearest
and its moments are read off the merged bins, no group is ever gathered in a task, and every sum is a partial aggregation.

Small groups follow the same rule as large ones (a regularised MCD): mean and scatter of a source are mixed with those of
its language, which count as much as `PRIOR` rows, and those of a language with its medians and median deviations, as
much as `LANGUAGE_PRIOR` rows. So a source with one row is judged by its language, and a language with one row rejects
nothing.

Defined results: a null or empty text has no words and fails the base. Null lang and source are a value of their own.
Repeated rows count as rows, an empty table gives an empty result, other columns are kept by `judge_quality`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, table, words_of, written

SYMBOLS = "#*$%&|<>"
SHARE = 0.75
#: Steps of all starts, most steps of the best one, and the fall of the log determinant that counts as none.
TRIES, STEPS, SETTLED = 2, 10, 1e-3
#: Most files of a table with a row for each group.
FILES = 8
#: Chi-square with 5 degrees of freedom at 0.975 and at one in a million, and the factors that make the scatter of the nearest 75 % and 97.5 % consistent under normality.
INNER, CUTOFF = 12.83, 35.89
FACTOR, INNER_FACTOR = 1.412, 1.055
PRIOR, LANGUAGE_PRIOR = 20.0, 5.0
#: Least deviation, against division by nought where all rows of a language are equal.
TINY = 1e-3
X = [f"_x{i}" for i in range(5)]
PAIRS = [(i, j) for i in range(5) for j in range(i + 1)]
GROUP = ["_lang", "_source"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: Column, n: int = 5) -> Column:
    """How many words lie in a window of n words that the text has twice or more."""

    def heavy(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda k, d: F.coalesce(F.get(s, k)["h"] == F.get(s, k + d)["h"], F.lit(False))
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, -1) | same(k, 1))
            return F.sort_array(F.transform(at, lambda k: F.get(s, k)["i"]))

        start = F.struct(F.lit(-n).alias("last"), F.lit(0).alias("covered"))
        return F.aggregate(let(pairs, twice), start, lambda a, i: F.struct(i.alias("last"), (a["covered"] + F.least(F.lit(n), i - a["last"])).alias("covered")), lambda a: a["covered"])

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) < n + 1, 0).otherwise(let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(heavy(h))))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts, base_failed and the vector of transformed statistics."""
    body = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.length(F.translate(body, chars, ""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    per_line = let(lines, lambda x: F.struct(F.size(x).alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    per_word = let(words_of(F.col(text)), lambda w: F.struct(F.size(w).alias("words"), repeated_words(w).alias("repeat")))
    out = docs.withColumns({"_w": per_word, "_l": per_line, "_plain": without(" \t\n\x0b\x0c\r"), "_unmarked": without(SYMBOLS), "_len": F.length(body)})
    out = out.withColumns({"n_words": F.col("_w.words").cast("long"), "word_chars": F.col("_plain").cast("long"), "n_symbols": (F.col("_len") - F.col("_unmarked")).cast("long"), "n_dup_lines": F.col("_l.dup").cast("long"), "n_repeat_words": F.col("_w.repeat").cast("long"), "_lines": F.col("_l.lines")})
    n, chars = F.col("n_words"), F.col("word_chars")
    jitter = lambda k: F.shiftrightunsigned(F.xxhash64(F.lit(k), body), 11) / F.lit(2.0**53)
    rate = lambda count, k, per: 2 * F.sqrt((count + jitter(k)) / (1 + per))
    return out.withColumns({
        "base_failed": (n < 10) | (100 * F.col("n_repeat_words") > 20 * n),
        "_lang": F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")), "_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "_x0": F.log(n + 1), "_x1": F.log((chars + 250) / (n + 50)), "_x2": rate(F.col("n_symbols"), 1, n / 200),
        "_x3": rate(F.col("n_dup_lines"), 2, F.col("_lines") / 10), "_x4": rate(F.col("n_repeat_words") / 5, 3, n / 200),
    }).drop("_w", "_l", "_plain", "_unmarked", "_len", "_lines")


def _less(start: str, terms: list[str]) -> str:
    return " - ".join([start, *terms])


#: The Cholesky factor _c of _s, its inverse _v, and the log determinant of _s, each from those before it.
FACTOR_SQL = [f"sqrt({_less(f'_s{j}{j}', [f'_c{j}{k} * _c{j}{k}' for k in range(j)])}) as _c{j}{j}" if i == j else f"({_less(f'_s{i}{j}', [f'_c{i}{k} * _c{j}{k}' for k in range(j)])}) / _c{j}{j} as _c{i}{j}" for j in range(5) for i in range(j, 5)]
INVERSE_SQL = [f"({_less('1D' if i == j else '0D', [f'_c{i}{k} * _v{k}{j}' for k in range(j, i)])}) / _c{i}{i} as _v{i}{j}" for j in range(5) for i in range(j, 5)]
LOGDET_SQL = " + ".join(f"2 * ln(_c{i}{i})" for i in range(5)) + " as _logdet"
#: Squared Mahalanobis distance of a row that is joined with its estimate.
DISTANCE_SQL = " + ".join("power(" + " + ".join(f"_v{i}{j} * (_x{j} - _m{j})" for j in range(i + 1)) + ", 2)" for i in range(5))
#: Sums of a set of rows, about the medians _o of their group.
SUMS = ["_n", *[f"_a{i}" for i in range(5)], *[f"_q{i}{j}" for i, j in PAIRS]]
SUMS_SQL = ["count(*) as _n", *[f"sum(_x{i} - _o{i}) as _a{i}" for i in range(5)], *[f"sum((_x{i} - _o{i}) * (_x{j} - _o{j})) as _q{i}{j}" for i, j in PAIRS]]


def inverse_factor(out: DataFrame) -> DataFrame:
    """The estimates of groups: _m, _v00 .. _v44, the inverse of the Cholesky factor of _s00 .. _s44, and _logdet, the log determinant of the latter. No other columns, for they travel to all rows."""
    return out.selectExpr("*", *FACTOR_SQL, *INVERSE_SQL, LOGDET_SQL).select("_g", "_s", "_total", "_logdet", *[f"_{k}{i}" for k in "om" for i in range(5)], *[f"_v{i}{j}" for i, j in PAIRS])


def distance() -> Column:
    return F.expr(DISTANCE_SQL)


#: What is fixed for each group: its size, medians, and the mean, scatter and weight (in rows) that its estimate is mixed with.
FRAME = ["_g", "_total", "_prior", *[f"_o{i}" for i in range(5)], *[f"_u{i}" for i in range(5)], *[f"_t{i}{j}" for i, j in PAIRS]]


def sums_of_rows() -> list[Column]:
    return [F.expr(x) for x in SUMS_SQL]


def estimate(sums: DataFrame, frame: DataFrame, factor: float, how: str = "left") -> DataFrame:
    """The estimates of groups from the sums over their nearest rows, mixed with what frame says; groups without sums get the latter alone."""
    own, other = "coalesce(_n / (_n + _prior), 0D)", "(1 - coalesce(_n / (_n + _prior), 0D))"
    mean = [f"coalesce({own} * (_o{i} + _a{i} / _n), 0D) + {other} * _u{i} as _m{i}" for i in range(5)]
    scatter = [f"coalesce({own} * {factor}D * (_q{i}{j} / _n - _a{i} / _n * _a{j} / _n), 0D) + {other} * _t{i}{j} as _s{i}{j}" for i, j in PAIRS]
    return inverse_factor(frame.join(sums, "_g", how).selectExpr(*FRAME, "coalesce(_s, 0) as _s", *mean, *scatter))


def spread(rows: DataFrame, medians: DataFrame) -> DataFrame:
    """medians with the median deviations _d of each group."""
    deviation = [F.percentile_approx(F.abs(F.col(x) - F.col(f"_o{i}")), 0.5, 10000).alias(f"_d{i}") for i, x in enumerate(X)]
    return medians.join(rows.join(medians, "_g").groupBy("_g").agg(*deviation), "_g").withColumns({f"_d{i}": F.greatest(F.col(f"_d{i}") * 1.4826, F.lit(TINY)) for i in range(5)})


def starts(rows: DataFrame, frame: DataFrame) -> DataFrame:
    """The three first estimates of each group, by _s."""
    scales = frame.select("_g", *[f"_{k}{i}" for k in "od" for i in range(5)])
    z = [f"(_x{i} - _o{i}) / _d{i} as _z{i}" for i in range(5)]
    scored = rows.join(scales, "_g").selectExpr("_g", *[f"_d{i}" for i in range(5)], *z, " + ".join(f"_z{i} * _z{i}" for i in range(5)) + " + 1e-12 as _norm")
    per = scored.groupBy("_g", *[f"_d{i}" for i in range(5)]).agg(*[F.expr(f"covar_pop(tanh(_z{i}), tanh(_z{j})) as _tanh{i}{j}") for i, j in PAIRS], *[F.expr(f"5 * avg(_z{i} * _z{j} / _norm) as _sign{i}{j}") for i, j in PAIRS])
    own, other = "_total / (_total + _prior)", "_prior / (_total + _prior)"
    kind = lambda s, i, j: ("1D" if i == j else "0D", f"_tanh{i}{j}", f"_sign{i}{j}")[s]
    one = [f"named_struct('_s', {s}, " + ", ".join(f"'_s{i}{j}', {own} * {kind(s, i, j)} * _d{i} * _d{j} + {other} * _t{i}{j}" for i, j in PAIRS) + ")" for s in range(3)]
    out = per.join(frame.select(*FRAME), "_g").selectExpr(*FRAME, *[f"_o{i} as _m{i}" for i in range(5)], f"inline(array({', '.join(one)}))")
    return inverse_factor(out)


def few(df: DataFrame, name: str) -> DataFrame:
    """Writes a table of a row for each group in at most FILES files: in as many as there are shuffle partitions, the files' own heads would make it too large to be broadcast, and all rows would be shuffled instead."""
    return written(df.coalesce(FILES), name)


def concentrate(rows: DataFrame, estimates: DataFrame, frame: DataFrame) -> DataFrame:
    """One concentration step of all estimates: those of the nearest SHARE of the rows of each. Not written yet; dealt by _g."""
    binned = rows.join(estimates, "_g").withColumn("_bin", F.floor(F.log1p(distance()) * 64))
    bins = binned.groupBy("_g", "_s", "_bin").agg(F.first("_total").alias("_total"), *sums_of_rows()).repartition("_g")
    before = F.sum("_n").over(Window.partitionBy("_g", "_s").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    nearest = bins.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < SHARE * F.col("_total"))
    return estimate(nearest.groupBy("_g", "_s").agg(*[F.sum(c).alias(c) for c in SUMS]), frame, FACTOR, "inner")  # each estimate has a first bin


def least_determinant(estimates: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("_g").orderBy("_logdet", "_s"))
    return estimates.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def better(best: DataFrame, now: DataFrame) -> DataFrame:
    """For each group that of both estimates with the lesser determinant, null before all numbers as in least_determinant, and by how much it fell."""
    both = now.select("_g", F.struct("*").alias("_new")).join(best.select("_g", F.struct("*").alias("_old")), "_g")
    new, old = F.col("_new._logdet"), F.col("_old._logdet")
    return both.select(F.when(new.isNull() | (new < old), F.col("_new")).otherwise(F.col("_old")).alias("_e"), (old - new).alias("_fall")).select("_e.*", "_fall")


def fit_level(rows: DataFrame, prior: DataFrame | None) -> DataFrame:
    """The estimates (_g, _m, _v and the scatter's factors) of the groups _g of rows; prior: for each _g the columns _u, _t that they are mixed with, else their medians and deviations. Written, a row for each group."""
    medians = rows.groupBy("_g").agg(F.count("*").alias("_total"), *[F.percentile_approx(x, 0.5, 10000).alias(f"_o{i}") for i, x in enumerate(X)])
    frame = spread(rows, few(medians, "mcd-medians"))
    if prior is None:
        own = {f"_t{i}{j}": F.col(f"_d{i}") * F.col(f"_d{j}") if i == j else F.lit(0.0) for i, j in PAIRS}
        frame = frame.withColumns({"_prior": F.lit(LANGUAGE_PRIOR), **{f"_u{i}": F.col(f"_o{i}") for i in range(5)}, **own})
    else:
        frame = frame.join(prior, "_g").withColumn("_prior", F.lit(PRIOR))
    frame = few(frame.select(*FRAME, *[f"_d{i}" for i in range(5)]), "mcd-frame")
    best = few(starts(rows, frame), "mcd-start")
    for left in reversed(range(TRIES)):
        now = concentrate(rows, best, frame)
        best = few(now if left else least_determinant(now), "mcd-step")
    for _ in range(STEPS):
        now = few(better(best, concentrate(rows, best, frame)), "mcd-step")
        fall = now.agg(F.max("_fall")).first()[0]
        if fall is None or fall < SETTLED:
            break
        best = now.drop("_fall")
    inside = rows.join(best, "_g").filter(distance() <= INNER).groupBy("_g", "_s").agg(*sums_of_rows())
    return few(estimate(inside, frame, INNER_FACTOR), "mcd-final")


def scatter_of(level: DataFrame) -> list[Column]:
    """The mean (_u) and scatter (_t) of estimates, from the inverse of its factor: the factor is found by forward substitution."""
    c = {(i, i): 1 / F.col(f"_v{i}{i}") for i in range(5)}
    # L V = I, so L[i][j] = -(sum over k from j + 1 to i of L[i][k] V[k][j]) / V[j][j]
    for i in range(5):
        for j in range(i - 1, -1, -1):
            c[i, j] = -reduce(lambda a, k: a + c[i, k] * F.col(f"_v{k}{j}"), range(j + 1, i + 1), F.lit(0.0)) / F.col(f"_v{j}{j}")
    return [*[F.col(f"_m{i}").alias(f"_u{i}") for i in range(5)], *[reduce(lambda a, k: a + c[i, k] * c[j, k], range(j + 1), F.lit(0.0)).alias(f"_t{i}{j}") for i, j in PAIRS]]


def fit_mcd(stats: DataFrame) -> DataFrame:
    """The estimates of each language and source, from the rows of stats that pass the base: a written row for each."""
    rows = stats.filter(~F.col("base_failed")).select(*GROUP, *X)
    languages = fit_level(rows.select(F.col("_lang").alias("_g"), *X), None)
    own = F.concat_ws("\x01", *GROUP).alias("_g")
    prior = rows.select("_lang", own).distinct().join(languages.select(F.col("_g").alias("_lang"), *scatter_of(languages)), "_lang").drop("_lang")
    return fit_level(rows.select(own, *X), prior)


def apply_mcd(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds distance (null without an estimate, that is where every row of the language and source fails the base) and kept."""
    model = estimates.select(F.col("_g"), *[f"_m{i}" for i in range(5)], *[f"_v{i}{j}" for i, j in PAIRS])
    out = stats.withColumn("_g", F.concat_ws("\x01", *GROUP)).join(model, "_g", "left").withColumn("distance", distance())
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))


def judge_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts, base_failed, distance and kept. The statistics are computed twice, the texts never written."""
    docs = docs.drop(*COUNTS, "base_failed", "distance", "kept")
    stats = statistics(docs.select(F.struct("*").alias("_row"), text, "lang", "source"), text)
    estimates = fit_mcd(written(stats.select(*GROUP, *X, "base_failed"), "mcd-rows"))
    return apply_mcd(stats, estimates).select("_row.*", *COUNTS, "base_failed", "distance", "kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = written(statistics(docs).drop("text"), "mcd-stats")
    return apply_mcd(stats, fit_mcd(stats)).select("doc_id", *COUNTS, "base_failed", "kept", "distance")
