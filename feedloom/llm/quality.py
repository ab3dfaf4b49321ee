"""Quality rules: multivariate outliers among text statistics, by minimum covariance determinant per language and source.

Everything here is column expressions: statistics of whole texts, moments per group, and matrices as arrays.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from feedloom.llm.text import carry, words_of
from feedloom.session import tidy, written

SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Share of a group's documents whose covariance determinant is made small.
SUPPORT = 0.75
#: Weight of the identity in a regularised covariance, in units of the group's own scales.
IDENTITY = 0.1
#: Documents that a language's pooled covariance counts for in that of each of its sources, and all documents' in its own.
DRAW = 50
#: The same for centers.
DRAW_CENTER = 10
#: A document is an outlier beyond this quantile of the chi-squared law; clean text has heavier tails than the normal law.
QUANTILE = 1 - 1e-12
STEPS = 8
#: Words by which a statistic of a short text is drawn to its group's median.
SHRINK = 50

#: The transformed statistics, and the least scale that is believed for each.
FEATURES = {
    "word_length": ("ln(word_chars / n_words)", 0.1),
    "symbols": ("sqrt(n_symbols / word_chars)", 0.04),
    "marks": ("sqrt(n_marks / word_chars)", 0.05),
    "capitals": ("sqrt(n_capitals / word_chars)", 0.05),
    "dup_lines": ("sqrt(n_dup_lines / n_lines)", 0.3),
    "repeats": ("sqrt(n_repeat_words / n_words)", 0.2),
}
P = len(FEATURES)
Z = [f"z{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts over its whole texts.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_marks`` (neither letter nor white space),
    ``n_capitals``, ``n_lines`` and ``n_dup_lines`` (lines with a word; those equal to an earlier one),
    ``n_repeat_words`` (words in three-word windows that occur at least twice). All are 0 for null and blank texts.
    """
    t = F.coalesce(F.col(text), F.lit(""))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")).cast("long")

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        "*",
        words_of(F.col(text)).alias("__words"),
        lines.alias("__lines"),
        left(SYMBOLS).alias("n_symbols"),
        left(r"[\p{L}\x20\x09-\x0D]+").alias("n_marks"),
        left(r"\P{Lu}+").alias("n_capitals"),
    )
    w, n = F.col("__words"), F.size("__words")
    window = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    hashed = counted.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__hashes": F.when(n >= 3, window),
        }
    ).drop("__words", "__lines")
    h = F.col("__hashes")
    placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(h)) < F.size(h)
    ordered = hashed.withColumn("__placed", F.when(some, placed)).drop("__hashes")
    s = F.col("__placed")
    twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
    starts = ordered.withColumn("__starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("__placed")
    q = F.col("__starts")
    covered = F.transform(q, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(q, i + 1) - x, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return starts.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("__starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_cdf(x: float, df: int) -> float:
    return _gamma_p(df / 2, x / 2) if x > 0 else 0.0


def chi2_quantile(q: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, df) < q else (low, mid)
    return low


def _consistency(share: float) -> float:
    """Factor by which the covariance of the ``share`` innermost documents falls short of that of all."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2)


def _sweep(matrix: Column) -> Column:
    """Inverse and log determinant of a symmetric positive definite matrix, given and returned row by row.

    Each round eliminates one row and column; after all of them the negative inverse is left.
    """

    def pivot(state: Column, k: Column) -> Column:
        a = state["a"]
        d = F.get(a, k * (P + 1))

        def entry(v: Column, ij: Column) -> Column:
            i, j = F.floor(ij / P).cast("int"), (ij % P).cast("int")
            left, up = F.get(a, i * P + k), F.get(a, k * P + j)
            return F.when((i == k) & (j == k), -1 / d).when(i == k, up / d).when(j == k, left / d).otherwise(v - left * up / d)

        return F.struct(F.transform(a, entry).alias("a"), (state["logdet"] + F.log(d)).alias("logdet"))

    start = F.struct(matrix.alias("a"), F.lit(0.0).alias("logdet"))
    rounds = F.sequence(F.lit(0), F.lit(P - 1))
    return F.aggregate(rounds, start, pivot, lambda s: F.struct(F.transform(s["a"], lambda v: -v).alias("precision"), s["logdet"].alias("logdet")))


def _estimates(moments: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """``center``, ``precision`` and ``logdet`` per key from weighted sums ``n``, ``s{i}`` and ``s{i}_{j}``.

    ``moments`` has a row per pair of language and source, ``grp`` and ``lang`` among the keys. A pair of n documents
    has its own covariance by n / (n + DRAW), the rest is the one within the sources of its language; its center is
    its own by n / (n + DRAW_CENTER), the rest its language's. Languages are drawn to all documents in the same way.
    """
    start = [k for k in keys if k not in ("grp", "lang")]
    windows = {"lang": ", ".join(["lang", *start]), "all": ", ".join(["0", *start])}

    def drawn(own: str, parent: str, n: str, k: int) -> str:
        return f"(({own}) * {n} + ({parent}) * {k}) / ({n} + {k})"

    rows = moments.selectExpr("*", *[f"if(n > 0, s{i} / n, 0D) AS m{i}" for i in range(P)])
    rows = rows.selectExpr("*", *[f"if(n > 0, s{i}_{j} / n, 0D) - m{i} * m{j} AS c{i}_{j}" for i, j in PAIRS])
    pooled = [f"sum(n) OVER (PARTITION BY {w}) AS n_{level}" for level, w in windows.items()]
    pooled += [f"sum(s{i}) OVER (PARTITION BY {w}) AS m{i}_{level}" for level, w in windows.items() for i in range(P)]
    pooled += [f"sum(n * c{i}_{j}) OVER (PARTITION BY {w}) AS c{i}_{j}_{level}" for level, w in windows.items() for i, j in PAIRS]
    rows = rows.selectExpr("*", *pooled)

    def shrunk(value: str, k: int) -> str:
        lang, every = (f"if(n_{level} > 0, {value}_{level} / n_{level}, 0D)" for level in windows)
        return drawn(value, drawn(lang, every, "n_lang", k), "n", k)

    factor = (1 - IDENTITY) * _consistency(share)
    center = [shrunk(f"m{i}", DRAW_CENTER) for i in range(P)]
    cells = [(min(i, j), max(i, j)) for i in range(P) for j in range(P)]
    matrix = [f"({shrunk(f'c{i}_{j}', DRAW)}) * {factor!r}D" + (f" + {IDENTITY!r}D" if i == j else "") for i, j in cells]
    solved = rows.selectExpr(*keys, f"array({', '.join(center)}) AS center", f"array({', '.join(matrix)}) AS matrix")
    return solved.withColumn("solved", _sweep(F.col("matrix"))).select(*keys, "center", "solved.precision", "solved.logdet")


def _distance() -> Column:
    """The squared Mahalanobis distance of ``z0``.. from ``center`` by ``precision``."""
    terms = [f"precision[{i * P + j}] * (z{i} - center[{i}]) * (z{j} - center[{j}]) * {1 if i == j else 2}" for i, j in PAIRS]
    return F.expr(" + ".join(terms))


def _moments(weight: str = "1D", z: str = "z{}") -> list[Column]:
    """Weighted sums of the statistics and of their products; ``z`` says how each goes in."""
    of = [z.format(i) for i in range(P)]
    sums = [f"sum({weight} * {of[i]}) AS s{i}" for i in range(P)]
    return [F.expr(e) for e in [f"sum({weight}) AS n", *sums, *[f"sum({weight} * {of[i]} * {of[j]}) AS s{i}_{j}" for i, j in PAIRS]]]


def _concentrate(points: DataFrame, estimates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One C-step: moments of each group's ``SUPPORT`` share of the documents nearest to its estimate.

    Distances are cut into narrow logarithmic bins whose moments are summed; the bin in which the share is reached
    counts in part. So a group of any size is combined on the map side and never ordered.
    """
    joined = points.join(estimates.drop("lang"), "grp")
    d2 = _distance()
    cell = F.floor(F.log2(F.greatest(d2, F.lit(1e-6))) * 8).cast("int")
    cells = joined.withColumn("cell", cell).groupBy(*keys, "cell").agg(*_moments())
    group = W.partitionBy(*keys)
    inside = F.sum("n").over(group) * SUPPORT
    before = F.coalesce(F.sum("n").over(group.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (inside - before) / F.col("n")))
    sums = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}_{j}" for i, j in PAIRS]]
    return cells.withColumn("part", part).groupBy(*keys).agg(*[F.expr(f"sum(part * {c}) AS {c}") for c in sums])


def _plain() -> list[Column]:
    """``center`` and ``precision`` of standardised values before any estimate: the identity around the median."""
    eye = F.array(*[F.lit(float(i == j)) for i in range(P) for j in range(P)])
    return [F.array(*[F.lit(0.0)] * P).alias("center"), eye.alias("precision")]


def _scales(quartiles: DataFrame) -> DataFrame:
    """``grp``, ``middle`` and ``spread`` per statistic, from ``n`` and quartiles per pair of language and source.

    Drawn like the estimates: medians by DRAW_CENTER, quartile distances by DRAW, towards the mean over the documents of
    the language, and those towards the mean over all.
    """
    n, of_lang, of_all = F.col("n"), W.partitionBy("lang"), W.partitionBy(F.lit(0))

    def drawn(value: Column, k: int) -> Column:
        n_lang = F.sum(n).over(of_lang)
        lang, every = F.sum(value * n).over(of_lang) / n_lang, F.sum(value * n).over(of_all) / F.sum(n).over(of_all)
        parent = (lang * n_lang + every * k) / (n_lang + k)
        return (value * n + parent * k) / (n + k)

    floors = [floor for _, floor in FEATURES.values()]
    middle = [drawn(F.get(f"q{i}", F.lit(1)), DRAW_CENTER) for i in range(P)]
    spread = [F.greatest(drawn(F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0)), DRAW) / 1.349, F.lit(floors[i])) for i in range(P)]
    return quartiles.select("grp", F.array(*middle).alias("middle"), F.array(*spread).alias("spread"))


def fit(points: DataFrame, steps: int = STEPS) -> DataFrame:
    """``grp``, ``center`` and ``precision`` of every group of ``points`` (``grp``, its ``lang``, and standardised ``z0``..).

    Two starts, both computed from all documents: the identity around the median, and the covariance of tanh(z),
    which bounds the pull of outliers. After two concentration steps the start with the smaller determinant goes on,
    until no determinant moves. A last pass takes in every document within the 97.5 % quantile. Groups of any size
    have an estimate, see :func:`_estimates`.
    """
    tanh = points.groupBy("grp", "lang").agg(*_moments(z="tanh(z{})"))
    bounded = _estimates(tanh, ["grp", "lang"], 1 - 1e-12).withColumn("start", F.lit("tanh"))
    plain = bounded.select("grp", "lang", *_plain(), F.lit(math.inf).alias("logdet"), F.lit("plain").alias("start"))
    est = written(bounded.unionByName(plain), "estimates")
    for step in range(steps):
        keys = ["grp", "lang", "start"]
        new = _estimates(_concentrate(points, est, keys), keys, SUPPORT)
        if step == 1:
            best = W.partitionBy("grp").orderBy("logdet", "start")
            new = new.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank").withColumn("start", F.lit("best"))
        new = written(new, "estimates")
        tidy(points.sparkSession)
        if step > 1:
            old = est.select("grp", F.col("logdet").alias("was"))
            moved = new.join(old, "grp").agg(F.max(F.abs(F.col("logdet") - F.col("was")))).first()[0]
            if moved is None or moved < 1e-3:
                est = new
                break
        est = new
    d2 = _distance()
    near = points.join(est.drop("lang"), "grp").withColumn("near", (d2 <= chi2_quantile(0.975, P)).cast("double"))
    last = near.groupBy("grp", "lang").agg(*_moments("near"))
    return written(_estimates(last, ["grp", "lang"], 0.975).drop("lang"), "estimates")


def judge(docs: DataFrame, keep: Sequence[str], quantile: float = QUANTILE) -> DataFrame:
    """Every row of ``docs`` as ``doc`` (a struct of the columns ``keep``), its statistics, ``base_failed`` and ``kept``.

    ``docs`` has ``text``, ``lang`` and ``source``. Null languages and sources are groups like any other. Documents
    that fail the base rules are not part of any estimate and not kept; null and blank texts are among them. Repeated
    rows count and are judged each. Every pair of language and source has an estimate of its own at every size: what
    few documents cannot tell is drawn from the language's and all documents' in proportion, so nothing changes at a
    threshold and a single document is judged by the others of its language. An empty table gives no rows.

    Statistics are written to the shared folder once; estimates have a row per pair, and Spark broadcasts them if
    they are small. Groups are only ever summed, so one with a third of all documents is no burden on a task.
    """
    read = carry(docs, keep, text=F.col("text"), lang=F.col("lang"), source=F.col("source"))
    stats = text_statistics(read).drop("text").withColumn("base_failed", base_failed())
    x = {f"x{i}": F.when(~F.col("base_failed"), F.expr(value)) for i, (value, _) in enumerate(FEATURES.values())}
    stats = stats.withColumns(x).withColumn("grp", F.to_json(F.struct("lang", "source")))
    stats = written(stats, "statistics")
    fine = stats.where(~F.col("base_failed"))
    quartiles = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)]
    scales = written(_scales(fine.groupBy("grp", "lang").agg(F.count(F.lit(1)).alias("n"), *quartiles)), "scales")

    def standard(rows: DataFrame) -> DataFrame:
        weight = F.col("n_words") / (F.col("n_words") + SHRINK)
        z = {Z[i]: (F.col(f"x{i}") - F.get("middle", F.lit(i))) * weight / F.get("spread", F.lit(i)) for i in range(P)}
        return rows.join(scales, "grp", "left").withColumns(z)

    estimates = fit(standard(fine).select("grp", "lang", *Z))
    scored = standard(stats).join(estimates, "grp", "left")
    d2 = _distance()
    inside = F.coalesce(d2 <= chi2_quantile(quantile, P), F.lit(True))
    return scored.withColumn("distance2", d2).select(
        "doc", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals", "n_lines",
        "base_failed", (~F.col("base_failed") & inside).alias("kept"), "distance2",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with the same columns."""
    return judge(docs, docs.columns).where("kept").select("doc.*")
