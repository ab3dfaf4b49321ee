"""Quality, mixing, languages, lengths and language model scores on small inputs."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import langid, mixing, ppm, quality, token_counts
from feedloom.llm.text import word_count

ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", None, "b"), (4, "Ab ab\x0bAB\x1fc d\r\nAb ab\nAb ab", "en", None),
    (5, "a b c a b c a b c d", "en", "a"), (6, "x " * 30_000, "de", "a"), (6, "x " * 30_000, "de", "a"), (7, "né\u00a0é # | <a> && ñ", "fr", "é"), (None, "no id here", "en", "a"),
]


def text(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))


def test_statistics_equal_brute_force(make):
    rng = random.Random(1)
    repeated = [(100 + i, " ".join(rng.choices("abc", k=rng.randint(0, 60))), "en", "a") for i in range(60)]
    docs = make(ODD + repeated)
    judged = quality.judge(docs, ["text"]).select("doc.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(judged) == len(ODD) + 60
    for r in judged:
        assert tuple(r)[1:6] == brute.statistics(r.text), r.text
        assert r.base_failed == brute.base_failed(r.text) and r.kept == (not r.base_failed)


def test_outliers_go_and_clean_documents_stay(make):
    rng = random.Random(2)
    rows = [(i, text(rng, rng.randint(60, 300)) + ".", "en" if i % 2 else None, "hot" if i % 3 else None) for i in range(600)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in text(rng, 100).split()), "en", "hot") for i in range(40)]
    docs = make(rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(600))


def test_sweep_inverts(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(quality.P, 20))
    matrix = a @ a.T
    r = spark.range(1).select(quality._sweep(F.array(*[F.lit(float(x)) for x in matrix.ravel()])).alias("s")).first().s
    assert np.allclose(np.array(r.precision).reshape(matrix.shape), np.linalg.inv(matrix))
    assert r.logdet == pytest.approx(np.linalg.slogdet(matrix)[1])


def test_concentration_lowers_the_determinant_of_a_spoiled_group(spark):
    rng = np.random.default_rng(4)
    good, bad = rng.normal(size=(900, quality.P)), rng.normal(8, 0.5, size=(180, quality.P))
    points = spark.createDataFrame([("g", "en", *map(float, x)) for x in np.vstack([good, bad])], ["grp", "lang", *quality.Z])
    found = quality.fit(points).first()
    assert np.abs(np.array(found.center)).max() < 0.3
    d = bad - np.array(found.center)
    precision = np.array(found.precision).reshape(quality.P, quality.P)
    assert (np.einsum("ni,ij,nj->n", d, precision, d) > quality.chi2_quantile(quality.QUANTILE, quality.P)).all()


def test_chi2():
    assert quality.chi2_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3)


def estimate(groups, weights, share):
    """Centers and covariances of {grp: (lang, points)} drawn to the language's and to all, in numpy."""
    p, moments = quality.P, {}
    for g, (lang, x) in groups.items():
        w = weights[g]
        n = w.sum()
        mean = w @ x / n if n else np.zeros(p)
        moments[g] = lang, n, mean, (x * w[:, None]).T @ x / n - np.outer(mean, mean) if n else np.zeros((p, p))

    def pooled(keys):
        n = sum(moments[g][1] for g in keys)
        if not n:
            return n, np.zeros(p), np.zeros((p, p))
        return n, sum(moments[g][1] * moments[g][2] for g in keys) / n, sum(moments[g][1] * moments[g][3] for g in keys) / n

    def drawn(own, parent, n, k):
        return (own * n + parent * k) / (n + k)

    _, center_all, cov_all = pooled(moments)
    out = {}
    for g, (lang, n, mean, cov) in moments.items():
        n_lang, center_lang, cov_lang = pooled([h for h in moments if moments[h][0] == lang])
        parent = drawn(center_lang, center_all, n_lang, quality.DRAW_CENTER), drawn(cov_lang, cov_all, n_lang, quality.DRAW)
        c = drawn(cov, parent[1], n, quality.DRAW) * (1 - quality.IDENTITY) * quality._consistency(share) + quality.IDENTITY * np.eye(p)
        out[g] = drawn(mean, parent[0], n, quality.DRAW_CENTER), c
    return out


def squared(estimates, groups):
    return {g: np.einsum("ni,ij,nj->n", x - estimates[g][0], np.linalg.inv(estimates[g][1]), x - estimates[g][0]) for g, (_, x) in groups.items()}


def inmost(d2):
    """Weights of the nearest SUPPORT share, in eighths of powers of two of the distance."""
    cell = np.floor(np.log2(np.maximum(d2, 1e-6)) * 8)
    left, weight = len(d2) * quality.SUPPORT, np.zeros(len(d2))
    for c in np.unique(cell):
        inside = cell == c
        weight[inside] = min(1.0, max(0.0, left / inside.sum()))
        left -= inside.sum()
    return weight


def brute_fit(groups):
    tanh = {g: (lang, np.tanh(x)) for g, (lang, x) in groups.items()}
    starts = [estimate(tanh, {g: np.ones(len(x)) for g, (_, x) in groups.items()}, 1 - 1e-12), {g: (np.zeros(quality.P), np.eye(quality.P)) for g in groups}]
    for _ in range(2):
        starts = [estimate(groups, {g: inmost(d) for g, d in squared(e, groups).items()}, quality.SUPPORT) for e in starts]
    volume = [{g: np.linalg.slogdet(c)[1] for g, (_, c) in e.items()} for e in starts]
    now = {g: starts[int(volume[0][g] > volume[1][g])][g] for g in groups}
    was = {g: min(v[g] for v in volume) for g in groups}
    for _ in range(quality.STEPS - 2):
        now = estimate(groups, {g: inmost(d) for g, d in squared(now, groups).items()}, quality.SUPPORT)
        volume = {g: np.linalg.slogdet(c)[1] for g, (_, c) in now.items()}
        if max(abs(volume[g] - was[g]) for g in groups) < 1e-3:
            break
        was = volume
    near = {g: (d <= quality.chi2_quantile(0.975, quality.P)).astype(float) for g, d in squared(now, groups).items()}
    return estimate(groups, near, 0.975)


def test_estimates_equal_numpy(spark):
    rng = np.random.default_rng(6)
    groups = {}
    for g, lang, n in [("a", "en", 120), ("b", "en", 30), ("c", "en", 1), ("d", "de", 40), ("e", None, 3)]:
        x = rng.normal(rng.normal(0, 2), 1, size=(n, quality.P)) @ np.triu(rng.normal(0.3, 0.3, size=(quality.P, quality.P)) + np.eye(quality.P))
        x[: n // 6] += 12
        groups[g] = lang, x
    points = [(g, lang, *map(float, row)) for g, (lang, x) in groups.items() for row in x]
    found = quality.fit(spark.createDataFrame(points, ["grp", "lang", *quality.Z]))
    want = brute_fit(groups)
    got = {r.grp: r for r in found.collect()}
    assert got.keys() == want.keys()
    for g, (center, cov) in want.items():
        assert np.allclose(got[g].center, center, atol=1e-6)
        assert np.allclose(np.array(got[g].precision).reshape(cov.shape), np.linalg.inv(cov), rtol=1e-5, atol=1e-7)


def test_what_is_normal_in_another_source_is_an_outlier(make):
    rng = random.Random(12)

    def marked(n):
        return " ".join(w + "!!!" for w in text(rng, n).split())

    rows = [(i, text(rng, rng.randint(80, 200)), "en", "plain") for i in range(30)] + [(100 + i, marked(rng.randint(80, 200)), "en", "marked") for i in range(30)]
    rows += [(200, marked(150), "en", "plain")]
    judged = {r.doc_id: r.kept for r in quality.judge(make(rows), ["doc_id"]).select("doc.doc_id", "kept").collect()}
    assert [i for i, kept in judged.items() if not kept] == [200]


@pytest.mark.parametrize("clean", [300, 90])
def test_rare_languages_and_small_tables_are_judged(make, clean):
    rng = random.Random(9)
    rows = [(i, text(rng, rng.randint(60, 300)) + ".", "en", "a") for i in range(clean)]
    rows += [(500 + i, text(rng, 100) + ".", "fr", "a" if i % 2 else None) for i in range(10)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in text(rng, 100).split()), "fr" if i % 2 else None, "b") for i in range(6)]
    judged = quality.judge(make(rows), ["doc_id"]).select("doc.doc_id", "kept", "distance2").collect()
    assert len(judged) == len(rows) and all(r.distance2 is not None for r in judged)
    assert {r.doc_id for r in judged if r.kept} == {r[0] for r in rows if r[0] < 1000}


def test_quality_without_rows(make):
    assert quality.keep_good(make([])).count() == 0


def test_mix_equals_brute_force(make):
    rng = random.Random(5)
    rows = [(i, text(rng, rng.randint(0, 40)), "en", rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"])) for i in range(300)] + ODD
    docs = make(rows)
    sizes = [(r[3], len(brute.words(r[1]))) for r in rows]
    of = brute.rates(sizes)
    found = {r.source: r for r in mixing.source_rates(docs.select("source", word_count(F.col("text")).alias("size"))).collect()}
    for source, (size, target) in of.items():
        assert found[source].source_size == size and found[source].target == pytest.approx(target)
        assert target <= 3 * size + 1e-9
    mixed = mixing.mix(docs, word_count(F.col("text")))
    assert mixed.columns == docs.columns
    got = sorted(str(r.doc_id) + str(r.text) for r in mixed.collect())
    assert got == sorted(str(r[0]) + str(r[1]) for r in rows for _ in range(brute.copies(r[0], r[3], of)))
    assert mixing.mix(make([]), word_count(F.col("text"))).count() == 0


def test_one_source_and_no_words(make):
    sized = make([(1, "a b"), (2, "c")]).select("source", F.lit(0).cast("long").alias("size"))
    assert mixing.source_rates(sized).first().rate == 0


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs.where("doc_id % 4 != 2"))
    held = langid.identify(docs.where("doc_id % 4 = 2"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in held)


def test_languages_of_odd_texts(make):
    docs = make(ODD + [(9, "123 !?", "en"), (10, "漢字", "zh"), (11, "漢字 漢", "zh")])
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and got[1].score == 0
    assert got[10].lang_pred == "zh" and set(model.languages) == {"en", "de", "fr", "zh"}
    none = langid.fit(make([(1, "abc", None)]))
    assert langid.identify(docs, none).select("lang_pred").distinct().collect() == [("und",)]
    assert langid.identify(make([]), model).count() == 0


def test_kernel_equals_definition():
    import pyarrow as pa

    sets = langid.ngram_sets(pa.array(["Abc, ab", "ab c", "xyz"]))
    model = langid.fit_sets(sets, ["a", "a", "b"])
    plain = [{g for n in (1, 2, 3) for g in (s[i : i + n] for i in range(len(s) - n + 1))} for s in (" abc ab ", " ab c ", " xyz ")]
    want = [[len(x & y) / (len(x) * len(y)) ** 0.5 for y in plain] for x in plain]
    assert np.allclose(model.kernel(sets), want, atol=1e-6)


def test_lengths(make, vocabulary):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    docs = make(ODD)
    lengths = sorted(len(whole.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ODD)
    sums = token_counts.suffix_sums(token_counts.length_counts(docs, vocabulary))
    got = {r.n_tokens: r for r in sums.collect()}
    assert sum(r.n_docs for r in got.values()) == len(ODD)
    for n, r in got.items():
        assert (r.docs_at_least, r.tokens_at_least) == (sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
        assert r.truncated_total == sum(min(x, n) for x in lengths)
    limits = docs.sparkSession.createDataFrame([(x,) for x in (0, 1, 2, 4095, 4096, 30_001, 10**6)], "context long")
    for r in token_counts.truncated_totals(sums, limits).collect():
        kept = sum(min(x, r.context) for x in lengths)
        assert (r.docs_below, r.kept_tokens, r.cut_tokens) == (sum(x < r.context for x in lengths), kept, sum(lengths) - kept)
    for r in token_counts.length_quantiles(sums, [0.0, 0.5, 1.0]).collect():
        assert r.n_tokens == min(n for n in lengths if sum(x <= n for x in lengths) >= r.share * len(lengths))
    assert token_counts.length_counts(make([]), vocabulary).count() == 0


@pytest.mark.parametrize("table", [0, 20, 10**6])
def test_ppm_equals_brute_force(make, table, monkeypatch):
    monkeypatch.setattr(ppm, "SLICE_BYTES", 300 if table else 2_000_000)
    monkeypatch.setattr(ppm, "HELD", 50 if table else 2_000_000)
    rng = random.Random(6)
    rows = ODD[:5] + ODD[7:] + [(20 + i, text(rng, rng.randint(1, 20), "abC é"), "en") for i in range(60)] + [(90, "ab cd ef")] * 3
    train = [r[1] for r in rows if brute.remainder(r[0], 3)]
    flag = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 != 0
    got = ppm.score(make(rows), flag, order=3, table=table).collect()
    model, base = brute.ppm(train, 3), brute.unigram(train)
    want = sorted((str(r[0]), *base(r[1]), model(r[1])) for r in rows)
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [w[:4] for w in want] == [f[:4] for f in found]
    assert np.allclose([w[4:] for w in want], [f[4:] for f in found])


def test_ppm_is_a_distribution():
    score = brute.ppm(["ab", "b"], 2)
    assert sum(10 ** score(t) for t in ("ab", "b")) < 1


def test_ppm_without_training_or_rows(make):
    got = ppm.score(make([(1, "ab"), (2, None)]), F.lit(False), order=2).orderBy("doc_id").collect()
    assert got[0].score == pytest.approx(-3 * np.log10(256)) and got[1].n_tokens == 1 and got[1].train_tokens == 0
    assert ppm.score(make([]), F.lit(True)).count() == 0
