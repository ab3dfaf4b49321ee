"""Periodic runs and SentencePiece ids against brute force and the library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from feedloom.llm import pieces, queries, runs
from feedloom.llm.word_hashes import mixed

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "x " * 30_000), (5, "x " * 30_000), (None, "ab ab ab ab ab ab ab ab"), (7, "Ab ab\x0bAB\x1fc d\r\n" * 9), (8, "né é ▁▁x  \x00 漢😀 " * 7)]


def lyndon(t):
    ends = []
    for i in range(len(t)):
        j = i + 1
        while j < len(t) and t[j:] > t[i:]:
            j += 1
        ends.append(j - i)
    return ends


def brute_runs(w, least=12):
    """All maximal stretches equal to themselves shifted by q, with no smaller such q."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40))
def test_grouping_gives_the_longest_lyndon_words(t):
    assert runs.lyndon_lengths(np.array([*t, 0]))[:-1].tolist() == lyndon(t)


def periodic(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(300):
        texts = [periodic(rng, rng.randint(0, 80), rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 4))]
        values = mixed(np.array([w for t in texts for w in t], np.uint64))
        assert runs.runs_of(values, np.cumsum([0, *map(len, texts)]), least) == [brute_runs(t, least) for t in texts]


def test_stretches_with_equal_hashes_are_told_apart():
    """Powers of an odd number modulo 2^64 do not tell Thue-Morse words apart."""
    w = [bin(i).count("1") % 2 for i in range(1 << 13)]
    assert len(runs.runs_of(mixed(np.array(w, np.uint64)), np.array([0, len(w)]))[0]) == len(brute_runs(w))


def expected_runs(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in dropped)).hexdigest()
    return str((doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, digest, kept))


def test_run_query_equals_brute_force(make, monkeypatch):
    rng = random.Random(5)
    short = [(i, "x y " * 60) if i == 5 else (i, t) for i, t in ODD]
    rows = short + [(i, " \t".join(f"w{x}" for x in periodic(rng, rng.randint(0, 90), 3))) for i in range(100, 250)]
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: make(rows))
    found = queries.periodic_runs(None, "")
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(expected_runs(*r) for r in rows)


def test_runs_of_odd_documents(make):
    found = {r.doc.doc_id: r for r in runs.periodic_runs(make(ODD), ["doc_id"]).collect()}
    assert found[5].runs == [(0, 30_000, 1)] and found[5].collapsed == "x"
    assert (found[1].n_words, found[1].runs, found[1].collapsed) == (0, [], "") == (found[3].n_words, found[3].runs, found[3].collapsed)
    assert found[None].collapsed == "ab ab ab ab ab ab ab ab"
    assert runs.periodic_runs(make([]), ["doc_id", "n_words"]).count() == 0


@pytest.fixture(scope="module")
def model():
    with open(queries.vocabulary(queries.PIECES), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def encoder(model):
    return pieces.PrefixEncoder(model)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab e\nthin▁é漢😀\x00\t019.ﬁ", max_size=60)))
def test_ids_equal_the_library(encoder, text):
    assert encoder.encode(text).tolist() == encoder.library.encode(text)


def test_long_texts_and_forgetting(model):
    encoder = pieces.PrefixEncoder(model, memo_bytes=2000)
    rng = random.Random(6)
    texts = ["x" * 20_000, " " * 9_001, "the thin " * 5000, "\n" * 999, *("".join(rng.choices("thein s.éo", k=500)) for _ in range(40))]
    for t in texts:
        assert encoder.encode(t).tolist() == encoder.library.encode(t)


def test_last_tokens_belong_to_the_prefixes(encoder):
    text = "▁Vorherrschaften"
    table = encoder.last_tokens(text)
    for end in range(2, len(text) + 1):
        assert table[end] == encoder.library.encode(text[1:end])[-1]


def test_piece_query_equals_the_library(make, monkeypatch, encoder):
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: make(ODD))
    got = queries.piece_digests(None, "").collect()
    want = []
    for doc_id, text in ODD:
        ids = encoder.library.encode(text or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), encoder.library.decode(ids) if ids else "")]
        want.append(str((doc_id, len(ids), *digests)))
    assert sorted(str(tuple(r)) for r in got) == sorted(want)


def test_whole_texts_come_back(make, model):
    rows = [(i, t) for i, t in ODD if t and "▁" not in t]
    coded = pieces.encode_texts(make(rows), model, ["doc_id", "text", "node"]).collect()
    assert [r.decoded for r in coded] == [r.doc.text for r in coded] and len(coded) == len(rows)
    assert pieces.encode_texts(make([]), model, ["doc_id"]).count() == 0
