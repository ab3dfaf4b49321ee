"""Near duplicates, decontamination, urls, WARC, token files and the pipeline on small inputs."""

import json
import os
import random
import time
import zlib
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedloom import session
from feedloom.llm import components, decontam, jaccard, token_files, url_graph, warc, word_hashes
from feedloom.llm.token_ids import PieceEncoder, read_vocabulary

VOCABULARY = [f"w{i}" for i in range(400)]


def text(rng, n):
    return " ".join(rng.choices(VOCABULARY, k=n))


def changed(rng, t, n):
    w = t.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
    return " ".join(w)


def near_duplicates(rng):
    rows = []
    for _ in range(12):
        base = text(rng, rng.randint(8, 200))
        rows += [base] + [changed(rng, base, rng.choice([0, 1, 1, 2, 4])) for _ in range(rng.choice([0, 1, 3, 20]))]
    shared = text(rng, 60)
    rows += [f"{shared} {text(rng, 40)}" for _ in range(25)]
    rows += ["a b c", "A  b\nc", "a b", "one two three four five", None, "", " \t", "x " * 20_000, "x " * 20_000]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows, strict=True)) + [(None, "no id at all but some words"), (None, "NO id at all but some words"), (5000, "a b c")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(make, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(jaccard, "GROUP", 3)
        monkeypatch.setattr(jaccard, "COLUMNS", 64)
    rows = near_duplicates(random.Random(seed))
    got = jaccard.jaccard_components(make(rows)).collect()
    want = sorted(map(str, zip([r[0] for r in rows], [len(brute.shingles(r[1])) for r in rows], brute.components(rows), strict=True)))
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == want


def test_keep_one(make):
    rows = near_duplicates(random.Random(3)) + [(7000, "twice the same row")] * 2
    rows += [(9000, "one id on two near copies " + "w " * 90), (9000, "one id on two near copies " + "w " * 91)]
    docs = make(rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    best = brute.components([(i, t) for i, (_, t) in enumerate(rows)])
    groups = {}
    for (name, t), g in zip(rows, best, strict=True):
        groups.setdefault(g, set()).add((name, t))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got)) == len(groups)
    for g in groups.values():
        (one,) = g.intersection(got)
        assert one[0] == min((name for name, _ in g if name is not None), default=None)
    assert jaccard.keep_one(make([])).count() == 0


def test_candidates_of_worn_copies(make, monkeypatch):
    """Four times as many copies of one text, each worn in its own places, cost few more comparisons a copy."""
    rng, made = random.Random(11), []
    write = jaccard.written

    def counting(df, label):
        found = write(df, label)
        if label in ("stars", "open-differing", "asked", "pairs"):
            made.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "written", counting)
    base = [f"b{i}" for i in range(100)]
    candidates = []
    for n in (300, 1200):
        rows = []
        for i in range(n):
            words = list(base)
            for place in rng.sample(range(100), rng.choice([1, 2, 2, 2, 3, 4, 6])):
                words[place] = f"u{i}-{place}"
            rows.append((i, " ".join(words)))
        made.clear()
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(make(rows)).collect()}
        candidates.append(sum(made))
        names = {}
        matrix = np.zeros((n, 40_000), np.float32)
        for i, t in rows:
            for x in brute.shingles(t):
                matrix[i, names.setdefault(x, len(names))] = 1
        size, same = matrix.sum(1), matrix @ matrix.T
        linked = 100 * same >= 75 * (size[:, None] + size - same)
        want = np.arange(n)
        while True:
            now = np.where(linked, want, n).min(1)
            if (now == want).all():
                break
            want = now
        assert [got[i] for i in range(n)] == want.tolist()
    assert candidates[1] < candidates[0] * 4**1.3


def test_a_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(-5, -9), (300, 200)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(101), 0), -5: -9, -9: -9, 300: 200, 200: 200}
    assert components.components(links.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ \t\n\r\x0b\x0cé漢", max_size=30)), max_size=6))
def test_word_hashes_tell_words_apart(texts):
    hashes, bounds = word_hashes.WordHasher().words(pa.array(texts, pa.string()))
    words = [brute.lowered(t) for t in texts]
    assert np.diff(bounds).tolist() == list(map(len, words))
    flat = [w for ws in words for w in ws]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    column = pa.array(["ab cd " * 500, None, "x" * 5000 + " ab"])
    whole = word_hashes.WordHasher().words(column)[0]
    monkeypatch.setattr(word_hashes, "SLICE", 64)
    assert (word_hashes.WordHasher().words(column)[0] == whole).all()


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_overlaps_survive_substitutions(make, spark):
    rng = random.Random(4)
    passage = text(rng, 40).split()
    worn = list(passage)
    for i in (6, 15, 24, 33):
        worn[i] = "other"
    docs = make(
        [
            (1, f"Before it: {' '.join(passage).upper()}. After"), (2, " ".join(["start", *worn, "end"])), (3, text(rng, 500)), (4, None), (5, ""),
            (6, " ".join(passage[5:25])), (7, " ".join(passage[:10])), (8, "q " * 30_000 + "; ".join(passage)), (8, "q " * 30_000 + "; ".join(passage)), (9, "one two, three four five six seven eight!"),
        ]
    )
    bench = items(spark, [(0, " ".join(passage)), (1, " ".join(passage)), (2, None), (3, "too short"), (4, "One two three four five six seven eight")])
    got = decontam.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted([(i, j) for i in (1, 2, 6, 8, 8) for j in "01"] + [(9, "4")])
    found = {r.doc_id: (r.doc_start, r.item_start, r.n_words, r.n_equal) for r in got}
    assert found[1] == (2, 0, 40, 40) and found[2] == (1, 0, 40, 36) and found[6] == (0, 5, 20, 20) and found[8] == (30_000, 0, 40, 40)
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 7]
    blocks = decontam.contaminated(docs, bench, words=10).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    assert decontam.contaminated(make([]), bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([True, True, True, False]), min_size=1, max_size=60))
def test_best_stretch_equals_brute_force(equal):
    fits = [(sum(equal[i:j]), -i, i - j) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1) if equal[i] and equal[j - 1] and sum(equal[i:j]) * 5 >= 4 * (j - i)]
    n, start, length = max(fits, default=(0, 0, 0))
    assert decontam.best_stretch(np.array(equal))[1:] == (-length, n)
    assert not n or decontam.best_stretch(np.array(equal))[0] == -start


def overlap(doc, item):
    found = decontam.Seeds.of(["i"], pa.array([" ".join(item)]))
    return found.overlaps(*decontam._words(decontam.WordHasher(decontam.SEPARATORS), pa.array([" ".join(doc)]))).get((0, 0))


def worn(rng, words, share):
    return [f"x{rng.random()}" if rng.random() < share else w for w in words]


def test_worn_text_around_a_copy_does_not_hide_it():
    item = [f"w{i}" for i in range(156)]
    doc = item[:16] + [f"x{i}" if i % 4 == 0 else w for i, w in enumerate(item[16:])]
    start, item_start, length, equal = overlap(doc, item)
    assert (start, item_start) == (0, 0) and equal >= 16 and equal * 5 >= length * 4
    rng, seen = random.Random(8), 0
    for n in (100, 200):
        for share in (0.2, 0.22, 0.25):
            for _ in range(30):
                item = [f"w{i}" for i in range(n)]
                doc = worn(rng, item, share)
                if any(doc[i : i + 13] == item[i : i + 13] for i in range(n - 12)):
                    seen += 1
                    found = overlap(["before", *doc, "after"], item)
                    assert found and found[3] >= 13 and found[3] * 5 >= found[2] * 4
    assert seen > 40


def test_a_hit_of_one_mask_does_not_hide_those_of_others():
    item = [f"w{i}" for i in range(60)]
    doc = [f"x{i}" if i in (4, 9, 14, 19) or 20 <= i < 48 else w for i, w in enumerate(item)]
    hashes = [decontam._words(decontam.WordHasher(decontam.SEPARATORS), pa.array([" ".join(t)]))[0] for t in (doc, item)]
    hit = [np.flatnonzero(decontam.seeds(hashes[0], m) == decontam.seeds(hashes[1], m)) for m in decontam.MASKS]
    assert hit[0].min() > 40 and min(hit[1].min(), hit[2].min()) < 10
    assert overlap(doc, item) == (0, 0, 19, 16)


RULES = [url_graph.Rule("allow", "com", "/"), url_graph.Rule("block", "example.com", "/en/"), url_graph.Rule("allow", "www.example.com", "/en/"), url_graph.Rule("block", "net", "/es/")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, verdict string")


def test_url_rules_and_links(spark):
    bad = '<a href="https://Bad.net/es/1">b</a>'
    rows = [
        (1, "HTTP://A.Example.COM/en/x?y://z", ""), (2, "http://www.example.com/en/", None), (3, "http://x.com", ""), (4, None, bad), (5, "no scheme", bad), (6, "http://a.com?/en/", "see good.org"),
        (7, "http://bad.net/es/", ""), (7, "http://bad.net/es/", ""), (8, "http://bad.net/en/", ""), (9, "http://farm.org/", bad), (10, "http://good.org/", ""), (11, "http://good.org/2", bad),
        (12, "http://lone.org/#es", ""), (13, "http://a.com/", "good.org"), (14, "://", ""), (15, "http://notcom/", ""),
    ]
    got = {r.page_id: r for r in url_graph.judge_urls(pages(spark, rows), RULES).collect()}
    assert len(got) == 15
    host_path = {i: (r.host, r.path) for i, r in got.items()}
    assert host_path[1] == ("a.example.com", "/en/x") and host_path[3] == ("x.com", "") and host_path[4] == host_path[5] == host_path[14] == ("", "")
    assert host_path[6] == ("a.com", "") and host_path[12] == ("lone.org", "/")
    assert [got[i].rule for i in (1, 2, 3, 7, 13, 15)] == ["example.com/en/", "www.example.com/en/", None, "net/es/", "com/", None]
    assert [got[i].verdict for i in (1, 2, 7, 13)] == ["block", "allow", "block", "allow"]
    # bad.net: two of three pages blocked. farm.org names only it; good.org is named by a trusted host as well.
    assert got[8].verdict == "block" and got[10].trust > 0 and got[9].distrust > 0 and got[12].verdict == "allow"
    assert url_graph.judge_urls(pages(spark, []), RULES).count() == 0


def test_hosts_of_any_form_are_linked(spark):
    hosts = ["example.net:8080", "10.0.0.1", "10.0.0.1:81", "a_b.example.org", "münchen.de", "x.xn--p1ai", "[::1]:80", "plain.org", "end.org"]
    links = "".join(f'<a href="HTTP://{h.upper() if h.isascii() else h}/p?q">x</a>' for h in hosts[:-2])
    read = [(h, None) for h in [*hosts, "example.net", "port.org"]]
    read += [("src.org", links + " see plain.org and http://end.org. Bye"), ("src.org", "<a href='//port.org'>x</a>"), ("src.org", "nothing")]
    got = url_graph.host_links(spark.createDataFrame(read, "host string, html string")).collect()
    assert {(r.src, r.dst): r.weight for r in got} == {("src.org", h): 1 for h in [*hosts, "port.org"]}


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    chain = spark.createDataFrame([(f"h{i + 1}", f"h{i}", 1) for i in range(30)], "src string, dst string, weight long")
    against = chain.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    seeds = spark.createDataFrame([("h0", 1000.0)], "host string, mass double")
    got = {r.host: r["rank"] for r in url_graph.propagate(against, seeds).collect()}
    first = 150 / (1 - 0.85**31)
    assert all(got[f"h{i}"] == pytest.approx(first * 0.85**i, abs=1) for i in range(31)) and got["h30"] > 1
    with pytest.raises(RuntimeError):
        url_graph.propagate(against, seeds, rounds=3)


def test_ranks_keep_their_mass(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(30), rng.randrange(30), rng.randint(1, 5)) for _ in range(80)]
    links = spark.createDataFrame([(f"h{a}", f"h{b}", w) for a, b, w in edges], "src string, dst string, weight long").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    seeds = spark.createDataFrame([("h1", 3.0), ("h2", 1.0)], "host string, mass double")
    got = {r.host: r["rank"] for r in url_graph.propagate(links, seeds, rounds=60).collect()}
    m = np.zeros((30, 30))
    for r in links.collect():
        m[int(r.dst[1:]), int(r.src[1:])] = r.weight
    m /= np.maximum(m.sum(axis=0), 1e-300)
    seed = np.zeros(30)
    seed[1], seed[2] = 3, 1
    rank = seed
    for _ in range(200):
        flow = 0.85 * m @ rank
        rank = flow + seed * (1 - flow.sum() / 4)
    assert sum(got.values()) == pytest.approx(4)
    assert np.allclose([got.get(f"h{i}", 0) for i in range(30)], rank, atol=4e-3)


def test_warc_round_trip(spark):
    html = "<html><head><title>T &amp; x</title><script>var a='</p>';</script></head><body><!-- <p>no --><p>One<b>two</b>&eacute;</p><a href='/l'>li\nnk</a><br>end</body>"
    rows = [(1, "http://a/x y", html), (2, None, "plain"), (3, "http://b/", None), (4, "http://c/", "<!-- open"), (4, "http://c/", "<!-- open"), (5, "http://d/", "<p>" * 50_000 + "\x00")]
    records = warc.responses(pages(spark, rows))
    got = warc.derivatives(records).collect()
    assert len(got) == 12
    first = {r.record_type: r for r in got if r.page_id == 1}
    source, block = warc.parse(next(r.record for r in records.collect() if r.page_id == 1))
    assert first["conversion"].block == "T & x\nOnetwoé\nli nk\nend"
    assert first["conversion"].refers_to == first["metadata"].refers_to == source["WARC-Record-ID"]
    assert first["conversion"].source_headers["WARC-Payload-Digest"] == source["WARC-Payload-Digest"] == warc.digest(html.encode())
    assert first["metadata"].headers["WARC-Concurrent-To"] == first["conversion"].record_id
    assert "http-content-type: text/html; charset=utf-8\r\n" in first["metadata"].block and "outlink: /l\r\n" in first["metadata"].block
    assert first["conversion"].headers["WARC-Block-Digest"] == warc.digest(first["conversion"].block.encode())
    assert [r.target_uri for r in got if r.page_id in (1, 2)] == ["http://a/x%20y"] * 2 + [None] * 2
    files = warc.write_warc(warc.derivatives(records)).collect()
    read = [x for f in files for x in warc.read_warc(f.path)]
    assert sorted((h["WARC-Record-ID"], b.decode()) for h, b in read) == sorted((r.record_id, r.block) for r in got)
    broken = spark.createDataFrame([(1, None), (2, b"junk")], "page_id long, record binary")
    assert [r.record_type for r in warc.derivatives(broken).collect()] == ["error"] * 2
    assert warc.derivatives(warc.responses(pages(spark, []))).count() == 0


def test_warc_bodies_are_decoded(spark):
    import gzip

    page = ("<title>t</title><p>é " + "words and words " * 9000 + "</p>").encode()
    raw = zlib.compressobj(wbits=-15)
    raw = raw.compress(page) + raw.flush()

    def chunked(data, size):
        parts = [data[i : i + size] for i in range(0, len(data), size)]
        return b"".join(b"%X;x=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"

    two = gzip.compress(page[:50]) + gzip.compress(page[50:])
    bodies = [
        ({}, page), ({"content-encoding": "GZIP"}, gzip.compress(page)), ({"Content-Encoding": "x-gzip"}, two), ({"Content-Encoding": "deflate"}, zlib.compress(page)),
        ({"Content-Encoding": "deflate"}, raw), ({"Transfer-Encoding": "chunked"}, chunked(page, 700)), ({"Transfer-Encoding": "gzip, chunked"}, chunked(gzip.compress(page), 100)),
        ({"Content-Encoding": "gzip", "Transfer-encoding": "Chunked"}, chunked(two, 33)), ({"Content-Encoding": "gzip, deflate"}, zlib.compress(gzip.compress(page))),
        ({"Content-Encoding": "gzip", "Transfer-Encoding": "chunked"}, page), ({"Content-Encoding": "identity"}, page), ({"Content-Encoding": "gzip"}, two + b"junk behind"),
    ]
    for http, body in bodies:
        assert warc.decoded(body, http) == page, http
    # Three lines of 9 bytes with sizes and two line ends are no data.
    assert warc.decoded(chunked(page, 700)[:2000], {"Transfer-Encoding": "chunked"}) == page[: 2000 - 3 * 9 - 2 * 2]
    assert page.startswith(cut := warc.decoded(gzip.compress(page)[:-30], {"Content-Encoding": "gzip"})) and len(cut) > 1000
    assert warc.decoded(b"", {"Content-Encoding": "gzip"}) == warc.decoded(gzip.compress(b""), {"Content-Encoding": "gzip"}) == b""
    for http, body, most in (({"Content-Encoding": "br"}, page, 10**9), ({"Content-Encoding": "gzip"}, gzip.compress(page), 1000)):
        with pytest.raises(ValueError):
            warc.decoded(body, http, most)

    def record(http, body):
        block = b"HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http.items()).encode() + b"\r\n" + body
        return warc.serialise({"WARC-Type": "response", "WARC-Record-ID": "<a>", "Content-Length": str(len(block))}, block)

    rows = [(i, record(*b)) for i, b in enumerate(bodies)] + [(99, record({"Content-Encoding": "br"}, page))]
    got = warc.derivatives(spark.createDataFrame(rows, "page_id long, record binary")).collect()
    texts = [r.block for r in got if r.record_type == "conversion"]
    assert len(texts) == len(bodies) and {t.removesuffix("junk behind") for t in texts} == {warc.plain_text(page.decode())}
    assert [(r.page_id, r.block) for r in got if r.record_type == "error"] == [(99, "unknown coding br")]


CHARACTERS = [*"abZsd09 .,'<|>\t\n\x0b\x0c\r\x1c\x85\xa0éÉßªº²µİſΣς́漢Ⅳẞ😀’`~#$", "'ll", "<|endoftext|>"]
TOKENS = st.lists(st.sampled_from(CHARACTERS), max_size=20).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TOKENS), min_size=1, max_size=5), st.sampled_from([10**8, 300]))
def test_piece_ids_equal_whole_texts(vocabulary, texts, memo):
    encoder = PieceEncoder(read_vocabulary(vocabulary), memo)
    assert encoder.in_pieces
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == encoder.whole.encode(t or "", add_special_tokens=False).ids


OTHER_RULES = [
    lambda v: v["normalizer"]["normalizers"].pop(),
    lambda v: v["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\S+"),
    lambda v: v["added_tokens"].append(v["added_tokens"][0] | {"id": 49408, "content": "the end"}),
]


@pytest.mark.parametrize("change", [None, *range(len(OTHER_RULES))])
def test_other_splitting_rules_are_given_whole_texts(vocabulary, change):
    """A vocabulary of another kind, and this one with a rule changed: the ids are those of the tokenizer itself."""
    import public_tokenizers
    from tokenizers import Tokenizer

    if change is None:
        source = read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    else:
        rules = json.loads(read_vocabulary(vocabulary))
        OTHER_RULES[change](rules)
        source = json.dumps(rules)
    encoder, whole = PieceEncoder(source), Tokenizer.from_str(source)
    texts = ["The end of it's 12 Days", None, "", "  two\n\n spaces\u3000ÉA the end", "x" * 5000]
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert not encoder.in_pieces
    for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == whole.encode(t or "", add_special_tokens=False).ids


def test_vocabulary_travels_as_a_value(make, vocabulary, tmp_path):
    """Its file may be gone when the tasks run."""
    from feedloom.llm import token_counts

    path = tmp_path / "words.json"
    path.write_text(read_vocabulary(vocabulary), encoding="utf-8")
    counts = token_counts.length_counts(make([(1, "one two"), (2, None)]), str(path))
    path.unlink()
    assert sorted(tuple(r) for r in counts.collect()) == [(1, 1), (3, 1)]


@pytest.mark.parametrize("operator", ["token_files", "token_counts"])
def test_one_encoder_a_worker(make, vocabulary, conf, tmp_path, monkeypatch, operator):
    """Tasks that a Python worker runs one after the other share its encoder; one a task left memory that did not come back."""
    from feedloom.llm import token_counts, token_ids

    made = tmp_path / "made"

    class Counted(PieceEncoder):
        def __init__(self, *args):
            super().__init__(*args)
            with made.open("a") as file:
                file.write(f"{os.getpid()}\n")

    for module in (token_ids, token_files, token_counts):
        monkeypatch.setattr(module, "PieceEncoder", Counted, raising=False)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "32")
    docs = make([(i, f"w{i} {i}") for i in range(400)])
    if operator == "token_files":
        assert token_files.write_token_files(docs, vocabulary).count() > 16
    else:
        assert token_counts.length_counts(docs.repartition(32, "doc_id"), vocabulary).agg(F.sum("n_docs")).first()[0] == 400
    workers = made.read_text().split()
    assert len(workers) == len(set(workers))


@pytest.mark.parametrize("length", [4, 2048])
def test_token_files_read_back(make, vocabulary, length):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    rows = [(i, text(rng, rng.randint(0, 300))) for i in rng.sample(range(500), 80)] + [(None, "null id"), (3000, None), (3001, ""), (3002, "z " * 20_000), (3003, "tie"), (3003, "tie"), (3003, "other tie")]
    manifest = token_files.write_token_files(make(rows), vocabulary, length=length)
    got = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(vocabulary)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*whole.encode(t or "", add_special_tokens=False).ids, 2])
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at
        assert (r.n_tokens, r.ids_crc32) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r.doc_id]]
        at += r.n_tokens
    files = [token_files.SequenceFile(f.path) for f in manifest.orderBy("part").collect()]
    for f, m in zip(files, manifest.orderBy("part").collect(), strict=True):
        assert len(f) == m.n_sequences and sum(f[i][1].true_count for i in range(len(f))) == m.n_tokens
        assert all(len(f[i][0]) == length for i in range(len(f)))
    view = files[0][0][0]
    assert not view.flags.owndata and not view.flags.writeable
    assert token_files.read_documents(token_files.write_token_files(make([]), vocabulary)).count() == 0


def test_pipeline_equals_brute_force(spark, tmp_path, vocabulary):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(7)
    rows = [(i, text(rng, rng.randint(20, 150)), rng.choice(["en", None]), rng.choice(["a", "b", None])) for i in range(80)]
    rows += [(100 + i, changed(rng, rows[i][1], 1), "en", "b") for i in range(20)] + [(200 + i, rows[i][1].upper(), "en", "a") for i in range(10)]
    passage = text(rng, 30)
    rows += [(300 + i, f"{text(rng, 60)} {passage} {text(rng, 5)}", "en", "c") for i in range(4)] + [(400, None, None, None), (401, "", "en", "a"), (402, "one two three " * 40, "en", "a")]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, [(0, passage)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [r for r in rows if not brute.base_failed(r[1])]
    best = brute.components([r[:2] for r in kept])
    kept = [r for r, b in zip(kept, best, strict=True) if r[0] == b and r[0] // 100 != 3]
    of = brute.rates([(r[3], len(brute.words(r[1]))) for r in kept])
    whole = Tokenizer.from_file(vocabulary)
    want = [len(whole.encode(r[1], add_special_tokens=False).ids) + 1 for r in sorted(kept) for _ in range(brute.copies(r[0], r[3], of))]
    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert [r.n_tokens for r in got] == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "source mix", "token files"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_shuffles_go_with_their_statement(make, spark):
    """Nothing that the statements of the join shuffled is left on disk when the last of them is done."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(f) for folder in disk.localDirsString() for f in Path(folder).rglob("shuffle_*.data")}

    setting = spark.conf.get(session._CLEANUP, None)
    docs, before = make(near_duplicates(random.Random(5))), files()
    judged = jaccard._judged(docs, jaccard.SHINGLE, jaccard.PERCENT)
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(session._CLEANUP, None) == setting
    assert judged.count() == judged.count() == docs.count()


def test_driver_of_the_join_holds_little(make, monkeypatch):
    """The token order is a byte a cell, and garbage is collected every few statements; links are those of brute force."""
    sizes, since, longest = [], [0], [0]
    send, write, tidy = jaccard._sent, jaccard.written, session.tidy

    def sending(spark, value):
        sizes.append(value.nbytes)
        return send(spark, value)

    def writing(df, label):
        since[0] += 1
        longest[0] = max(longest[0], since[0])
        return write(df, label)

    def tidying(spark):
        since[0] = 0
        tidy(spark)

    monkeypatch.setattr(jaccard, "_sent", sending)
    monkeypatch.setattr(jaccard, "written", writing)
    monkeypatch.setattr(jaccard, "tidy", tidying, raising=False)
    rows = near_duplicates(random.Random(4))
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(make(rows)).collect() if r.doc_id is not None}
    assert got == {name: c for (name, _), c in zip(rows, brute.components(rows), strict=True) if name is not None}
    assert max(sizes) <= jaccard.CELLS
    assert longest[0] <= 8
