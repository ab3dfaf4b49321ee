"""Scans on small files: separators, ragged rows, layouts, line order over many splits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import rows

from feedloom.sources import delimited, documents, fixed_width as fw, lake, sinks
from feedloom.sources.coerce import coerce, load_with_rejects
from feedloom.sources.jdbc import PartitionBounds, jdbc_options
from feedloom.sources.lines import first_lines, read_lines, with_line_order
from feedloom.types import ColumnSpec, FieldSpec


def test_first_separator_of_the_list_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a|b, c|d\n1|x, y|2\n")
    df = delimited.read_delimited(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["a", "b_c", "d"] and rows(df) == [("1", "x, y", "2")]


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"x ""y""\nz"\n2,w\n')
    assert rows(delimited.read_delimited(spark, str(tmp_path / "a.csv"))) == [("1", 'x "y"\nz'), ("2", "w")]


@pytest.mark.parametrize("split_bytes", ["60", "1000", "100m"])
def test_quoted_records_over_many_splits(spark, tmp_path, conf, split_bytes):
    """Records that run over several splits, doubled quotes, an empty line, a file without quotes."""
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    conf("spark.sql.files.openCostInBytes", "1")
    want = [(str(i), "\n".join(f"line {j} of ""{i}"" , x" if j % 2 else f'say "{j}"' for j in range(i % 9)) + "end") for i in range(200)]
    quoted = lambda t: '"' + t.replace('"', '""') + '"'
    (tmp_path / "a.csv").write_text("Id,The Text\n" + "".join(f"{i},{quoted(t)}\n" for i, t in want) + "\n")
    (tmp_path / "b.csv").write_text("Id,The Text\n900,plain\n901,\n")
    got = delimited.read_quoted_records(spark, str(tmp_path))
    assert got.columns == ["Id", "The_Text"]
    assert rows(got) == rows(spark.createDataFrame([*want, ("900", "plain"), ("901", None)], "a string, b string"))
    assert rows(got) == rows(delimited.read_delimited(spark, str(tmp_path)))


def test_ragged_rows_give_null(spark, tmp_path):
    (tmp_path / "a.txt").write_text("H|x\nD|1|2|3\nD|4\nT|2\n")
    cols = [ColumnSpec("a"), ColumnSpec("unused"), ColumnSpec("c")]
    got = delimited.parse_ordinal(read_lines(spark, str(tmp_path / "a.txt")), cols, "|", "D|")
    assert rows(got) == [("1", "3"), ("4", None)]


def test_quoted_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text('"*BOF*",x\n"a, b",,  "c"  ,d\n"*EOF*",x\n')
    cols = [ColumnSpec(n) for n in "wxyz"]
    assert rows(delimited.parse_quoted(read_lines(spark, str(tmp_path / "a.txt")), cols)) == [("a, b", "", "c", "d")]


def test_layouts_are_checked():
    with pytest.raises(ValueError, match="bad position"):
        fw.layout_from_positions([{"field_name": "a", "position": "009-003"}])
    with pytest.raises(ValueError, match="repeats"):
        fw.layout_from_positions([{"field_name": "a", "position": "001-003"}, {"field_name": "A", "position": "004"}])
    with pytest.raises(ValueError, match="repeats"):
        fw.layout_from_segments([{"field_name": "a", "position_start": "1", "position_end": "2", "record_segment": "1"}] * 2)
    got = fw.layout_from_pictures([{"business_name": "Fee Amt", "source_field_start_pos": 3, "source_field_end_pos": 9, "source_field_pic": "9(5)V99"}])
    assert got == [FieldSpec("fee_amt", 3, 7, 2)]
    assert fw.layout_from_positions([{"field_name": "Filler", "position": "001-002"}]) == []


def test_condition_is_matched_exactly(spark, tmp_path):
    """One condition's text contains the other's: each row must get its own layout only."""
    (tmp_path / "a.txt").write_text("US12345     \nDEABCDEFGHIJ\n")
    home, away = "US or Canada addresses only", "Non-US or Canada addresses only"
    layout = fw.layout_from_positions(
        {"field_name": n, "position": p, "conditional_changes": c}
        for n, p, c in [("country", "001-002", ""), ("zip", "003-007", home), ("code", "003-012", away)]
    )
    got = fw.parse_conditional(read_lines(spark, str(tmp_path / "a.txt")), layout, "country", {home: ["US", "CA"]}, otherwise=away)
    assert rows(got) == [("DE", None, "ABCDEFGHIJ"), ("US", "12345", None)]


@pytest.mark.parametrize("split_bytes", ["700", "4096", "100m"])
def test_line_order_does_not_depend_on_splits(spark, tmp_path, conf, split_bytes):
    """Two files of unequal size, one line group that spans many splits, lines before the first start."""
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    conf("spark.sql.files.openCostInBytes", "1")
    want = {}
    for name, count in (("big.txt", 6000), ("small.txt", 7)):
        text = [("S" if i % 3 == 2 and not 2000 < i < 4000 else "x") + f" {name} {i:05d}" for i in range(count)]
        (tmp_path / name).write_text("\n".join(text) + "\n")
        entity, start = 0, 1
        for i, line in enumerate(text, 1):
            if line.startswith("S"):
                entity, start = entity + 1, i
            want[line] = (i, entity, start)
    lines = read_lines(spark, str(tmp_path))
    assert split_bytes != "700" or lines.rdd.getNumPartitions() > 50
    got = with_line_order(lines, F.col("value").startswith("S")).collect()
    assert {r.value: (r.line_no, r.entity_no, r.entity_start) for r in got} == want and len(got) == len(want)
    plain = with_line_order(lines).collect()
    assert {r.value: r.line_no for r in plain} == {k: v[0] for k, v in want.items()}
    assert sorted(r.value[2:] for r in first_lines(lines).collect()) == ["big.txt 00000", "small.txt 00000"]


def test_repeated_lines_keep_their_numbers(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "500")
    conf("spark.sql.files.openCostInBytes", "1")
    (tmp_path / "a.txt").write_text("same\n" * 3000)
    got = with_line_order(read_lines(spark, str(tmp_path / "a.txt")))
    assert sorted(r.line_no for r in got.collect()) == list(range(1, 3001))


def test_coerce(spark):
    df = spark.createDataFrame([("21.0", "20200229", "1", "x"), ("abc", "2020-02-30", "maybe", "1.5"), (None, "2020-02-28", "FALSE", " 7 ")], "A string, B string, C string, D string")
    got = coerce(df, {"A": "int", "B": "date", "C": "bit", "D": "decimal"})
    assert got.columns == ["a", "b", "c", "d"]
    assert [(r.a, str(r.b), r.c, None if r.d is None else float(r.d)) for r in got.collect()] == [(21, "2020-02-29", True, None), (None, "None", None, 1.5), (None, "2020-02-28", False, 7.0)]


def test_rejects_name_the_first_bad_column(spark):
    df = spark.createDataFrame([("f", "1", "2020-01-01"), ("f", "x", "y"), ("f", "", None)], "file string, n string, d string")
    good, bad = load_with_rejects(df, {"n": "int", "d": "date"})
    assert good.count() == 2
    r = bad.first()
    assert (r.error, r.column_name, r.column_text, r.failed_columns, r.rejected_record) == ("not a int", "n", "x", 2, '{"n":"x","d":"y"}')


def test_jdbc_options():
    bounds = PartitionBounds("id", 0, 1000, 8)
    assert jdbc_options("jdbc:x", table="t") == {"url": "jdbc:x", "dbtable": "t"}
    assert jdbc_options("jdbc:x", query="select 1") == {"url": "jdbc:x", "query": "select 1"}
    got = jdbc_options("jdbc:x", query="select id from t", bounds=bounds, extra={"fetchsize": "1000"})
    assert got == {"url": "jdbc:x", "fetchsize": "1000", "dbtable": "(select id from t) bounded", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_multi_line_json_and_parallel_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"symbol": "X",\n "timestamp": [0, 86400],\n "close": [1.5, null]}')
    df = documents.read_json_docs(spark, str(tmp_path / "a.json"), "symbol string, timestamp array<bigint>, close array<double>")
    out = documents.parallel_arrays_to_rows(df, ["timestamp", "close"], ["symbol"])
    day = F.timestamp_seconds("timestamp").cast("date").cast("string")
    assert rows(out.select("symbol", day, "close")) == [("X", "1970-01-01", 1.5), ("X", "1970-01-02", None)]


def test_versions(spark, tmp_path):
    v = lake.TableVersions(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        v.read()
    assert [v.write(spark.range(n)) for n in (1, 2)] == [0, 1]
    (tmp_path / "t" / "v=7").mkdir()
    assert v.versions() == [0, 1] and v.read().count() == 2 and v.read(0).count() == 1


def test_lake_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda v, p: spark.createDataFrame([(v, p)], "V int, elt_partition_date string")
    lake.write_lake(frame(1, "a"), path)
    lake.write_lake(frame(2, "b"), path)
    lake.write_lake(frame(3, "b"), path)
    assert rows(lake.read_lake(spark, path).select("v", "elt_partition_date")) == [(1, "a"), (3, "b")]
    assert rows(lake.latest_partition(lake.read_lake(spark, path)).select("v")) == [(3,)]
    lake.write_lake(frame(4, None), path)
    assert rows(lake.read_latest_partition(spark, path, kind="string").select("v", "elt_partition_date")) == [(3, "b")]
    assert lake.read_latest_partition(spark, path, kind="date").isEmpty()


def test_extract_names():
    at = dt.datetime(2024, 1, 31)
    assert sinks.extract_name("x", "yyyymmdd", at) == "x_20240131.csv" and sinks.extract_name("x", "", at, "txt") == "x.txt"


def test_bounded_files_hold_whole_entities(spark, tmp_path):
    df = spark.createDataFrame([(e, i) for e in range(1, 8) for i in range(e)], "entity_no bigint, i int")
    chunks = sinks.chunked(df, "entity_no", 3)
    line = F.concat_ws("-", F.col("record_in_chunk").cast("string"), F.col("i").cast("string"))
    body = sinks.bounded_lines(chunks, line, ["record_in_chunk", "i"], F.lit("HEAD"), F.concat(F.lit("T"), F.col("records").cast("string")))
    manifest = sinks.write_bounded(body, str(tmp_path / "out"))
    files = {p.name: p.read_text().split() for p in (tmp_path / "out").glob("chunk=*.txt")}
    assert files["chunk=0.txt"] == ["HEAD", "1-0", "2-0", "2-1", "3-0", "3-1", "3-2", "T3"]
    assert files["chunk=2.txt"] == ["HEAD", *[f"1-{i}" for i in range(7)], "T1"]
    assert sorted((r.chunk, r.path.rsplit("/", 1)[1], r.n_lines) for r in manifest.collect()) == [(c, f"chunk={c}.txt", len(files[f"chunk={c}.txt"])) for c in range(3)]


def test_many_bounded_files_take_one_folder_and_few_tasks(spark, tmp_path):
    lines = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("a/"), (F.col("id") % 3).cast("string"))).alias("kind"), F.floor(F.col("id") / 20).alias("chunk"), F.lit(1).alias("place"), "id",
        F.when(F.col("id") != 77, F.concat(F.lit("é"), F.col("id").cast("string"))).alias("value"),
    ).withColumnRenamed("id", "at")
    out = tmp_path / "out"
    (out / "old").mkdir(parents=True)
    (out / "old.txt").write_text("left")
    for _ in range(2):
        manifest = sinks.write_bounded(lines, str(out), keys=["kind"])
        found = [p for p in out.iterdir() if not p.name.startswith(".")]
        assert len(found) == 900 == manifest.count() and all(p.is_file() for p in found)
    assert manifest.rdd.getNumPartitions() <= 16
    assert (out / "kind=a%2F2.chunk=3.txt").read_text().split("\n") == [*[f"é{i}" if i != 77 else "" for i in range(60, 80) if i % 3 == 2], ""]
    assert (out / "kind=__HIVE_DEFAULT_PARTITION__.chunk=0.txt").read_text().split() == [f"é{i}" for i in range(0, 20, 3)]
    assert sinks.write_bounded(lines.where("false"), str(out), keys=["kind"]).count() == 0 and not list(out.glob("*.txt"))


def test_undated_names_take_the_time_of_the_file(spark):
    from feedloom.sources.file_meta import DIALECTS, file_name_meta

    df = spark.sql("SELECT * FROM VALUES ('in/Some Feed.TXT', timestamp'2024-01-31 10:00:00'), ('other.xml', timestamp'2024-01-31 10:00:00') AS t(f, at)")
    got = file_name_meta(df, F.col("f"), DIALECTS["undated"], [".txt", "csv"], F.col("at")).select("table_name", F.col("key_datetime").cast("string")).collect()
    assert [tuple(r) for r in got] == [("some feed", "2024-01-31 10:00:00"), (None, None)]


def test_separator_behind_a_long_first_name(spark, tmp_path):
    from feedloom.sources.delimited import read_delimited

    (tmp_path / "a.csv").write_text("x" * 5100 + "|b,c\n1|2\n")
    assert read_delimited(spark, str(tmp_path / "a.csv")).columns[1] == "b_c"


def test_null_lines_are_bad_lines(spark):
    from feedloom.sources.lines import split_by_delimiter_count

    good, bad = split_by_delimiter_count(spark.createDataFrame([("a|b",), (None,), ("a",)], "value string"), "|", 1)
    assert good.count() == 1 and bad.count() == 2


def test_xml_is_split_at_rows(spark, tmp_path, conf):
    rows_in = [f'<row key="{i}"><name> n{i}&amp;x </name>\r\n<t/></row>' if i % 7 else f'<row key="{i}"/>' for i in range(5000)]
    (tmp_path / "a.xml").write_text('<rows><head of="h"><x>1</x></head>\n' + "\n".join(rows_in) + "\n</rows>\n")
    conf("spark.sql.files.maxPartitionBytes", "65536")
    pieces = documents.xml_pieces(spark, str(tmp_path / "a.xml"), "row")
    got = documents.xml_rows(pieces, "row", "_key int, name string")
    assert got.rdd.getNumPartitions() >= 3
    assert sorted((r._key, r.name) for r in got.collect()) == [(i, f"n{i}&x" if i % 7 else None) for i in range(5000)]
    assert [(r._of, r.x) for r in documents.xml_elements(pieces, "head", "_of string, x int").collect()] == [("h", 1)]
    whole = documents.read_xml(spark, str(tmp_path / "a.xml"), "row", "_key int, name string")
    assert rows(got.drop("file_path")) == rows(whole)


def test_xml_rows_closed_with_blanks(spark, tmp_path, conf):
    texts = ['<row key="1"><name>a</name></row >', '<row key="2"/>', '<row key="3"><name>b</name></row\n>\n', '<row key="4"><name>c</name></row>', '<row key="5"><rowid>7</rowid></row >']
    (tmp_path / "a.xml").write_text("<rows>" + "".join(texts * 400) + '<row key="6"><name>never closed<row key="7"><name>d</name></row></rows>')
    conf("spark.sql.files.maxPartitionBytes", "8192")
    pieces = documents.xml_pieces(spark, str(tmp_path), "row")
    got = documents.xml_rows(pieces, "row", "_key int, name string, rowid int").drop("file_path")
    assert rows(got) == sorted([(1, "a", None), (2, None, None), (3, "b", None), (4, "c", None), (5, None, 7)] * 400, key=lambda r: tuple(map(str, r)))
    (left,) = documents.xml_rejects(pieces, "row").collect()
    assert left.xml.startswith('<row key="6">') and left.file_path.endswith("a.xml")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_ends_in_quotes_stay(spark, tmp_path, conf, end):
    values = ["p\rq", "p\nq", "plain", "", "\rp", "a\r\rb"]
    body = "".join(f'{i},"{v}"{end}' for i, v in enumerate(values * 50))
    (tmp_path / "a.csv").write_bytes(f"id,v{end}{body}".encode())
    conf("spark.sql.files.maxPartitionBytes", "256")
    got = rows(delimited.read_quoted_records(spark, str(tmp_path)))
    assert got == rows(delimited.read_delimited(spark, str(tmp_path)))
    assert ("0", "p\rq") in got and len(got) == 300


def test_stray_quotes_cost_their_own_lines(spark, tmp_path, conf):
    """Quotes within a field are text; one that opens a field for good is a reject, alone, and all else is read."""
    conf("spark.sql.files.maxPartitionBytes", "300")
    good = [f'{i},"a ""{i}""\nb, c",z' if i % 3 else f"{i},plain,z" for i in range(300)]
    stray = {40: 'x1,"open,z', 41: 'x2,5" pipe,z', 200: 'x3,"again,z', 299: '"end,y,z'}
    (tmp_path / "a.csv").write_text("id,v,w\n" + "".join(f"{g}\n{stray[i]}\n" if i in stray else f"{g}\n" for i, g in enumerate(good)))
    got, rejects = delimited.read_quoted(spark, str(tmp_path))
    want = [(str(i), f'a "{i}"\nb, c' if i % 3 else "plain", "z") for i in range(300)]
    assert rows(got) == sorted([*want, ("x2", '5" pipe', "z")])
    assert sorted(r.value for r in rejects.collect()) == sorted([stray[40], stray[200], stray[299]])
    whole = (tmp_path / "a.csv").read_text().split("\n")
    assert all(whole[r.line_no - 1] == r.value for r in rejects.collect())


def line_states(lines, width, longest):
    """The rule of quoted records, one line after the other: (first line of the record, broken) of every line."""
    import re

    events = []
    for n, line in enumerate(lines):
        single = line.replace('""', "")
        if single.count('"') % 2:
            opens, closes = re.search(r'(^|,)"[^"]*$', single), re.match(r'[^"]*"[ \t\r]*(,|$)', single)
            if opens or closes:
                events.append([n, bool(opens), bool(closes)])
    out, open_at, at = [(n, False) for n in range(len(lines))], None, 0
    while at < len(events):
        n, opens, closes = events[at]
        near = at > 0 and n - events[at - 1][0] <= longest
        inside = open_at is not None and near
        if opens and not (closes and inside):
            last = events[at + 1] if at + 1 < len(events) else None
            ended = last and last[2] and last[0] - n <= longest
            for i in range(n, last[0] if last else len(lines)):
                bare = re.sub(r'"[^"]*"', "", lines[i])
                if not ended and i > n and bare.count(",") == width - 1 and '"' not in bare:
                    break
                out[i] = (n, not ended)
            open_at = n
        else:
            if inside:
                out[n] = (open_at, False)
            open_at = None
        at += 1
    return out


@pytest.mark.parametrize("longest", [3, 1000])
def test_quoted_records_equal_the_rule_line_by_line(spark, tmp_path, conf, longest):
    import random

    from feedloom.sources.lines import with_quoted_records

    rng = random.Random(longest)
    kinds = ['a,"b', 'c",d', '"', ',"', '",', "x,y", "text", 'q"r,s', '"a","b"', '"a",""', 'e"",f', '"""g,', 'h"""', "", '",i,"j', 'k","l","']
    conf("spark.sql.files.maxPartitionBytes", "40")
    conf("spark.sql.files.openCostInBytes", "1")
    files = {f"{i}.csv": rng.choices(kinds, [rng.random() ** 3 for _ in kinds], k=120) for i in range(25)}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    got = {}
    for r in with_quoted_records(read_lines(spark, str(tmp_path), record_sep="\n"), 2, longest=longest).collect():
        got.setdefault(r.file_path.rsplit("/", 1)[1], {})[r.line_no - 1] = (r.record_start - 1, r.is_broken)
        assert r.is_whole or r.is_broken or r.record_start <= r.line_no
    for name, lines in files.items():
        assert [got[name][n] for n in range(len(lines))] == line_states(lines, 2, longest), name
