"""Hot keys, long groups and plans: what must hold when one key has a third of the rows."""

import hashlib

import pytest
from pyspark.sql import Window, functions as F
from support import SF, rows

from feedloom.operators import nested, quality, ranking, records, relational, state
from feedloom.plans import feed_queries, feeds
from feedloom.plans.registry import table
from feedloom.plans.state_queries import order_changes, order_target
from feedloom.sources.fixed_width import FieldSpec, attach_header
from feedloom.sources.lines import first_lines, read_lines, with_line_order
from feedloom.streaming import streams


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    return spark.range(3000).select("id", key.alias("k"), (F.col("id") * 7 % 11).alias("v"))


def test_running_total_of_a_hot_key(hot):
    got = ranking.running_total(hot.withColumn("b", F.floor(F.col("id") / 100)), ["k"], "b", ["id"], F.col("v"), "s")
    want = hot.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(got.select("id", "s")) == rows(want.select("id", "s"))


def test_numbers_of_a_table_come_from_ranges_of_like_size(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    # a third of the rows share the first column, the rest grows by powers
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pow(F.lit(1.01), F.col("id"))).alias("a"), "id")
    got = [tuple(r) for r in ranking.table_numbers(df.repartition(5), ["a", "id"], "no").collect()]
    assert sorted(got) == [(*r, i) for i, r in enumerate(sorted(tuple(r) for r in df.collect()), 1)]
    assert ranking.table_numbers(df.limit(0), ["a", "id"], "no").isEmpty()
    sizes = [r["count"] for r in df.repartitionByRange("a", "id").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * min(sizes)


def test_collected_parts_are_bounded_and_whole(hot):
    docs = relational.collect_records(hot, ["k"], {"items": F.lit(True)}, ["id"], ["v"], max_children=100).cache()
    assert rows(docs.select("k", F.inline("items"))) == rows(hot.select("k", "id", "v"))
    sizes = {(r.k, r.part_no): r.n for r in docs.select("k", "part_no", F.size("items").alias("n")).collect()}
    hot_parts = sorted(p for k, p in sizes if k == 0)
    assert hot_parts == list(range(len(hot_parts))) and len(hot_parts) >= 10
    assert all(n == 100 for (k, p), n in sizes.items() if k == 0 and p < hot_parts[-1]) and max(sizes.values()) <= 100
    assert all(p == 0 for k, p in sizes if k != 0)
    edges = sorted((r.part_no, r.low, r.high) for r in docs.where("k = 0").select("part_no", F.array_min("items.id").alias("low"), F.array_max("items.id").alias("high")).collect())
    assert all(a[2] < b[1] for a, b in zip(edges, edges[1:], strict=False))


def test_rows_without_a_key_do_not_meet_in_one_task(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    key = F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, F.lit("N/A"))).otherwise(F.col("id").cast("string"))
    target = spark.range(9000).select(
        key.alias("elt_integration_id"), F.col("id").cast("string").alias("v"), F.lit("h").alias("elt_columns_hash"),
        F.lit("FULL").alias("elt_load_type"), F.lit("1").alias("elt_execution_date"), F.lit(0).alias("elt_delete_ind"),
    )
    changes = target.where("v % 7 = 1").withColumns({"elt_columns_hash": F.lit("g"), "elt_stream_action": F.lit("INSERT"), "elt_execution_date": F.lit("2")})
    merged = state.upsert(target, changes)
    got = {r.v: (r.elt_columns_hash, r.elt_execution_date) for r in merged.collect()}
    assert len(got) == merged.count() == 9000
    assert all(h == (("g", "2") if int(v) % 7 == 1 and int(v) % 3 else ("h", "1")) for v, h in got.items())
    unkeyed = target.withColumn("elt_integration_id", F.nullif("elt_integration_id", F.lit("N/A")))
    deleted = state.soft_delete(unkeyed, changes, "elt_integration_id")
    assert deleted.count() == 9000 and deleted.where("elt_delete_ind = 1 AND elt_integration_id IS NULL").isEmpty()
    for out in (merged, deleted):
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect() if r["count"] > 100)
        assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_segments_of_a_long_entity_are_joined_in_blocks(spark):
    field = lambda name, segment, start, length: FieldSpec(name=name, record="", segment=segment, start=start, length=length)
    layout = [field("one", "1", 2, 3), field("two", "2", 2, 3), field("both", "1", 5, 1), field("both", "2", 5, 1), field("none", "3", 2, 3)]
    entity = F.when(F.col("id") < 1000, 0).otherwise(F.floor(F.col("id") / 10))
    lines = spark.range(3000).select(
        F.lit("f").alias("file_path"), entity.cast("long").alias("entity_no"), F.col("id").alias("line_no"),
        F.concat(F.when(F.col("id") % 10 == 0, "1").when(F.col("id") % 10 == 9, "9").otherwise("2"), F.lpad((F.col("id") % 1000).cast("string"), 3, "0"), F.lit("x")).alias("value"),
    ).repartition(7)
    segment = F.substring("value", 1, 1)
    want = rows(records.merge_segments(lines, layout, segment, fan_out=10**9))
    assert rows(records.merge_segments(lines, layout, segment, fan_out=16)) == want and len(want) == 201
    longest = next(r for r in want if r[1] == 0)
    body = [f"{i:03d}" for i in range(1000)]
    assert longest[2:] == ("".join(body[::10]), "".join(b for b in body if b[2] not in "09"), "x" * 900, None)


def test_ordinary_keys_are_collected_in_one_pass(spark, tmp_path):
    rows_ = [(None, "a", i) for i in range(5)] + [("a", None, i) for i in range(5)] + [("", "a", 9)]
    spark.createDataFrame(rows_, "k string, l string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plain = relational.collect_records(df, ["k", "l"], {"items": F.lit(True)}, ["v"], [], max_children=10)
    assert plan(plain).split("== Initial Plan ==")[0].count("FileScan") == 1 and {r.part_no for r in plain.collect()} == {0}
    # null keys are told apart in parts too, whether or not their hashes are
    parts = relational.collect_records(df, ["k", "l"], {"items": F.lit(True)}, ["v"], [], max_children=4)
    assert {(r.k, r.l, r.part_no): len(r["items"]) for r in parts.collect()} == {
        (None, "a", 0): 4, (None, "a", 1): 1, ("a", None, 0): 4, ("a", None, 1): 1, ("", "a", 0): 1,
    }
    empty = relational.collect_records(df.limit(0), ["k", "l"], {"items": F.lit(True)}, ["v"], [])
    assert empty.columns == ["k", "l", "part_no", "items"] and empty.isEmpty()


def test_newest_rows_are_trimmed_before_the_shuffle(hot):
    text = plan(ranking.newest_per_group(hot, ["k"], [F.col("id").desc()]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_documents_in_parts(spark):
    whole, _ = feed_queries.account_documents(spark, SF)
    parts, _ = feed_queries.account_documents(spark, SF, max_lines=5)
    flat = lambda d: rows(d.select("account_number", "ffr_name_count", F.inline("addresses")))
    assert flat(whole) == flat(parts) and parts.where("part_no > 0").count() > 50
    assert parts.where(F.size("addresses") > 5).isEmpty()
    assert whole.where("part_no > 0").isEmpty()


@pytest.mark.parametrize("fan_out", [2, 3, 1000])
def test_entity_hash_is_a_tree_over_positions(spark, tmp_path, fan_out):
    entities = [[f"S{i}"] + [f"x{i}.{j}" for j in range(n)] for i, n in enumerate((0, 1, 2, 3, 8, 27, 40))]
    (tmp_path / "a.txt").write_text("\n".join(sum(entities, [])) + "\n")

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    def tree(lines):
        level = [sha(x) for x in lines]
        for _ in range(2):
            level = [sha("".join(h)) for h in _cut(level)]
        return sha("".join(level))

    def _cut(items):
        return [items[i : i + fan_out] for i in range(0, len(items), fan_out)]

    lines = with_line_order(read_lines(spark, str(tmp_path / "a.txt")), F.col("value").startswith("S"))
    got = {r.entity_no: (r.line_count, r.entity_id) for r in records.entity_hash(lines, fan_out=fan_out).collect()}
    assert got == {i: (len(e), tree(e)) for i, e in enumerate(entities, 1)}


def test_reconcile_with_itself_is_a_match(spark):
    l = table(spark, SF, "lineitem")
    r = quality.reconcile(l, l, ["l_orderkey", "l_linenumber"])
    assert r.missing.isEmpty() and r.mismatches.isEmpty()
    assert r.summary.first().status == "MATCH"


def test_reconcile_cases(spark):
    f = lambda *r: spark.createDataFrame(list(r), "k string, v int, w string")
    none = f(("a", 1, "x")).limit(0)
    status = lambda s, t: quality.reconcile(s, t, ["K"]).summary.first().status
    assert [status(none, none), status(none, f(("a", 1, "x"))), status(f(("a", 1, "x")), none)] == ["BOTH_EMPTY", "SOURCE_EMPTY", "TARGET_EMPTY"]
    s, t = f(("a", 1, "x"), (None, 1, "x"), ("b", None, "x"), ("d", 1, "p"), ("d", 1, "q")), f(("a", 1, "y"), (None, 1, "x"), ("b", 2, "x"), ("c", 1, "x"), ("d", 1, "q"), ("d", 1, "r"))
    r = quality.reconcile(s, t, ["k"])
    assert sorted(rows(r.mismatches), key=str) == sorted([("a", "w", "x", "y", 1), ("b", "v", None, "2", 1), ("d", "w", "p", None, 1), ("d", "w", None, "r", 1)], key=str)
    assert rows(r.missing) == [("c", "source", 1)]
    wide = t.withColumn("v", F.col("v").cast("decimal(10,2)"))
    assert rows(quality.reconcile(t, wide, ["k"]).mismatches) == []
    with pytest.raises(ValueError, match="not on both sides"):
        quality.reconcile(s, t, ["nope"])


def test_reconcile_of_a_hot_key_stays_linear(spark):
    s = spark.range(20000).select(F.when(F.col("id") < 10000, 0).otherwise(F.col("id")).alias("k"), "id")
    r = quality.reconcile(s, s.withColumn("id", F.when(F.col("id") == 5, -5).otherwise(F.col("id"))), ["k"])
    assert rows(r.mismatches) == [(0, "id", "5", None, 1), (0, "id", None, "-5", 1)]


def test_no_single_task_sorts_everything(spark):
    upserted = plan(state.upsert(order_target(spark, SF), order_changes(spark, SF)))
    compared = plan(quality.reconcile(table(spark, SF, "orders"), table(spark, SF, "orders"), ["o_orderkey"]).mismatches)
    lines = plan(with_line_order(read_lines(spark, feed_queries.feeds.order_feed(spark, SF)), F.col("value").startswith("OR")))
    for text in (upserted, compared, lines):
        assert "SinglePartition" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_bucketed_target_is_not_shuffled(spark, conf):
    """Without broadcasts: every exchange below the join belongs to the changes."""
    from feedloom.plans.state_queries import upsert_bucketed

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(upsert_bucketed(spark, SF).drop("x"))
    final = text.split("Initial Plan")[0]
    scans = [i for i, line in enumerate(final.splitlines()) if "Bucketed: true" in line]
    assert len(scans) == 2 and "SelectedBucketsCount: 16 out of 16" in final
    lines = final.splitlines()
    for i in scans:
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        above = []
        for line in reversed(lines[:i]):
            d = len(line) - len(line.lstrip(" :+-"))
            if d < depth:
                depth = d
                above.append(line)
            if "Join" in line and above and above[-1] is line:
                break
        assert "Join" in above[-1] and not any("Exchange" in line for line in above)


def test_filters_and_columns_reach_the_scan(spark):
    from feedloom.sources.lake import select_from_config

    text = plan(select_from_config(table(spark, SF, "customer"), "c_custkey", "c_mktsegment = 'BUILDING'"))
    assert "EqualTo(c_mktsegment,BUILDING)" in text and "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text


def test_flatten_rules(spark):
    df = spark.createDataFrame([(1, ("a", ("x",)), [("p", 1), ("q", 2)]), (2, ("b", ("y",)), [])], "id int, s struct<n: string, t: struct<_code: string>>, items array<struct<k: string, v: int>>")
    flat = nested.flatten(df)
    assert flat.columns == ["id", "s_n", "s_t_code", "items_k", "items_v"]
    assert rows(flat) == [(1, "a", "x", "p", 1), (1, "a", "x", "q", 2)]
    assert rows(nested.flatten(df, outer=True))[-1] == (2, "b", "y", None, None)


def test_key_discovery_finds_all(spark):
    many = "{" + ", ".join(f'"k{i}": {i}' for i in range(1500)) + "}"
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('[{"c": 3}]',), (many,)], "doc string")
    assert nested.json_keys(df, "doc") == sorted(["a", "b", "c", *[f"k{i}" for i in range(1500)]])


def test_name_slots(spark, tmp_path):
    layout = feed_queries.feeds.RECORD_LAYOUT["102"]
    line = lambda *slots: "D102F001000000001" + "02" + "".join(f"{t}{n:<12}{s:<9}" for t, n, s in slots)
    df = spark.createDataFrame([(line(("B", "ACME", "123456789"), ("P", "JO", "987654321"), ("P", "", "")),)], "value string")
    got = df.select(F.inline(records.name_slots(layout, "_ffr_name_type", ["_ffr_primary_acct_name", "_ffr_ssn_number"])))
    assert [tuple(r) for r in got.collect()] == [("B", "ACME", None), ("P", "JO", "987654321")]


def test_ambiguous_prefix(spark):
    files = spark.createDataFrame([("X_abc_1.csv",), ("x_abcd_1.csv",), ("zzz",)], "file_name string")
    inventory = spark.createDataFrame([("ABC", "l1"), ("abcd", "l2")], "prefix string, location string")
    got = quality.prefix_match(files, inventory).select("file_name", "prefix", "match_status")
    assert rows(got) == [("X_abc_1.csv", "ABC", "MATCHED"), ("x_abcd_1.csv", "ABC", "AMBIGUOUS"), ("zzz", None, "UNKNOWN")]


def _feed_tables(spark, path):
    """Orders, one twice and one without a key, and items: some without an order, some without a key."""
    day = "timestamp '1996-01-02 00:00:00'"
    spark.sql(f"SELECT cast(k AS bigint) AS o_orderkey, k * 10 AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority FROM VALUES (1), (2), (2), (5000), (null) AS t(k)").write.parquet(f"{path}/orders.parquet")
    spark.sql(f"SELECT cast(k AS bigint) AS l_orderkey, 7L AS l_partkey, 8L AS l_suppkey, n AS l_linenumber, 1D AS l_quantity, 2D AS l_extendedprice, 0D AS l_discount, 0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, {day} AS l_shipdate FROM VALUES (1, 1), (1, 2), (2, 1), (3, 1), (5000, 1), (9999, 1), (null, 1) AS t(k, n)").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _tables_by_sql(spark, sf):
    """The same lines by a semi-join: (order_key, kind, value)."""
    o = table(spark, sf, "orders").selectExpr("o_orderkey k", "'A' kind", f"{feeds.ORDER_LINE} value")
    l = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey"), "left_semi")
    return o.unionByName(l.selectExpr("l_orderkey k", "'B' kind", f"{feeds.ITEM_LINE} value"))


def test_order_feed_holds_the_lines_of_known_orders(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf = _feed_tables(spark, tmp_path)
    got = spark.read.text(feeds.write_order_feed(spark, sf)).where("not startswith(value, 'BOF') and not startswith(value, 'EOF')")
    # A line without a key is an empty one, its chunk's header too.
    assert rows(got.where("value != ''")) == rows(_tables_by_sql(spark, sf).where("value is not null").select("value"))
    trailers = spark.read.text(feeds.write_order_feed(spark, sf)).where("startswith(value, 'EOF')").selectExpr("cast(substring(value, 19, 10) as int)")
    assert rows(trailers) == [(1,), (2,), (6,)]


def _shuffled_columns(df):
    return [line for line in plan(df).split("== Initial Plan ==")[0].splitlines() if " Exchange " in line]


def test_items_are_shuffled_once_for_a_feed(spark, tmp_path, conf):
    """However many orders there are: no join tells which items are known."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf = _feed_tables(spark, tmp_path)
    seen = []
    real = feeds.write_bounded

    def spy(lines, path, keys=(), having=None):
        seen.append(lines._jdf.queryExecution().executedPlan().toString())
        return real(lines, path, keys, having)

    feeds.write_bounded = spy
    try:
        feeds.write_order_feed(spark, sf)
    finally:
        feeds.write_bounded = real
    # The one exchange is that of the chunks' counts, which are written already.
    assert len(seen) == 1 and "Join" not in seen[0] and seen[0].count("Exchange") == 1


def test_segments_hold_the_lines_of_known_orders(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf = _feed_tables(spark, tmp_path)
    got = spark.read.text(feed_queries.write_segments(spark, sf)).selectExpr("substring(value, 1, 1) s", "try_cast(substring(value, 2, 12) as int) k")
    assert rows(got.where("k is not null")) == sorted([("1", 1), ("1", 2), ("1", 2), ("1", 5000), ("2", 1), ("3", 1), ("2", 2), ("2", 5000)], key=lambda r: (r[0], str(r[1])))


def test_lines_are_numbered_and_joined_to_headers_without_a_shuffle(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text("".join(f"{i}.{j}\n" for j in range(50)))
    lines = read_lines(spark, str(tmp_path))
    numbered = with_line_order(lines)
    assert not _shuffled_columns(numbered)
    assert rows(numbered.select("value", "line_no")) == sorted(((f"{i}.{j}", j + 1) for i in range(3) for j in range(50)), key=lambda r: (r[0], str(r[1])))
    headed = attach_header(lines, first_lines(lines), [F.col("value").alias("head")])
    assert not _shuffled_columns(headed) and headed.where("head = concat(substring(value, 1, 1), '.0')").count() == 150


def test_steps_are_replayed_in_order_by_many_tasks(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.concat(F.lit("d"), (F.col("id") % 3).cast("string"))).alias("step"))
    streams.replay_files(df, str(tmp_path / "s"), "step", rows_per_file=100)
    files = sorted((p.stat().st_mtime_ns, p.parent.name) for p in (tmp_path / "s").glob("*/*.parquet"))
    names = [n for _, n in files]
    assert list(dict.fromkeys(names)) == ["step=__HIVE_DEFAULT_PARTITION__", "step=d0", "step=d1", "step=d2"] and names == sorted(names)
    assert all(names.count(n) >= 3 for n in names if n != names[0])
    assert rows(spark.read.parquet(str(tmp_path / "s")).select("id", "step")) == rows(df)
    streams.replay_files(df.where("false"), str(tmp_path / "none"), "step")
    assert (tmp_path / "none" / "_SUCCESS").exists()


def test_changes_are_shuffled_once_before_they_meet_the_target(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    target, changes = order_target(spark, SF), order_changes(spark, SF)
    text = state.upsert(target, changes)._jdf.queryExecution().executedPlan().toString()
    # For the newest of each key: the kept rows, the known keys and the new rows. The target: its rows and its keys.
    assert text.count(" Exchange ") == 5
