"""Table state: repeated loads change nothing, history stays consistent, streams equal batches."""

import pytest
from pyspark.sql import functions as F
from support import SF, rows

from feedloom.functions.keys import with_content_hash
from feedloom.operators import ledger, state
from feedloom.operators.columns import with_audit, with_history_meta
from feedloom.plans.state_queries import customer_batch, customer_history, order_changes, order_target
from feedloom.streaming import streams
from feedloom.types import RunContext

TARGET = "elt_integration_id string, v string, w string, elt_columns_hash string, elt_execution_date string, elt_delete_ind int"
CHANGE = TARGET + ", elt_stream_action string"


def test_upsert_twice_changes_nothing(spark):
    target, changes = order_target(spark, SF), order_changes(spark, SF)
    once = state.upsert(target, changes)
    assert rows(state.upsert(once, changes)) == rows(once)


def test_upsert_rules(spark):
    target = spark.createDataFrame(
        [("same", "a", "b", "h1", "2", 0), ("edited", "a", "b", "h1", "2", 0), ("gone", "a", "b", "h1", "2", 1), ("newer", "a", "b", "h1", "9", 0), ("N/A", "a", "b", "h1", "2", 0)], TARGET
    )
    changes = spark.createDataFrame(
        [
            ("same", "x", "x", "h1", "3", 0, "INSERT"), (" edited ", "x", None, "h2", "3", 0, "INSERT"), ("edited", "old", "old", "h3", "1", 0, "INSERT"), ("gone", "x", "x", "h1", "3", 0, "INSERT"),
            ("newer", "x", "x", "h2", "3", 0, "INSERT"), ("N/A", "x", "x", "h2", "3", 0, "INSERT"), (None, "x", "x", "h2", "3", 0, "INSERT"), ("new", None, "x", "h2", "3", 0, "INSERT"), ("del", "x", "x", "h2", "3", 0, "DELETE"),
        ],
        CHANGE,
    )
    got = {r[0]: tuple(r)[1:] for r in state.upsert(target, changes).collect()}
    assert got == {
        "same": ("a", "b", "h1", "2", 0), " edited ": ("x", "", "h2", "3", 0), "gone": ("x", "x", "h1", "3", 0),
        "newer": ("a", "b", "h1", "9", 0), "N/A": ("a", "b", "h1", "2", 0), "new": ("", "x", "h2", "3", 0),
    }


def test_soft_delete_needs_a_full_row(spark):
    target = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "elt_primary_key string, elt_delete_ind int")
    batch = lambda kind: spark.createDataFrame([("a", 0, kind)], "elt_primary_key string, elt_delete_ind int, elt_load_type string")
    assert rows(state.soft_delete(target, batch("FULL"))) == [("a", 0), ("b", 1), ("c", 1)]
    assert rows(state.soft_delete(target, batch("INCREMENTAL"))) == [("a", 0), ("b", 0), ("c", 1)]


@pytest.mark.parametrize("full", [True, False])
def test_history_load_is_idempotent(spark, full):
    target, batch = customer_history(spark, SF), customer_batch(spark, SF, full)
    once = state.scd2_merge(target, batch, "2024-02-01", full)
    assert rows(state.scd2_merge(once, batch, "2024-03-01", full)) == rows(once)
    per_hash = once.where("meta_is_current = 1").groupBy("meta_hash_key").count()
    assert per_hash.where("count > 1").isEmpty()
    assert once.where("meta_is_current = 1 AND meta_end_date <> '9999-12-31'").isEmpty()


def test_history_of_a_value_that_returns(spark):
    load = lambda v, day: with_history_meta(spark.createDataFrame([(v,)], "v string"), "p", True, day, day, day)
    table = load("a", "1")
    for v, day in (("b", "2"), ("a", "3")):
        table = state.scd2_merge(table, load(v, day), day, full=True)
    assert rows(table.select("v", "meta_start_date", "meta_end_date", "meta_is_current")) == [("a", "1", "2", 0), ("a", "3", "9999-12-31", 1), ("b", "2", "3", 0)]


def test_mirror_keeps_unkeyed_rows_only_with_their_like(spark):
    t = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with_na, without = (spark.createDataFrame(r, "k string, v int") for r in ([(" a", 9), (None, 8)], [("b", 9)]))
    assert rows(state.mirror_merge(t, with_na, ["k"])) == [(" a", 9, "update"), (None, 2, "keep")]
    assert set(rows(state.mirror_merge(t, without, ["k"]))) == {("a", 1, "delete"), ("b", 9, "insert"), (None, 2, "delete")}


def test_folding_equals_one_batch_after_the_other(spark):
    target = spark.createDataFrame([(k, "v", "w", "h0", "0", d) for k, d in (("back", 0), ("same", 0), ("gone", 1), ("late", 0))], TARGET)
    steps = [
        [("back", "h1"), ("same", "h0"), ("gone", "h0"), ("new", "h1"), ("late", "h2")],
        [("back", "h0"), ("same", "h0"), ("gone", "h0"), ("new", "h1")],
        [("new", "h2"), ("gone", "h5")],
    ]
    frames = [spark.createDataFrame([(k, h, f"b{i}", h, str(i + 1), 0, "INSERT") for k, h in step], CHANGE) for i, step in enumerate(steps)]
    one_by_one = target
    for f in frames:
        one_by_one = state.upsert(one_by_one, f)
    log = None
    for i, f in enumerate(frames):
        numbered = f.withColumn("batch_no", F.lit(i))
        log = numbered if log is None else log.unionByName(numbered)
    assert rows(state.upsert(target, state.fold_changes(log))) == rows(one_by_one)


def test_newest_date_wins_in_any_order(spark):
    target = spark.createDataFrame([(k, "v", "w", "hB", "0", 0, "0") for k in ("late", "later", "back")], f"{TARGET}, {state.SEEN} string")
    steps = [[("late", "hB", "2"), ("later", "hA", "3"), ("back", "hA", "1")], [("late", "hA", "1"), ("later", "hC", "2"), ("back", "hB", "2")], [("late", "hB", "3"), ("later", "hA", "4"), ("new", "h1", "2")], [("new", "h0", "1")]]
    frames = [spark.createDataFrame([(k, h, h, h, d, 0, "INSERT") for k, h, d in step], CHANGE) for step in steps]
    one_by_one, log = target, None
    for i, f in enumerate(frames):
        one_by_one = state.upsert(one_by_one, f)
        log = f.withColumn("batch_no", F.lit(i)) if log is None else log.unionByName(f.withColumn("batch_no", F.lit(i)))
    got = {r.elt_integration_id: (r.elt_columns_hash, r.elt_execution_date, r[state.SEEN]) for r in one_by_one.collect()}
    assert got == {"late": ("hB", "0", "3"), "later": ("hA", "3", "4"), "back": ("hB", "2", "2"), "new": ("h1", "2", "2")}
    assert rows(state.upsert(target, state.fold_changes(log, target=target))) == rows(one_by_one)


def test_change_stream_compacts_and_restarts(spark, tmp_path):
    target, changes = order_target(spark, SF), order_changes(spark, SF)
    want = target
    for day in ("2024-01-02", "2024-01-03"):
        want = state.upsert(want, changes.where(F.col("elt_execution_date") == day))
    table = streams.ChangeStream(spark, str(tmp_path / "t"), target, compact_every=2)
    for step, day in enumerate(("2024-01-02", "2024-01-03")):
        changes.where(F.col("elt_execution_date") == day).write.parquet(f"{tmp_path}/in/step={step}")
        stream = streams.file_stream(spark, f"{tmp_path}/in", changes.schema, files_per_trigger=1000, recursiveFileLookup="true")
        table.run(stream, f"{tmp_path}/cp")
    assert table.snapshots.versions() == [0, 2]
    assert rows(table.current()) == rows(want)
    again = streams.ChangeStream(spark, str(tmp_path / "t"), target)
    again.run(streams.file_stream(spark, f"{tmp_path}/in", changes.schema, recursiveFileLookup="true"), f"{tmp_path}/cp")
    assert again.snapshots.versions() == [0, 2] and rows(again.current()) == rows(want)
    # a micro-batch that is repeated after a failure replaces its own output
    again.apply(changes.where("elt_execution_date = '2024-01-03'"), 1)
    assert rows(again.current()) == rows(want)


def test_full_loads_read_and_leave_their_own_folders(spark, tmp_path):
    row = lambda k, d, kind="INSERT", load="FULL": (k, f"h{k}", f"h{k}", load, d, 0, kind)
    schema = "elt_integration_id string, v string, elt_columns_hash string, elt_load_type string, elt_execution_date string, elt_delete_ind int, elt_stream_action string"
    frame = lambda *r: spark.createDataFrame(list(r), schema).coalesce(1)
    table = streams.ChangeStream(spark, str(tmp_path / "t"), frame(*[row(k, "0") for k in "abcd"]).drop("elt_stream_action"), compact_every=2)
    end = lambda d: (None, None, None, "FULL", d, None, streams.LOAD_END)
    deleted = lambda: {r.elt_integration_id for r in table.current().where("elt_delete_ind = 1").collect()}
    # two loads side by side over several batches, a change between them
    table.apply(frame(row("a", "1")), 0)
    table.apply(frame(row("b", "1"), row("a", "2"), row("e", "1", load="INCR")), 1)
    assert deleted() == set() and table.load_keys.numbers() == [0, 1]
    table.apply(frame(row("c", "1"), end("1")), 2)
    assert deleted() == {"d", "e"} and table.load_keys.numbers() == [1]
    # the end again, in the same batch after a failure and in one of its own
    table.apply(frame(row("c", "1"), end("1")), 2)
    table.apply(frame(row("d", "1"), end("1")), 3)
    assert deleted() == {"e"} and table.load_keys.numbers() == [1]
    table.apply(frame(row("b", "2"), row("c", "2"), row("d", "2"), end("2")), 4)
    assert deleted() == {"e"} and table.load_keys.numbers() == []
    before = rows(table.current())
    table.apply(frame(row("b", "2"), row("c", "2"), row("d", "2"), end("2")), 4)
    assert rows(table.current()) == before and table.load_keys.numbers() == []
    # what two snapshots hold is gone, the rest of the log is there
    for n in range(5, 12):
        table.apply(frame(row("a", str(n), load="INCR")), n)
    versions = table.snapshots.versions()
    assert len(versions) <= 3 and min(table.log.numbers()) >= versions[0] and max(table.log.numbers()) == 11
    assert deleted() == {"e"} and table.current().count() == 5


def test_dml_type_is_checked(spark):
    run = RunContext("d", "s", "d", True, "p", "i", "f", "x", dml_type="X")
    with pytest.raises(ValueError):
        with_audit(spark.range(1), run)


def test_reingested_files_come_back(spark):
    files = spark.createDataFrame([("a", "z"), ("b", "z"), ("c", "y")], "file_path string, zip_file_path string")
    known = spark.createDataFrame([("a", "z", 0, 0), ("b", "z", 1, 0), ("y", "y", 0, 0)], "file_path string, zip_file_path string, reingest_file int, zip_file_fully_ingested int")
    assert rows(ledger.unseen_files(files, known, ["file_path"]).select("file_path")) == [("b",), ("c",)]
    assert rows(ledger.unseen_paths(files, known).select("file_path")) == [("b",), ("c",)]


def test_legacy_content_hash_is_an_option(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    assert with_content_hash(df, ["x", "y"], legacy=True).select("elt_columns_hash").distinct().count() == 1


def test_replaced_schema_refuses_existing_table(spark):
    from feedloom.operators.catalog import replace_feed_schema

    schema = spark.createDataFrame([(1, "t1", "a"), (2, "t2", "b")], "feed_id int, table_name string, column_name string")
    new = spark.createDataFrame([("t2", "x#y")], "table_name string, column_name string")
    none, there = (spark.createDataFrame([(n,)], "table_name string") for n in ("t9", "t2"))
    assert rows(replace_feed_schema(schema, 2, new, none)) == [(1, "t1", "a"), (2, "t2", "x_y")]
    with pytest.raises(Exception, match="table exists"):
        replace_feed_schema(schema, 2, new, there).collect()


def test_rows_meet_open_and_overlapping_windows(spark, conf):
    """One table has most rows; the join is by table and bin, and equals a plain one."""
    import datetime as dt

    day = dt.date(2020, 1, 1)
    data = [(i, "hot" if i % 4 else "cold", day + dt.timedelta(days=i % 900)) for i in range(3000)] + [(-1, None, day), (-2, "hot", None)]
    frame = spark.createDataFrame(data, "id long, t string, d date")
    given = [("hot", day, dt.date(2020, 3, 1)), ("hot", dt.date(2020, 2, 1), dt.date(2021, 6, 1)), ("hot", dt.date(2022, 1, 1), None), ("cold", None, dt.date(2020, 1, 5)), ("none", None, None), ("hot", dt.date(2021, 1, 1), dt.date(2020, 1, 1))]
    windows = spark.createDataFrame(given, "table_name string, start_date date, end_date date")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = ledger.rows_in_windows(frame, F.col("t"), F.col("d"), windows)
    assert found.columns == frame.columns
    want = [r for r in data for t, a, b in given if r[1] == t and r[2] and (a is None or r[2] >= a) and (b is None or r[2] <= b)]
    assert rows(found) == sorted(want, key=lambda r: tuple(map(str, r)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__name" in plan and "__bin" in plan
    assert ledger.rows_in_windows(frame, F.col("t"), F.col("d"), windows.limit(0)).count() == 0
    assert ledger.rows_in_windows(frame, F.col("t"), F.col("d"), windows.where("table_name = 'none'")).count() == 0
