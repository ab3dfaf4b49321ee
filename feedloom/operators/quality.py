"""Reconciliation of two tables, load validation, file checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from feedloom.operators.columns import differs
from feedloom.operators.ranking import newest_per_group
from feedloom.operators.relational import aggregated_count, anti_join
from feedloom.session import written

# Alarm share of the previous run, in percent, and the texts of the validation report.
VOLUME_ALARM_PERCENT = 70
NO_ERROR = "NO Error"
VOLUME_MESSAGE = "Huge data surge is there"
FAILED_MESSAGE = " are not processed from source file"
MISSING_MESSAGE = "This file is not  processed today"


@dataclass(frozen=True)
class Reconciliation:
    summary: DataFrame
    missing: DataFrame
    mismatches: DataFrame


def _status(pairs_differ: Column) -> Column:
    return F.when(pairs_differ, "DIFFERENT").otherwise("MATCH")


def _comparable(a: T.DataType, b: T.DataType) -> bool:
    """Whether two columns compare by value; all other pairs compare as text."""
    numbers = isinstance(a, T.NumericType) and isinstance(b, T.NumericType)
    return numbers or (a == b and not isinstance(a, (T.MapType, T.VariantType)))


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> Reconciliation:
    """Compare two tables by key: counts, keys on one side, and values that differ.

    Both sides go into one aggregate per key of counts and 64-bit row digests, which combines on the map
    side, so neither repeated keys nor null keys pile up or multiply, and no whole row is shuffled. Only
    the rows of keys that differ there are compared; what is left is written to the shared folder once,
    and all results are read from it. A key held once on each side
    is compared column by column. A key held more often is compared by how often each value of each
    column occurs, which is exact and grows with the rows, not with their pairs; its values carry the
    surplus count.
    """
    keys = [k.lower() for k in keys]
    s, t = (df.toDF(*[c.lower() for c in df.columns]) for df in (source, target))
    absent = [k for k in keys if k not in s.columns or k not in t.columns]
    if absent:
        raise ValueError(f"key columns not on both sides: {absent}")
    columns = [c for c in s.columns if c in t.columns and c not in keys]
    cells = [F.col(c) if _comparable(s.schema[c].dataType, t.schema[c].dataType) else F.col(c).cast("string").alias(c) for c in columns]
    cells = cells or [F.lit(0).alias("__none")]
    both = s.select(*keys, F.lit(1).alias("__s"), F.lit(0).alias("__t"), F.struct(*cells).alias("__row")).unionByName(
        t.select(*keys, F.lit(0).alias("__s"), F.lit(1).alias("__t"), F.struct(*cells).alias("__row"))
    )
    values = [F.col(f"__row.{f.name}") for f in both.schema["__row"].dataType]
    digest = F.xxhash64(*[part for v in values for part in (v, v.isNull())])
    sides = {side: F.bit_xor(F.when(F.col(side) == 1, digest)) for side in ("__s", "__t")}
    counted = both.groupBy(*keys).agg(F.sum("__s").alias("n_s"), F.sum("__t").alias("n_t"), *[v.alias(f"h{k}") for k, v in sides.items()])
    same = (F.col("n_s") == 1) & (F.col("n_t") == 1) & (F.col("h__s") == F.col("h__t"))
    suspect = written(counted.where(~F.coalesce(same, F.lit(False))).select(*keys), "suspect-keys")
    match = reduce(lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])
    both = both.alias("b").join(suspect.alias("k"), match, "left_semi")
    per_key = both.groupBy(*keys).agg(
        F.sum("__s").alias("source_rows"),
        F.sum("__t").alias("target_rows"),
        F.max(F.when(F.col("__s") == 1, F.col("__row"))).alias("__source"),
        F.max(F.when(F.col("__t") == 1, F.col("__row"))).alias("__target"),
    )
    single = (F.col("source_rows") == 1) & (F.col("target_rows") == 1)
    alike = single & F.col("__source").eqNullSafe(F.col("__target"))
    found = written(per_key.where(~alike), "reconcile")
    on_both = (F.col("source_rows") > 0) & (F.col("target_rows") > 0)
    if columns:
        diffs = F.array_compact(F.array(*[_difference(c) for c in columns]))
        simple = found.where(single).select(*keys, F.explode(diffs).alias("__d")).select(*keys, "__d.*", F.lit(1).cast("bigint").alias("copies"))
        repeated = found.where(~single & on_both).select(*keys)
        on = reduce(lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
        rows = both.alias("b").join(repeated.alias("r"), on, "left_semi")
        cell = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__row.{c}").cast("string").alias("value")) for c in columns]))
        surplus = (
            rows.select(*keys, "__s", "__t", cell.alias("__c"))
            .groupBy(*keys, "__c.column_name", "__c.value")
            .agg((F.sum("__s") - F.sum("__t")).alias("extra"))
            .where(F.col("extra") != 0)
            .select(
                *keys,
                "column_name",
                F.when(F.col("extra") > 0, F.col("value")).alias("source_value"),
                F.when(F.col("extra") < 0, F.col("value")).alias("target_value"),
                F.abs("extra").alias("copies"),
            )
        )
        mismatches = simple.unionByName(surplus)
    else:
        blank = [F.lit(None).cast("string").alias(n) for n in ("column_name", "source_value", "target_value")]
        mismatches = found.limit(0).select(*keys, *blank, F.lit(0).cast("bigint").alias("copies"))
    missing = found.where(~on_both).select(
        *keys,
        F.when(F.col("target_rows") == 0, "target").otherwise("source").alias("missing_in"),
        (F.col("source_rows") + F.col("target_rows")).alias("row_count"),
    )
    counts = {
        "only_in_source": F.sum(F.when(F.col("target_rows") == 0, F.col("source_rows"))),
        "only_in_target": F.sum(F.when(F.col("source_rows") == 0, F.col("target_rows"))),
        "mismatched_keys": F.count(F.when(single, 1)),
        "repeated_keys": F.count(F.when((F.col("source_rows") > 1) | (F.col("target_rows") > 1), 1)),
    }
    totals = [df.select(F.count(F.lit(1)).alias("n")).scalar().alias(n) for df, n in ((s, "source_count"), (t, "target_count"))]
    totals = found.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(n) for n, v in counts.items()]).select(*totals, *counts)
    return Reconciliation(totals.select("*", summary_status()), missing, mismatches)


def _difference(c: str) -> Column:
    """Both values of a column where they differ, else null."""
    source, target = F.col(f"__source.{c}"), F.col(f"__target.{c}")
    pair = F.struct(F.lit(c).alias("column_name"), source.cast("string").alias("source_value"), target.cast("string").alias("target_value"))
    return F.when(differs(source, target), pair)


def summary_status() -> Column:
    """One word for the outcome, from the counts of a summary row."""
    empty_s, empty_t = F.col("source_count") == 0, F.col("target_count") == 0
    differ = (
        (F.col("only_in_source") + F.col("only_in_target") + F.col("mismatched_keys") > 0)
        | (F.col("source_count") != F.col("target_count"))
    )
    return (
        F.when(empty_s & empty_t, "BOTH_EMPTY")
        .when(empty_s, "SOURCE_EMPTY")
        .when(empty_t, "TARGET_EMPTY")
        .when(differ, "DIFFERENT")
        .otherwise("MATCH")
        .alias("status")
    )


def rows_missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows of one side whose key the other side lacks."""
    return anti_join(left, right, keys)


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts only, for queries without keys; a column named like a count is summed."""
    s = aggregated_count(source, "n").select(F.col("n").alias("source_count"), F.lit(None).cast("bigint").alias("target_count"))
    t = aggregated_count(target, "n").select(F.lit(None).cast("bigint").alias("source_count"), F.col("n").alias("target_count"))
    both = s.unionByName(t).agg(F.max("source_count").alias("source_count"), F.max("target_count").alias("target_count"))
    same = F.col("source_count") == F.col("target_count")
    message = F.when(same, F.concat(F.lit("Counts match: "), F.col("source_count"), F.lit("."))).otherwise(
        F.concat(F.lit("Count mismatch: Source has "), F.col("source_count"), F.lit(", Target has "), F.col("target_count"), F.lit("."))
    )
    return both.select("*", _status(~same).alias("status"), message.alias("message"))


@dataclass(frozen=True)
class ReconcileConfig:
    id: int
    source: DataFrame
    target: DataFrame
    keys: tuple[str, ...] = ()
    active: bool = True


def reconcile_batch(configs: Sequence[ReconcileConfig]) -> DataFrame:
    """One result row per active configuration, with the whole summary as JSON.

    Each configuration runs by itself: one that fails gives a row with status ``ERROR`` and the message as its
    result, and the others go on. Without an active configuration there are no rows.
    """
    spark, rows = SparkSession.active(), []
    for c in configs:
        if not c.active:
            continue
        try:
            summary = reconcile(c.source, c.target, c.keys).summary if c.keys else reconcile_counts(c.source, c.target)
            found = summary.select("source_count", "target_count", "status", F.to_json(F.struct(*summary.columns)).alias("result")).first()
            rows.append((c.id, *found))
        except (ValueError, PySparkException) as e:
            rows.append((c.id, None, None, "ERROR", str(e).splitlines()[0]))
    return spark.createDataFrame(rows, "config_id int, source_count bigint, target_count bigint, status string, result string")


def schedule_tags(calendar: DataFrame, monthly: DataFrame) -> DataFrame:
    """Frequencies due on each day: (calendar_date, tag).

    ``calendar`` has calendar_date, is_business_day, is_weekend; ``monthly`` lists frequency texts such as
    ``MONTHLY_15_BD`` whose number between underscores is the day of the month.
    """
    day = F.col("calendar_date")
    tags = F.array_compact(
        F.array(
            F.when(F.col("is_business_day"), F.lit("BD_DAILY")),
            F.lit("CD_DAILY"),
            F.when(F.col("is_weekend"), F.concat(F.lit("WEEKLY_"), F.upper(F.date_format(day, "EEE")))),
        )
    )
    daily = calendar.select("calendar_date", F.explode(tags).alias("tag"))
    texts = monthly.where(F.col("frequency_text").like("%MONTHLY%")).select("frequency_text").distinct()
    numbered = texts.select(
        "frequency_text", F.explode(F.regexp_extract_all("frequency_text", F.lit(r"_(\d+)(?=_)"), 1)).alias("__text")
    ).select("frequency_text", F.col("__text").try_cast("int").alias("__day"))
    due = calendar.select("calendar_date", F.dayofmonth(day).alias("__day")).join(numbered, "__day").select("calendar_date", F.col("frequency_text").alias("tag"))
    return daily.unionByName(due).distinct()


def volume_check(run_log: DataFrame, table: Sequence[str], percent: int = VOLUME_ALARM_PERCENT) -> DataFrame:
    """Each run beside the run before it: previous count, share in percent, alarm.

    One row per table and business date is kept before the window, so its length is the number of dates.
    """
    w = Window.partitionBy(*table).orderBy("business_date")
    previous = F.lag("rows_ingested").over(w)
    share = F.try_divide(F.col("rows_ingested") * 100, previous)
    return run_log.withColumn("previous_rows", previous).withColumn("is_drop", F.coalesce(share < percent, F.lit(False)))


def load_validation(due: DataFrame, run_log: DataFrame, table: Sequence[str]) -> DataFrame:
    """Due feeds with the run of their day: load flag and error message; feeds without a run stay, with nulls."""
    runs = volume_check(run_log, table)
    failed = F.col("rows_failed") != 0
    message = (
        F.when(failed, F.concat(F.col("rows_failed"), F.lit(FAILED_MESSAGE)))
        .when(F.col("is_drop"), VOLUME_MESSAGE)
        .when(F.col("rows_ingested").isNotNull(), NO_ERROR)
    )
    flag = F.when(F.col("source_rows") == F.col("rows_ingested"), "Y").when(F.col("rows_failed").isNotNull(), "N")
    return due.join(runs, [*table, "business_date"], "left").select("*", flag.alias("load_flag"), message.alias("error_message"))


def missing_feeds(validation: DataFrame) -> DataFrame:
    """What the report shows: feeds that did not arrive, or arrived with an error."""
    return validation.where(F.col("error_message").isNull() | (F.col("error_message") != NO_ERROR)).withColumn(
        "error_message", F.coalesce("error_message", F.lit(MISSING_MESSAGE))
    )


def preload_violations(requests: DataFrame, feeds: DataFrame, key: str = "feed_id") -> DataFrame:
    """Load requests with the list of rules they break."""
    known = feeds.withColumn("__known", F.lit(True))
    rules = {
        "FILE_DETAILS_NOT_AVAILABLE": F.col("__known").isNull(),
        "LOAD_TYPE_NOT_FOUND": ~F.coalesce(F.col("load_type").isin("INCREMENTAL", "FULL_LOAD"), F.lit(False)),
        "PRIMARY_KEY_COLUMNS_NOT_FOUND": F.col("__known") & (F.col("load_type") == "INCREMENTAL") & F.col("key_columns").isNull(),
        "FIXED_LINE_LENGTH_NOT_MATCHING": (F.col("file_format") == "FIXED_LENGTH") & (F.col("line_length") != F.col("record_length")),
    }
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return requests.join(known, key, "left").withColumn("violations", broken).drop("__known")


def size_guard(files: DataFrame, thresholds: DataFrame, key: str = "firm", size: str = "file_size") -> DataFrame:
    """Full files with a flag whether they are large enough for their firm."""
    enough = F.coalesce(F.col(size) >= F.col("min_size"), F.lit(True))
    return files.join(thresholds, key, "left").withColumn("is_accepted", enough).drop("min_size")


def owner_check(rows: DataFrame, owners: Mapping[str, str], client: Column, firm: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by whether the client id of the header belongs to the firm."""
    table = F.create_map(*[F.lit(x) for pair in owners.items() for x in pair])
    ok = F.coalesce(F.try_element_at(table, client) == firm, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def prefix_match(files: DataFrame, inventory: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Files with the inventory prefix their name holds; several prefixes make the file ambiguous.

    A name can only hold a prefix that equals one of its own pieces of that length, so the match is an
    equi-join on pieces instead of a comparison of every name with every prefix.
    """
    lengths = inventory.select(F.collect_set(F.length("prefix")).alias("n"))
    name, n = F.col(file_name), F.col("__n")
    sized = files.select(file_name, lengths.scalar().alias("__lengths")).select(file_name, F.explode("__lengths").alias("__n"))
    places = F.sequence(F.lit(1), F.length(name) - n + 1)
    pieces = F.explode(F.array_distinct(F.transform(places, lambda i: F.substr(F.upper(name), i, n))))
    cut = sized.where(F.length(name) >= n).select(file_name, pieces.alias("__piece"))
    known = inventory.select(F.upper("prefix").alias("__piece"), "prefix", "location")
    hits = cut.join(known, "__piece")
    matched = hits.groupBy(file_name).agg(
        F.count(F.lit(1)).alias("matches"), F.min("prefix").alias("prefix"), F.min_by("location", "prefix").alias("location")
    )
    return (
        files.join(matched, file_name, "left")
        .withColumn("matches", F.coalesce("matches", F.lit(0)))
        .withColumn("match_status", F.when(F.col("matches") == 0, "UNKNOWN").when(F.col("matches") == 1, "MATCHED").otherwise("AMBIGUOUS"))
    )


def control_totals(data: DataFrame, trailers: DataFrame, key: str = "file_path") -> DataFrame:
    """Data rows per file against the count its trailer names."""
    found = data.groupBy(key).agg(F.count(F.lit(1)).alias("data_rows"))
    return trailers.join(found, key, "full").select(
        key,
        "trailer_rows",
        F.coalesce("data_rows", F.lit(0)).alias("data_rows"),
        F.coalesce(F.col("trailer_rows") == F.coalesce("data_rows", F.lit(0)), F.lit(False)).alias("is_balanced"),
    )


def latest_runs(run_log: DataFrame, table: Sequence[str]) -> DataFrame:
    return newest_per_group(run_log, list(table), [F.col("business_date").desc()])
