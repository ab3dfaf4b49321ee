"""Which files and windows are still to be loaded, and the record of what was."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.operators.ranking import newest_per_group
from feedloom.operators.relational import anti_join

# States of a backfill window.
NOT_YET_LOADED, IN_PROGRESS, COMPLETE = "NOT_YET_LOADED", "IN_PROGRESS", "COMPLETE"
#: Days of a bin by which rows meet their windows.
WINDOW_DAYS = 31


def unseen_files(files: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files the ledger does not know, or wants loaded again."""
    return anti_join(files, ledger.where(F.coalesce("reingest_file", F.lit(0)) == 0), keys)


def unseen_paths(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files by path: known as themselves or as a fully ingested archive, unless flagged for re-ingestion."""
    flag = F.coalesce("reingest_file", F.lit(0))
    done = ledger.where(flag == 0)
    known = done.select("file_path").unionByName(
        done.where(F.col("zip_file_fully_ingested") == 1).select(F.col("zip_file_path").alias("file_path"))
    )
    again = ledger.where(flag == 1)
    wanted = again.select("file_path").unionByName(again.select(F.col("zip_file_path").alias("file_path")))
    blocked = known.join(wanted, "file_path", "left_anti").distinct()
    return files.join(blocked, "file_path", "left_anti")


def record_loaded(ledger: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ledger with one row per loaded file; older rows of these files lose their re-ingest flag."""
    done = loaded.select(*keys).distinct().withColumn("__done", F.lit(True))
    cleared = ledger.join(done, list(keys), "left").withColumn(
        "reingest_file", F.when(F.col("__done"), 0).otherwise(F.col("reingest_file"))
    )
    return cleared.select(*ledger.columns).unionByName(loaded.withColumn("reingest_file", F.lit(0)), allowMissingColumns=True)


def complete_archive(ledger: DataFrame, archive: Column) -> DataFrame:
    """Mark all rows of an archive as fully ingested."""
    hit = F.col("zip_file_path") == archive
    return ledger.withColumn("zip_file_fully_ingested", F.when(hit, 1).otherwise(F.col("zip_file_fully_ingested")))


def select_files(
    found: DataFrame, history: DataFrame, base_keys: Sequence[str], key: str, at: str, ingested_at: str
) -> tuple[DataFrame, DataFrame]:
    """(new files, work list). An incremental file older than the newest full load is new but not ingested."""
    every = anti_join(found, history, [key]).unionByName(history.select(*found.columns))
    newest_full = newest_per_group(every.where("is_full_load"), list(base_keys), [F.col(at).desc(), F.col(key).desc()])
    newest_full = newest_full.select(*base_keys, F.col(at).alias("__full"))
    limit = F.coalesce("full_load_date", "__full")
    stale = F.col("ingestion_date").isNull() & limit.isNotNull() & (F.col(at) < limit)
    judged = (
        every.join(newest_full, list(base_keys), "left")
        .withColumns({"is_ingested": F.when(stale, False).otherwise(F.col("is_ingested")), "full_load_date": limit})
        .drop("__full")
    )
    new = judged.where(F.col("ingestion_date").isNull()).withColumn("ingestion_date", F.lit(ingested_at).cast("timestamp"))
    work = new.where("is_ingested").orderBy(*[F.col(k).desc() for k in base_keys], F.col("is_full_load").desc(), F.col(at).asc())
    return new, work


def next_windows(windows: DataFrame) -> DataFrame:
    """The first window per table that was not loaded yet."""
    open_ = windows.where(F.col("status") == NOT_YET_LOADED)
    return newest_per_group(open_, ["table_name"], [F.col("start_date").asc()])


def rows_in_windows(df: DataFrame, table: Column, date: Column, windows: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows of each table that fall between its window's dates (both included), once per window they fall into.

    A window without a start or an end is open on that side; a row without a table or date is in none. Windows are
    cut into bins of ``days`` and rows are joined by table and bin, so a table with most rows is spread over its bins.
    Bins outside of all given dates count as the outermost ones, which bounds those of open windows.
    """

    def bin_of(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days)

    span = windows.select(F.explode(F.array("start_date", "end_date")).alias("d")).agg(F.min(bin_of(F.col("d"))), F.max(bin_of(F.col("d")))).first()
    low, high = span[0] or 0, span[1] or 0
    first, last = F.coalesce(bin_of(F.col("start_date")), F.lit(low)), F.coalesce(bin_of(F.col("end_date")), F.lit(high))
    w = windows.where(first <= last).select(
        F.col("table_name").alias("__table"), F.col("start_date").alias("__from"), F.col("end_date").alias("__to"), F.explode(F.sequence(first, last)).alias("__of")
    )
    placed = df.withColumns({"__name": table, "__day": date}).withColumn("__bin", F.least(F.lit(high), F.greatest(F.lit(low), bin_of(F.col("__day")))))
    placed = placed.where("__day IS NOT NULL")
    inside = ((F.col("__day") >= F.col("__from")) | F.col("__from").isNull()) & ((F.col("__day") <= F.col("__to")) | F.col("__to").isNull())
    return placed.join(w, (F.col("__name") == F.col("__table")) & (F.col("__bin") == F.col("__of")) & inside).select(*[placed[c] for c in df.columns])


def mark_windows(windows: DataFrame, chosen: DataFrame, status: str) -> DataFrame:
    """Set the state of the chosen windows."""
    hit = chosen.select("table_name", "start_date").withColumn("__hit", F.lit(True))
    return (
        windows.join(hit, ["table_name", "start_date"], "left")
        .withColumn("status", F.when(F.col("__hit"), status).otherwise(F.col("status")))
        .select(*windows.columns)
    )
