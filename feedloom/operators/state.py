"""Table state: each operator takes snapshots and changes and returns the next snapshot.

The target is only left-joined to the changes, and inserts are found among the changes alone. When the
changes are small enough for Spark to broadcast, the target is therefore never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from feedloom.functions.keys import content_hash
from feedloom.functions.text import canonical_text
from feedloom.operators.ranking import newest_per_group
from feedloom.types import ACTION, AUDIT_COLUMNS, CONTENT_HASH, INTEGRATION_ID, NO_KEY, PARTITION_COLUMN, ROW_KEY

_FORCE, _LAST = "__force", "__last"

#: Parts over which rows without a key are spread.
KEYLESS_PARTS = 4096

#: Date of the newest change that was seen of a row, also of one with the content the row had already.
SEEN = "elt_seen_date"


def _key_text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(NO_KEY)))


def _spread(target: DataFrame, keyless: Column) -> Column:
    """0 for rows with a key; for others a number from their values, so that they do not meet in one task of a join."""
    plain = [F.col(f"t.{f.name}") for f in target.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return F.when(keyless, F.pmod(F.xxhash64(*plain), F.lit(KEYLESS_PARTS)) + 1).otherwise(0)


def _with_part(source: DataFrame) -> DataFrame:
    """The other side of :func:`_spread`: 0 for every key, as a value Spark does not fold, or it would not join by it."""
    return source.withColumn("__part", F.pmod(F.xxhash64("__key"), F.lit(1).cast("bigint")))


def dedupe_changes(
    changes: DataFrame, key: str = ROW_KEY, action: str = ACTION, order: str = "elt_execution_date"
) -> DataFrame:
    """The newest row per key and action; equal dates are decided by the content hash."""
    ties = [F.col(CONTENT_HASH).desc()] if CONTENT_HASH in changes.columns else []
    return newest_per_group(changes, [F.coalesce(F.col(key), F.lit(NO_KEY)), action], [F.col(order).desc(), *ties])


def change_view(batch: DataFrame, key: str = ROW_KEY, legacy_hash: bool = False) -> DataFrame:
    """A loaded batch as changes: integration id, content hash of all columns but the key, one row per key."""
    skip = {key, PARTITION_COLUMN, ACTION, *AUDIT_COLUMNS}
    columns = [c for c in batch.columns if c not in skip]
    view = batch.select(
        F.trim(F.coalesce(canonical_text(batch, key), F.lit(NO_KEY))).alias(INTEGRATION_ID),
        "*",
        content_hash(batch, columns, "" if legacy_hash else "\x1f").alias(CONTENT_HASH),
    )
    if ACTION not in view.columns:
        view = view.withColumn(ACTION, F.lit("INSERT"))
    return dedupe_changes(view, key)


def upsert(
    target: DataFrame,
    changes: DataFrame,
    key: str = INTEGRATION_ID,
    content: str = CONTENT_HASH,
    order: str = "elt_execution_date",
    deleted: str = "elt_delete_ind",
    action: str = ACTION,
    keys_are_clean: bool = False,
) -> DataFrame:
    """Update rows whose content changed or which were deleted, insert new ones.

    Only INSERT changes with a key count, the newest per key; a change older than its target row is
    ignored. Where the target has a column ``elt_seen_date`` it moves with every change of the row, of
    equal content too, and a change older than that date is ignored: so the newest date wins in
    whatever order batches come. Text that is null in a change is stored as empty, audit columns are
    stored as they are.
    With ``keys_are_clean`` the target's keys are taken as trimmed and not null and are joined as they
    are, so that a target bucketed by its key (see ``write_bucketed``) is not shuffled.
    """
    forced = F.col(_FORCE) if _FORCE in changes.columns else F.lit(False)
    source = (
        changes.where((F.col(action) == "INSERT") & (_key_text(F.col(key)) != NO_KEY))
        .withColumns({"__key": _key_text(F.col(key)), "__hash": _key_text(F.col(content)), _FORCE: forced})
    )
    # By all that the changes are joined by later, so that they are shuffled once for the newest and for the join.
    source = _with_part(source.where(F.col("__key").isNotNull()))
    by = ["__key"] if keys_are_clean else ["__key", "__part"]
    source = newest_per_group(source, by, [F.col(order).desc(), F.col("__hash").desc()])
    seen = SEEN in target.columns
    if seen:
        source = source.drop(SEEN).withColumn(SEEN, F.col(_LAST if _LAST in changes.columns else order))
    kinds = {f.name: f.dataType for f in target.schema}

    def incoming(name: str) -> Column:
        c = F.col(f"s.{name}") if name in source.columns else F.lit(None).cast(kinds[name])
        plain = isinstance(kinds[name], T.StringType) and name not in AUDIT_COLUMNS and name != content
        return F.coalesce(c, F.lit("")) if plain else c

    t, s = target.alias("t"), source.alias("s")
    own_key = (lambda c: c) if keys_are_clean else _key_text
    same_key = own_key(F.col(f"t.{key}")) == F.col("s.__key")
    if not keys_are_clean:
        same_key = same_key & (_spread(target, _key_text(F.col(f"t.{key}")) == NO_KEY) == F.col("s.__part"))
    edited = (_key_text(F.col(f"t.{content}")) != F.col("s.__hash")) | (F.col(f"t.{deleted}") == 1) | F.col(f"s.{_FORCE}")
    since = F.coalesce(F.col(f"t.{SEEN}"), F.col(f"t.{order}")) if seen else F.col(f"t.{order}")
    newer = F.coalesce(F.col(f"s.{order}") >= since, F.lit(True))
    take = F.coalesce(F.col("s.__key").isNotNull() & edited & newer, F.lit(False))

    def value(name: str) -> Column:
        if seen and name == SEEN:
            return F.greatest(since, F.col(f"s.{SEEN}").cast(kinds[SEEN]))
        return F.when(take, incoming(name)).otherwise(F.col(f"t.{name}"))

    kept = t.join(s, same_key, "left").select(*[value(c).alias(c) for c in target.columns])
    keys = _with_part(target.select(own_key(F.col(key)).alias("__key")).where(F.col("__key") != NO_KEY)).select(*by)
    known = keys.join(source.select(*by), by, "left_semi")
    new = source.join(known, by, "left_anti").alias("s").select(*[incoming(c).alias(c) for c in target.columns])
    return kept.unionByName(new)


def fold_changes(
    log: DataFrame,
    key: str = INTEGRATION_ID,
    content: str = CONTENT_HASH,
    order: str = "elt_execution_date",
    batch: str = "batch_no",
    target: DataFrame | None = None,
) -> DataFrame:
    """Many change batches as one: the change that applying them one by one would have left standing.

    Per key that is the last change whose content differs from the one before it, among those that are
    not older than a change of an earlier batch. With a ``target`` that has ``elt_seen_date``, changes
    older than what its row has seen are left out as well. ``log`` holds at most one row per key, date
    and batch, so a window is never longer than the number of batches and dates.
    """
    valid = log.where((F.col(ACTION) == "INSERT") & (_key_text(F.col(key)) != NO_KEY)).withColumn("__key", _key_text(F.col(key)))
    if target is not None and SEEN in target.columns:
        rows = target.select(_key_text(F.col(key)).alias("__key"), F.coalesce(SEEN, order).alias("__since")).where(F.col("__key") != NO_KEY)
        valid = valid.join(rows, "__key", "left").where(F.coalesce(F.col(order) >= F.col("__since"), F.lit(True))).drop("__since")
    arrival = Window.partitionBy("__key").orderBy(batch, order)
    newest = F.max(order).over(arrival.rowsBetween(Window.unboundedPreceding, -1))
    valid = valid.withColumn("__newest", newest).where(F.coalesce(F.col(order) >= F.col("__newest"), F.lit(True))).drop("__newest")
    before = F.lag(content).over(arrival)
    marked = valid.withColumn("__change", (before.isNull() | (before != F.col(content))).cast("int"))
    whole = Window.partitionBy("__key")
    marked = marked.withColumns({_FORCE: F.sum("__change").over(whole) > 1, _LAST: F.max(order).over(whole)})
    standing = marked.where(F.col("__change") == 1)
    return newest_per_group(standing, ["__key"], [F.col(order).desc(), F.col(batch).desc()]).drop("__change", "__key", batch)


def soft_delete(
    target: DataFrame, batch: DataFrame, key: str = ROW_KEY, deleted: str = "elt_delete_ind", load_type: str = "elt_load_type"
) -> DataFrame:
    """Mark target rows whose key the batch lacks, if the batch holds a row of a full load."""
    full = batch.where((F.col(deleted) == 0) & (F.col(load_type) == "FULL")).select(F.count(F.lit(1)).alias("n"))
    present = _with_part(batch.where(F.col(key).isNotNull()).select(F.col(key).alias("__key")).distinct())
    same = (F.col(f"t.{key}") == F.col("__key")) & (_spread(target, F.col(f"t.{key}").isNull()) == F.col("__part"))
    missing = F.col("__key").isNull() & (F.col(deleted) != 1) & F.col(key).isNotNull()
    return (
        target.alias("t").join(present, same, "left")
        .withColumn(deleted, F.when(missing & (full.scalar() > 0), 1).otherwise(F.col(deleted)))
        .select(*target.columns)
    )


def scd2_merge(target: DataFrame, batch: DataFrame, as_of: str, full: bool) -> DataFrame:
    """Next version of a history table; a row's identity is its content hash.

    Known content refreshes the load columns of its current row, new content is inserted, and a full load
    closes current rows it no longer holds. Closed rows are passed on as they are, without a join.
    """
    refreshed = ["meta_pipeline_key", "meta_run_date", "meta_date_of_data", "meta_is_full_load"]
    source = batch.withColumn("__hash", F.coalesce("meta_hash_key", F.lit("")))
    source = newest_per_group(source, ["__hash"], [F.col("meta_date_of_data").desc()])
    is_current = F.coalesce(F.col("meta_is_current") == 1, F.lit(False))
    current = target.where(is_current)
    hit = F.col("s.__hash").isNotNull()
    close = ~hit if full else F.lit(False)

    def value(name: str) -> Column:
        old = F.col(f"t.{name}")
        if name in refreshed:
            return F.when(hit, F.col(f"s.{name}")).otherwise(old)
        if name == "meta_is_current":
            return F.when(close, 0).otherwise(old)
        if name == "meta_end_date":
            return F.when(close, F.lit(as_of).cast(target.schema[name].dataType)).otherwise(old)
        return old

    same = F.coalesce("t.meta_hash_key", F.lit("")) == F.col("s.__hash")
    kept = current.alias("t").join(source.alias("s"), same, "left").select(*[value(c).alias(c) for c in target.columns])
    known = current.select(F.coalesce("meta_hash_key", F.lit("")).alias("__hash")).join(source.select("__hash"), "__hash", "left_semi")
    new = source.join(known, "__hash", "left_anti").select(*target.columns)
    return target.where(~is_current).unionByName(kept).unionByName(new)


def mirror_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target as a mirror of the source, with a ``change`` column: update, insert, delete or keep.

    Keys compare trimmed, null as ``N/A``. Source rows with such a key are not applied; a target row with
    one stays only while the source has its like. Drop the rows marked delete for the next snapshot.
    """
    normal = {f"__k{i}": _key_text(F.col(k).cast("string")) for i, k in enumerate(keys)}
    usable = F.lit(True)
    for name in normal:
        usable = usable & (F.col(name) != NO_KEY)
    s, t = source.withColumns(normal), target.withColumns(normal)
    names = list(normal)
    live = s.where(usable).select(*names, F.struct(*target.columns).alias("__new"))
    old = t.where(usable).select(*names, F.struct(*target.columns).alias("__old"))
    merged = live.join(old, names, "full").select(
        F.coalesce("__new", "__old").alias("__row"),
        F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").otherwise("update").alias("change"),
    )
    kept_keys = s.where(~usable).select(*names).distinct().withColumn("__kept", F.lit(True))
    unkeyed = t.where(~usable).join(kept_keys, names, "left").select(
        F.struct(*target.columns).alias("__row"), F.when(F.col("__kept"), "keep").otherwise("delete").alias("change")
    )
    return merged.unionByName(unkeyed).select("__row.*", "change")


def insert_only_merge(target: DataFrame, batch: DataFrame, key: str, at: str, keep_from: str | Column) -> DataFrame:
    """Add rows with unseen ids, then drop rows older than the retention limit."""
    newest = newest_per_group(batch.select(*target.columns), [key], [F.col(at).desc()])
    known = target.select(key).join(newest.select(key), key, "left_semi")
    new = newest.join(known, key, "left_anti")
    limit = F.lit(keep_from).cast("timestamp") if isinstance(keep_from, str) else keep_from
    return target.unionByName(new.select(*target.columns)).where(F.col(at) >= limit)


def purge_history(target: DataFrame) -> DataFrame:
    return target.where(F.col("meta_is_current") == 1)


def keep_latest_batches(batches: DataFrame, keys: Sequence[str], batch: str = "batch_no") -> DataFrame:
    """For every key the distinct rows of the last batch that has it; all batches in one union."""
    last = batches.groupBy(*keys).agg(F.max(batch).alias(batch))
    return batches.join(last, [*keys, batch], "left_semi").distinct()


def align_schema(target: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """(target with the new columns, incoming in that shape, names added); names match without case."""
    spelling = {c.lower(): c for c in target.columns}
    shaped = incoming.toDF(*[spelling.get(c.lower(), c) for c in incoming.columns])
    added = [c for c in shaped.columns if c.lower() not in spelling]
    wide = target.select("*", *[F.lit(None).cast(shaped.schema[c].dataType).alias(c) for c in added])
    missing = [c for c in target.columns if c not in shaped.columns]
    shaped = shaped.select("*", *[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in missing])
    return wide, shaped.select(*wide.columns), added


def bronze_rows(stage: DataFrame, keys: Sequence[str], run_id: str, lineage: dict[str, str]) -> DataFrame:
    """Stage rows of a run with key hash, content hash and lineage columns; no key means the whole row is."""
    rows = stage.where(F.col("run_id") == run_id)
    data = [c for c in stage.columns if c != "run_id"]
    others = [c for c in data if c not in keys] if keys else data
    key = F.sha2(F.concat_ws("_", *[F.coalesce(canonical_text(stage, c), F.lit("")) for c in keys or data]), 256)
    return rows.select(
        *data,
        key.alias("elt_key_hash"),
        content_hash(stage, others).alias(CONTENT_HASH),
        F.lit(run_id).alias("elt_run_id"),
        *[F.lit(v).alias(n) for n, v in lineage.items()],
    )


def replace_rows(current: DataFrame, condition: Column, updates: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, rows as they were): a changed row goes to the history before it is updated."""
    before = current.where(condition)
    after = current.select(
        *[F.when(condition, updates[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c) for c in current.columns]
    )
    return after, before
