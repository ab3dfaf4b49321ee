"""The catalog: one row per source column, built from information-schema rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.operators.ranking import newest_per_group
from feedloom.operators.relational import duplicate_keys, join_ignoring_case, keys_without, ordered_names

TABLE = ["table_catalog", "table_schema", "table_name"]
HASH_KEY = "MD5_KEY"

# Type names of one engine and their counterparts in another.
FORWARD_TYPES = {
    "bigint": "bigint",
    "numeric": "decimal",
    "bit": "smallint",
    "smallint": "smallint",
    "decimal": "decimal",
    "smallmoney": "double",
    "int": "int",
    "tinyint": "smallint",
    "money": "double",
    "float": "float",
    "real": "double",
    "date": "date",
    "datetime2": "datetime",
    "smalldatetime": "date",
    "datetime": "datetime",
    "time": "time",
    "char": "varchar",
    "varchar": "varchar",
    "text": "string",
    "nchar": "string",
    "nvarchar": "string",
    "ntext": "string",
    "binary": "binary",
    "varbinary": "varbinary",
    "xml": "variant",
}
BACKWARD_TYPES = {
    "variant": "varchar",
    "boolean": "bit",
    "text": "varchar",
    "number": "decimal",
    "float": "float",
    "timestamp_ntz": "datetime",
    "timestamp_ltz": "datetime",
    "array": "varchar",
    "date": "date",
}

# How the types of a Spark frame are called in information-schema rows.
SOURCE_NAMES = {
    "string": "varchar",
    "integer": "int",
    "long": "bigint",
    "double": "float",
    "timestamp": "datetime",
    "timestamp_ntz": "datetime",
}


def translation_table(spark: SparkSession) -> DataFrame:
    rows = [("forward", a, b) for a, b in FORWARD_TYPES.items()] + [("backward", a, b) for a, b in BACKWARD_TYPES.items()]
    return spark.createDataFrame(rows, "direction string, type_from string, type_to string")


def profile_columns(df: DataFrame, table: str, schema: str = "dbo", catalog: str = "feeds") -> DataFrame:
    """Information-schema rows of a table, measured in one pass: types, lengths, whether nulls occur."""
    stats, entries = [], []
    for i, f in enumerate(df.schema.fields, 1):
        is_text = isinstance(f.dataType, T.StringType)
        length = F.max(F.length(f.name)) if is_text else F.lit(0)
        stats += [F.count(f.name).alias(f"n{i}"), length.cast("int").alias(f"l{i}")]
        kind = SOURCE_NAMES.get(f.dataType.typeName(), f.dataType.typeName())
        entries.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.coalesce(f"l{i}", F.lit(0)).alias("character_maximum_length"),
                F.lit(i).alias("ordinal_position"),
                F.when(F.col(f"n{i}") < F.col("__rows"), "YES").otherwise("NO").alias("is_nullable"),
                F.col("__rows").alias("table_rows"),
            )
        )
    measured = df.agg(F.count(F.lit(1)).alias("__rows"), *stats)
    return measured.select(
        F.lit(catalog).alias("table_catalog"), F.lit(schema).alias("table_schema"), F.lit(table).alias("table_name"),
        F.explode(F.array(*entries)).alias("__c"),
    ).select(*TABLE, "__c.*")


def key_columns(declared: DataFrame, table: str = "asset_name", schema: str = "asset_schema", keys: str = "key_list") -> DataFrame:
    """Declared key lists (comma separated) as one row per table and column, upper case, without copies."""
    return (
        declared.select(
            F.upper(F.trim(schema)).alias("table_schema"),
            F.upper(F.trim(table)).alias("table_name"),
            F.explode(F.split(keys, ",")).alias("k"),
        )
        .select("table_schema", "table_name", F.upper(F.trim("k")).alias("column_name"))
        .where(F.col("column_name") != "")
        .distinct()
    )


def primary_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Columns of the primary-key constraints."""
    pk = constraints.where(F.upper("constraint_type") == "PRIMARY KEY")
    both = join_ignoring_case(pk, usage, [*TABLE, "constraint_name"])
    return both.select(*TABLE, "column_name").distinct()


def mark_keys(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``key_column_name``: the column's own name if it is a key."""
    on = [c for c in (*TABLE, "column_name") if c in keys.columns]
    named = keys.select(*on, F.col("column_name").alias("__hit")).distinct()
    return join_ignoring_case(columns, named, on, "left").withColumn(
        "key_column_name", F.when(F.col("__hit").isNotNull(), F.col("column_name"))
    ).drop("__hit")


def infer_missing_keys(columns: DataFrame) -> DataFrame:
    """Tables without any key get the hash column as their key, after their last column."""
    bare = keys_without(columns, TABLE, F.col("key_column_name").isNotNull())
    defaults = {
        "column_name": F.lit(HASH_KEY),
        "key_column_name": F.lit(HASH_KEY),
        "data_type": F.lit("char"),
        "ordinal_position": (F.col("row_count") + 1).cast("int"),
        "is_nullable": F.lit("YES"),
    }
    added = bare.select(
        *[
            (F.col(f.name) if f.name in TABLE else defaults.get(f.name, F.lit(0))).cast(f.dataType).alias(f.name)
            for f in columns.schema
        ]
    )
    return columns.unionByName(added).distinct()


def translate_types(columns: DataFrame, translation: DataFrame, truncate_varchar: int = 0) -> DataFrame:
    """Add ``target_type``: the translated type with its length or precision."""
    names = translation.select(F.upper("type_from").alias("__from"), F.col("type_to").alias("__to"))
    out = columns.join(names, F.upper("data_type") == F.col("__from"), "left")
    length = F.col("character_maximum_length")
    kind = F.when((F.col("__to") == "varchar") & length.between(1, 1000), F.concat(F.lit("varchar("), length, F.lit(")")))
    if truncate_varchar:
        kind = kind.when(F.col("__to") == "varchar", F.lit(f"varchar({truncate_varchar})"))
    if "numeric_precision" in columns.columns:
        sized = F.concat(F.lit("decimal("), F.col("numeric_precision"), F.lit(","), F.col("numeric_scale"), F.lit(")"))
        kind = kind.when(F.col("__to").isin("decimal", "numeric") & (F.col("numeric_precision") > 0), sized)
    return out.withColumn("target_type", kind.otherwise(F.col("__to"))).drop("__from", "__to")


def build_catalog(
    ingest_list: DataFrame, tables: DataFrame, columns: DataFrame, keys: DataFrame, translation: DataFrame
) -> DataFrame:
    """Ingest list, tables, columns, keys and types to one row per source column."""
    base = tables.where(F.col("table_type") == "BASE TABLE")
    wanted = join_ignoring_case(ingest_list, base, ["table_schema", "table_name"])
    chosen = join_ignoring_case(columns, wanted.select(*TABLE).distinct(), TABLE)
    typed = translate_types(infer_missing_keys(mark_keys(chosen, keys)), translation)
    clean = F.regexp_replace(F.trim("column_name"), r"\W+", "_")
    return typed.select(
        F.col("table_catalog").alias("source_database"),
        F.col("table_schema").alias("source_schema"),
        "table_name",
        clean.alias("source_column"),
        F.col("data_type").alias("source_type"),
        clean.alias("target_column"),
        "target_type",
        "ordinal_position",
        F.when(F.upper("is_nullable") == "YES", 1).otherwise(0).alias("is_nullable"),
        F.when(F.col("column_name") == F.col("key_column_name"), 1).otherwise(0).alias("key_indicator"),
        F.lit(1).alias("is_active"),
    )


def unlisted_tables(ingest_list: DataFrame, tables: DataFrame) -> DataFrame:
    """Listed tables the source does not have."""
    base = tables.where(F.col("table_type") == "BASE TABLE")
    return join_ignoring_case(ingest_list, base, ["table_schema", "table_name"], "left_anti")


def frame_catalog(df: DataFrame, table: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per top-level column of a frame; nested ones are variant, all others text."""
    lower = {k.lower() for k in keys}
    rows = [
        (table, f.name, i, "variant" if re.search(r"struct<", f.dataType.simpleString()) else "varchar", int(f.name.lower() in lower))
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, ordinal_position int, target_type string, key_indicator int"
    )


def new_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per table, the columns the target lacks, as one ordered list."""
    missing = join_ignoring_case(source, target, ["table_name", "column_name"], "left_anti")
    return ordered_names(missing, ["table_name"], "column_name", ["column_name"])


def integrity_report(columns: DataFrame, feeds: DataFrame) -> DataFrame:
    """(rule, subject, amount): repeated names or ordinals, tables without a key, ids active more than once."""
    return (
        duplicate_keys(columns.select("table_name", F.upper("column_name").alias("c")), ["table_name", "c"])
        .select(F.lit("DUPLICATE_COLUMN").alias("rule"), F.concat_ws(".", "table_name", "c").alias("subject"), F.col("copies").alias("amount"))
        .unionByName(
            duplicate_keys(columns, ["table_name", "ordinal_position"]).select(
                F.lit("DUPLICATE_ORDINAL").alias("rule"), F.concat_ws(".", "table_name", "ordinal_position").alias("subject"), F.col("copies").alias("amount")
            )
        )
        .unionByName(
            keys_without(columns, ["table_name"], F.col("key_indicator") == 1).select(
                F.lit("NO_KEY").alias("rule"), F.col("table_name").alias("subject"), F.col("row_count").alias("amount")
            )
        )
        .unionByName(
            duplicate_keys(feeds.where(F.col("is_active") == 1), ["feed_id"]).select(
                F.lit("SEVERAL_ACTIVE_ROWS").alias("rule"), F.col("feed_id").cast("string").alias("subject"), F.col("copies").alias("amount")
            )
        )
    )


def lookup_rows(df: DataFrame, flag: str, stamp: str) -> DataFrame:
    """A lookup file with ``is_active`` from its YES column, and stamps."""
    return df.select(
        "*",
        F.when(F.upper(F.trim(flag)) == "YES", 1).otherwise(0).alias("is_active"),
        F.lit(stamp).alias("created_at"),
        F.lit(stamp).alias("modified_at"),
    )


def replace_feed_schema(schema: DataFrame, feed_id: int, new_rows: DataFrame, existing: DataFrame) -> DataFrame:
    """The schema table with the rows of one feed replaced; refused if the feed's table already exists.

    The refusal is part of the plan, so nothing comes to the driver.
    """
    clash = new_rows.join(existing, new_rows["table_name"] == existing["table_name"], "left_semi").select(F.count(F.lit(1)).alias("n"))
    text = F.lit("the table exists; alter it to add columns")
    guard: Column = F.when(clash.scalar() > 0, F.raise_error(text).cast("boolean")).otherwise(True)
    named = new_rows.withColumn("column_name", F.replace(F.col("column_name"), F.lit("#"), F.lit("_")))
    kept = schema.where(F.col("feed_id") != feed_id)
    return kept.unionByName(named.withColumn("feed_id", F.lit(feed_id)).select(*schema.columns)).where(guard)


def best_per_table(columns: DataFrame, order: Sequence[Column]) -> DataFrame:
    return newest_per_group(columns, TABLE, order)
