"""Typed columns out of text, and rows that refuse to be typed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.session import scratch_path

# Source types of a relational result and their Spark types.
SOURCE_TYPES = {
    "char": "string", "varchar": "string", "nvarchar": "string", "text": "string",
    "decimal": "decimal(38,18)", "numeric": "decimal(38,18)", "money": "decimal(38,18)",
    "smallint": "smallint", "int": "int", "bigint": "bigint",
    "real": "float", "float": "double", "double": "double",
    "bit": "boolean", "date": "date", "datetime": "timestamp", "timestamp": "timestamp",
    "binary": "binary", "varbinary": "binary",
}
_WHOLE = ("smallint", "int", "bigint")


def coerced(c: Column, kind: str) -> Column:
    """The value as the type; what does not fit becomes null. ``21.0`` is a whole number, 1 and 0 are booleans."""
    text = c.cast("string")
    if kind in _WHOLE:
        fraction = F.when(text.rlike(r"^[+-]?[0-9]+\.[0-9]*$"), text)
        return F.coalesce(text.try_cast(kind), fraction.try_cast("decimal(38,10)").try_cast(kind))
    if kind == "date":
        compact = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
        dashed = text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
        return F.when(text.rlike("^[0-9]{8}$"), compact.try_cast("date")).when(dashed, text.try_cast("date"))
    if kind == "timestamp":
        return F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSS")))
    if kind == "boolean":
        return F.when(F.lower(text).isin("1", "true"), True).when(F.lower(text).isin("0", "false"), False)
    return text.try_cast(kind)


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed columns with lower-case names; types may be source type names."""
    return df.select(
        *[
            coerced(F.col(c), SOURCE_TYPES.get(types[c].lower(), types[c])).alias(c.lower()) if c in types else F.col(c).alias(c.lower())
            for c in df.columns
        ]
    )


def load_with_rejects(
    df: DataFrame, types: Mapping[str, str], carry: tuple[str, ...] = (), path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rejects keep the record, and the first column that failed with its text.

    Every row is read, typed and checked once and written once, to a folder for its outcome below ``path`` (in the
    shared folder if none is given); both results are read from there.
    """
    spark, path = df.sparkSession, path or scratch_path(df.sparkSession, "load")
    typed = {c: coerced(F.col(c), SOURCE_TYPES.get(k.lower(), k)) for c, k in types.items()}
    wrong = {c: F.col(c).isNotNull() & (F.trim(c) != "") & F.col(f"__typed.{c}").isNull() for c in types}
    others = [c for c in df.columns if c not in types]
    failed = F.array_compact(
        F.array(*[F.when(w, F.struct(F.lit(c).alias("name"), F.col(c).alias("text"), F.lit(types[c]).alias("kind"))) for c, w in wrong.items()])
    )
    checked = df.withColumn("__typed", F.struct(*[v.alias(c) for c, v in typed.items()])).withColumn("__failed", failed)
    bad = F.size("__failed") > 0
    record = F.when(bad, F.to_json(F.struct(*types))).alias("rejected_record")
    routed = checked.select(*others, "__typed", "__failed", record, bad.alias("__bad"))
    routed.write.partitionBy("__bad").parquet(path)
    staged = spark.read.schema(routed.schema).parquet(path)
    first = F.get(F.col("__failed"), 0)
    good = staged.where(~F.col("__bad")).select(*others, *[F.col(f"__typed.{c}").alias(c) for c in types])
    rejects = staged.where("__bad").select(
        *(carry or others),
        F.concat(F.lit("not a "), first["kind"]).alias("error"),
        first["name"].alias("column_name"),
        first["text"].alias("column_text"),
        F.size("__failed").alias("failed_columns"),
        "rejected_record",
    )
    return good, rejects


def stage_load(df: DataFrame, types: Mapping[str, str], path: str, request: str) -> DataFrame:
    """Replace the staging table at ``path`` by the good rows of a request; its row for the request log comes back.

    A request that cannot be loaded leaves the staging table as it is and is logged as ``failed`` with the reason.
    """
    spark = df.sparkSession
    log = "request string, status string, rows_loaded bigint, rows_rejected bigint, message string"
    try:
        good, rejects = load_with_rejects(df, types)
        counts = good.select(F.lit(1).alias("g"), F.lit(0).alias("r")).unionAll(rejects.select(F.lit(0), F.lit(1)))
        loaded, rejected = counts.agg(F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum("r"), F.lit(0))).first()
        good.write.mode("overwrite").parquet(path)
    except PySparkException as e:
        return spark.createDataFrame([(request, "failed", None, None, e.getCondition() or str(e).splitlines()[0])], log)
    return spark.createDataFrame([(request, "loaded", loaded, rejected, None)], log)
