"""Column-level operators: names, casts, audit columns, predicates, layouts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.functions.keys import history_hash
from feedloom.functions.text import normalize_name, safe_name
from feedloom.types import OPEN_END_DATE, PARTITION_COLUMN, RunContext


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    clashes = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if clashes:
        raise ValueError(f"columns share a name after renaming: {clashes}")
    return df.toDF(*names)


def normalize_columns(df: DataFrame, lower: bool = False) -> DataFrame:
    return rename_all(df, [safe_name(normalize_name(c, lower)) for c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def to_string_columns(df: DataFrame, types: Sequence[str] = ("timestamp", "timestamp_ntz")) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if t in types else F.col(c) for c, t in df.dtypes])


def trim_strings(df: DataFrame) -> DataFrame:
    texts = set(string_columns(df))
    return df.select(*[F.trim(c).alias(c) if c in texts else F.col(c) for c in df.columns])


def with_audit(df: DataFrame, run: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "elt_reception_date": F.lit(run.reception_date),
            "elt_execution_date": F.lit(run.execution_date),
            "elt_source": F.lit(run.source),
            "elt_pipelinekey": F.lit(run.pipeline_key),
            "elt_load_type": F.lit(run.load_type),
            "elt_delete_ind": F.lit(0),
            "elt_process_id": F.lit(run.process_id),
            "elt_firm": F.lit(run.firm),
            "elt_dml_type": F.lit(run.change_type),
            PARTITION_COLUMN: F.lit(run.partition_value),
        }
    )


def with_history_meta(
    df: DataFrame, pipeline_key: str, is_full_load: bool, run_date: str, date_of_data: str | Column, start_date: str
) -> DataFrame:
    """History columns of a batch; identity is the hash of every column the batch came with."""
    return df.select(
        "*",
        F.lit(pipeline_key).alias("meta_pipeline_key"),
        F.lit(int(is_full_load)).alias("meta_is_full_load"),
        F.lit(run_date).alias("meta_run_date"),
        (F.lit(date_of_data) if isinstance(date_of_data, str) else date_of_data).alias("meta_date_of_data"),
        F.lit(start_date).alias("meta_start_date"),
        F.lit(OPEN_END_DATE).alias("meta_end_date"),
        F.lit(1).alias("meta_is_current"),
        history_hash(df, df.columns).alias("meta_hash_key"),
    )


def add_missing_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    present = {c.lower() for c in df.columns}
    return df.withColumns({n: v for n, v in defaults.items() if n.lower() not in present})


def match_column_case(df: DataFrame, catalog_names: Sequence[str]) -> DataFrame:
    """Spell the columns as the catalog does."""
    spelling = {n.lower(): n for n in catalog_names}
    return df.toDF(*[spelling.get(c.lower(), c) for c in df.columns])


def project_mapping(df: DataFrame, mapping: Sequence[tuple[int, str, str, str]]) -> DataFrame:
    """Columns by a list of (ordinal, source name, target name, target type)."""
    return df.select(
        *[F.col(source).cast(kind).alias(target) for _, source, target, kind in sorted(mapping)]
    )


def since_watermark(df: DataFrame, history: DataFrame, column: str, stored: str = "max_timestamp") -> DataFrame:
    """Rows past the highest stored mark; everything when nothing is stored. The mark is a scalar subquery."""
    mark = history.select(F.max(stored).alias("mark"))
    return df.where(mark.scalar().isNull() | (F.col(column) > mark.scalar()))


def watermark_of(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_timestamp"), F.count(F.lit(1)).alias("rows_ingested"))


def like_any(c: Column, patterns: str) -> Column:
    """Case-insensitive match of any pattern in a comma list; ``*`` and ``%`` are wildcards."""
    wanted = [p.strip().replace("*", "%") for p in patterns.split(",") if p.strip()]
    return reduce(lambda a, b: a | b, [c.ilike(p) for p in wanted])


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def by_condition(switch: Column, variants: Mapping[tuple[str, ...], Column], default: Column) -> Column:
    """One field cut by the layout its record asks for: exact match of the switch value, else the default."""
    out = None
    for values, column in variants.items():
        hit = switch.isin(*values)
        out = F.when(hit, column) if out is None else out.when(hit, column)
    return default if out is None else out.otherwise(default)
