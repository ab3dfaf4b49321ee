"""Lake tables: partitioned Parquet, the newest partition, configured selects, table versions."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.operators.columns import rename_all
from feedloom.session import COMPRESSION
from feedloom.types import PARTITION_COLUMN

# Fixed value: rows per output file.
ROWS_PER_FILE = 50_000
# Fixed value: the folder name Spark gives to the partition of null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_lake(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (PARTITION_COLUMN,),
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "overwrite",
) -> None:
    """Lower-case names, one folder per partition value, files of at most ``rows_per_file`` rows.

    Only the partitions in ``df`` are replaced. Rows go to the writers by partition value and AQE splits
    large values over several writers, so one load that holds most rows is not written by one task.
    """
    named = rename_all(df, [c.lower() for c in df.columns])
    columns = [c.lower() for c in partition_by]
    if columns:
        named = named.hint("rebalance", *columns)
    (
        named.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*columns)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table bucketed and sorted by its key: joins on the key then shuffle only the other side."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def latest_partition(df: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Rows of the newest partition. Its value is taken from the names of the folders Spark has listed; null is none."""
    start = f"/{column}="
    names = {unquote(f.split(start, 1)[1].split("/", 1)[0]) for f in df.inputFiles() if start in f}
    kind = df.schema[column].dataType
    values = df.sparkSession.createDataFrame([(n,) for n in sorted(names)], "name string")
    newest = values.agg(F.max(F.col("name").try_cast(kind))).first()[0]
    return df.where(F.col(column) == F.lit(newest).cast(kind))


def read_latest_partition(spark: SparkSession, path: str, column: str = PARTITION_COLUMN, kind: str = "date") -> DataFrame:
    """Rows of the newest partition of a table at a path. One listing of its folders finds it; no other is listed or
    read. Values that are not of the given kind, and null, are none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    start = f"{column}="
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [n for n in (f.getPath().getName() for f in found if f.isDirectory()) if n.startswith(start) and n != start + NULL_PARTITION]
    values = spark.createDataFrame([(n, unquote(n.removeprefix(start))) for n in names], "folder string, name string")
    value = F.col("name").try_cast(kind)
    newest = values.where(value.isNotNull()).orderBy(value.desc()).first()
    if newest is None:
        return spark.read.parquet(path).limit(0)
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{newest.folder}").withColumn(column, F.col(column).cast(kind))


def select_from_config(df: DataFrame, columns: str, condition: str | None = None) -> DataFrame:
    """A comma list of columns and a filter, as kept in a configuration row."""
    out = df.where(condition) if condition else df
    return out.select(*[c.strip() for c in columns.split(",") if c.strip()])


class NumberedFolders:
    """Parquet folders ``<prefix>=N`` below a path, each complete once Spark has written its ``_SUCCESS`` mark.

    Writing a number again replaces it, which makes a repeated micro-batch harmless.
    """

    def __init__(self, spark: SparkSession, path: str, prefix: str):
        self.spark, self.path, self.prefix = spark, path.rstrip("/"), prefix

    def folder(self, number: int) -> str:
        return f"{self.path}/{self.prefix}={number}"

    def numbers(self) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        where = hadoop(self.path)
        fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(where):
            return []
        start = f"{self.prefix}="
        names = [status.getPath().getName() for status in fs.listStatus(where)]
        found = [int(n.removeprefix(start)) for n in names if n.startswith(start)]
        return sorted(n for n in found if fs.exists(hadoop(f"{self.folder(n)}/_SUCCESS")))

    def write(self, df: DataFrame, number: int, partition_by: Sequence[str] = ()) -> None:
        df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(self.folder(number))

    def remove(self, numbers: Sequence[int]) -> None:
        """Delete folders that nothing reads any more. The mark goes first, so a folder that is half deleted is not read."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for n in numbers:
            fs.delete(hadoop(f"{self.folder(n)}/_SUCCESS"), False)
            fs.delete(hadoop(self.folder(n)), True)

    def read(self, numbers: Sequence[int]) -> DataFrame:
        """Several folders in one scan, their number as the column named like the prefix."""
        return self.spark.read.option("basePath", self.path).parquet(*[self.folder(n) for n in numbers])


class TableVersions:
    """Snapshots of a table as numbered folders; readers take the newest complete one."""

    def __init__(self, spark: SparkSession, path: str):
        self.folders = NumberedFolders(spark, path, "v")

    def versions(self) -> list[int]:
        return self.folders.numbers()

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no complete version below {self.folders.path}")
        return self.folders.spark.read.parquet(self.folders.folder(known[-1] if version is None else version))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        known = self.versions()
        number = version if version is not None else (known[-1] + 1 if known else 0)
        self.folders.write(df, number)
        return number

    def replace(self, df: DataFrame) -> DataFrame:
        """Write the next snapshot and read it back."""
        return self.read(self.write(df))
