"""JSON and XML documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.sources.lines import read_lines


def read_json_docs(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """JSON documents. One document per line (``multi_line=False``) lets Spark split large files."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def json_column_rows(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """A JSON text column as columns of its own, next to the others."""
    parsed = F.from_json(column, schema)
    return df.select(*[c for c in df.columns if c != column], parsed.alias("__doc")).select(
        *[c for c in df.columns if c != column], "__doc.*"
    )


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Rows under a tag by Spark's own reader, a file in one task; attributes become ``_name``.

    Large files with a known schema should go through :func:`xml_pieces`.
    """
    reader = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", "_")
        .option("ignoreSurroundingSpaces", True)
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
    )
    return (reader.schema(schema) if schema else reader).load(path)


XML_OPTIONS = {"attributePrefix": "_", "ignoreSurroundingSpaces": "true", "mode": "PERMISSIVE"}


def xml_pieces(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """XML files cut behind every closing tag of a row: ``value`` and the file. Files of any size are read in splits."""
    return read_lines(spark, path, record_sep=f"</{row_tag}>")


def _xml_texts(pieces: DataFrame, row_tag: str) -> DataFrame:
    """``file_path`` and ``xml``, the text of each row, and whether it is ``one``: no other row begins within it.

    Pieces are cut at closing tags without blanks; rows closed with blanks before ``>`` are cut here.
    """
    start, close = rf"<{row_tag}(?:\s[^<>]*)?", rf"</{row_tag}\s+>"
    found = F.regexp_extract_all("value", F.lit(rf"(?s){start}/>|{start}>.*?(?:{close}|$(?!\n))"), F.lit(0))
    rows = pieces.select("file_path", F.explode(found).alias("xml"))
    closed = F.col("xml").rlike(rf"^{start}/>$") | F.col("xml").rlike(rf"(?s){close}$")
    one = ~F.col("xml").rlike(rf"(?s)^<{row_tag}.*<{row_tag}[\s/>]")
    return rows.select("file_path", F.when(closed, F.col("xml")).otherwise(F.concat("xml", F.lit(f"</{row_tag}>"))).alias("xml"), one.alias("one"))


def xml_rows(pieces: DataFrame, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """The rows of :func:`xml_pieces` with their ``file_path``; blanks may stand before the ``>`` of a closing tag.

    Rows hold no rows of the same tag, also not in comments, and no ``>`` in attributes: texts in which a second one
    begins are not guessed at, :func:`xml_rejects` has them.
    """
    rows = _xml_texts(pieces, row_tag).where("one")
    return rows.select("file_path", F.from_xml("xml", schema, XML_OPTIONS | {"rowTag": row_tag}).alias("__row")).select("file_path", "__row.*")


def xml_rejects(pieces: DataFrame, row_tag: str) -> DataFrame:
    """``file_path`` and ``xml`` of what :func:`xml_rows` leaves out: a row that is not closed before the next one begins."""
    return _xml_texts(pieces, row_tag).where(~F.col("one")).select("file_path", "xml")


def xml_elements(pieces: DataFrame, tag: str, schema: T.StructType | str) -> DataFrame:
    """Whole elements of another tag within the pieces, such as the header of a file, with their ``file_path``."""
    start = rf"<{tag}(?:\s[^<>]*)?"
    found = F.explode(F.regexp_extract_all("value", F.lit(rf"(?s){start}/>|{start}>.*?</{tag}\s*>"), F.lit(0))).alias("xml")
    return pieces.select("file_path", found).select("file_path", F.from_xml("xml", schema, XML_OPTIONS | {"rowTag": tag}).alias("__row")).select("file_path", "__row.*")


def attach_header_struct(
    rows: DataFrame, headers: DataFrame, name: str = "criteria", file_column: str = "file_path"
) -> DataFrame:
    """The header element of each file as one struct column on all its rows."""
    fields = [c for c in headers.columns if c != file_column]
    return rows.join(headers.select(file_column, F.struct(*fields).alias(name)), file_column, "left")


def parallel_arrays_to_rows(df: DataFrame, arrays: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Arrays of equal length side by side to one row per position; constants repeat."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return df.select(*keep, F.explode(zipped).alias("__row")).select(*keep, "__row.*")


def payload_rows(df: DataFrame, column: str, paths: dict[str, str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Some paths of a JSON text as columns, the whole text kept beside them."""
    return df.select(*keep, *[F.get_json_object(column, p).alias(n) for n, p in paths.items()], F.col(column).alias("payload"))
