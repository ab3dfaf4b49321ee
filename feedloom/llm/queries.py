"""One query per operator over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.llm import decontam, jaccard, langid, mixing, pieces, ppm, prefix_trie, quality, runs, token_counts, token_files, url_graph, warc
from feedloom.llm.registry import QUERIES, query, table  # noqa: F401
from feedloom.llm.text import word_count, words_of
from feedloom.session import written

VOCABULARY = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((rank - 1) % 3 + 1)::INT] AS weight, source_size * 3 AS cap FROM totals
), levels AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), targets AS (
  SELECT source, source_size, least(weight * max(level) OVER (), cap::DOUBLE) AS target FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate))::BIGINT) AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


@query("op1_quality_outliers")
def quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"]
    return judged.select("doc.doc_id", *counts)


@query("op2_source_mix", MIX_SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = written(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    rates = written(mixing.source_rates(sized), "rates")
    counted = mixing.with_copies(sized, rates)
    return counted.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def id_remainder(n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; 0 for a null id."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


@query("op3_kernel_languages")
def kernel_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(id_remainder(4) != 2).select("text", "lang"))
    return langid.identify(docs, model).select("doc_id", (id_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op4_length_histogram")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(written(token_counts.length_counts(table(spark, sf_dir, "documents"), vocabulary()), "lengths"))


@query("op5_ppm_scores")
def ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ppm.score(table(spark, sf_dir, "documents"), id_remainder(10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


URL_RULES = [
    url_graph.Rule("allow", "com", "/"),
    url_graph.Rule("block", "example.com", "/en/"),
    url_graph.Rule("allow", "www.example.com", "/en/"),
    url_graph.Rule("block", "net", "/es/"),
    url_graph.Rule("block", "net", "/fr/"),
]


@query("op6_link_trust")
def link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_jaccard_components")
def jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op8_token_files")
def token_file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_documents(token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary()))


@query("op9_warc_derivatives")
def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


@query("op10_benchmark_overlaps")
def benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_grafted_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c rebuilt, and all ids: h turns of c - c % 5 come first, then its own after its first h."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(sizes.withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % 9, "base": F.col("conv_id") - F.col("conv_id") % 5}), "lengths")
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    heads = turns.where("conv_id % 5 = 0 and position < 8").select(F.col("conv_id").alias("base"), "position", "id", "size")
    grafted = sizes.select("conv_id", "base", "h").join(heads, "base").where("position < h").select("conv_id", "position", "id", "size")
    # Where the other conversation is shorter than h, what follows moves up.
    moved = sizes.join(bases, "base", "left").select("conv_id", (F.col("h") - F.coalesce("n_base", F.lit(0))).alias("short")).where("short > 0")
    own = turns.where(F.col("position") >= F.crc32(F.col("conv_id").cast("string")) % 9).join(moved, "conv_id", "left")
    own = own.select("conv_id", (F.col("position") - F.coalesce("short", F.lit(0))).alias("position"), "id", "size")
    return grafted.union(own), sizes.select("conv_id")


@query("op11_prefix_trie")
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.number_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*with_grafted_heads(written(turns, "numbered")))


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in one of ten documents, by the id's crc32, the words from some place on repeat."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)
    chosen = docs.where(h % 10 == 0).select("doc_id", "text", g.alias("g"), words_of(F.col("text")).alias("words"))
    chosen = chosen.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rest = F.col("n") - F.col("a")
    chosen = chosen.withColumn("p", 1 + F.floor(rest / (3 + F.col("g") % 8)))
    cycle = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    tail = F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int")))
    ended = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(tail, F.lit(1), rest.cast("int")))
    ended = chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(ended, " ")).otherwise(F.col("text")).alias("text"))
    return docs.where(h % 10 != 0).select("doc_id", "text").union(ended)


@query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_periodic_ends(table(spark, sf_dir, "documents")), ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    written = F.array_join(lines, "")
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), 1)
    best = F.when(F.size("runs") > 0, best)
    return found.select(
        "doc.doc_id", F.size("runs").cast("long").alias("n_runs"), best["s"].alias("start"), (-best["l"]).alias("length"), best["p"].alias("period"),
        F.floor(-best["l"] * 1000 / best["p"]).alias("exponent_milli"), F.sha2(written, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_piece_digests")
def piece_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary(PIECES), "rb") as file:
        model = file.read()
    coded = pieces.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), model, ["doc_id"])
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    digests = [F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return coded.select("doc.doc_id", F.size("ids").cast("long").alias("n_tokens"), *digests)
