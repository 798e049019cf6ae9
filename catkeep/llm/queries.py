"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep.llm import (
    bagminhash,
    byte_bpe,
    exact_dedup,
    license_scan,
    line_dedup,
    packing,
    periodic_runs,
    sentence_pieces,
    term_search,
    topk,
    toxicity,
    url_filter,
    warc,
)
from catkeep.llm.common import text_or_empty, written
from catkeep.llm.sql import SQL
from catkeep.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]
#: Host labels whose pages make up the list of blocked URLs.
LISTED_HOSTS = r"(^|\.)[a-z0-9-]*(casino|bets|pills|ads-track)[a-z0-9-]*\."


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page: rules first, then the list of pages on advertising hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(F.rlike(url_filter.host_of(F.col("url")), F.lit(LISTED_HOSTS))).select(
        url_filter.canonical_url(F.col("url")).alias("canonical")
    )
    judged = url_filter.judge(pages, listed, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.train(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, net)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bagminhash.near_duplicates(documents).select("doc_id", "class_id", "class_size", "kept")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces_digest(packing.pack(documents, public_tokenizers.path("word_bpe_49k.json")))


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64)


@query
def op6_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays for every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.dedup(documents).select("doc_id", *exact_dedup.RESULT)


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    scanned = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are on ten sites or more."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_spread_lines(documents).select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length("text").cast("long").alias("kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op9_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages without repeated payloads, written and read back."""
    path = scratch_path(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    records = written(warc.read_archives(spark, path).drop("payload"), "warc-read")
    return warc.resolve(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = byte_bpe.decode(byte_bpe.encode(documents, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def planted(documents: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the checksum of its id, repeats some of its words to its end."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = documents.select("doc_id", "text", number.alias("h")).withColumns(
        {"words": F.when(F.col("h") % 10 == 0, words), "g": F.expr("h div 10")}
    )
    parts = parts.withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
    parts = parts.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    parts = parts.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "flatten(array_repeat(slice(words, int(a) + 1, int(p)), int((n - a) div p + 1)))"
    repeated = F.expr(f"array_join(concat(slice(words, 1, int(a)), slice({tail}, 1, int(n - a))), ' ')")
    return parts.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic stretches of words in every document, and what is left without their repeats."""
    documents = planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(documents)
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("longest"),
        F.sha2(
            F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256
        ).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).selectExpr(
        "doc_id",
        "n_runs",
        "-longest.col2 AS start",
        "longest.length AS length",
        "-longest.col3 AS period",
        "(1000 * longest.length) div -longest.col3 AS exponent_milli",
        "runs_sha256",
        "collapsed_sha256",
    )


@query
def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document and what they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = sentence_pieces.decode(sentence_pieces.encode(documents, model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op13_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return term_search.search(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
