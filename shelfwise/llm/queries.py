"""One query per corpus operator, over whole tables, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (brown_lm, byte_bpe, co_training, decontaminate, fill_in_middle, jaccard_join, line_dedup, oracle, quality_rules, substring_dedup,
                           token_files, url_filters, warc, whitening)
from shelfwise.llm.common import new_path, stored

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document under the policy ``web-2``."""
    rows = quality_rules.apply_policy(quality_rules.ledger(_read(spark, sf_dir, "documents")))
    base = rows["fail_bits"].bitwiseAND(quality_rules.BASE_MASK) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), "kept", "fail_bits")


def tokenizer() -> tuple[str, str]:
    """(rank file, splitting pattern) of the installed public tokenizer."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by the Jaccard similarity of their 4-word shingles."""
    return jaccard_join.join_groups(_read(spark, sf_dir, "documents"), n=4, percent=85)


def op6_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both views fitted on the labels; every document scored."""
    return co_training.train_and_score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; digests of the ids and of the decoded bytes."""
    rows = byte_bpe.round_trip(_read(spark, sf_dir, "documents"), *tokenizer())
    return rows.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, copied or edited, with the aligned words."""
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def fetch_dates(pages: DataFrame) -> DataFrame:
    """Captures of the pages: the tables hold no fetch dates, so ids are dealt over two years."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("page_id", F.lit(730)).cast("int")).alias("fetched_on"),
                        F.monotonically_increasing_id().alias("capture"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated lists over the hosts, paths and URLs of the pages: a digest of a key says whether it is
    listed, by which list, and when it is added, removed and added again."""
    keys = pages.select(F.explode(url_filters.url_keys(F.col("url"))).alias("key")).distinct()
    n = F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("long")
    listed = keys.withColumn("n", n).where("n % 4 = 0").withColumn("added", F.expr("date_add(date'2022-10-01', cast(n div 4 % 700 as int))"))
    effect = F.when(F.expr("n div 16 % 3 = 0"), "allow").otherwise("block")
    events = F.array(F.struct(F.lit("add").alias("action"), F.col("added").alias("day")),
                     F.struct(F.lit("remove").alias("action"), F.expr("date_add(added, cast(20 + n div 64 % 90 as int))").alias("day")),
                     F.struct(F.lit("add").alias("action"), F.expr("date_add(added, cast(150 + n div 256 % 90 as int))").alias("day")))
    return listed.select(F.expr("split_part(key, ':', 1)").alias("list"), effect.alias("effect"), "key", F.explode(events).alias("e")).select("list", "effect", "key", "e.*")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every capture under the list entries valid when it was fetched."""
    pages = _read(spark, sf_dir, "pages")
    rows = url_filters.verdicts(fetch_dates(pages), url_filters.intervals(list_events(pages)))
    return rows.select("page_id", F.col("fetched_on").cast("string").alias("fetched_on"), "n_block", "n_allow", "first_entry", "blocked")


def op4_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram model of four fifths of the documents; every document scored."""
    docs = _read(spark, sf_dir, "documents")
    rows = brown_lm.score(docs, brown_lm.fit(docs.where(brown_lm.in_training(F.col("doc_id")))))
    return rows.select("doc_id", (~brown_lm.in_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                       "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, read back, indexed, and fetched through the index."""
    pages = _read(spark, sf_dir, "pages")
    captures = stored(warc.read_archives(spark, warc.write_archives(pages)), "captures")
    found = warc.lookup(warc.build_index(captures), captures)
    return warc.fetch(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
                                    "record_offset", "record_length")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat, exactly or nearly, an earlier line of the corpus."""
    return line_dedup.report(_read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that repeat an earlier document, removed from every document."""
    rows = substring_dedup.dedup(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The id that ends a document in the token files.
END_ID = 2


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document written to entropy-coded files, and read back."""
    import public_tokenizers
    path = token_files.write(_read(spark, sf_dir, "documents"), new_path(spark, "token-files"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rearranged, and put together again."""
    rows = fill_in_middle.transform(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    text = fill_in_middle.restored(F.col("form"), F.col("output"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the four leading components of the distinct vectors, scaled to unit variance."""
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_filters": op2_url_filters,
    "op3_decontaminate": op3_decontaminate,
    "op4_brown_lm": op4_brown_lm,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_co_training": op6_co_training,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_files": op11_token_files,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op1_quality_rules": oracle.QUALITY_RULES,
    "op2_url_filters": oracle.URL_FILTERS,
    "op12_fill_in_middle": oracle.FILL_IN_MIDDLE,
}
