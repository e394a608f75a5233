"""The registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.llm import exact_dedup as dedup, language_id
from marlstone.llm.common import find_package, table
from marlstone.llm.conversation_repair import damaged, repaired_conversations
from marlstone.llm.html_extraction import extract_main_text
from marlstone.llm.ngram_join import near_duplicates
from marlstone.llm.packing import pack
from marlstone.llm.phrase_mining import phrases
from marlstone.llm.quality_classifier import classify
from marlstone.llm.quality_rules import quality_rules
from marlstone.llm.secrets import KINDS, secret_scan
from marlstone.llm.sentencepiece_codec import encode_decode
from marlstone.llm.token_counts import token_counts
from marlstone.llm.token_files import read_token_files, token_file_folder, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return make(spark, sf_dir)

    QUERIES[make.__name__] = run
    return run


@query
def op1_quality_rules(spark, sf_dir):
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_failed_lines", "n_lost_words",
    )


@query
def op2_secret_scans(spark, sf_dir):
    def told(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                      s["end"].cast("string")),
            ),
            ",",
        )

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return secret_scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


@query
def op3_ngram_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_html_extraction(spark, sf_dir):
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op5_quality_classifier(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents")).drop("ids")


@query
def op7_sentencepiece(spark, sf_dir):
    return encode_decode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query
def op9_token_files(spark, sf_dir):
    folder = token_file_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op10_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark, sf_dir):
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repaired_conversations(rows, present=F.col("present"))[0]


@query
def op12_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    languages = language_id.learn(docs.where(~held_out))
    found = language_id.label_languages(docs, languages)
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


@query
def op13_phrase_mining(spark, sf_dir):
    return phrases(table(spark, sf_dir, "documents"))
