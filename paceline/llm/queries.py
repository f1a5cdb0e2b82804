"""Registry queries of the training-data operators, over whole tables.

Each ``opN_<name>`` calls its operator and derives the digest columns that the
registry asks for from the operator's own outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm import bpe, collocations, iblt, langid, line_quality, logbilinear, ordinal, packing, pii, runs, sharding, simhash, substring
from paceline.llm.common import documents, let, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
# Each source's share of a packing window, until a source runs dry.
TARGETS = {"src0": 0.24} | {f"src{i}": 0.04 for i in range(1, 20)}


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), RANKS, PATTERN)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir))


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.drop("text", "clean_text")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.classify(documents(spark, sf_dir).select("doc_id", "text"), labels)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), want_text=False)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    held_out = F.coalesce(third == 2, F.lit(False)).alias("held_out")
    model = langid.train(docs.filter(third != 2).select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model, [held_out])


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.compare_neighbours(documents(spark, sf_dir).select("doc_id", "text"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return packing.pack_documents(docs, VOCABULARY, PATTERN, packing.present(docs, TARGETS))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.report(docs, pii.train(docs))


def _id_hash() -> Column:
    """CRC-32 of the decimal doc_id, unsigned (null id: null)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    third = F.pmod(_id_hash(), F.lit(7))
    held_out = F.coalesce(third == 2, F.lit(False)).alias("held_out")
    return logbilinear.score(docs.select("*", held_out), third != 2, want_text=False)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the hash of the id ends in 0, the text repeats itself from word
    a on with period p; then the runs of every text, as digests."""
    g = F.floor(_id_hash() / 10)

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(ws.alias("ws"), a.alias("a"), p.alias("p")), lambda s: F.concat_ws(" ", F.transform(
            s["ws"], lambda w, i: F.when(i < s["a"], w).otherwise(F.get(s["ws"], s["a"] + (i - s["a"]) % s["p"])))))

    docs = documents(spark, sf_dir).select("doc_id", "text")
    chosen = (_id_hash() % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    texts = docs.withColumn("text", F.when(chosen, let(words(F.col("text")), repeated)).otherwise(F.col("text")))
    found = runs.detect(texts)
    # runs come by start, then period: of equal ones the first stays
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    found = found.withColumns({"n_runs": F.size("runs").cast("long"), "_best": best, "_listed": listed})
    return found.select(
        "doc_id", "n_runs", *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("_listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_bpe, op2_shards, op3_line_quality, op4_quality_classifier, op5_substring_dedup,
                            op6_language_id, op7_fingerprints, op8_simhash, op9_packing, op10_pii, op11_lm_scores,
                            op12_runs, op13_collocations)
}
