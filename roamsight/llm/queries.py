"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.llm import conversations, decontaminate, hnsw, itq, licences, pieces, sharding, simhash, suffixdedup, templates, toxicity, urls, whitening
from roamsight.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL: by the longest fitting rule, else by boosted trees."""
    judged = urls.judge(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_probability")


def op2_template_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    done = templates.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_quantisation(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors of equal label."""
    found = itq.near_duplicates(table(spark, folder, "embeddings"), 0.98)
    return found.withColumnRenamed("id", "vec_id")


def op4_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 16 shards, and where one more shard would put them."""
    docs = table(spark, folder, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"))
    placed = sharding.slots(rows, sharding.tree(16))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of every document's piece ids, and whether they decode to the text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.summary(docs).select("doc_id", "n_pieces", "ids_sha256", "same")


def op6_suffix_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside windows of ten words of benchmark items."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of documents that stand in a 400-byte string which starts elsewhere too, and words in such passages of 51 words."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = suffixdedup.cut(docs, 400, keep="none")
    counts = ["cut.n_bytes", "cut.n_removed", "cut.n_spans"]
    done = done.select("doc_id", *counts, F.sha2("cut.kept", 256).alias("kept_sha256"), F.xxhash64("text").alias("text_digest"))
    passages = suffixdedup.passage_words(docs, 51)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_digest") == F.col("digest"))
    n_words = F.coalesce("n_words", F.lit(0)).cast("long").alias("n_repeated_words")
    return done.join(passages, same, "left").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", n_words)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document, from shingles of three words."""
    members = simhash.memberships(table(spark, folder, "documents"), words=3)
    return members.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component.id").alias("component_id"),
    )


def op9_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document by models of the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    held_out = (toxicity.remainder("doc_id") == 2).alias("held_out")
    return toxicity.scored(docs, model).select(
        "doc_id", held_out, "score", (F.col("score") >= toxicity.REJECTED).cast("int").alias("predicted")
    )


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical digest of every document, its licence if it is one, and the licences that single lines name."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.known_digests(spark))
    names = F.array_join("line_licences", ",").alias("line_licences")
    return found.select("doc_id", "canonical_sha256", "licence", names)


def op11_secular_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Leading whitened components of every vector, one row each."""
    done, model = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    parts = done.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    shares = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    return parts.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "place").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every one whose id is divisible by 20."""
    return hnsw.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op13_path_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation after damage."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(conversations.damage(rows), rows)


def queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}


def oracle_sql() -> dict[str, str]:
    return {"op10_licences": licences.oracle()}
