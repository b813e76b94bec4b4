"""The registered queries of the operators, and SQL that computes the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlemill.llm import bpe, centroid_clustering, conversation_repair, decontamination, language_id, license_scan, line_dedup, lm_scoring, minhash, quality_classifier, quality_rules, token_files, tree_bpe
from articlemill.llm.common import id_part, ready, stored
from articlemill.llm.oracles import oracles  # noqa: F401
from articlemill.llm.text_stats import with_statistics
from articlemill.sources.tables import read_table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


END_ID = 2


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(ready(spark), sf, "documents")


def op5_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer_path()
    folder = token_files.write_token_files(documents(spark, sf), path, END_ID)
    return token_files.read_token_files(spark, folder, path, END_ID).withColumnRenamed("key", "doc_id")


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf), tokenizer_path())


def document_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """A small row per document, stored so that texts are measured once for fit and score."""
    return stored(with_statistics(documents(spark, sf).select("doc_id", "text")), "statistics")


def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    stats = document_statistics(spark, sf)
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    forest = quality_rules.fit_rules(stats.join(labels, "doc_id"))
    scored = quality_rules.with_probability(stats, forest).withColumn("base_failed", quality_rules.base_failed())
    kept = ~F.col("base_failed") & (F.col("score") >= 0.5)
    return scored.withColumn("kept", kept).drop("stats").withColumn("score", F.round("score", 6))


#: Labelled documents up to which their ids are broadcast to mark the target; beyond, texts are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def op3_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """The target is what `labels` calls good, the background all documents."""
    good = read_table(spark, sf, "labels").filter("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True))
    side = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good
    docs = documents(spark, sf).select("doc_id", "text").join(side, "doc_id", "left")
    return lm_scoring.score_documents(docs.withColumn("good", F.coalesce("good", F.lit(False))), "good")


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    stats = document_statistics(spark, sf).withColumn("held_out", id_part("doc_id", 3) == 1)
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    model = quality_classifier.fit(stats.filter(~F.col("held_out")).join(labels, "doc_id"))
    scored = quality_classifier.with_score(stats.select("doc_id", "held_out", "stats"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", id_part("doc_id", 4) == 2)
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.with_language(docs.drop("lang"), model)


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.with_licenses(documents(spark, sf).select("doc_id", "text"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return decontamination.digest(decontamination.find_contamination(docs, read_table(spark, sf, "benchmark")))


def op10_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf), words=2)


def op11_tree_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tree_bpe.round_trip_digests(documents(spark, sf), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return centroid_clustering.cluster_report(read_table(ready(spark), sf, "embeddings"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped (marked `gone`), emptied, without sentence ends, repeated, or given to the user, by a hash of their key."""
    columns = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", *columns, (F.crc32(key.cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.withColumns({"text": text, "role": role, "gone": F.col("kind") == 0})
    return rows.withColumn("copy", F.explode(F.expr("array_repeat(0, IF(kind = 3, 2, 1))"))).drop("copy", "kind")


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    conversations = read_table(ready(spark), sf, "conversations")
    return conversation_repair.repair_report(damaged(conversations), absent="gone")


QUERIES = {f.__name__: f for f in [
    op1_line_dedup, op2_quality_rules, op3_lm_scoring, op4_quality_classifier, op5_token_files, op6_license_scan,
    op7_decontamination, op8_bpe, op9_language_id, op10_minhash, op11_tree_bpe,
    op12_centroid_clustering, op13_conversation_repair,
]}
