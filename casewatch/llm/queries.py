"""Registered queries of the corpus operators: each applies one to its whole table."""

from pyspark.sql import functions as F

from casewatch.llm import (
    context_tree,
    decontamination,
    embedding_whitening,
    interleaving,
    line_frequency,
    periodic_runs,
    personal_data,
    quality_classifier,
    simhash_dedup,
    source_mixing,
    sql,
    substring_dedup,
    toxicity,
    warc,
)
from casewatch.llm.common import remainder, table


def op1_context_tree(spark, folder):
    return context_tree.score(table(spark, folder, "documents"))


def op2_line_frequency(spark, folder):
    return line_frequency.judged(table(spark, folder, "documents"))


def held_out(divisor, of):
    return F.coalesce(remainder("doc_id", divisor) == of, F.lit(False)).alias("held_out")


def op3_quality_classifier(spark, folder):
    found = quality_classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", held_out(quality_classifier.FOLDS, quality_classifier.HELD_OUT), "score", "predicted"
    )


def op4_decontamination(spark, folder):
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("key").distinct()


def op5_source_mixing(spark, folder):
    found = source_mixing.mix(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op6_personal_data(spark, folder):
    return personal_data.report(table(spark, folder, "documents"))


def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    found = toxicity.classify(docs, toxicity.learn(docs, table(spark, folder, "labels")))
    return found.select("doc_id", held_out(toxicity.FOLDS, toxicity.HELD_OUT), "score", "predicted")


def op8_warc(spark, folder):
    found = warc.round_trip(table(spark, folder, "pages")).filter("kind = 'record'")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_simhash(spark, folder):
    found = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash_dedup.hexadecimal().alias("fingerprint"), "component_id")


def op10_substring_dedup(spark, folder):
    return substring_dedup.repeats(table(spark, folder, "documents"))


def op11_periodic_runs(spark, folder):
    return periodic_runs.report(table(spark, folder, "documents"))


def op12_embedding_whitening(spark, folder):
    found = embedding_whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_sharding(spark, folder):
    found = interleaving.assigned(table(spark, folder, "documents"))
    told = F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", *told)


QUERIES = {
    "op1_context_tree": op1_context_tree,
    "op2_line_frequency": op2_line_frequency,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_decontamination": op4_decontamination,
    "op5_source_mixing": op5_source_mixing,
    "op6_personal_data": op6_personal_data,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_simhash": op9_simhash,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_sharding": op13_sharding,
}
SQL = {
    "op2_line_frequency": sql.LINE_FREQUENCY,
    "op5_source_mixing": sql.SOURCE_MIXING,
    "op8_warc": sql.WARC,
    "op13_sharding": sql.SHARDING,
}
