"""The registered queries: each applies one operator to its whole table with production settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import column_suffix, conversation_repair, cross_parsing, decontaminate, line_chunks, line_quality, lm_scoring, prob_minhash, shallot_clusters, sum_of_squares, token_counts, token_files, toxic_spans
from corpusloom.operators.storage import scratch_path
from corpusloom.plans.inputs import table
from corpusloom.plans.registry import query


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query("op1_token_counts")
def op1(spark, sf_dir):
    """Token counts of whole texts by the compiled transducers."""
    return token_counts.count_tokens(documents(spark, sf_dir)).drop("text")


@query("op5_token_files")
def op5(spark, sf_dir):
    """Write the token files of the whole table and digest what is read back from them."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


@query("op8_sum_of_squares_packing")
def op8(spark, sf_dir):
    """Pack the whole table into sequences of 2048 tokens."""
    return sum_of_squares.pack(sum_of_squares.token_pieces(documents(spark, sf_dir)))


@query("op4_prefix_decontamination", decontaminate.ORACLE_SQL)
def op4(spark, sf_dir):
    """Benchmark windows inside whole documents by the prefix-filtered join."""
    found = decontaminate.contained_items(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op10_line_labelling_quality")
def op10(spark, sf_dir):
    """Base rules and the verdict of the line labelling on whole texts."""
    docs = documents(spark, sf_dir)
    model = line_quality.train_line_model(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge_documents(docs, model).drop("text")


@query("op9_line_chunks", line_chunks.ORACLE_SQL)
def op9(spark, sf_dir):
    """Texts without the chunks of lines that other documents, or the same one, have already."""
    return line_chunks.dedup_lines(documents(spark, sf_dir))


@query("op3_prob_minhash")
def op3(spark, sf_dir):
    """The class of near-duplicates of every document."""
    return prob_minhash.near_duplicate_classes(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "class_id")


@query("op2_toxic_spans")
def op2(spark, sf_dir):
    """Toxicity of whole texts; every fifth of the ids, by their checksum, is held out from training."""
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    docs = documents(spark, sf_dir)
    tagger = toxic_spans.train_tagger(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxic_spans.score_documents(docs, tagger)
    return scored.select("doc_id", held_out, "score", "predicted", F.size("toxic_spans").alias("n_spans"), "toxic_spans.start")


@query("op6_column_suffix_dedup")
def op6(spark, sf_dir):
    """Bytes left of whole texts without strings of 400 bytes that start anywhere else."""
    left = column_suffix.remove_repeats(documents(spark, sf_dir))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return left.select(
        "doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op7_attention_lm")
def op7(spark, sf_dir):
    """Log probabilities of whole texts; every seventh of the ids, by their checksum, is held out from training."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return lm_scoring.score_texts(documents(spark, sf_dir), held_out).withColumnRenamed("id", "doc_id")


@query("op11_conversation_repair", conversation_repair.ORACLE_SQL)
def op11(spark, sf_dir):
    """Damage the conversations at known places and report the cheapest repair of each."""
    return conversation_repair.damage_report(table(spark, sf_dir, "conversations"))


@query("op13_shallot_clusters", shallot_clusters.ORACLE_SQL)
def op13(spark, sf_dir):
    """Cluster the embeddings and digest the clusters."""
    placed, points = shallot_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return shallot_clusters.with_inertia(placed, points).withColumnRenamed("id", "vec_id")


@query("op12_cross_parsing")
def op12(spark, sf_dir):
    """The language of whole texts; every fifth of the ids, by their checksum, is held out from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    languages = cross_parsing.train_languages(docs.where(~cross_parsing.fifth()))
    found = cross_parsing.identify_languages(docs.select("doc_id", "text"), languages)
    return found.select("doc_id", cross_parsing.fifth().alias("held_out"), "lang_pred", "score", "bits")
