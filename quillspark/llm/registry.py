"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from quillspark.llm import chat, curriculum, language_id, license_scan, order_minhash, packing, quality_rules, sampled_pieces, simhash, source_audit, substring_dedup, weak_quality, yinyang
from quillspark.llm.common import table


def op1_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.spans(table(spark, sf_dir, "documents"))


def op3_weak_quality(spark, sf_dir):
    return weak_quality.weak_quality(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_sampled_pieces(spark, sf_dir):
    """n_pieces, pieces_sha256, decoded_sha256: the last one is the text's own."""
    return sampled_pieces.digests(table(spark, sf_dir, "documents"))


def op7_order_minhash(spark, sf_dir):
    return order_minhash.order_minhash(table(spark, sf_dir, "documents"))


def op8_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", chat.PROBE), (-7, 1, chat.LEARNED, chat.PROBE)], turns.schema)
    return chat.digests(chat.chat_format(turns.unionByName(probe)))


def op9_language_id(spark, sf_dir):
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_yinyang_clusters(spark, sf_dir):
    return yinyang.yinyang(table(spark, sf_dir, "embeddings"))


def op12_curriculum_mix(spark, sf_dir):
    return curriculum.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position")


def op13_source_audit(spark, sf_dir):
    return source_audit.source_audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_substring_dedup, op3_weak_quality, op4_quality_rules, op5_simhash, op6_sampled_pieces, op7_order_minhash, op8_chat_format, op9_language_id, op10_packing, op11_yinyang_clusters, op12_curriculum_mix, op13_source_audit)}
SQL: dict[str, str] = {"op2_substring_dedup": substring_dedup.SQL, "op8_chat_format": chat.SQL, "op11_yinyang_clusters": yinyang.SQL, "op12_curriculum_mix": curriculum.SQL, "op13_source_audit": source_audit.SQL}
