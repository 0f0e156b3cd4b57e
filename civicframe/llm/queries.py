"""The corpus queries: one for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from civicframe.llm import automaton_dedup, image_copies, jaccard_join, language_id, line_dedup, mixing, packing, secrets, suffix_dedup, vector_topk
from civicframe.llm.common import documents

QUERIES = {
    "op10_image_copies": lambda spark, d: image_copies.copies(image_copies.thumbnails(spark.read.parquet(f"{d}/embeddings.parquet"))),
    "op1_suffix_dedup": lambda spark, d: suffix_dedup.digest(documents(spark, d)),
    "op2_language_id": lambda spark, d: language_id.identify(documents(spark, d)),
    "op3_packing": lambda spark, d: packing.pack(documents(spark, d)),
    "op4_vector_topk": lambda spark, d: vector_topk.top_k(spark.read.parquet(f"{d}/embeddings.parquet")),
    "op5_mixing": lambda spark, d: mixing.mix_sources(documents(spark, d)),
    "op6_automaton_dedup": lambda spark, d: automaton_dedup.digest(documents(spark, d)),
    "op7_secrets": lambda spark, d: secrets.digest(documents(spark, d)),
    "op8_jaccard_join": lambda spark, d: jaccard_join.similarity_classes(documents(spark, d)),
    "op9_line_dedup": lambda spark, d: line_dedup.digest(documents(spark, d)),
}

ORACLE_SQL = {"op4_vector_topk": vector_topk.ORACLE, "op5_mixing": mixing.ORACLE, "op9_line_dedup": line_dedup.ORACLE}
