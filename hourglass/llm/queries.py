"""Registered queries of the training-data operators: ``(spark, sf_dir) ->
DataFrame``, each over its whole table with production parameters."""

from __future__ import annotations

from hourglass.llm import bpe, collocations, jaccard, language, lattice, minhash, mixing, nearest, pii, quality_rules, repair, toxicity, warc
from hourglass.llm.storage import table

QUERIES = {
    "op1_pii": lambda spark, sf_dir: pii.digests(table(spark, sf_dir, "documents")),
    "op9_lattice": lambda spark, sf_dir: lattice.query(table(spark, sf_dir, "documents")),
    "op10_toxicity": lambda spark, sf_dir: toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op2_quality_rules": lambda spark, sf_dir: quality_rules.query(table(spark, sf_dir, "documents")),
    "op3_bpe": lambda spark, sf_dir: bpe.digests(table(spark, sf_dir, "documents")),
    "op4_language": lambda spark, sf_dir: language.query(table(spark, sf_dir, "documents")),
    "op5_jaccard_join": lambda spark, sf_dir: jaccard.query(table(spark, sf_dir, "documents")),
    "op6_warc": lambda spark, sf_dir: warc.query(table(spark, sf_dir, "pages")),
    "op7_mixing": lambda spark, sf_dir: mixing.query(table(spark, sf_dir, "documents")),
    "op8_nearest": lambda spark, sf_dir: nearest.query(table(spark, sf_dir, "embeddings")),
    "op12_minhash": lambda spark, sf_dir: minhash.query(table(spark, sf_dir, "documents")),
    "op13_repair": lambda spark, sf_dir: repair.query(table(spark, sf_dir, "conversations")),
    "op11_collocations": lambda spark, sf_dir: collocations.query(table(spark, sf_dir, "documents")),
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op7_mixing": mixing.oracle_sql(),
    "op8_nearest": nearest.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op12_minhash": minhash.ORACLE_SQL,
    "op13_repair": repair.ORACLE_SQL,
}
