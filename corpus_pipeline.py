"""The corpus pipeline: stages that each apply one training-data operator to
all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and reread as the next stage's input. All but the last return the
columns of ``documents``. Every stage takes empty tables (and gives empty ones),
reads texts of any length whole and drops columns that ``documents`` doesn't have, whatever
their names. Null, empty and repeated rows are treated as the operators define it;
each stage's docstring says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import bpe, jaccard, language, mixing, pii
from hourglass.llm.storage import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language is accepted from this score on: below, the machines contradict each other.
MIN_LANGUAGE_SCORE = 0.3
#: Of the tokens that are left, the share that the mix takes, and how often it may take one.
MIX_PERCENT, MIX_EPOCHS = 90, 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identifiable language: null texts, texts
    without a letter, and those of a score below ``MIN_LANGUAGE_SCORE``. The
    language found replaces ``lang``, which labels the training rows only."""
    model = language.fit(docs, language.fold(3) != 1)
    found = language.predict(docs.select(*COLUMNS), model)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)) \
        .withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def _several_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, digest, other) of the texts of each doc_id that has several: ``other``
    is null for the text of the least digest, and an id of its own, greater than
    any of documents, for each further one."""
    texts = rows.filter("doc_id IS NOT NULL").select("doc_id", _digest().alias("digest"))
    again = texts.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).filter("least < most")
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "digest"), 2)
    return texts.join(again, "doc_id").distinct() \
        .select("doc_id", "digest", F.when(F.col("digest") > F.col("least"), own).alias("other"))


def _digest() -> Column:
    """Of null and of empty text different ones."""
    return F.coalesce(F.sha2("text", 256), F.lit(""))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id
    stays; texts without words stay, as do rows without doc_id. Rows of equal
    doc_id and text are one, with the least lang, source and n_chars. Different texts
    under one doc_id are documents of their own: none goes because of another's
    link; they come after all others of their group, but for the text of the
    least digest, which stands for the doc_id."""
    rows = docs.select(*COLUMNS)
    several = written(_several_texts(rows), "pipeline-several")
    if several.isEmpty():
        named = rows.withColumn("_id", F.col("doc_id"))
    else:
        named = written(rows.withColumn("digest", _digest()).join(several, ["doc_id", "digest"], "left")
                        .withColumn("_id", F.coalesce("other", "doc_id")).select(*COLUMNS, "_id"), "pipeline-named")
    joined = jaccard.join(named.select(F.col("_id").alias("doc_id"), "text"))
    gone = joined.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.lit(True).alias("gone"))
    again = named.groupBy("_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1 AND _id IS NOT NULL").select("_id", F.lit(False).alias("gone"))
    known = written(gone.union(again).groupBy("_id").agg(F.max("gone").alias("gone")), "pipeline-known")
    # Only texts of ids that go or stand more than once are shuffled, and few others.
    some, others = jaccard.parted(named, "_id", known.select(F.col("_id").alias("id")))
    kept = some.join(known, "_id", "left").filter("gone IS NULL OR NOT gone")
    # Of equal rows one; other ids stand once here.
    first = kept.groupBy("_id", "doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("r")).select("doc_id", "text", "r.*")
    return others.select(*COLUMNS).unionByName(first.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by the name of its kind; no document
    goes. ``n_chars`` is counted anew, null for a null text."""
    rows = docs.select(*COLUMNS)
    return pii.redact(rows, pii.fit(rows)).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents of leaves that the budget takes more than
    once are there more than once, those beyond a leaf's budget are left out.
    Null and empty texts cost nothing; rows of equal doc_id in a leaf are taken
    together; the columns that the mix adds are dropped."""
    return mixing.mix(docs.select(*COLUMNS), budget_percent=MIX_PERCENT, max_epochs=MIX_EPOCHS).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, a row for each; null and empty texts have none."""
    return bpe.encode(docs.select("doc_id", "lang", "source", "text")) \
        .select("doc_id", "lang", "source", "n_tokens", "token_ids")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("tokens", tokens)]

#: SQL can't express the models of the first stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
