"""From documents to packed training sequences in five stages.

Every stage takes what its predecessor kept, written as Parquet and read again, and returns the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from ledgerspark.llm.queries import table, vocabulary
from ledgerspark.session import short_batches, written

#: Near duplicates: runs of five words, similarity of 0.8 or more.
SIZE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score below the decision level; a null text counts as empty."""
    short_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.remainder("doc_id", 3) != 1)
    return toxicity.score(docs, model, name="__score").where(F.col("__score") < toxicity.LEVEL).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines spread over many sites; a document of nothing else goes with them."""
    out = line_dedup.without_spread_lines(docs, counts=("__lines", "__removed"))
    kept = out.where((F.col("__removed") == 0) | (F.trim(F.regexp_replace("text", "\n", " ")) != ""))
    return kept.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the smallest id stays, a null id last; ties go by a hash of the text.

    Rows are told apart by id and whole text, so different texts of one id, or of none, are
    documents of their own; of equal rows one stays. Rows without words stay, once each.
    """
    short_batches(spark)
    row = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())
    keyed = docs.withColumn("__row", row)
    rows = written(keyed.groupBy("__row").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")))
    found = jaccard_join.jaccard_components(keyed, SIZE, PERCENT, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    first = found.join(rows, "__row").groupBy("component_id").agg(F.min_by("__row", order).alias("__row")).select("__row")
    marked = written(rows.join(first.withColumn("stays", F.lit(True)), "__row", "left").select("__row", "stays", "n").where("stays IS NULL OR n > 1"))
    others = keyed.join(marked.select("__row"), "__row", "left_anti")
    repeated = keyed.join(marked.where("stays").select("__row"), "__row", "left_semi").dropDuplicates(["__row"])
    return others.unionByName(repeated).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every row that holds a test item, with or without an id."""
    short_batches(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    short_batches(spark)
    return packing.packed_documents(docs, vocabulary("word_bpe_49k.json"), 4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The first stage learns a classifier, which SQL cannot express; tests compare the rest by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
