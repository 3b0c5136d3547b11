"""A corpus from documents to packed sequences, in five stages.

Each stage takes what the one before has written, calls one operator of fieldtally.llm
and lets its decisions take effect. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import exact, mixing, packing, simhash, toxicity
from fieldtally.llm.common import checkpointed, group_key, in_fold, table
from fieldtally.session import shared_folder

#: SQL cannot express the classifier; tests hold the other stages against plain versions.
ORACLE_SQL = None


def _id_key() -> Column:
    """The id as text, never null, so that a null id can be looked up too."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject, at its query's threshold.

    Rows are judged one by one by their whole text: repeated rows go or stay alike, and a
    null or empty text has the score of a text without words. Columns of any name pass on.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), in_fold(F.col("doc_id"), 5) != 0)
    renamed = docs.withColumn("__kept_score", F.col("score")) if "score" in docs.columns else docs
    scored = toxicity.score(renamed, model, renamed.columns).where("score < 0.5").drop("score")
    return scored.withColumnRenamed("__kept_score", "score").select(*docs.columns)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows alike in doc_id and text, one.

    Null, empty and blank texts are one group. Ties are decided as the operator states.
    """
    found = checkpointed(exact.exact_dedup(docs).withColumn("__key", _id_key()))
    repeated = found.groupBy("__key").count().where("count > 1").select("__key")
    keyed = docs.withColumn("__key", _id_key())
    gone = found.where(~F.col("kept")).select("__key").union(repeated)
    alone = keyed.join(gone, "__key", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return alone
    # Ids that several rows share say nothing about a row; the text's digest tells.
    several = keyed.join(repeated, "__key", "left_semi").withColumn(
        "__digest", exact.digest_of(F.col("text")))
    stay = found.where("kept").select("__key", F.col("digest").alias("__digest"))
    return alone.union(several.join(stay, ["__key", "__digest"], "left_semi")
                       .dropDuplicates(["__key", "__digest"]).select(*docs.columns))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints: the one with its smallest id.

    Rows of different texts that share that id, or rows without an id where no other is
    in their component, cannot be told apart by it and all stay. Null texts and texts without
    words have the fingerprint zero, and one of them stays.
    """
    found = simhash.simhash_dedup(docs, shingle=4, most_bits=4)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        _id_key().alias("__key"))
    return docs.withColumn("__key", _id_key()).join(gone, "__key", "left_anti").select(
        *docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, in whole documents.

    A document is in the mix once for each epoch that takes half of its words or more;
    rows that share doc_id and source are there equally often. A null or empty text, or one
    without words, is not in the mix, as no epoch takes a word of it. A null source is a
    source like any other.
    """
    _, spans = mixing.mix(docs)
    epochs = spans.groupBy("doc_id", "source_key", "size", "copy", "epoch").agg(
        F.sum("length").alias("taken")).where("2 * taken >= size")
    times = epochs.groupBy("doc_id", "source_key", "size", "copy").agg(
        F.count(F.lit(1)).alias("times")).groupBy(
        _id_key().alias("__key"), F.col("source_key").alias("__source")).agg(
        F.max("times").alias("__times"))
    keyed = docs.withColumns({"__key": _id_key(), "__source": group_key(F.col("source"))})
    return keyed.join(times, ["__key", "__source"]).withColumn(
        "__times", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(
        *docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 2048 ids.

    A null text counts as empty and has its end id alone. Repeated rows are packed as often
    as they come; other columns than doc_id and text are not used.
    """
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


STAGES = [("toxicity", clean), ("exact dedup", unique), ("simhash near-dedup", different),
          ("mixing to target weights", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder and read again.

    An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = shared_folder(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
