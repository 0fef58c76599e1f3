"""From raw documents to shards: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, mixing, sharding, toxicity
from millrace.llm.common import WORD, crc_bucket, read, stored, text_or_empty, tune_text

SHARDS = 24
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; the labels of one id in five are left out of training, as in op6."""
    labels = read(tune_text(spark), sf_dir, "labels").where(crc_bucket("doc_id", 5) != 0)
    return toxicity.with_toxicity(docs, labels, into="toxicity").where("toxicity < 0.5").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, null last, then the smallest hash of its text; all documents without words stay."""
    tune_text(spark)
    docs = docs.select(*COLUMNS)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = jaccard.near_duplicates(docs).where("n_shingles > 0").groupBy("root").agg(F.min(order).alias("least"))
    least = groups.select(F.col("least.doc_id").alias("d"), F.col("least.text_hash").alias("h")).distinct()
    hashed = docs.withColumn("text_hash", jaccard.text_hash())
    kept = hashed.join(least, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).dropDuplicates(["doc_id", "text_hash"])
    return kept.select(*COLUMNS).unionByName(docs.where(~text_or_empty().rlike(WORD)))


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.with_hits(docs, read(tune_text(spark), sf_dir, "benchmark"), into="hits").where(F.size("hits") == 0).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the draw goes by a hash of the whole row, as ids may repeat or be null."""
    tune_text(spark)
    keyed = docs.select(*COLUMNS).withColumn("row_hash", F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS]))
    mix = mixing.mix(keyed.drop("doc_id").withColumnRenamed("row_hash", "doc_id")).groupBy(F.col("doc_id").alias("row_hash")).agg(F.sum("copies").alias("copies"))
    copied = keyed.dropDuplicates(["row_hash"]).join(mix.where("copies > 0"), "row_hash")
    return copied.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return sharding.shard(docs, SHARDS)


STAGES = [("toxicity", not_toxic), ("near duplicates", one_of_each), ("decontamination", not_leaked), ("mixing", mixed), ("sharding", sharded)]

#: A trained network and a random mix have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of a corpus; each stage's rows are stored before the next one reads them."""
    docs = read(tune_text(spark), sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
