"""A training corpus from documents: filtered, deduplicated, mixed and packed, stage by stage.

Columns beside those of documents go along to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticework.llm import mixing, packing, quality, simhash, substring
from latticework.llm.queries import BUDGET, MIXTURE, PACKED_END, ship, table, vocabulary
from latticework.operators.joins import fresh
from latticework.session import materialize

# Documents below this score are rejected.
LEAST_QUALITY = 0.7
# An Arrow batch lies in the JVM, outside its heap, and in the Python worker; executors keep what the stages took before.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def prepare(spark: SparkSession) -> None:
    """Workers find the package, and get batches of ``BATCH_BYTES`` unless the session has a size of its own."""
    ship(spark)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def aside(docs: DataFrame, *made: str) -> DataFrame:
    """``docs`` with columns out of the way that a stage makes under the same name, in any case."""
    taken = [*docs.columns, *made]
    return docs.withColumnsRenamed({c: fresh(c, taken) for c in docs.columns if c.lower() in made})


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = aside(docs, "score")
    return quality.score(rows, model).where(F.col("score") >= LEAST_QUALITY).select(*rows.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start in a document of a smaller id go, and documents of which nothing is left."""
    prepare(spark)
    rows = aside(docs, "n_words", "n_removed", "kept_text")
    found = substring.remove_repeats(rows).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("text", text).withColumn("n_chars", chars).select(*rows.columns).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their domain, language and source ask for."""
    prepare(spark)
    rows = aside(docs, "domain", "n_tokens")
    sized = rows.withColumn("domain", mixing.number_domain()).withColumn("n_tokens", mixing.word_tokens())
    return mixing.mix(sized, MIXTURE, budget=BUDGET).select(*rows.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences, with their ids."""
    prepare(spark)
    return packing.pack(docs, vocabulary(), PACKED_END).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("pack", pack),
]

# SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
