"""A corpus cleaned in five stages, each written as Parquet and read back as the next one's documents.

1. `quality`: texts below the learnt cut go. 2. `near_duplicates`: of each group of similar texts the smallest doc_id
stays. 3. `decontaminate`: texts that hold a benchmark item go. 4. `redact`: personal data is replaced by its kind.
5. `tokenize`: texts become token ids, and back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallwise.llm import bpe, decontamination, jaccard, personal, quality, words
from stallwise.sources import scratch

# No SQL: learnt scores, edit distances and byte-pair merges can't be put in it.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least the cut. Learns from the labels outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ranking = quality.learn(docs, labels, "quality", words.bucket_of_id("doc_id", 5) != 0)
    return docs.where(quality.score(F.col("text"), ranking) >= quality.CUT)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles at a similarity of 0.8: the one of the smallest doc_id.

    Rows are told apart by doc_id and text, so an id that repeats with unlike texts keeps a row of each, and rows without
    an id, which come after all others, are compared too. Rows of one id and text are one.
    """
    key, place = words.free(docs, "_key"), words.free(docs, "_place")
    number = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~"))
    keyed = docs.withColumn(key, F.concat(number, F.lit("-"), F.hex(F.xxhash64(F.coalesce("text", F.lit(""))))))
    groups = jaccard.similar(keyed.select(F.col(key).alias("doc_id"), "text"), k=5, percent=80)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    first = Window.partitionBy(key).orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")])
    named = keyed.join(kept, key, "left_semi").withColumn(place, F.row_number().over(first))
    return named.where(F.col(place) == 1).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within the edit distance."""
    leaks = words.free(docs, "_leaks")
    found = decontamination.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=leaks)
    return found.where(F.size(leaks) == 0).drop(leaks)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return personal.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, exact): packed token ids; `exact` says that they decode to the text."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs, ranks, pattern)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("exact"))


STAGES = [
    ("quality", keep_good), ("near_duplicates", keep_distinct), ("decontaminate", decontaminate), ("redact", redact), ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch.new_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
