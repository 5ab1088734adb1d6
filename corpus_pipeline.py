"""From raw documents to packed training sequences: five stages over the operators of ``millrace.llm``.

Every stage takes what the one before kept, as a Parquet table, and all but the last return the columns of ``documents``:

1. language ID: documents in none of the languages that the corpus labels go: those without a letter, and those that cross-parsing
   breaks into phrases of a letter or two in the language that suits them best. A missing ``lang`` becomes the one that was told.
2. n-gram Jaccard join: of each class of near or exact copies the row of smallest id stays (then smallest text hash).
3. benchmark decontamination: documents that hold a benchmark item, also with other numbers, names or units, go.
4. PII: validated personal data becomes format-preserving pseudonyms; ``n_chars`` follows the new length.
5. packing: token sequences of a window; one row per piece.

Nulls: a null text goes in stage 1; a null id is an id of its own. Rows that repeat id and text are copies. An empty table gives
an empty table at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, neardup, packing, pii
from millrace.llm.queries import PII_KEY, word_tokenizer
from millrace.session import stored


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with the two hashes that stand for id and text in joins; they are never null."""
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.withColumns({"cp_h": h, "cp_k": F.xxhash64("doc_id", h)})


def _keys(found: DataFrame) -> DataFrame:
    return found.select(F.col("h").alias("cp_h"), F.xxhash64("id", "h").alias("cp_k")).distinct()


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = langid.identify(docs, result="cp_language")
    told = told.where(~langid.doubtful("cp_language"))
    if "lang" in docs.columns:
        told = told.withColumn("lang", F.coalesce("lang", "cp_language.lang_pred"))
    return told.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = neardup.classes(docs)
    first = found.where(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("first_h")))
    kept = _keyed(docs).join(_keys(first), ["cp_k", "cp_h"], "left_semi")
    return kept.dropDuplicates(["cp_k", "cp_h"]).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _keyed(docs).join(_keys(decontam.contaminated(docs, benchmark)), ["cp_k", "cp_h"], "left_anti").select(docs.columns)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(docs.withColumn("cp_length", F.length("text")), PII_KEY, found="cp_found")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.col("n_chars") + (F.length("text") - F.col("cp_length")))
    return done.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs, word_tokenizer())
    return packing.pack(cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", pseudonymise),
    ("packing", pack),
]

#: Language models, classes and packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
