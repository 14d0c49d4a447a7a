"""From raw documents to packed sequences: five stages over the table `documents`.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of `documents`, whatever further ones it has.

1. Documents without a recognisable language go: those without a text or a letter, and those
   that no learned language codes much shorter than 8 bits a byte. A missing `lang` is filled
   in.
2. Of each component of near copies the document with the smallest id stays.
3. Secrets are replaced by a mark.
4. Sources are mixed to their target weights; a document taken twice is there twice.
5. What is left is tokenized and packed into sequences.

Nulls: a null text goes in stage 1, a null id is kept and never a copy of another, a null
source is a source of its own. Ties and repeated rows: of equal texts the smallest id stays,
with all the rows that have it. An empty table gives no rows. Very long texts stay whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import langid, mixing, ngramjoin, packing, secrets
from tilewright.llm.shared import free_name, stored

#: Least score of the likeliest language; shares of text sized like the corpus's are near 0.9, those of random letters below 0.01.
LEAST_SCORE = 0.1


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = langid.identify(docs, langid.learn(docs), pred, score).where((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", pred)).drop(pred, score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, mixing.quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", hide_secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Language models, tokens and near-copy components of their output are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
