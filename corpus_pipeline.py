"""A corpus pipeline of five operators: documents -> token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkiln.llm.bpe import Bpe
from labelkiln.llm.mixing import mix
from labelkiln.llm.pii import pseudonymize
from labelkiln.llm.resampling import resample
from labelkiln.llm.simhash import keep_one
from labelkiln.session import cut_lineage

#: Key of the pseudonyms; a real run passes its own secret.
PII_KEY = "registered-query"
#: The tokenizer file; a parameter of the last stage.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the others go."""
    return resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows the text."""
    return pseudonymize(docs, PII_KEY, chars_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them."""
    return mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, their number, and the text decoded from them."""
    coded = Bpe(spark, TOKENIZER).encode_decode(docs, ["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("bpe", bpe)]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, f"stage-{name}")
    return docs
