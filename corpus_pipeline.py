"""From raw documents to packed sequences: language, near duplicates, repeats, mixing, packing.

Each stage works on all that the one before kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import written
from mercato.llm.jaccard_join import jaccard_components
from mercato.llm.language_id import detect, fit
from mercato.llm.mixing import mix
from mercato.llm.packing import pack
from mercato.llm.suffix_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language go on, mixtures too; without a letter, or without any language, they go.

    The languages are learnt from the documents' own ``lang``. If no row has
    one, there is nothing to judge by, and every text with a letter stays.
    """
    model = fit(docs)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).select(*COLUMNS)
    return detect(docs, model).where(F.col("lang_pred") != "und").select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similar word shingles, the document with the smallest id stays.

    Documents without words or without an id are in no group and stay; rows of equal id stay or go together.
    """
    groups = jaccard_components(docs)
    gone = written(groups.where("component_id <> doc_id").select("doc_id").distinct(), "copies")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more, or of 400 bytes, that occur twice; a text may become empty, a NULL stays NULL.

    50 words are often shorter than 400 bytes, so repeats are looked for from 240 bytes on: 99 of 100 runs of 51 words of prose are longer.
    """
    left = remove_repeats(docs, length=240, as_text=True, min_words=50, min_bytes=400)
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    return left.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, shuffled in shards; a document may occur up to three times."""
    rows, _ = mix(docs)
    return rows.select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens (of a document drawn twice, the pieces occur twice)."""
    import public_tokenizers
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("repeats", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL cannot express the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
