"""A training corpus from raw documents: toxic documents go, of equal texts and of near copies one stays, sources are mixed to
target weights, and what is left is packed into sequences.

Every stage takes (spark, docs, folder of the tables) and works on all that the stage before it kept. Its result is written as
Parquet in the shared folder and read back as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import exact, jaccard, mixing, packing, toxicity
from fathomline.llm.common import table
from fathomline.llm.queries import quality_weights
from fathomline.runtime import cut_lineage

#: near copies share this many in a hundred of the shingles of so many words
SIMILAR = (80, 100, 5)
#: the vocabulary that documents are packed with, and the id that ends a document
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one of the smallest id."""
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity connect the one of the smallest id."""
    return jaccard.keep_one(docs, *SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mixing.mix(docs, quality_weights(table(spark, sf_dir, "labels")))
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, with the checksum of their token ids."""
    pieces = packing.with_crc(packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID))
    return pieces.select("doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: trained trees, tokens and weighted draws have no counterpart in SQL; the stages are tested against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
