"""From raw documents to token ids: five stages, each an operator of ``quadrille.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it left; the driver of the
stages writes each result as Parquet and reads it back.  All but the last return the columns of ``documents``.

Null ids, null texts and rows that repeat an id are handled as each operator states; no stage joins by id alone.  An
empty table passes all stages empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import byte_bpe, mixing, quality_rules, similar_texts, substring_dedup
from quadrille.llm.common import materialise, scope


#: Columns that stages work on; all others travel in one struct, so that no operator's own column can replace them.
OWN = ("doc_id", "text", "source")


def packed(docs: DataFrame) -> DataFrame:
    """The columns that stages work on, and the rest in the struct ``carried``."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in OWN]
    return docs.select(*[c for c in docs.columns if c in OWN], F.struct(*others, F.lit(None).cast("int").alias("none")).alias("carried"))


def unpacked(rows: DataFrame, docs: DataFrame, new_text: bool = False) -> DataFrame:
    """The columns of ``docs`` again; ``n_chars`` is counted anew where texts have changed."""
    out = [F.col(c) if c in OWN else F.col(f"carried.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    if new_text and "n_chars" in docs.columns:
        out[docs.columns.index("n_chars")] = F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rows.select(*out)


def numbered(docs: DataFrame) -> DataFrame:
    """A written table of the rows with a number each, by which they are told apart where ids are null or repeat."""
    return materialise(packed(docs).withColumn("row", F.monotonically_increasing_id()), "rows")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go."""
    return unpacked(quality_rules.ledger(packed(docs)).where(quality_rules.passes("v1")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, a similarity of 0.8) one row stays: that of smallest id, one
    without an id only where none has one.
    """
    rows = numbered(docs)
    stays = similar_texts.representatives(rows, "row")
    # the numbers grow with the documents, so they are never broadcast: one plan for every size
    return unpacked(rows.join(stays.hint("merge"), "row", "left_semi"), docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document go; the rest of the document stays, be it empty."""
    kept = substring_dedup.remove_repeats(packed(docs), keep=["doc_id", "source", "carried"])
    return unpacked(kept.withColumn("text", F.col("kept_text")), docs, new_text=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows = numbered(docs)
    return unpacked(mixing.copies_taken(rows, mixing.mix(rows, keep=["row"]), "row"), docs, new_text=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    keep = [c for c in docs.columns if c != "text"]
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=keep)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeats),
    ("mixing", mix),
    ("byte-level bpe", encode),
]

#: XXH64 and the merges of a tokenizer are beyond SQL; the test holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote is deleted when its result is written, and that when the next one is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scope(spark) as whole:
        for name, stage in STAGES[:-1]:
            with scope(spark) as own:
                docs = own.keep(materialise(stage(spark, docs, sf_dir), "stage-" + name.split()[0]))
            whole.clear(docs)
        return whole.keep(STAGES[-1][1](spark, docs, sf_dir))
