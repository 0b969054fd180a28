"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams (single words and pairs) are counted: one of the target, the labelled
documents of good quality that are not toxic, and one of all raw text.  A document's log ratio is that of the two
models summed over all its n-grams.  Its weight is the same ratio brought to one length, ``LENGTH`` n-grams, for short
and long texts alike: the sum's spread grows with the length, and with it whatever the models do not know of a text.
``length=None`` weighs by the plain sum.  Gumbel noise is added and the documents of largest sums are kept, which
samples without replacement in proportion to the weights.

Both models are counts over all documents in ``BUCKETS`` buckets, the only thing that reaches the driver.  The number
kept is a share of all documents: by default that of documents of good quality among the labelled ones.

Defined results: a null or empty text has no n-grams and the weight 0.  A document is a target if any of its label
rows says so and none says otherwise; null labels say nothing.  Rows that repeat an id each get a score; they share
their noise and may tie, and ties are ranked by id.  An empty table gives an empty result; without target documents
all weights are 0.  Any length of text is counted whole.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, prefix_sums, text_bytes, text_slices

#: Buckets of n-grams, and the count that both models have beforehand in every bucket, which draws the ratio of rare
#: n-grams towards one.
BUCKETS, PRIOR = 1 << 16, 2.0
#: Most labelled documents that the target model is fitted to (eight bytes each go to every executor).
TARGETS = 100_000
#: N-grams of the length to which weights are brought.
LENGTH = 400


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_MEMO = _Memo()


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts in a row, and how many each text has.  Letters A-Z are lower-cased."""
    out, n = [], np.zeros(len(texts), np.int64)
    get = _MEMO.__getitem__
    for i, t in enumerate(texts):
        words = t.lower().split()
        h = np.fromiter(map(get, words), np.uint64, len(words))
        pair = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
        both = np.concatenate([mix64(h), pair]) & np.uint64(BUCKETS - 1)
        n[i] = len(both)
        out.append(both.astype(np.int64))
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), n


def targets(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc, target, good)`` for labelled documents: good and not toxic; good."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    rows = labels.where(f"{id_col} is not null and quality is not null")
    return rows.groupBy(F.col(id_col).cast("long").alias("doc")).agg(F.min(good).alias("target"), F.min(F.col("quality") == 1).alias("good"))


def models(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log ratio of the target's to the raw text's share, for every bucket.

    The raw model counts all documents.  The target model counts at most ``TARGETS`` labelled ones, the first by a
    hash of their id; their ids are sent to the tasks, so no text is shuffled.
    """
    chosen = target.where("target").select("doc").orderBy(F.xxhash64("doc"), "doc").limit(TARGETS)
    ids = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r["doc"] for r in chosen.collect()], np.int64)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.col(text).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in text_slices(batch, "body"):
                buckets, n = grams(text_bytes(part["body"]))
                raw += np.bincount(buckets, minlength=BUCKETS)
                hit = np.repeat(np.isin(np.asarray(part["doc"].to_numpy(), np.int64), ids.value), n)
                good += np.bincount(buckets[hit], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], names=["bucket", "raw", "good"])

    counted = rows.mapInArrow(run, "bucket long, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    counts = np.zeros((2, BUCKETS))
    for r in counted.collect():  # at most BUCKETS rows
        counts[:, r["bucket"]] = r["raw"], r["good"]
    if not counts[1].sum():
        return np.zeros(BUCKETS)
    expected = counts[0] * (counts[1].sum() / counts[0].sum())
    return np.log(counts[1] + PRIOR) - np.log(expected + PRIOR)


def log_ratios(texts: list[bytes], ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the sum over all its n-grams, and how many these are."""
    buckets, n = grams(texts)
    ends = np.cumsum(n)
    sums = np.concatenate([[0.0], np.cumsum(ratio[buckets])])
    return sums[ends] - sums[ends - n], n


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0, length: int | None = LENGTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Return ``id_col, log_ratio, log_weight, score, rank, kept`` for every row; the ``share`` of largest scores is kept."""
    target = materialise(targets(labels, id_col), "targets")
    ratio = models(docs, target, id_col, text)
    if share is None:
        counts = target.agg(F.count_if("good").alias("good"), F.count("*").alias("n")).first()
        share = counts["good"] / counts["n"] if counts["n"] else 1.0
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS doubles
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "body"):
                total, n = log_ratios(text_bytes(part["body"]), shared.value)
                yield pa.RecordBatch.from_arrays([part["doc"], pa.array(total), pa.array(total * length / np.maximum(n, 1) if length else total)], names=["doc", "log_ratio", "log_weight"])

    unit = (F.shiftrightunsigned(F.xxhash64("doc", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    scored = rows.mapInArrow(run, "doc long, log_ratio double, log_weight double").withColumn("score", F.col("log_weight") - F.log(-F.log(unit)))
    scored = materialise(scored.withColumn("one", F.lit(1).cast("long")), "scores")
    keep = round(share * scored.count())
    ranked = prefix_sums(scored, [-F.col("score"), F.col("doc")], "one", "rank")
    return ranked.select(F.col("doc").alias(id_col), "log_ratio", "log_weight", "score", "rank", (F.col("rank") < keep).alias("kept"))
