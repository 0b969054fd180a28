"""SimHash near-duplicates, found by Golay-code fuzzy keys.

A fingerprint of 64 bits is cut into three segments.  Of at most two differing bits, at least one segment has none;
that segment is an exact key, and the next segment, which has at most two, gives fuzzy keys: the perfect binary Golay
code of length 23 has one codeword within three bits of any vector, and the codewords of a segment and of its
one-bit neighbours are one or six.  Two segments at two bits or less have a neighbour in common, so they share one of
these codewords.  Fingerprints are joined on (exact segment, codeword) and each pair is verified.

A key that more than ``CROWD`` different fingerprints hold is not paired.  Its fingerprints are linked exactly in
another way: each names itself and its 64 one-bit neighbours, and those that name one and the same are within two bits
of each other.  So all who name a point link to the smallest of them: rows in proportion, and no link between them is
lost, as their components are the same.

Equal fingerprints are one node throughout, so copies never form pairs.

Defined results: a null or empty text, or one of white space, has the fingerprint zero, linked like any other.  Rows
that repeat an id are one document.  A null id takes part but names no component unless its whole component is null.
Any length of text is read whole.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, heavy_join, materialise, scope, text_bytes, text_slices
from .components import connected_components

SHINGLE, SEED, DISTANCE, CROWD = 3, 42, 2, 64
#: (lowest bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: a generator polynomial of the perfect binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR, LENGTH, CHECKS = 0b110001110101, 23, 11


class Golay:
    """Nearest codeword of every vector of 23 bits, by syndrome."""

    def __init__(self) -> None:
        bit = []
        for i in range(LENGTH):  # syndrome of each single bit
            r = 1 << i
            for k in range(LENGTH - 1, CHECKS - 1, -1):
                if r >> k & 1:
                    r ^= GENERATOR << (k - CHECKS)
            bit.append(r)
        low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
        for i in range(12):
            low[np.arange(1 << 12) >> i & 1 == 1] ^= bit[i]
        for i in range(11):
            high[np.arange(1 << 11) >> i & 1 == 1] ^= bit[12 + i]
        self.low, self.high = low, high
        self.error = np.full(1 << CHECKS, -1, np.int64)
        for weight in range(4):
            for at in combinations(range(LENGTH), weight):
                s = 0
                for i in at:
                    s ^= bit[i]
                self.error[s] = sum(1 << i for i in at)

    def index(self, v: np.ndarray) -> np.ndarray:
        """Twelve bits that number the nearest codeword."""
        s = self.low[v & 0xFFF] ^ self.high[v >> 12]
        return (v ^ self.error[s]) >> CHECKS

    def keys(self, v: np.ndarray, bits: int) -> np.ndarray:
        """Codewords of each vector and of its one-bit neighbours, a row each, repeats included."""
        flips = np.array([0, *(1 << i for i in range(bits))], np.int64)
        return self.index(v[:, None] ^ flips)


GOLAY = Golay()


def majority(h: np.ndarray) -> int:
    """The majority bits of big-endian hashes, as a signed long; 0 of none."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[a : a + (1 << 16)].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 of all shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= SHINGLE:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], ">u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=False)], ">u8")
    return majority(h)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, fp)``: the id and the fingerprint as a signed long."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "body"):
                fp = np.array([fingerprint(t) for t in text_bytes(part["body"])], np.int64)
                yield pa.RecordBatch.from_arrays([part["doc"], pa.array(fp)], names=["doc", "fp"])

    return source.mapInArrow(run, "doc long, fp long")


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of signed fingerprints, and the row each belongs to."""
    v = fps.view(np.uint64)
    segment = [((v >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64) for low, bits in SEGMENTS]
    keys, rows = [], []
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        code = np.sort(GOLAY.keys(segment[j], SEGMENTS[j][1]), axis=1)
        new = np.ones(code.shape, bool)
        new[:, 1:] = code[:, 1:] != code[:, :-1]
        row, column = np.nonzero(new)
        keys.append((((np.int64(i) << 22) | segment[i][row]) << 12) | code[row, column])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def points(fp: str) -> Column:
    """The fingerprint itself and its one-bit neighbours; any two within two bits of each other have one in common."""
    return F.concat(F.array(F.col(fp)), F.transform(F.lit([1 << i if i < 63 else -(1 << 63) for i in range(64)]), lambda b: F.col(fp).bitwiseXOR(b)))


def links(fps: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints ``fp`` whose components are those of all links within two bits.

    They come as a written table; what they were made of is deleted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 20_000):
                fp = np.asarray(batch["fp"].slice(a, 20_000).to_numpy(), np.int64)
                keys, row = fuzzy_keys(fp)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[row])], names=["key", "fp"])

    with scope(fps.sparkSession) as own:
        keyed = materialise(fps.mapInArrow(run, "key long, fp long"), "keys")
        counts = materialise(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        shared = materialise(heavy_join(keyed, counts, ["key"], "n"), "shared")
        few = shared.where(F.col("n") <= CROWD).select("key", "fp")
        near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE
        pairs = few.withColumnRenamed("fp", "u").join(few.withColumnRenamed("fp", "v"), "key").where(F.col("u") < F.col("v")).where(near).select("u", "v")
        crowd = shared.where(F.col("n") > CROWD).select("fp").distinct()
        named = materialise(crowd.select("fp", F.explode(points("fp")).alias("point")), "points")
        least = named.groupBy("point").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
        stars = named.join(least, "point").where("fp <> v").select(F.col("fp").alias("u"), "v")
        found = materialise(pairs.unionByName(stars).distinct(), "links")
        return own.keep(found)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Return ``id_col, fp, component_id`` for every row; a component is named by its smallest id."""
    prints = materialise(fingerprints(docs, id_col, text), "prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc").alias("least"), F.count("*").alias("n")), "nodes")
    classes = materialise(connected_components(links(nodes.select("fp"))), "classes")
    joined = materialise(nodes.join(classes, nodes["fp"] == classes["node"]).select("fp", "component", "least"), "joined")
    roots = joined.groupBy("component").agg(F.min("least").alias("root"))
    linked = attach(joined.select("fp", "component"), roots, "component").select("fp", "root")
    named = materialise(nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("root", "least").alias("component_id")), "named")
    return heavy_join(prints, named, ["fp"], "n").select(F.col("doc").alias(id_col), "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    """Sixteen lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
