"""Groups of similar texts: word shingles with a Jaccard similarity of 0.8 or more, every link verified exactly.

Equal sets of shingles are one node, so copies never form pairs.  Candidates come from two searches:

1. SimHash: fingerprints within two bits of each other, as near copies with few changes have, are found as in
   :mod:`simhash`; all texts that have them share a key, so that none of their pairs is left out;
2. samples of shingles: a text has ``BANDS`` keys, each of the ``ROWS`` shingles that come first under as many random
   orders.  Texts of similarity s share one such shingle with probability s, so two of 0.8 share none of the keys in
   one of 600 cases, and texts that only share a passage hardly ever share one.

Every two texts that share a key are compared, unless they are in one group already or too different in size.  First,
``STARS`` times, all who share a key are compared with one of them, the one that most others in the table are near to
(its keys are the most crowded), which then has met all of them and leaves the key.  Keys whose texts are all in one
group are settled; this is how large groups of near copies end, in rows in proportion.  What is left under a key meets
in all pairs across groups: listed where a key has up to ``CROWD`` texts, else in blocks of bounded memory, of which a
task takes two.  That last step is quadratic in texts that share a key and are not alike, and leaves none out.

A pair is linked if the shingle sets themselves (as 64-bit hashes) are similar enough; sets are made for candidates
only, and joined in the parts that a hot one fills.  Hence no link is reported that is not there, and groups are the
components of links.

Defined results: letters A-Z are lower-cased; a text of fewer words than a shingle is one shingle as a whole; texts
without words (or null) are alike.  Of each group one row stays: that of smallest id, a null id coming after all
others, and equal ids going by a hash of the text.  Rows that repeat an id are told apart by their row number.  Any
length of text is read whole.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import attach, heavy_join, materialise, mix64, scope, text_bytes, text_slices
from .components import connected_components

#: Keys of a text, and shingles in each.
BANDS, ROWS = 12, 4
#: Rounds in which all who share a key meet one of them; texts of a key whose pairs are listed; hashes of a block, and
#: texts of it that are compared at once.
STARS, CROWD, HASHES, AT_ONCE = 2, 64, 1 << 20, 256
#: Odd factors that order hashes anew, one for each sampled shingle.
ORDERS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of all word shingles in order, repeats included; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    digest, seed = xxhash.xxh64_intdigest, simhash.SEED
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)), np.uint64, n)


def sampled(hashes: np.ndarray) -> np.ndarray:
    """Of every order, the first hash."""
    first = np.full(len(ORDERS), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 1 << 12):
        np.minimum(first, (hashes[a : a + (1 << 12), None] * ORDERS).min(axis=0), out=first)
    return first


def band_keys(first: np.ndarray) -> np.ndarray:
    """Of rows of sampled hashes, the keys of every band."""
    rows = first.reshape(len(first), BANDS, ROWS)
    key = np.broadcast_to(mix64(np.arange(BANDS, dtype=np.uint64)), rows.shape[:2])
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key.view(np.int64)


def measured(docs: DataFrame, row: str, id_col: str, text: str, shingle: int) -> DataFrame:
    """Per row its id, number and text's hash, 128 bits that name its shingle set, the set's size, and its search keys."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).cast("string").alias("body"), F.xxhash64(text).alias("hash"), F.col(row).alias("row"))
    names = ["doc", "hash", "row", "h1", "h2", "size", "fp", "keys"]

    def lists(rows: np.ndarray, have: np.ndarray) -> pa.Array:
        """Lists of ``BANDS`` longs; an empty one where the text has no words."""
        ends = np.concatenate([[0], np.cumsum(have * BANDS)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows[have]).ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "body"):
                n = part.num_rows
                ints = np.zeros((n, 4), np.int64)
                first = np.zeros((n, len(ORDERS)), np.uint64)
                for i, t in enumerate(text_bytes(part["body"])):
                    h = shingles(t, shingle)
                    own = np.unique(h)
                    name = xxhash.xxh3_128_digest(own.tobytes())
                    ints[i] = *np.frombuffer(name, np.int64), len(own), simhash.majority(h.astype(">u8"))
                    first[i] = sampled(own)
                have = ints[:, 2] > 0
                yield pa.RecordBatch.from_arrays([part["doc"], part["hash"], part["row"], *(pa.array(np.ascontiguousarray(c)) for c in ints.T), lists(band_keys(first), have)], names=names)

    return source.mapInArrow(run, "doc long, hash long, row long, h1 long, h2 long, size long, fp long, keys array<long>")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``(node, set)`` of ``(node, body)``: the distinct hashes of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "body"):
                sets = [np.unique(shingles(t, shingle)).view(np.int64) for t in text_bytes(part["body"])]
                yield pa.RecordBatch.from_arrays([part["node"], pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])

    return texts.mapInArrow(run, "node long, set array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs (u, v)``, a written table, whose sets are similar enough, as a written table."""
    near = attach(pairs, sets.select(F.col("node").alias("v"), F.col("set").alias("b")), "v")
    both = near.join(sets.select(F.col("node").alias("u"), F.col("set").alias("a")), "u")
    common = F.size(F.array_intersect("a", "b"))
    return materialise(both.where(common / (F.size("a") + F.size("b") - common) >= similarity).select("u", "v"), "similar")


def fingerprint_keys(nodes: DataFrame) -> DataFrame:
    """``(node, size, key)``: all nodes whose fingerprints are equal, and any two within two bits, share a key.

    A fingerprint that several nodes have, or that is linked to another one, names itself and its one-bit neighbours:
    two within two bits name a point in common.  Points that nobody else names are no keys.
    """
    prints = materialise(nodes.groupBy("fp").agg(F.count("*").alias("n")), "prints")
    linked = simhash.links(prints.select("fp"))
    near = prints.where("n > 1").select("fp").unionByName(linked.select(F.col("u").alias("fp"))).unionByName(linked.select(F.col("v").alias("fp")))
    named = materialise(prints.join(near.distinct(), "fp").select("fp", "n", F.explode(simhash.points("fp")).alias("point")), "points")
    own = F.max(F.when(F.col("point") == F.col("fp"), F.col("n")))
    shared = named.groupBy("point").agg(F.count("*").alias("c"), own.alias("own")).where("c > 1 or own > 1").select("point")
    held = materialise(named.join(shared, "point").groupBy("fp").agg(F.first("n").alias("n"), F.collect_list("point").alias("points")), "held")
    return heavy_join(nodes.select("node", "size", "fp"), held, ["fp"], "n").select("node", "size", F.explode(F.transform("points", lambda x: F.xxhash64(F.lit("point"), x))).alias("key"))


def _comparable(a: str, b: str, similarity: float) -> Column:
    """Sets whose sizes differ more than this are surely less similar."""
    return F.least(a, b) / F.greatest(a, b) >= similarity


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``a`` has in common with each of ``b``."""
    out = np.zeros((len(a), len(b)), np.float32)
    left, right = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(left, right)
    sides = []
    for values, own in ((left, a), (right, b)):
        at = np.minimum(np.searchsorted(both, values), max(0, len(both) - 1))
        ok = both[at] == values if len(both) else np.zeros(len(values), bool)
        sides.append((at[ok], np.repeat(np.arange(len(own)), [len(x) for x in own])[ok]))
    for start in range(0, len(both), 4096):
        dense = []
        for (at, row), own in zip(sides, (a, b), strict=True):
            part = (at >= start) & (at < start + 4096)
            m = np.zeros((len(own), min(4096, len(both) - start)), np.float32)
            m[row[part], at[part] - start] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def block_links(crowd: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between nodes of different labels under each key of ``crowd (key, node, label, hashes)``, block by block.

    ``hashes`` is the number of all of a key; a block has some ``HASHES`` of them, and a task holds two blocks.
    """
    rows = crowd.select("key", "node", "label", F.ceil(F.col("hashes") / HASHES).cast("int").alias("blocks"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = materialise(rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "label"), "blocks")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, label, own = (table[c].to_numpy() for c in ("node", "label", "own"))
        column = table["set"].combine_chunks()
        ends, values = column.offsets.to_numpy(), column.values.to_numpy()
        p, q = table["p"][0].as_py(), table["q"][0].as_py()
        first, second = np.flatnonzero(own == p), np.flatnonzero(own == q)
        u, v = [], []
        for i in range(0, len(first), AT_ONCE):
            a = first[i : i + AT_ONCE]
            for j in range(i if p == q else 0, len(second), AT_ONCE):
                b = second[j : j + AT_ONCE]
                both = common([values[ends[k] : ends[k + 1]] for k in a], [values[ends[k] : ends[k + 1]] for k in b]).astype(np.float64)
                whole = (ends[a + 1] - ends[a])[:, None] + (ends[b + 1] - ends[b])[None, :]
                x, y = np.nonzero((both / (whole - both) >= similarity) & (label[a][:, None] != label[b][None, :]))
                u.append(node[a[x]])
                v.append(node[b[y]])
        u, v = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (u, v))
        return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    return materialise(attach(rows, sets, "node").groupBy("key", "p", "q").applyInArrow(run, "u long, v long").distinct(), "similar")


def links(nodes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Verified links ``(u, v)`` between ``nodes (node, size, fp, keys)``, whose texts are ``(node, body)``.

    Their components are those of all links between nodes that share a key.
    """
    keyed = nodes.select("node", "size", F.explode("keys").alias("key")).unionByName(fingerprint_keys(nodes))
    keyed = materialise(keyed, "keyed")
    counts = materialise(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    shared = materialise(heavy_join(keyed, counts, ["key"], "n"), "shared")
    # how near a node is to the others: the base of many copies shares the most crowded keys
    rank = shared.groupBy("node").agg(F.sum(F.floor(1024 * F.log2("n"))).alias("rank"))
    shared = materialise(shared.drop("n").join(rank, "node").withColumn("label", F.col("node")), "ranked")
    sets = materialise(shingle_sets(texts.join(rank.select("node").hint("merge"), "node"), shingle), "sets")
    found = None
    for _ in range(STARS):
        first = F.max(F.struct("rank", (-F.col("node")).alias("least"), "size", "label")).alias("first")
        pivots = shared.groupBy("key").agg(first, F.count("*").alias("n"))
        pivots = materialise(pivots.select("key", "n", (-F.col("first.least")).alias("pivot"), F.col("first.size").alias("pivot_size"), F.col("first.label").alias("pivot_label")), "pivots")
        met = materialise(heavy_join(shared, pivots, ["key"], "n").where("node <> pivot"), "met")
        pairs = met.where("label <> pivot_label").where(_comparable("size", "pivot_size", similarity)).select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
        new = verified(materialise(pairs, "pairs"), sets, similarity)
        found = new if found is None else found.unionByName(new)
        classes = connected_components(found).withColumnRenamed("component", "label")
        rest = materialise(met.select("key", "node", "size", "rank").join(classes, "node", "left").withColumn("label", F.coalesce("label", "node")), "rest")
        spans = rest.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("hashes"), F.min("label").alias("a"), F.max("label").alias("b"))
        spans = materialise(spans.where("a <> b").drop("a", "b"), "spans")
        if spans.isEmpty():
            return found
        left = materialise(heavy_join(rest, spans, ["key"], "n"), "open")
        shared = left.drop("n", "hashes")
    few = left.where(F.col("n") <= CROWD)
    one, other = (few.select("key", F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("label").alias(f"label_{c}")) for c in "uv")
    pairs = one.join(other, "key").where("u > v and label_u <> label_v").where(_comparable("size_u", "size_v", similarity)).select("u", "v").distinct()
    found = found.unionByName(verified(materialise(pairs, "pairs"), sets, similarity))
    crowd = left.where(F.col("n") > CROWD)
    return found if crowd.isEmpty() else found.unionByName(block_links(crowd, sets, similarity))


def representatives(docs: DataFrame, row: str, id_col: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Return the numbers (a long column ``row``, another one for every row) of one row of each group of similar texts.

    ``docs`` should be a written table: its texts are read once for the keys and once for candidates' sets.
    """
    with scope(docs.sparkSession) as own:
        rows = measured(docs, row, id_col, text, shingle)
        best = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "hash", "row", "size", "fp", "keys")).alias("best")
        nodes = materialise(rows.groupBy("h1", "h2").agg(best).select(F.col("best.row").alias("node"), "best.no_id", "best.doc", "best.hash", "best.size", "best.fp", "best.keys"), "nodes")
        texts = docs.select(F.col(row).alias("node"), F.col(text).cast("string").alias("body"))
        found = materialise(links(nodes.select("node", "size", "fp", "keys"), texts, shingle, similarity), "links")
        own.clear(nodes, found)
        classes = materialise(connected_components(found), "classes")
        named = nodes.select("node", F.struct("no_id", "doc", "hash", "node").alias("best")).join(classes, "node", "left")
        stays = named.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("best").alias("best"))
        return own.keep(materialise(stays.select(F.col("best.node").alias(row)), "stays"))
