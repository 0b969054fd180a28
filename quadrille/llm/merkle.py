"""A Merkle manifest of a table: leaves, roots, and every row's proof, folded again from its present content.

Leaves of a group stand in order of id; every ``ARITY`` consecutive nodes of a level become the hash of their digests
(as hexadecimal text), until one is left: the group's root.  The groups' roots, in order of the group, become the root
of all in the same way.

Shape of the job, for any size and any skew: an aligned block is a whole subtree of ``BLOCK`` places of a group, so a
hot group is as many blocks as it fills.  Blocks are reduced to their roots, which are the leaves of the next tier, up
to one root; then paths go down again, a row a block: what lies above a block is shared by all its leaves and is
appended to theirs.  Within a block the paths are found by traversal: at each level the run of siblings now in force is
kept, while a stack (treehash) builds the next run one leaf a step, so that it is ready when the traversal reaches it.
Memory is some runs a level, besides the digests of the block's own leaves.

Hashes of leaves are taken by Spark, from whole texts, before anything is shuffled; rows then carry digests only.

Defined results: the value of a null field is ``-``; null groups and null ids come first.  Rows that repeat an id
follow each other in order of their leaf, so rows equal in all fields have different places and like leaves.  An empty
table gives an empty result.  Columns that are not named as fields are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise, prefix_sums, scope, settle

#: Children of a node, levels within a block, and leaves of a block.
ARITY, LEVELS = 8, 4
BLOCK = ARITY**LEVELS
#: The smallest long stands for a null id within packed rows.
NULL_ID = -(1 << 63)


def field_text(field: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value; integers in decimal."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def joined(digests: Sequence[bytes]) -> bytes:
    """The hash of digests, which are hexadecimal text."""
    return sha256(b"".join(digests)).hexdigest().encode()


class Treehash:
    """Builds the nodes of one level from the leaves below them, one leaf at a time, on a stack of unfinished runs."""

    def __init__(self, level: int) -> None:
        self.stack: list[list[bytes]] = [[] for _ in range(level)]
        self.done: list[bytes] = []

    def push(self, digest: bytes) -> None:
        for run in self.stack:
            run.append(digest)
            if len(run) < ARITY:
                return
            digest = joined(run)
            run.clear()
        self.done.append(digest)

    def finish(self) -> list[bytes]:
        """The nodes; runs that the leaves did not fill become a node as they are."""
        for level, run in enumerate(self.stack):
            if run:
                digest = joined(run)
                run.clear()
                (self.stack[level + 1] if level + 1 < len(self.stack) else self.done).append(digest)
        return self.done


def subtree_root(leaves: Sequence[bytes], levels: int) -> bytes:
    tree = Treehash(levels)
    for leaf in leaves:
        tree.push(leaf)
    return tree.finish()[0]


def traverse(leaves: Sequence[bytes], levels: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """For every leaf in turn its path: at each level its place in its run, and the run's digests, itself included."""
    n, span = len(leaves), [ARITY**h for h in range(levels + 1)]
    runs: list[list[bytes]] = []
    for h in range(levels):
        tree = Treehash(h)
        for leaf in leaves[: span[h + 1]]:
            tree.push(leaf)
        runs.append(tree.finish())
    coming = [Treehash(h) for h in range(levels)]
    for i in range(n):
        for h in range(levels):
            if i and i % span[h + 1] == 0:
                runs[h], coming[h] = coming[h].finish(), Treehash(h)
        yield [(i // span[h] % ARITY, runs[h]) for h in range(levels)]
        for h in range(levels):
            ahead = i + span[h + 1]
            if ahead < n:
                coming[h].push(leaves[ahead])


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves that end in one node."""
    levels = 0
    while ARITY**levels < n:
        levels += 1
    return levels


def pack_path(path: Sequence[tuple[int, Sequence[bytes]]]) -> bytes:
    """Level by level: a byte for the place, a byte for the number of siblings, and their digests of 32 bytes."""
    return b"".join(struct.pack("BB", at, len(run) - 1) + bytes.fromhex(b"".join([*run[:at], *run[at + 1 :]]).decode()) for at, run in path)


@lru_cache(maxsize=256)
def unpack_path(packed: bytes) -> tuple[tuple[int, tuple[bytes, ...]], ...]:
    """``(place, siblings)`` of every level."""
    out, i = [], 0
    while i < len(packed):
        at, n = packed[i], packed[i + 1]
        out.append((at, tuple(packed[i + 2 + 32 * k : i + 34 + 32 * k].hex().encode() for k in range(n))))
        i += 2 + 32 * n
    return tuple(out)


@lru_cache(maxsize=256)
def fold(digest: bytes, packed: bytes) -> bytes:
    """The root that a digest and the packed path above it lead to."""
    for at, siblings in unpack_path(packed):
        digest = joined([*siblings[:at], digest, *siblings[at:]])
    return digest


def _digests(body: bytes) -> list[bytes]:
    text = body.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _blocks(elements: DataFrame, carried: bool) -> DataFrame:
    """``(group, block, n, digests, root)``: each aligned block of ``(group, at, n, digest)`` as one row of a written table.

    With ``carried`` also the ids and present digests of its leaves.
    """
    more = ", ids binary, present binary" * carried

    def run(table: pa.Table) -> pa.Table:
        settle()
        table = table.sort_by("at")
        n, body = table["n"][0].as_py(), table["digest"].to_pylist()
        leaves = _digests(b"".join(body))
        root = subtree_root(leaves, levels_of(n) if n <= BLOCK else LEVELS)
        out = {
            "group": table["group"][:1],
            "block": pa.array([table["at"][0].as_py() // BLOCK], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "digests": pa.array([b"".join(body)], pa.binary()),
            "root": pa.array([bytes.fromhex(root.decode())], pa.binary()),
        }
        if carried:
            out["ids"] = pa.array([table["id"].to_numpy().astype("<i8").tobytes()], pa.binary())
            out["present"] = pa.array([b"".join(now or was for now, was in zip(table["present"].to_pylist(), body, strict=True))], pa.binary())
        return pa.table(out)

    grouped = elements.withColumn("block", F.floor(F.col("at") / BLOCK)).groupBy("group", "block")
    return materialise(grouped.applyInArrow(run, "group long, block long, n long, digests binary, root binary" + more), "blocks")


def _paths(blocks: DataFrame) -> DataFrame:
    """``(group, at, path, subroot)`` of every element of ``blocks``, whose rows hold the path above each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                group, block, n, digests, above, subroot = (batch[c][i].as_py() for c in ("group", "block", "n", "digests", "above", "subroot"))
                leaves = _digests(digests)
                paths = [pack_path(p) + above for p in traverse(leaves, levels_of(n) if n <= BLOCK else LEVELS)]
                at = np.arange(len(leaves), dtype=np.int64) + block * BLOCK
                # where nothing is named yet, each element is the root of its own group
                own = [subroot] * len(leaves) if subroot else [d.decode() for d in leaves]
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(leaves), pa.int64()), pa.array(at), pa.array(paths, pa.binary()), pa.array(own, pa.string())], names=["group", "at", "path", "subroot"])

    return blocks.select("group", "block", "n", "digests", "above", "subroot").mapInArrow(run, "group long, at long, path binary, subroot string")


def _tiers(elements: DataFrame, carried: bool) -> list[DataFrame]:
    """Tables of blocks, from the leaves up to one block a group."""
    tiers = [_blocks(elements, carried)]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > BLOCK:
        above = tiers[-1].select("group", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("root").alias("digest"))
        tiers.append(_blocks(above, False))
    return tiers


def _below(paths: DataFrame, blocks: DataFrame) -> DataFrame:
    """``blocks`` with the path above each and its group's root."""
    named = paths.select("group", F.col("at").alias("block"), F.col("path").alias("above"), "subroot")
    return blocks.join(named.hint("merge"), ["group", "block"])


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    id_col: str = "doc_id",
    present: Sequence[Column] | None = None,
    with_path: bool = True,
) -> DataFrame:
    """Return ``id_col, leaf, subroot, root, path, proof_sha256, folded_root, verified`` for every row.

    ``leaf``, ``subroot`` and ``root`` are those of the fields as they stand; ``folded_root`` is what the row's proof
    makes of its ``present`` fields (the same ones, by default), and ``verified`` tells whether that is the root.
    ``path`` is the proof itself, see :func:`pack_path`; ``proof_sha256`` is the hash of its digests in a row.
    """
    with scope(docs.sparkSession) as scoped:
        own = [F.col(f"`{c}`") for c in fields]
        rows = docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{group}`").cast("string").alias("name"),
            F.unhex(leaf_digest(own)).alias("digest"),
            F.unhex(leaf_digest(own if present is None else list(present))).alias("present"),
        )
        rows = rows.withColumn("present", F.nullif("present", "digest"))
        rows = materialise(rows, "leaves")
        order = [F.col("name").isNotNull(), F.col("name"), F.col("id").isNotNull(), F.col("id"), F.col("digest"), F.col("place")]
        placed = materialise(prefix_sums(rows.withColumns({"one": F.lit(1), "place": F.monotonically_increasing_id()}), order, "one", "before").drop("one", "place"), "placed")
        key = {"no_name": F.col("name").isNull(), "name": F.coalesce("name", F.lit(""))}
        placed = placed.withColumns(key)
        groups = materialise(placed.groupBy("no_name", "name").agg(F.min("before").alias("group"), F.count("*").alias("n")), "groups")
        leaves = heavy_join(placed, groups, ["no_name", "name"], "n")
        leaves = leaves.select("group", (F.col("before") - F.col("group")).alias("at"), "n", "digest", "id", "present")
        leaves = leaves.withColumn("id", F.coalesce("id", F.lit(NULL_ID)))

        within = _tiers(leaves, True)
        # the groups' roots, in order of the group, which is that of their first places
        ranked = prefix_sums(within[-1].select("group", "root", F.lit(1).alias("one")), [F.col("group")], "one", "rank")
        ranked = materialise(ranked.select("group", "root", "rank"), "ranked")
        number = ranked.count()
        across = _tiers(ranked.select(F.lit(0).cast("long").alias("group"), F.col("rank").alias("at"), F.lit(number).cast("long").alias("n"), F.col("root").alias("digest")), False)
        top = across[-1].first()
        root = bytes(top["root"]).hex() if top else ""

        nothing = {"above": F.lit(b"").cast("binary"), "subroot": F.lit(None).cast("string")}
        paths = _paths(across[-1].withColumns(nothing))
        for tier in reversed(across[:-1]):
            paths = _paths(_below(materialise(paths, "paths"), tier).withColumn("subroot", F.lit(None).cast("string")))
        # a group's root is the one block, number 0, of its last tier
        paths = paths.drop("group").join(ranked.select("group", F.col("rank").alias("at")), "at").select("group", F.lit(0).cast("long").alias("at"), "path", "subroot")
        for tier in reversed(within[1:]):
            paths = _paths(_below(materialise(paths, "paths"), tier))
        blocks = scoped.keep(materialise(_below(materialise(paths, "paths"), within[0]), "proofs"))
    top_bytes = root.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, digests, ids, now, above, subroot = (batch[c][i].as_py() for c in ("n", "digests", "ids", "present", "above", "subroot"))
                leaves, changed = _digests(digests), _digests(now)
                upper = b"".join(d for _, siblings in unpack_path(above) for d in siblings)
                packed, proof, folded = [], [], []
                for digest, path in zip(changed, traverse(leaves, levels_of(n) if n <= BLOCK else LEVELS), strict=True):
                    told = []
                    for at, run_ in path:
                        before, after = b"".join(run_[:at]), b"".join(run_[at + 1 :])
                        told += before, after
                        digest = sha256(before + digest + after).hexdigest().encode()
                    proof.append(sha256(b"".join(told) + upper).hexdigest())
                    folded.append(fold(digest, above))
                    if with_path:
                        packed.append(pack_path(path) + above)
                id_ = np.frombuffer(ids, "<i8")
                count = len(leaves)
                columns = [pa.array(id_, mask=id_ == NULL_ID), pa.array([d.decode() for d in leaves]), pa.array([subroot] * count), pa.array(proof), pa.array([d.decode() for d in folded]), pa.array([d == top_bytes for d in folded])]
                names = ["id", "leaf", "subroot", "proof_sha256", "folded_root", "verified"]
                if with_path:
                    columns, names = [*columns, pa.array(packed, pa.binary())], [*names, "path"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        settle()

    schema = "id long, leaf string, subroot string, proof_sha256 string, folded_root string, verified boolean" + ", path binary" * with_path
    made = blocks.select("n", "digests", "ids", "present", "above", "subroot").mapInArrow(run, schema)
    return made.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(root).alias("root"), *["path"] * with_path, "proof_sha256", "folded_root", "verified")


def tampered(fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", text: str = "text") -> list[Column]:
    """The fields, where the text of each row whose id has a crc32 that 3 divides has its A-Z lower-cased."""
    hit = F.crc32(F.col(id_col).cast("long").cast("string")) % 3 == 0
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [F.when(hit, lower).otherwise(F.col(text)) if c == text else F.col(f"`{c}`") for c in fields]
