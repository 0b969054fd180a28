"""Removal of repeated word passages, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words.  Hashes are taken of ``ANCHOR`` words, and only at positions whose residue
modulo ``PERIOD`` lies in the cover.  The cover holds, for any two residues, a shift below ``PERIOD`` that brings both
into it; so two equal windows share an anchor at one and the same shift, whatever their positions.  Hence only windows
around anchors that occur twice are looked at: they are extended to the full window, hashed over all its words to 96
bits, and the earliest place of each hash is found.

Shape of the job, which holds for any size and any skew:

1. documents are dealt into batches of bounded text by a hash of the row (rows alike in all columns stay together);
2. a batch sends the distinct anchor hashes it has, not their occurrences, to slices of the hash space; a slice
   answers with those seen in two batches.  A passage that every document holds is thus one entry a batch;
3. a batch extends its repeated anchors to windows and sends the earliest place of each window; a slice answers with
   the places that are not the earliest of all;
4. the batch drops the covered words.

Rows whose text equals that of a row with a smaller id are settled beforehand: all their windows start earlier.

Defined results: a null text has no words.  A document of fewer than ``WINDOW`` words loses none.  Rows that repeat an
id count as one document with the same place, so neither is earlier than the other; a null id comes last.  Any length
of text is handled whole.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise, mix64, nullable, settle, text_bytes

WINDOW, ANCHOR, PERIOD = 20, 8, 13
#: A perfect difference set modulo 13; every residue is a difference of two of them.
COVER = (0, 1, 3, 9)
#: Bytes of text in a batch, and bytes of anchors in a slice of the hash space.
BATCH_BYTES, SLICE_BYTES = 8 << 20, 8 << 20
NO_ID = (1 << 63) - 1

PLACE = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("pos", "<i4")])
SPOT = np.dtype([("doc", "<i8"), ("pos", "<i4"), ("run", "<i4")])

assert PERIOD - 1 + ANCHOR == WINDOW
assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


class _Memo(dict):
    """Hashes of words; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_MEMO = _Memo()


class Batch:
    """The documents of a batch in order of id, and the hashes of all their words in a row."""

    def __init__(self, table: pa.Table, copies: set):
        rows = zip(table["doc"].to_pylist(), table["t1"].to_pylist(), strict=True)
        table = table.filter(pa.array([r not in copies for r in rows], pa.bool_()))
        self.ids = np.asarray(table["doc"].to_numpy(), dtype=np.int64)
        self.order = np.argsort(self.ids, kind="stable")
        self.ids = self.ids[self.order]
        texts = text_bytes(table["body"])
        self.words = [texts[i].split() for i in self.order]
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.end = np.cumsum(self.length)
        self.start = self.end - self.length
        self.total = int(self.end[-1]) if len(self.end) else 0
        get = _MEMO.__getitem__
        self.h = np.concatenate([np.fromiter(map(get, w), np.uint64, len(w)) for w in self.words]) if self.total else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(self.words)), self.length)

    def rolling(self, n: int, base: int, words: np.ndarray) -> np.ndarray:
        """Hash of the ``n`` words from each position on."""
        m = max(0, len(words) - n + 1)
        out = words[:m].copy()
        for k in range(1, n):
            out *= np.uint64(base)
            out += words[k : k + m]
        return mix64(out)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes at the cover's positions of documents that have a window."""
        inside = np.arange(self.total) - self.start[self.doc]
        left = self.length[self.doc] - inside
        chosen = np.isin(inside % PERIOD, COVER) & (left >= ANCHOR) & (self.length[self.doc] >= WINDOW)
        at = np.flatnonzero(chosen)
        return at, self.rolling(ANCHOR, 0x9E3779B97F4A7C15, self.h)[at] if len(at) else np.zeros(0, np.uint64)


def _slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


def _short(h: np.ndarray, slices: int) -> np.ndarray:
    """Forty bits of a hash, apart from those that choose its slice: a slice is of bounded size, so they suffice."""
    return mix64(h) & np.uint64((1 << 40) - 2)


def _pack(x: np.ndarray) -> bytes:
    """Five bytes an entry."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _local(batch: Batch, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions; their slice and forty bits as one key of distinct (slice, bits)."""
    at, h = batch.anchors()
    return at, _slice_of(h, slices), _short(h, slices)


ASK = "slice int, batch int, body binary"


def _copies(notes: pa.Table) -> tuple[set, pa.Table]:
    """The rows of the batch that are copies, and the other notes."""
    is_copy = np.asarray(notes["doc"].is_valid().to_numpy(), dtype=bool)
    copies = notes.filter(pa.array(is_copy))
    return set(zip(copies["doc"].to_pylist(), copies["t1"].to_pylist(), strict=True)), notes.filter(pa.array(~is_copy))


def _ask_anchors(slices: int):
    def run(key: tuple, table: pa.Table, notes: pa.Table) -> pa.Table:
        settle()
        batch = Batch(table, _copies(notes)[0])
        _, part, bits = _local(batch, slices)
        order = np.lexsort((bits, part))
        part, bits = part[order], bits[order]
        new = np.ones(len(bits), bool)
        new[1:] = (bits[1:] != bits[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(bits)))
        part, bits = part[first], bits[first] | (times > 1).astype(np.uint64)
        cut = np.flatnonzero(np.diff(part)) + 1
        bodies = [_pack(x) for x in np.split(bits, cut)] if len(bits) else []
        names = part[np.append(0, cut)].astype(np.int32) if len(bits) else []
        return pa.table({"slice": pa.array(names, pa.int32()), "batch": pa.array([key[0].as_py()] * len(bodies), pa.int32()), "body": pa.array(bodies, pa.binary())})

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """Per batch, the anchors of the slice that it saw once but others saw too."""
    names = table["batch"].to_pylist()
    parts = [_unpack(b) for b in table["body"].to_pylist()]
    bits = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    base, flag = bits >> np.uint64(1), (bits & np.uint64(1)).astype(bool)
    order = np.argsort(base, kind="stable")
    same = np.zeros(len(bits), bool)
    hit = np.flatnonzero(base[order][1:] == base[order][:-1])
    same[order[hit]] = True
    same[order[hit + 1]] = True
    tell = np.flatnonzero(same & ~flag)  # positions are still in the order of owners
    slice_id = table["slice"][0].as_py() if len(parts) else 0
    cut = np.searchsorted(owner[tell], np.arange(len(parts) + 1))
    rows = [(slice_id, names[i], _pack(bits[tell[cut[i] : cut[i + 1]]])) for i in range(len(parts)) if cut[i + 1] > cut[i]]
    return pa.table({"slice": pa.array([r[0] for r in rows], pa.int32()), "batch": pa.array([r[1] for r in rows], pa.int32()), "body": pa.array([r[2] for r in rows], pa.binary())})


def _runs(doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Places as runs of following positions; they come sorted by document and position."""
    if not len(doc):
        return np.zeros(0, SPOT)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(new)
    out = np.zeros(len(first), SPOT)
    out["doc"], out["pos"], out["run"] = doc[first], pos[first], np.diff(np.append(first, len(doc)))
    return out


TOLD = "slice int, batch int, settled boolean, body binary"


def _ask_windows(slices: int, window_slices: int):
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        empty = pa.table({"slice": pa.array([], pa.int32()), "batch": pa.array([], pa.int32()), "settled": pa.array([], pa.bool_()), "body": pa.array([], pa.binary())})
        settle()
        copies, answers = _copies(answers)
        batch = Batch(docs, copies)
        at, part, bits = _local(batch, slices)
        if not len(at):
            return empty
        # distinct within a slice is all that matters; a slice number fits above forty bits
        whole = bits | (part.astype(np.uint64) << np.uint64(40))
        order = np.argsort(whole, kind="stable")
        repeated = np.zeros(len(at), bool)
        hit = np.flatnonzero(whole[order][1:] == whole[order][:-1])
        repeated[order[hit]] = True
        repeated[order[hit + 1]] = True
        if answers.num_rows:
            known = np.concatenate([_unpack(b) | np.uint64(s << 40) for s, b in zip(answers["slice"].to_pylist(), answers["body"].to_pylist(), strict=True)])
            repeated |= np.isin(whole, known)
        at = at[repeated]
        doc = batch.doc[at]
        low = np.maximum(at - (WINDOW - ANCHOR), batch.start[doc])
        high = np.minimum(at, batch.end[doc] - WINDOW)  # last window that holds the anchor
        ok = high >= low
        edge = np.zeros(batch.total + 1, np.int64)
        np.add.at(edge, low[ok], 1)
        np.add.at(edge, high[ok] + 1, -1)
        place = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(place):
            return empty
        h1 = batch.rolling(WINDOW, 0xC2B2AE3D27D4EB4F, batch.h)[place]
        h2 = (batch.rolling(WINDOW, 0x165667B19E3779F9, mix64(batch.h))[place] >> np.uint64(32)).astype(np.uint32)
        doc_id, pos = batch.ids[batch.doc[place]], (place - batch.start[batch.doc[place]]).astype(np.int32)
        order = np.lexsort((pos, doc_id, h2, h1))
        h1, h2, doc_id, pos = h1[order], h2[order], doc_id[order], pos[order]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = np.flatnonzero(new)
        head = first[np.cumsum(new) - 1]
        later = (doc_id != doc_id[head]) | (pos != pos[head])
        again = np.lexsort((pos[later], doc_id[later]))
        runs = _runs(doc_id[later][again], pos[later][again])
        ask = np.zeros(len(first), PLACE)
        ask["h1"], ask["h2"], ask["doc"], ask["pos"] = h1[first], h2[first], doc_id[first], pos[first]
        part = _slice_of(ask["h1"], window_slices)
        cut = np.flatnonzero(np.diff(part)) + 1
        bodies = [x.tobytes() for x in np.split(ask, cut)] + [runs.tobytes()]
        names = [*part[np.append(0, cut)].astype(int).tolist(), -1]
        return pa.table({"slice": pa.array(names, pa.int32()), "batch": pa.array([key[0].as_py()] * len(names), pa.int32()), "settled": pa.array([n < 0 for n in names], pa.bool_()), "body": pa.array(bodies, pa.binary())})

    return run


def _answer_windows(table: pa.Table) -> pa.Table:
    """Per batch, the places it asked about that are not the earliest of all with that window."""
    names = table["batch"].to_pylist()
    parts = [np.frombuffer(b, PLACE) for b in table["body"].to_pylist()]
    every = np.concatenate(parts) if parts else np.zeros(0, PLACE)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.lexsort((every["pos"], every["doc"], every["h2"], every["h1"]))
    every, owner = every[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = (every["h1"][1:] != every["h1"][:-1]) | (every["h2"][1:] != every["h2"][:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(every) else np.zeros(0, np.int64)
    later = (every["doc"] != every["doc"][head]) | (every["pos"] != every["pos"][head])
    every, owner = every[later], owner[later]
    order = np.lexsort((every["pos"], every["doc"], owner))
    every, owner = every[order], owner[order]
    cut = np.searchsorted(owner, np.arange(len(parts) + 1))
    rows = [(names[i], _runs(every["doc"][cut[i] : cut[i + 1]], every["pos"][cut[i] : cut[i + 1]]).tobytes()) for i in range(len(parts)) if cut[i + 1] > cut[i]]
    return pa.table({"batch": pa.array([r[0] for r in rows], pa.int32()), "body": pa.array([r[1] for r in rows], pa.binary())})


def _cover(length: int, runs: np.ndarray) -> np.ndarray:
    edge = np.zeros(length + WINDOW + 1, np.int64)
    np.add.at(edge, runs["pos"], 1)
    np.add.at(edge, runs["pos"] + runs["run"] + WINDOW - 1, -1)
    return np.cumsum(edge[:length]) > 0


def _finish(with_text: bool):
    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        settle()
        ids = docs["doc"].to_pylist()
        copies, told = _copies(told)
        runs = np.concatenate([np.frombuffer(b, SPOT) for b in told["body"].to_pylist()]) if told.num_rows else np.zeros(0, SPOT)
        runs = runs[np.argsort(runs["doc"], kind="stable")]
        words, removed, digest, kept_text = [], [], [], []
        for i, t1, text in zip(ids, docs["t1"].to_pylist(), text_bytes(docs["body"]), strict=True):
            w = text.split()
            a, b = np.searchsorted(runs["doc"], [i, i], side="left")[0], np.searchsorted(runs["doc"], i, side="right")
            if (i, t1) in copies and len(w) >= WINDOW:
                kept = []
            elif b > a:
                gone = _cover(len(w), runs[a:b])
                kept = [x for x, g in zip(w, gone.tolist(), strict=True) if not g]
            else:
                kept = w
            joined = b" ".join(kept)
            words.append(len(w))
            removed.append(len(w) - len(kept))
            digest.append(hashlib.sha256(joined).hexdigest())
            if with_text:
                kept_text.append((text if len(kept) == len(w) else joined).decode())
        out = {"row": docs["row"].cast(nullable(docs["row"].type)), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(kept_text, pa.string())} if with_text else {}))

    return run


#: Columns of the result; a carried column of such a name gives way.
OUT = ("n_words", "n_removed", "kept_sha256", "kept_text")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", with_text: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Return the columns ``keep`` (the id, by default) with ``n_words, n_removed, kept_sha256`` and ``kept_text``.

    ``kept_text`` is the text as it was where nothing goes, else the kept words joined by single spaces.
    """
    spark = docs.sparkSession
    carried = [c for c in ([id_col] if keep is None else keep) if c not in OUT]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)])
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), body.alias("body"), row.alias("row"))
    # 16 bytes that name a text; equal texts with a larger id are copies
    size = docs.select(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    cores = spark.sparkContext.defaultParallelism
    batches = max(2 * cores, math.ceil(size / BATCH_BYTES))
    slices = max(cores, math.ceil(size / 6 * len(COVER) / PERIOD * 5 / SLICE_BYTES))
    rows = rows.withColumn("t1", F.xxhash64("body"))
    told = [f"row.c{i}" for i, c in enumerate(carried) if "map<" not in docs.schema[c].dataType.simpleString()]
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("doc", "t1", *told), F.lit(batches)).cast("int"))
    keys = materialise(rows.select("batch", "doc", "t1", F.xxhash64("body", F.lit(1)).alias("t2")), "texts")
    least = keys.groupBy("t1", "t2").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n")).where("most > least")
    copies = heavy_join(keys, materialise(least, "least"), ["t1", "t2"], "n").where("doc > least")
    copies = materialise(copies.select("batch", "doc", "t1"), "copies")
    dealt = rows.select("batch", "doc", "t1", "body")

    def noted(notes: DataFrame):
        return notes.unionByName(copies, allowMissingColumns=True).groupBy("batch")

    nothing = copies.where("false").select(F.lit(0).alias("slice"), "batch", F.lit(b"").alias("body"))
    ask = dealt.groupBy("batch").cogroup(noted(nothing)).applyInArrow(_ask_anchors(slices), ASK)
    answers = ask.groupBy("slice").applyInArrow(_answer_anchors, ASK)
    windows = materialise(dealt.groupBy("batch").cogroup(noted(answers)).applyInArrow(_ask_windows(slices, slices), TOLD), "windows")
    told = windows.where("not settled").select("slice", "batch", "body").groupBy("slice").applyInArrow(_answer_windows, "batch int, body binary")
    told = windows.where("settled").select("batch", "body").unionByName(told)
    schema = f"row {row_type(docs, carried)}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    out = rows.groupBy("batch").cogroup(noted(told)).applyInArrow(_finish(with_text), schema)
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carried)], "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text)


def row_type(docs: DataFrame, columns: list[str]) -> str:
    inner = ", ".join(f"c{i}: {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    return f"struct<{inner}>"
