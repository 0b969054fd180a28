"""Token ids in directly addressable codes.

An id is split into chunks of ``CHUNK`` bits.  Level 0 holds the lowest chunk of every id; level ``k`` holds the next
chunk of those ids of level ``k - 1`` that have more.  A level carries a bitmap of continuations and a directory of
ranks every ``BLOCK`` bits, so that the place of an id's next chunk is a directory entry and a popcount: any token is
read without decoding others.

A segment is the codes of consecutive documents, with a directory of the documents in it.  Its layout, all integers
little-endian: magic ``DAC1``; u32 number of levels, u64 number of ids, u32 number of documents; then for each level
u64 number of chunks, the chunks (u8 each), the bitmap (u64 words) and the ranks (u32 each); then for each document
i64 id (the smallest value for null) and u64 offset of its first id, and one last offset.  Segments are the rows of a
Parquet table in the shared store, in ascending order of id, because a cluster's store is reached through Spark only.

Defined results: a null text is an empty one; an empty text has the end id alone.  Null ids come first.  Rows that
repeat an id follow each other in the order of a hash of their text.  Any length of text is encoded whole.  Other
columns are not read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_slices

CHUNK, BLOCK, NULL_ID = 8, 512, -(1 << 63)
#: Bytes of text behind one segment, pieces whose ids are remembered, and pieces encoded behind one another.
SEGMENT_BYTES, PIECES, GROUP = 4 << 20, 400_000, 400
#: How a special token of the file begins.
SPECIAL = b"<|"


def write_segment(ids: np.ndarray, doc_ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """``offsets`` has one entry more than ``doc_ids``."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunk = (rest & np.uint64((1 << CHUNK) - 1)).astype(np.uint8)
        rest = rest >> np.uint64(CHUNK)
        more = rest > 0
        bits = np.zeros(-(-max(1, len(more)) // BLOCK) * BLOCK, np.uint8)
        bits[: len(more)] = more
        bitmap = np.packbits(bits, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(bits.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))[:-1]]).astype("<u4")
        levels.append(struct.pack("<Q", len(chunk)) + chunk.tobytes() + bitmap.tobytes() + ranks.tobytes())
        rest = rest[more]
        if not len(rest):
            break
    head = b"DAC1" + struct.pack("<IQI", len(levels), len(ids), len(doc_ids))
    return head + b"".join(levels) + doc_ids.astype("<i8").tobytes() + offsets.astype("<u8").tobytes()


class Segment:
    """Reader of a segment's bytes; arrays are views into them."""

    def __init__(self, body: bytes):
        if body[:4] != b"DAC1":
            raise ValueError("not a segment")
        n_levels, self.n, n_docs = struct.unpack_from("<IQI", body, 4)
        at, self.levels = 20, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", body, at)
            blocks = -(-max(1, n) // BLOCK)
            chunk = np.frombuffer(body, np.uint8, n, at + 8)
            bitmap = np.frombuffer(body, np.uint8, blocks * BLOCK // 8, at + 8 + n)
            ranks = np.frombuffer(body, "<u4", blocks, at + 8 + n + len(bitmap))
            self.levels.append((chunk, bitmap, ranks))
            at += 8 + n + len(bitmap) + 4 * blocks
        self.doc_ids = np.frombuffer(body, "<i8", n_docs, at)
        self.offsets = np.frombuffer(body, "<u8", n_docs + 1, at + 8 * n_docs).astype(np.int64)

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit ``i``."""
        _, bitmap, ranks = self.levels[level]
        b = min(i // BLOCK, len(ranks) - 1)
        part = np.unpackbits(bitmap[b * BLOCK // 8 : -(-i // 8)], bitorder="little")[: i - b * BLOCK]
        return int(ranks[b]) + int(part.sum())

    def get(self, i: int) -> int:
        """The id at place ``i``, from one chunk a level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            out |= int(chunk[i]) << (CHUNK * level)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                return out
            i = self._rank(level, i)
        raise ValueError("the last level continues")

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``; only those are read."""
        out, who = np.zeros(stop - start, np.uint64), np.arange(stop - start)
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            if stop <= start:
                break
            out[who] |= chunk[start:stop].astype(np.uint64) << np.uint64(CHUNK * level)
            more = np.unpackbits(bitmap[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            who, start = who[more], self._rank(level, start)
            stop = start + len(who)
        return out.astype("<u4")

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.offsets[k]), int(self.offsets[k + 1]))


# The rules of a tokenizer file under which :func:`pieces` cuts a text where they do.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def parts_words(rules: dict) -> bool:
    """Whether pieces may be encoded one by one under a tokenizer file's rules."""
    normalizer, steps = rules.get("normalizer") or {}, (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = steps[0] if steps else {}
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and [x["type"] for x in steps] == ["Split", "ByteLevel"]
        and (split["pattern"], split["behavior"], split["invert"]) == ({"Regex": PARTED}, "Removed", True)
        and not steps[1]["add_prefix_space"]
        and not steps[1]["use_regex"]
        and all(t["content"].encode().startswith(SPECIAL) for t in rules.get("added_tokens", []))
    )


class WordEncoder:
    """Encodes with a tokenizer file.

    Where the file's rules never join characters across white space and some other places, the distinct pieces of a
    slice of texts are encoded once each and the ids of its texts gathered from them; these are the ids of the whole
    texts.  Under other rules every text is encoded whole.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            self.by_words = parts_words(json.load(f))
        self.pieces: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """Encode new pieces, many behind one another; a token belongs to the piece that its place lies in."""
        special = [w for w in new if SPECIAL in w]  # may hold a special token: each by itself
        self.pieces.update(zip(special, self._whole([w.decode() for w in special]), strict=True))
        plain = [w for w in new if SPECIAL not in w] if special else new
        groups = [plain[a : a + GROUP] for a in range(0, len(plain), GROUP)]
        texts = [b" ".join(g).decode() for g in groups]
        for group, text, e in zip(groups, texts, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids, places = np.array(e.ids, "<u4").tobytes(), np.array([a for a, _ in e.offsets], np.int64)
            ends = np.cumsum(np.fromiter(map(len, text.split(" ")), np.int64, len(group)) + 1)
            cuts = (4 * np.searchsorted(places, ends)).tolist()
            self.pieces.update(zip(group, (ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)), strict=True))

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece."""
        if len(self.pieces) > PIECES:
            self.pieces = {}
        found = list(map(self.pieces.get, pieces))
        new = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        if not new:
            return found
        self._learn(new)
        return list(map(self.pieces.__getitem__, pieces))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), each closed by ``end_id``, in a row; and where each text's ids start."""
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        end = np.array([end_id], "<u4").tobytes()
        if not self.by_words:
            bodies = [x + end for x in self._whole([t.decode() for t in texts.to_pylist()])]
            lengths = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
            return np.frombuffer(b"".join(bodies), "<u4"), np.concatenate([[0], np.cumsum(lengths)])
        words, ends = pieces(texts)
        words = words.dictionary_encode()
        bodies = [*self._known(words.dictionary.to_numpy(zero_copy_only=False).tolist()), end]
        ids, size = np.frombuffer(b"".join(bodies), "<u4"), np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
        # the end id stands behind each text's last piece
        index = np.insert(np.asarray(words.indices.to_numpy(zero_copy_only=False), np.int64), ends, len(bodies) - 1)
        start, length = np.cumsum(size) - size, size[index]
        to = np.cumsum(length)
        out = ids[np.repeat(start[index] - (to - length), length) + np.arange(int(to[-1]) if len(to) else 0)]
        return out, np.concatenate([[0], to[ends + np.arange(len(ends))]])


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: the lower-case byte, and 1 letter, 2 digit, 3 mark, 4 white space, 0 others; of plain characters only."""
    low, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    low[65:91] += 32
    kind[33:127] = 3
    kind[48:58], kind[97:123], kind[65:91], kind[ord("'")] = 2, 1, 1, 0
    kind[9:14] = kind[32] = 4
    return low, kind


LOW, KIND = _classes()


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts cut at white space and between plain letters, single digits and marks, where the pattern cuts too; and
    how many pieces there are up to each text's end.  Plain letters are lower-cased, as the tokenizer does.

    A text that may hold a special token is cut at white space only, and left as it is.
    """
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    body, kind = LOW[raw], KIND[raw]
    inside, last = kind != 4, np.concatenate([[4], kind[:-1]]).astype(np.uint8) if len(kind) else kind
    cut = (last == 4) | (last > 0) & (kind > 0) & ((last != kind) | (kind == 2))
    whole = raw.tobytes()
    at = whole.find(SPECIAL)
    while at >= 0:
        k = int(np.searchsorted(bounds, at, side="right")) - 1
        a, b = int(bounds[k]), int(bounds[k + 1])
        body[a:b], cut[a:b] = raw[a:b], last[a:b] == 4
        at = whole.find(SPECIAL, b)
    cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
    starts = np.flatnonzero(cut & inside)
    offsets = np.append(np.cumsum(inside)[starts] - 1, int(inside.sum())).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body[inside])])
    return words, np.searchsorted(starts, bounds[1:])


@lru_cache(maxsize=2)
def _encoder(file: str) -> WordEncoder:
    return WordEncoder(file)


def write_store(docs: DataFrame, file: str, end_id: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write segments; returns ``(part, segment, before, n_ids, body)`` as read back from the store.

    ``before`` counts the ids of the part's earlier segments.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.col(text).cast("string").alias("body"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie")
    dealt = dealt.select("doc", "body", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number, before = _encoder(file), 0, 0
        for batch in batches:
            for piece in text_slices(batch, "body", SEGMENT_BYTES):
                ids, offsets = encoder.encode(piece["body"], end_id)
                body = write_segment(ids, np.asarray(piece["doc"].to_numpy(), np.int64), offsets)
                values = [piece["part"][:1], pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([body], pa.binary())]
                yield pa.RecordBatch.from_arrays(values, names=["part", "segment", "before", "n_ids", "body"])
                number, before = number + 1, before + len(ids)

    return materialise(dealt.mapInArrow(run, "part int, segment int, before long, n_ids long, body binary"), "tokens")


def read_store(store: DataFrame) -> DataFrame:
    """Per document ``id, start, n_tokens, ids_crc32`` from the segments; ``start`` counts the ids of all before it.

    Only one total a part is added up on the driver: as many numbers as the store has partitions.
    """
    totals = store.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, sofar = [0] * (max((r["part"] for r in totals), default=0) + 1), 0
    for r in totals:
        starts[r["part"]] = sofar
        sofar += r["n"]
    placed = store.select((F.element_at(F.lit(starts), F.col("part") + 1) + F.col("before")).alias("first"), "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, body in zip(batch["first"].to_pylist(), batch["body"], strict=True):
                s = Segment(body.as_py())
                ids, cuts = memoryview(s.slice(0, s.n)).cast("B"), (4 * s.offsets).tolist()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
                doc = pa.array(s.doc_ids, mask=s.doc_ids == NULL_ID)
                yield pa.RecordBatch.from_arrays([doc, pa.array(first + s.offsets[:-1]), pa.array(np.diff(s.offsets)), pa.array(crc, pa.int64())], names=["doc", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc long, start long, n_tokens long, ids_crc32 long")
