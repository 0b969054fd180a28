"""Byte-level BPE by merge rounds over padded matrices.

A text is cut by the pattern; distinct pieces are bucketed by length and laid out as the rows of a matrix of token ids,
padded at the right.  In each round every row looks up the rank of all its neighbouring pairs in a hash table, merges
its leftmost pair of least rank, and closes the gap; rows without a mergeable pair leave the matrix.  A piece that is a
token itself is that token.

Most of a text is words behind single spaces, and such a word is cut alike wherever it stands.  So the ids of words
are remembered, in a table of bounded size, and only words that are new go through the pattern and the matrices.

Defined results: a null text is an empty one, and an empty text has no ids.  Any length of text or piece is encoded
whole; pieces beyond ``LONG`` bytes are merged one by one through a heap, which makes the same merges.  Repeated rows
are each encoded.  Other columns are carried only where asked for.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, text_bytes, text_slices

#: Longest piece in a matrix, most cells of one matrix, most remembered words.
LONG, CELLS, WORDS = 256, 1 << 20, 200_000
NONE = np.int64(1 << 40)


class PairTable:
    """Open-addressing table from a pair of ids to the id of their union, which is also its rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, union: np.ndarray):
        bits = max(4, int(len(left) * 3).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(1 << 63), np.uint64)
        self.values = np.full(1 << bits, NONE, np.int64)
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots, todo = mix64(keys) & self.mask, np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            at = slots[todo]
            free = self.keys[at] == np.uint64(1 << 63)
            _, first = np.unique(at, return_index=True)
            wins = np.zeros(len(todo), bool)
            wins[first] = True
            wins &= free
            self.keys[at[wins]], self.values[at[wins]] = keys[todo[wins]], union[todo[wins]]
            todo = todo[~wins]
            slots[todo] = (slots[todo] + np.uint64(1)) & self.mask

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = mix64(keys) & self.mask
        out = np.full(keys.shape, NONE, np.int64)
        seen = self.keys[at]
        found = seen == keys
        out[found] = self.values[at[found]]
        rest = np.flatnonzero(~found & (seen != np.uint64(1 << 63)))
        for _ in range(self.probes):
            if not len(rest):
                break
            at[rest] = (at[rest] + np.uint64(1)) & self.mask
            seen = self.keys[at[rest]]
            found = seen == keys[rest]
            out[rest[found]] = self.values[at[rest[found]]]
            rest = rest[~found & (seen != np.uint64(1 << 63))]
        return out


class ByteBPE:
    """Encoder and decoder for a rank file; ``pattern`` cuts the text."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).T)
        self.words: dict[str, bytes | None] = {}

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of about one length."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n, width = len(pieces), int(lengths.max())
        m = np.zeros((n, width), np.int64)
        inside = np.arange(width) < lengths[:, None]
        m[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((n, width), NONE, np.int64)  # of the pair that starts here
        for_pair = inside[:, 1:]
        rank[:, :-1][for_pair] = self.pairs(m[:, :-1][for_pair], m[:, 1:][for_pair])
        done: list[np.ndarray] = [None] * n  # type: ignore[list-item]
        who = np.arange(n)
        while len(who):
            at = rank.argmin(axis=1)  # the leftmost of least rank
            row = np.arange(len(who))
            best = rank[row, at]
            ends = best == NONE
            if ends.any():
                for r in np.flatnonzero(ends):
                    done[who[r]] = m[r, : lengths[r]].copy()
                stay = ~ends
                who, m, rank, lengths, at, best = who[stay], m[stay], rank[stay], lengths[stay], at[stay], best[stay]
                if not len(who):
                    break
                row = np.arange(len(who))
            m[row, at] = best
            shift = np.arange(m.shape[1] - 1) + (np.arange(m.shape[1] - 1) > at[:, None])
            m, rank = np.take_along_axis(m, shift, 1), np.take_along_axis(rank, shift, 1)
            lengths = lengths - 1
            last = at >= lengths - 1  # nothing stands to the right
            rank[row[last], at[last]] = NONE
            r, c = row[~last], at[~last]
            rank[r, c] = self.pairs(m[r, c], m[r, c + 1])
            has = at > 0
            r, c = row[has], at[has]
            rank[r, c - 1] = self.pairs(m[r, c - 1], m[r, c])
            width = int(lengths.max())
            if width < m.shape[1]:
                m, rank = m[:, :width], rank[:, :width]
        return done

    def _long(self, piece: bytes) -> np.ndarray:
        """The same merges through a heap and a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        right, left = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        first = self.pairs(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        ranks, tokens, n = self.ranks, self.tokens, len(ids)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n:
                    k = ranks.get(tokens[ids[x]] + tokens[ids[y]])
                    if k is not None:
                        heapq.heappush(heap, (k, x, ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, by buckets of length."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole])
            elif len(p) > LONG:
                out[i] = self._long(p)
            else:
                buckets.setdefault(len(p) if len(p) < 16 else -(-len(p) // 8) * 8, []).append(i)
        for width, members in sorted(buckets.items()):
            step = max(1, CELLS // width)
            for a in range(0, len(members), step):
                part = members[a : a + step]
                for i, ids in zip(part, self._matrix([pieces[j] for j in part]), strict=True):
                    out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.words) > WORDS:
            self.words.clear()
        words = self.words
        parts = [t.split(" ") for t in texts]
        # units are a text's first word and later words with the space before them
        units = [p[:1] + [" " + w for w in p[1:]] for p in parts]
        new = list({u for us in units for u in us if u not in words})
        cut: list[list[str] | None] = []
        for u in new:
            word = u.removeprefix(" ")
            # a word with white space at an end, or none at all, is cut differently beside others
            cut.append(self.pattern.findall(u) if word and not word[0].isspace() and not word[-1].isspace() else None)
        whole = [i for i, us in enumerate(units) if any(words.get(u, b"") is None for u in us)]
        odd = {u for u, c in zip(new, cut, strict=True) if c is None}
        if odd:
            whole = sorted({*whole, *(i for i, us in enumerate(units) if not odd.isdisjoint(us))})
        full = {i: self.pattern.findall(texts[i]) for i in whole}
        pieces = list({p for c in (*cut, *full.values()) if c for p in c})
        ids = dict(zip(pieces, (x.astype("<u4").tobytes() for x in self.encode_pieces([p.encode() for p in pieces])), strict=True))
        for u, c in zip(new, cut, strict=True):
            words[u] = None if c is None else b"".join([ids[p] for p in c])
        return [b"".join([ids[p] for p in full[i]]) if i in full else b"".join([words[u] for u in us]) for i, us in enumerate(units)]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids given as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _coder(rank_file: str, pattern: str) -> ByteBPE:
    return ByteBPE(rank_file, pattern)


#: Columns of the result; a carried column of such a name gives way.
OUT = ("n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", keep: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """The columns ``keep`` with ``n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``token_ids`` (binary).

    ``decoded_sha256`` is of the bytes that the ids decode to, for a check against the text.
    """
    carried = [c for c in (docs.columns if keep is None else keep) if c not in OUT]
    source = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)]).alias("row"), F.col(text).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(rank_file, pattern)
        for batch in batches:
            for part in text_slices(batch, "body"):
                ids = coder.encode([b.decode() for b in text_bytes(part["body"])])
                values = [
                    part["row"],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids], pa.string()),
                ]
                names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    values, names = [*values, pa.array(ids, pa.binary())], [*names, "token_ids"]
                yield pa.RecordBatch.from_arrays(values, names=names)

    inner = ", ".join(f"c{i}: {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carried))
    schema = f"row struct<{inner}>, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids binary" * with_ids
    made = source.mapInArrow(run, schema)
    return made.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carried)], *[c for c in made.columns if c != "row"])
