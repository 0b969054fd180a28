"""Quality rules as a ledger of bits.

Every rule is evaluated once over the whole text; the row keeps the measurements and one integer whose bits name the
rules that failed.  A policy is a versioned mask: applying one, or asking what each rule costs alone, is integer
arithmetic on the ledger and never touches the text again.

Defined results: a null text is an empty one (no words, so the word-count rule fails).  Repeated rows are each
measured.  Any length of text is measured whole.  Columns of the input whose names clash with the ledger's are
replaced by the ledger's where rows are passed through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, text_bytes, text_slices

WINDOW = 5
SYMBOLS = b"#*$%&|<>"

#: Rule name by bit.  The first two are the base rules.
RULES = ("few_words", "repeated_windows", "word_length", "symbols", "duplicate_lines", "shouting")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


def mask_of(*names: str) -> int:
    return sum(1 << RULES.index(n) for n in names)


#: Versioned policies.
POLICIES = {
    "base": mask_of("few_words", "repeated_windows"),
    "v1": mask_of(*RULES),
}


def _repeat_words(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Per document, how many words stand in a window of ``WINDOW`` words that the document holds twice or more."""
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(docs, np.int64)
    starts = np.flatnonzero(doc[: len(ids) - WINDOW + 1] == doc[WINDOW - 1 :])
    if not len(starts):
        return np.zeros(docs, np.int64)
    h = mix64(doc[starts].astype(np.uint64))
    for k in range(WINDOW):
        h = mix64(h + ids[starts + k].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(h, kind="stable")
    sorted_h, at = h[order], starts[order]
    same = np.flatnonzero(sorted_h[1:] == sorted_h[:-1])
    a, b = at[same], at[same + 1]
    true = doc[a] == doc[b]
    for k in range(WINDOW):
        true &= ids[a + k] == ids[b + k]
    if true.all():
        hit = np.zeros(len(starts), bool)
        hit[order[same]] = True
        hit[order[same + 1]] = True
    else:  # two windows with one hash: count the windows themselves
        rows = np.column_stack([doc[starts], *(ids[starts + k] for k in range(WINDOW))])
        _, inverse, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        hit = times[inverse.ravel()] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts[hit], 1)
    np.add.at(edge, starts[hit] + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)[:docs]


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measurements of UTF-8 texts, one value a text."""
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in MEASURES}
    number: dict[bytes, int] = defaultdict(count().__next__)
    parts, lengths = [], np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        words = t.split()
        lengths[i] = len(words)
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        raw = np.frombuffer(t, np.uint8)
        white = (raw == 32) | ((raw >= 9) & (raw <= 13))
        out["word_chars"][i] = len(t) - np.count_nonzero((raw & 0xC0) == 0x80) - np.count_nonzero(white)
        out["n_symbols"][i] = len(t) - len(t.translate(None, SYMBOLS))
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        out["n_upper"][i] = np.count_nonzero((raw >= 65) & (raw <= 90))
        out["n_letters"][i] = out["n_upper"][i] + np.count_nonzero((raw >= 97) & (raw <= 122))
    out["n_words"] = lengths
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    out["n_repeat_words"] = _repeat_words(ids, np.repeat(np.arange(n), lengths), n)
    return out


def failures(m: dict[str, np.ndarray]) -> np.ndarray:
    """Bits of the rules that fail, by integer comparisons alone."""
    words = m["n_words"]
    tests = {
        "few_words": words < 10,
        "repeated_windows": 100 * m["n_repeat_words"] > 20 * words,
        "word_length": (m["word_chars"] < 2 * words) | (m["word_chars"] > 20 * words),
        "symbols": 10 * m["n_symbols"] > 3 * words,
        "duplicate_lines": (2 * m["n_dup_lines"] > m["n_lines"]) & (m["n_lines"] > 3),
        "shouting": (2 * m["n_upper"] > m["n_letters"]) & (words >= 10),
    }
    bits = np.zeros(len(words), np.int64)
    for i, name in enumerate(RULES):
        bits |= tests[name].astype(np.int64) << i
    return bits


LEDGER = T.StructType([*(T.StructField(k, T.LongType()) for k in MEASURES), T.StructField("fail_bits", T.LongType())])


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, by default) with the measurements and ``fail_bits`` of every row."""
    carried = [c for c in (docs.columns if keep is None else keep) if c not in LEDGER.names]
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(text).cast("string").alias("body"))
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "body"):
                m = measure(text_bytes(part["body"]))
                values = [*part.columns[: len(carried)], *(pa.array(m[k]) for k in MEASURES), pa.array(failures(m))]
                yield pa.RecordBatch.from_arrays(values, names=[*part.schema.names[: len(carried)], *LEDGER.names])

    made = source.mapInArrow(run, T.StructType([*fields, *LEDGER.fields]))
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *LEDGER.names)


def passes(policy: str = "v1") -> Column:
    """True where no rule of the policy failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0


def sole_failure(policy: str = "v1") -> Column:
    """The rule that alone rejects a row under the policy, so that the row would be kept without it; null if none does."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]))
    out = F.lit(None).cast("string")
    for i, name in enumerate(RULES):
        if POLICIES[policy] >> i & 1:
            out = F.when(bits == 1 << i, name).otherwise(out)
    return out


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: rows it fails, rows it alone rejects, and rows kept if it were dropped.

    One aggregation over distinct bit masks (at most two to the number of rules), not over rows.
    """
    mask = POLICIES[policy]
    masks = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    tests = [i for i in range(len(RULES)) if mask >> i & 1]
    sums = masks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
        F.coalesce(F.sum(F.when(F.col("bits") == 0, F.col("n"))), F.lit(0)).alias("kept"),
        *[F.coalesce(F.sum(F.when(F.getbit("bits", F.lit(i)) == 1, F.col("n"))), F.lit(0)).alias(f"f{i}") for i in tests],
        *[F.coalesce(F.sum(F.when(F.col("bits") == 1 << i, F.col("n"))), F.lit(0)).alias(f"a{i}") for i in tests],
    )
    each = F.explode(F.array(*[F.struct(F.lit(RULES[i]).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"a{i}").alias("failed_alone"), (F.col("kept") + F.col(f"a{i}")).alias("kept_without")) for i in tests]))
    return sums.select(F.lit(policy).alias("policy"), each.alias("r")).select("policy", "r.*")
