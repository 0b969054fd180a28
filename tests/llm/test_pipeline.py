"""The pipeline against the same five steps in plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from quadrille.llm import quality_rules, similar_texts


def lower_words(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()).split()


def shingles(t):
    w = lower_words(t)
    return [b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))]


def similarity(a, b):
    return len(a & b) / len(a | b)


def groups_of(texts, least=0.8):
    """Number of the first text of each one's group, by all pairs that share a shingle."""
    sets = [frozenset(shingles(t)) if t.split() else frozenset() for t in texts]
    root, holders = list(range(len(texts))), defaultdict(list)

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for i, own in enumerate(sets):
        near = {j for x in own for j in holders[x]} if own else {j for j in range(i) if not sets[j]}
        for j in near:
            if not own or similarity(own, sets[j]) >= least:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in own:
            holders[x].append(i)
    return [find(i) for i in range(len(texts))]


def plain(rows):
    words = lambda t: t.encode().split()
    bits = quality_rules.failures(quality_rules.measure([r["text"].encode() for r in rows]))
    rows = [r for r, b in zip(rows, bits, strict=True) if not b]

    rows.sort(key=lambda r: r["doc_id"])
    rows = [r for i, (r, g) in enumerate(zip(rows, groups_of([r["text"] for r in rows]), strict=True)) if i == g]

    first = {}
    for r in rows:
        w = words(r["text"])
        for p in range(len(w) - 19):
            first.setdefault(tuple(w[p : p + 20]), (r["doc_id"], p))
    for r in rows:
        w = words(r["text"])
        gone = {k for p in range(len(w) - 19) if first[tuple(w[p : p + 20])] != (r["doc_id"], p) for k in range(p, p + 20)}
        if gone:
            r["text"] = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()

    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    order = sorted(sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    stopped = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in stopped)
        total = sum(weight[s] for s in order if s not in stopped)
        target = {s: 2 * sizes[s] if s in stopped else weight[s] * left / total for s in order}
        more = {s for s in order if target[s] > 2 * sizes[s]}
        if not more:
            break
        stopped |= more
    out = []
    for s in order:
        budget, at = math.floor(target[s]), 0
        whole, rest = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
        for r in sorted((r for r in rows if r["source"] == s), key=lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest()):
            w = words(r["text"])
            part = max(0, min(len(w), rest - at))
            at += len(w)
            out += [(r, r["text"])] * (whole if w else 0)
            if part:
                out.append((r, r["text"] if part == len(w) else b" ".join(w[:part]).decode()))

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Counter((r["doc_id"], r["source"], len(t), hashlib.sha256(np.array(coder.encode_ordinary(t), "<u4").tobytes()).hexdigest()) for r, t in out)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain([r.asDict() for r in docs.collect()])
    got = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.source, r.n_chars, r.ids_sha256) for r in got) == want


def test_near_duplicates_on_the_documents(spark, sf):
    """Whole documents of the next size against all pairs: what goes, and that no group goes wholly."""
    docs = corpus_pipeline.quality(spark, spark.read.parquet(f"{sf}/../sf0.01/documents.parquet"), sf)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = {rows[i][0] for i, g in enumerate(groups_of([t for _, t in rows])) if i == g}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()} == want


def test_near_copies_go(spark, sf):
    """Pairs in every band of similarity, by scattered changes and by cuts; large groups around one text and around none."""
    rng = random.Random(8)
    make = lambda n: [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(n)]
    rows, bands = [], defaultdict(list)
    while min((len(bands[k]) for k in (70, 75, 80, 85, 90, 95)), default=0) < 40:
        base, g = make(rng.randint(60, 400)), len(rows) // 2
        changed = list(base)
        if g % 2:
            for at in rng.sample(range(len(base)), rng.randint(1, max(1, len(base) // 14))):
                changed[at] = "new" + str(at)
        else:
            changed = changed[: len(changed) - rng.randint(1, len(changed) // 4)]
        j = similarity(*(set(shingles(" ".join(t))) for t in (base, changed)))
        if 0.7 <= j < 1:
            bands[int(j * 20) * 5].append(g)
            rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(changed).upper() if g % 4 == 1 else " ".join(changed))]
    top = len(rows)
    crowd, common = make(300), make(60)
    rows += [(top + k, " ".join([*crowd[:k], "other", *crowd[k + 1 :]])) for k in range(300)]
    # a wide circle: neighbours are alike, those further on are not
    ring = make(600)
    rows += [(top + 1000 + k, " ".join((ring + ring)[4 * k : 4 * k + 200])) for k in range(100)]
    # texts that share a long passage and nothing else
    rows += [(top + 2000 + k, " ".join(make(100) + common + make(100))) for k in range(200)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], spark.read.parquet(f"{sf}/documents.parquet").schema).repartition(3)
    stays = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    for band, members in bands.items():
        gone = sum(2 * g + 1 not in stays for g in members)
        assert gone == 0 if band < 80 else gone >= 0.95 * len(members), (band, gone, len(members))
    assert all(2 * g in stays for g in range(top // 2))
    assert [i for i in stays if top <= i < top + 1000] == [top]
    assert sum(i >= top + 2000 for i in stays) == 200
    assert 1 <= sum(top + 1000 <= i < top + 2000 for i in stays) <= 2


def test_stages_with_clashing_columns(spark, sf):
    """Columns under the names that operators use come back as they were, whatever is done to the rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    names = "row row_number n_words n_removed kept_sha256 kept_text fail_bits size taken whole target source_size carried node key fp body batch u v doc hash c0 none"
    clash = docs.withColumns({c: F.concat(F.lit(c + ":"), F.col("doc_id").cast("string")) for c in names.split()})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain_rows, rows = stage(spark, docs, sf).collect(), stage(spark, clash, sf)
        assert rows.columns == clash.columns
        rows = rows.collect()
        assert Counter((r.doc_id, r.text, r.n_chars) for r in rows) == Counter((r.doc_id, r.text, r.n_chars) for r in plain_rows)
        assert all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in names.split())


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, sf)
        assert out.columns == docs.columns and out.count() == 0
    hostile = spark.createDataFrame([(1, None, None, None, None), (None, "a b", "en", None, 3), (1, "", None, "x", 0)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, hostile, sf).count()
        # none has ten words; the null and the empty text are alike; a mix takes words, so "a b" once or more
        want = {corpus_pipeline.quality: got == 0, corpus_pipeline.near_duplicates: got == 2, corpus_pipeline.mix: got >= 1}
        assert want.get(stage, got == 3)


def test_one_row_of_a_group_stays(spark, sf):
    """Null and repeated ids: no unique text is lost, no copy stays."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    a, b, c, d, e = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcde")
    rows = [(1, a), (1, a), (2, a), (None, a), (1, b), (2, e), (None, c), (None, d), (None, d), (5, d[:0]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], schema)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(3), sf).collect())
    assert got == Counter([(1, a), (1, b), (2, e), (None, c), (None, d), (5, "")])
    copies = docs.where("text is not null and text <> ''")
    for _, stage in corpus_pipeline.STAGES[1:3]:
        copies = stage(spark, copies, sf)
    assert Counter((r.doc_id, r.text) for r in copies.collect()) == Counter([(1, a), (1, b), (2, e), (None, c), (None, d)])


def grouped(links):
    """The groups of two or more that links make."""
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for u, v in links:
        root[find(u)] = find(v)
    out = defaultdict(set)
    for a in list(root):
        out[find(a)].add(a)
    return {frozenset(g) for g in out.values()}


def test_no_partner_under_a_key_is_lost(spark, monkeypatch):
    """Pairs that share a crowded key or a fingerprint with texts that they are unlike, in lists and in several blocks."""
    rng = random.Random(3)
    texts, pairs = {}, set()
    for g in range(120):
        words = [f"{g}w{rng.randint(0, 10**6)}" for _ in range(60 + g % 30)]
        texts[3 * g], texts[3 * g + 1] = " ".join(words), " ".join([*words, "more"])
        texts[3 * g + 2] = " ".join(f"{g}v{k}" for k in range(60 + g % 30))
        pairs.add(frozenset((3 * g, 3 * g + 1)))
    bodies = spark.createDataFrame(sorted(texts.items()), "node long, body string")
    size = {n: len(set(shingles(t))) for n, t in texts.items()}
    own = lambda n: [1000 * n + k for k in range(similar_texts.BANDS)]

    def found(fp, keys):
        nodes = spark.createDataFrame([(n, size[n], fp(n), keys(n)) for n in texts], "node long, size long, fp long, keys array<long>")
        return grouped((r.u, r.v) for r in similar_texts.links(nodes, bodies, 5, 0.8).collect())

    far = lambda n: int.from_bytes(hashlib.md5(str(n).encode()).digest()[:8], "big", signed=True)
    monkeypatch.setattr(similar_texts, "HASHES", 5_000)
    monkeypatch.setattr(similar_texts, "AT_ONCE", 32)
    assert found(lambda n: 5, own) == pairs
    assert found(far, lambda n: [7, *own(n)[1:]]) == pairs
    # thirty texts a key, and fingerprints one bit from their group's
    assert found(far, lambda n: [n // 30, *own(n)[1:]]) == pairs
    assert found(lambda n: far(n // 30) ^ 1 << n % 30, own) == pairs
    assert found(far, own) == set()


def test_common_hashes():
    rng = np.random.default_rng(1)
    a, b = ([np.unique(rng.integers(0, 9_000, n)) for n in sizes] for sizes in ((0, 5, 4_000), (7_000, 1, 300, 2)))
    assert similar_texts.common(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert similar_texts.common([np.array([1])], [np.array([2])]).tolist() == [[0]]
