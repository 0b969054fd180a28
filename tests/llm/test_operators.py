"""Each corpus operator against brute force, and on hostile rows: nulls, empty and long texts, ties, repeats, clashes."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quadrille.llm import byte_bpe, embedding_graph, importance, mixing, quality_rules, queries, sharding, simhash, substring_dedup, token_store, url_filter
from quadrille.llm.components import connected_components

WORD_FILE, RANK_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, nulls, empty and long texts, a repeated row, a hot source."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghéü") for _ in range(rng.randint(1, 9))) for _ in range(900)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows = make(60), []
    for i in range(140):
        w = make(rng.randint(0, 90))
        if i % 5 == 0:
            w = w[:20] + passage[rng.randint(0, 20) :] + w[20:]
        if i % 17 == 3:
            w = make(12) * 4
        rows.append([i, rng.choice([" ", "\n", "  "]).join(w), "en", "hot" if i % 3 else f"s{i % 7}"])
    base = rows[11][1]
    rows += [[200 + k, base, "en", "hot"] for k in range(30)]
    rows += [[300 + k, f"{make(400)[0]} {rows[20][1]}", "en", "hot"] for k in range(8)]
    rows += [[400, None, None, None], [401, "", "en", "s1"], [402, " \n\t ", "en", None], [403, " ".join(make(30000)), "en", "s2"], [404, "a" * 5000, "en", "s2"], [405, "one two", "en", "s1"]]
    rows += [[None, "null id " + " ".join(passage), "en", "s1"], [20, rows[20][1], "en", "hot"]]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], COLUMNS).repartition(5).persist()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def clashing(df):
    """Extra columns under the operators' own names."""
    names = "size key fp h doc body row batch slice copy u v n node component rank one before source_size taken whole tie start n_words fail_bits shard slot first t1 t2 part n_tokens token_ids id at"
    return df.withColumns({c: F.lit("x") for c in names.split()})


# --- every query against its SQL --------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, duck, name):
    from conftest import same_rows

    df = queries.queries()[name](spark, sf)
    same_rows(df.collect(), df.columns, duck.execute(queries.oracle_sql()[name]))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("key", ["op2_quality_rules", "op3_substring_dedup"])
def test_sql_on_hostile_rows(docs, key):
    import duckdb
    from conftest import same_rows

    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    con = duckdb.connect()
    con.register("documents", unique.toPandas())
    if key.startswith("op2"):
        out = quality_rules.ledger(unique, keep=["doc_id"])
        out = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes().alias("kept"), "fail_bits", quality_rules.sole_failure().alias("sole_rule"))
    else:
        out = substring_dedup.remove_repeats(unique, with_text=False)
    same_rows(out.collect(), out.columns, con.execute(queries.oracle_sql()[key]))


# --- 1 ----------------------------------------------------------------------------------------------------------------


def test_url_filter(spark):
    page = lambda href: f'<html><link rel="canonical" href="{href}"></html>'
    rows = [
        (1, "HTTP://WWW.Example.COM/en/x?q#f", None), (2, "http://example.com/en/x", None), (3, "http://a.example.com/en/x", None), (4, "http://b.com", None), (5, "http://b.com/", None),
        (6, "http://x.net/es/a", page("http://y.org/a")), (7, "http://y.org/a#top", None), (8, "http://z.org/q", page("/r")), (9, "http://z.org/r", page("http://x.net/es/b")),
        (10, "http://w.org/1", page("http://x.net/fr/b")), (11, "http://w.org/2", page("http://w.org/1")), (12, "http://w.org/3", '<meta http-equiv="refresh" content="0;url=http://w.org/2">'), (13, "http://v.org/1", page("http://c.com/ok")),
        (14, "http://v.org/2", page("http://v.org/1")), (15, "http://v.org/3", page("http://x.net/es/z") + page("http://v.org/2")), (16, None, page("http://x.net/es/z")), (17, "no scheme", None), (18, "", None), (19, "http://u.org/self", page("http://u.org/self")), (7, "http://y.org/a#top", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = defaultdict(list)
    for r in url_filter.filter_urls(clashing(df)).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert got[1] == [("www.example.com", "/en/x", "www.example.com/en/", "allow")]
    assert got[2][0][2:] == ("example.com/en/", "block") and got[3][0][2:] == ("example.com/en/", "block")
    assert got[4] == [("b.com", "", None, "allow")] and got[5][0][2] == "com/"
    assert got[6][0][2:] == ("net/es/", "block")
    assert got[7] == [("y.org", "/a", None, "block")] * 2
    assert {got[i][0][3] for i in (8, 9, 10, 11, 12)} == {"block"}
    assert {got[i][0][3] for i in (13, 14, 15)} == {"allow"}  # an explicitly allowed member prevails
    assert got[16] == got[17] == got[18] == [("", "", None, "allow")] and got[19][0][3] == "allow"
    assert url_filter.filter_urls(df.where("false")).count() == 0
    logged = spark.createDataFrame([("http://x.net/es/a", "http://t.org/1"), (None, "http://t.org/1")], "source string, target string")
    assert url_filter.filter_urls(spark.createDataFrame([(1, "http://t.org/1")], "page_id long, url string"), html=None, redirects=logged).first().verdict == "block"


def test_two_calls_at_once(spark):
    """Each thread deletes only what it wrote itself, and a call that fails leaves nothing behind."""
    import os
    from concurrent.futures import ThreadPoolExecutor

    from quadrille.llm.common import materialise, scope, shared_dir

    def run(k):
        edges = spark.createDataFrame([(k + i, k + i + 1) for i in range(40)], "u long, v long")
        return {(r.node, r.component) for r in connected_components(edges).collect()}

    starts = [0, 1000, 2000, 3000]
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(run, starts)) == [{(k + i, k) for i in range(41)} for k in starts]
    before = set(os.listdir(shared_dir(spark)))
    with scope(spark) as own:
        kept = own.keep(materialise(spark.range(3), "kept"))
        materialise(spark.range(3), "gone")
    assert kept.count() == 3 and len(set(os.listdir(shared_dir(spark))) - before) == 1
    with pytest.raises(ZeroDivisionError), scope(spark) as own:
        own.keep(materialise(spark.range(3), "gone"))
        raise ZeroDivisionError
    assert len(set(os.listdir(shared_dir(spark))) - before) == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 400)] + [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(220)] + [(5, 5), (None, 3)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 2 ----------------------------------------------------------------------------------------------------------------


def test_quality_ledger(docs, rows, empty):
    out = quality_rules.ledger(clashing(docs))
    assert out.count() == len(rows) and "lang" in out.columns
    table = {r.rule: r for r in quality_rules.ablations(out).collect()}
    alone = Counter(r.sole for r in out.select(quality_rules.sole_failure().alias("sole")).collect())
    assert all(alone[rule] == r.failed_alone for rule, r in table.items())
    bits = [r.fail_bits for r in out.collect()]
    for i, name in enumerate(quality_rules.RULES):
        assert table[name].failed == sum(b >> i & 1 for b in bits)
        assert table[name].failed_alone == sum(b == 1 << i for b in bits)
        assert table[name].kept_without == sum(b & ~(1 << i) == 0 for b in bits)
    assert quality_rules.ledger(empty).count() == 0 and quality_rules.ablations(quality_rules.ledger(empty)).first().failed == 0


# --- 3 ----------------------------------------------------------------------------------------------------------------


def brute_repeats(rows):
    first, out = {}, []
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, text, *_ in ordered:
        w = words(text)
        for p in range(len(w) - 19):
            first.setdefault(tuple(w[p : p + 20]), (i, p))
            first[tuple(w[p : p + 20])] = min(first[tuple(w[p : p + 20])], (i, p), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    for i, text, *_ in ordered:
        w = words(text)
        gone = set()
        for p in range(len(w) - 19):
            if first[tuple(w[p : p + 20])] != (i, p):
                gone |= set(range(p, p + 20))
        out.append((i, len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


def test_substring_dedup(docs, rows, empty):
    want = Counter((i, n, g, hashlib.sha256(b" ".join(k)).hexdigest()) for i, n, g, k in brute_repeats(rows))
    got = substring_dedup.remove_repeats(clashing(docs)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert sum(r.n_removed for r in got) > 2000
    for r in got:
        if r.n_removed:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_cover_aligns_any_two_positions():
    for a in range(substring_dedup.PERIOD):
        for b in range(substring_dedup.PERIOD):
            assert any((a + k) % 13 in substring_dedup.COVER and (b + k) % 13 in substring_dedup.COVER for k in range(13))


# --- 4 ----------------------------------------------------------------------------------------------------------------


def test_token_store(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_FILE)
    store = token_store.write_store(clashing(docs), WORD_FILE)
    got = token_store.read_store(store).collect()
    want, at = [], 0
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(repr, [(r.doc, r.start, r.n_tokens, r.ids_crc32) for r in got])) == sorted(map(repr, want))
    assert token_store.read_store(token_store.write_store(empty, WORD_FILE)).count() == 0
    hard = ["x<|endoftext|>y <|ENDOFTEXT|>", "İß ΣΣ é é ́a", "it's 'S 12.5,!? a.,'s", "\x85\xa0x　y", "€. €,, a€."]
    rng, letters = random.Random(4), "ab é.,'s1#$\n\t\u3000İ<|>ß-\u0301Σ"
    hard += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "  a  "]
    for by_words in (True, False):
        coder = token_store.WordEncoder(WORD_FILE)
        assert coder.by_words
        coder.by_words = by_words
        ids, starts = coder.encode(pa.array([*hard, None]), 1)
        for t, a, b in zip([*hard, ""], starts, starts[1:], strict=False):
            assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t
    assert token_store.WordEncoder(WORD_FILE).encode(pa.array([], pa.string()), 1)[1].tolist() == [0]
    assert not token_store.parts_words({"normalizer": None, "pre_tokenizer": {"pretokenizers": []}})


@pytest.mark.parametrize("top", [200, 60_000, 1 << 31])
def test_segment_random_access(top):
    rng = np.random.default_rng(top)
    ids = rng.integers(0, top, 3000).astype("<u4") >> rng.integers(0, 9, 3000).astype("<u4")
    s = token_store.Segment(token_store.write_segment(ids, np.array([4, 9, 12]), np.array([0, 700, 700, 3000])))
    assert [s.get(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
    assert (s.slice(123, 2345) == ids[123:2345]).all() and s.document(1).tolist() == [] and (s.document(2) == ids[700:]).all()
    none = token_store.Segment(token_store.write_segment(np.zeros(0, "<u4"), np.zeros(0, np.int64), np.array([0])))
    assert none.n == 0 and none.slice(0, 0).tolist() == []


# --- 5 ----------------------------------------------------------------------------------------------------------------


def brute_capacity(sizes, shards):
    low, high = max(sizes) - 1, sum(sizes)
    while high - low > 1:
        mid, n, a = (low + high) // 2, 1, 0
        for x in sizes:
            if x > mid:
                n = shards + 1
            if a + x > mid:
                n, a = n + 1, 0
            a += x
        low, high = (low, mid) if n <= shards else (mid, high)
    return high


@pytest.mark.parametrize("seed", range(60))
def test_minimax(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 300))]
    if seed % 3 == 0:
        sizes[rng.randrange(len(sizes))] = sum(sizes) // 2 + 1
    shards, points = rng.randint(1, 16), rng.choice([2, 5, 20])
    ends = np.cumsum(sizes).tolist()

    def fetch(stretches):
        out = []
        for a, b in stretches:
            blocks = defaultdict(list)
            for p in ends:
                if a < p <= b:
                    blocks[(p - a - 1) // max(1, -(-(b - a) // points))].append(p)
            out.append([(min(v), max(v), len(v)) for v in blocks.values()])
        return out

    capacity, cuts = sharding.minimax_cuts(fetch, ends[-1], max(sizes), shards)
    assert capacity == brute_capacity(sizes, shards) and set(cuts) <= set(ends) and len(cuts) < shards
    assert max(b - a for a, b in zip([0, *cuts], [*cuts, ends[-1]], strict=True)) <= capacity


def test_sharding(docs, rows, empty):
    got = sharding.shard(clashing(docs).where("doc_id is not null"), 7).collect()
    texts = [(i, t) for i, t, _ in rows if i is not None]
    assert len(got) == len(texts)
    by_id = defaultdict(set)
    for i, t in texts:
        by_id[i].add(t)
    slots, home, sizes = defaultdict(list), {}, Counter()
    for r in got:
        (text,) = by_id[r.doc_id]
        assert r["size"] == len((text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text or "").encode())
        assert home.setdefault(text, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(7))
    groups = defaultdict(int)
    for _, t in sorted(texts, key=lambda r: r[0]):
        groups[t] += len((t or "").encode()) + 1
    assert max(sizes.values()) == brute_capacity(list(groups.values()), 7)
    assert sharding.shard(empty).count() == 0


# --- 6 ----------------------------------------------------------------------------------------------------------------


def test_mixing(docs, rows, empty):
    got = mixing.mix(clashing(docs), keep=["doc_id", "source"]).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, stopped = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in stopped)
        total = sum(weight[s] for s in order if s not in stopped)
        target = {s: 2 * sizes[s] if s in stopped else weight[s] * left / total for s in order}
        more = {s for s in order if target[s] > 2 * sizes[s]}
        if not more:
            break
        stopped |= more
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(taken[s] == math.floor(target[s]) for s in order)
    again = mixing.mix(docs.repartition(3), keep=["doc_id", "source"]).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in got) == Counter((r.doc_id, r["size"], r.taken) for r in again)
    assert mixing.mix(empty).count() == 0
    repeated = docs.unionByName(docs.where("doc_id = 20 or doc_id is null")).withColumn("row", F.monotonically_increasing_id()).persist()
    plan = mixing.mix(repeated, keep=["row"])
    copies = mixing.copies_taken(repeated, plan, "row")
    assert copies.columns == repeated.columns
    each = Counter()
    for r in copies.collect():
        each[r.row] += len(words(r.text))
    assert each == Counter({r.row: r.taken for r in plan.collect() if r.taken})  # not a word more or less


# --- 7 ----------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    every = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(every[:i] ^ every[i]) <= 2).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash(docs, rows, empty):
    got = simhash.near_duplicates(clashing(docs)).withColumn("hex", simhash.hex_fingerprint()).collect()
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    least = {}
    for (i, _, _), c in zip(rows, brute_components(prints), strict=True):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", least[c]) for (i, _, _), p, c in zip(rows, prints, brute_components(prints), strict=True))
    assert Counter((r.doc_id, r.hex, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_crowded_keys_lose_no_link(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 500:
        f = base
        for b in rng.sample(range(64) if rng.random() < 0.6 else range(7), rng.randint(0, 5)):
            f ^= 1 << b
        prints.add(f)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = {r.node: r.component for r in connected_components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))).collect()}
    roots = brute_components([p & (1 << 64) - 1 for p in signed])
    assert [found.get(p, p) for p in signed] == [signed[r] for r in roots]


def test_golay():
    assert (simhash.GOLAY.error >= 0).all()  # a perfect code: every syndrome has its error
    x = np.random.default_rng(0).integers(0, 1 << 23, 2000)
    keys = simhash.GOLAY.keys(x, 23)
    assert {len(set(k)) for k in keys.tolist()} == {1, 6}
    for flips in ((0,), (1,), (3, 17), (22, 5)):
        y = x.copy()
        for f in flips:
            y ^= 1 << f
        assert all(set(a) & set(b) for a, b in zip(keys.tolist(), simhash.GOLAY.keys(y, 23).tolist(), strict=True))


# --- 8 ----------------------------------------------------------------------------------------------------------------


def scrambled(x):
    m = (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ x >> 27) * 0x94D049BB133111EB & m
    return x ^ x >> 31


def brute_grams(text):
    """Buckets of single words and of pairs."""
    h = [xxhash.xxh3_64_intdigest(w) for w in text.lower().split()]
    return [scrambled(a) % 65536 for a in h] + [scrambled((a * 0x9E3779B97F4A7C15 + b) % (1 << 64)) % 65536 for a, b in zip(h, h[1:], strict=False)]


def test_importance(spark, sf, docs, empty):
    """Models, ratios, noise and the cut, all by plain Python."""
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = importance.resample(d, labels).collect()
    n = len(got)
    assert sorted(r.rank for r in got) == list(range(n)) == list(range(d.count()))
    texts = {r.doc_id: r.text.encode() for r in d.collect()}
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    raw, target = Counter(), Counter()
    for i, t in texts.items():
        raw.update(brute_grams(t))
        target.update(brute_grams(t) if i in good else [])
    rate = sum(target.values()) / sum(raw.values())
    score = {}
    for r in got:
        grams = brute_grams(texts[r.doc_id])
        ratio = sum(math.log((target[b] + 2) / (raw[b] * rate + 2)) for b in grams)
        assert abs(ratio - r.log_ratio) < 1e-6 * max(1, abs(ratio))
        h = xxhash.xxh64_intdigest((0).to_bytes(4, "little"), xxhash.xxh64_intdigest(r.doc_id.to_bytes(8, "little"), 42))
        noise = -math.log(-math.log(((h >> 11) + 0.5) / (1 << 53)))
        score[r.doc_id] = 400 * ratio / max(1, len(grams)) + noise
        assert abs(score[r.doc_id] - r.score) < 1e-6 * max(1, abs(r.score))
    by_rank = [r.doc_id for r in sorted(got, key=lambda r: r.rank)]
    assert all(score[a] >= score[b] - 1e-9 for a, b in zip(by_rank, by_rank[1:], strict=False))
    share = labels.where("quality = 1").count() / labels.count()
    assert all(r.kept == (r.rank < round(share * n)) for r in got)
    plain = importance.resample(d, labels, length=None).collect()
    assert all(r.log_weight == r.log_ratio for r in plain)
    assert importance.resample(empty, labels).count() == 0
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    assert {r.doc: r.target for r in importance.targets(odd).collect()} == {1: False, 2: True}
    assert importance.resample(clashing(docs), odd).count() == docs.count()


def test_importance_on_held_out_labels(spark):
    """Fitted on even ids, judged on odd ones."""
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = importance.resample(d, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rates = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rates[1] > 0.95 and rates[0] < 0.25


# --- 9 ----------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(RANK_FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, rows, empty, tiktoken_encoding):
    got = byte_bpe.encode_documents(clashing(docs), RANK_FILE, public_tokenizers.PATTERN).collect()
    want = Counter()
    for i, t, _ in rows:
        ids = np.array(tiktoken_encoding.encode_ordinary(t or ""), "<u4").tobytes()
        want[(i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(hashlib.sha256(r.token_ids).hexdigest() == r.ids_sha256 for r in got)
    assert byte_bpe.encode_documents(empty, RANK_FILE, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_odd_texts(tiktoken_encoding):
    coder, rng = byte_bpe.ByteBPE(RANK_FILE, public_tokenizers.PATTERN), random.Random(1)
    letters = "ab c\n\t  's1é😀,.!　́Z<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choice("abehtin") for _ in range(n)) for n in (200, 255, 256, 257, 300, 1000, 5000)] + [" " * 3000, "a" * 4000, "\n" * 500 + " x", "x  "]
    for t, b in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(b, "<u4").tolist() == tiktoken_encoding.encode_ordinary(t) and coder.decode(b) == t.encode()


# --- 10 ---------------------------------------------------------------------------------------------------------------


def vectors(rng):
    rows, n = [], 0
    for label, clusters in (("a", 25), ("b", 4)):
        for _ in range(clusters):
            center = rng.normal(size=16)
            for _ in range(rng.integers(1, 14)):
                rows.append((n, (center + rng.normal(size=16) * 0.1).tolist(), label))
                n += 1
    center = rng.normal(size=16)
    for k in range(200):
        rows.append((n, (center + rng.normal(size=16) * 0.02).tolist(), "a"))
        n += 1
    rows += [(n + k, rows[0][1], "a") for k in range(40)]
    n += 40
    for v in rng.normal(size=(700, 3)):  # an even spread, cut by many borders
        rows.append((n, v.tolist(), "c"))
        n += 1
    center = rng.normal(size=16)
    for k in range(300):  # a crowd that does not come apart, in part farther than half the reach from its middle
        rows.append((n, (center / np.linalg.norm(center) + rng.normal(size=16) * (0.01 if k % 2 else 0.033)).tolist(), "d"))
        n += 1
    odd = [([0.0] * 16, "a"), (None, "a"), ([None] + [1.0] * 15, "a"), ([math.nan] + [1.0] * 15, "a"), ([math.inf] + [1.0] * 15, "a"), (rows[0][1], None), ([1.0, 2.0], "a"), ([1.0, 2.0], "a"), ([], "a"), ([1e200] * 16, "b"), ([1e-200] * 16, "b")]
    rows += [(n + k, v, x) for k, (v, x) in enumerate(odd)]
    return rows


@pytest.mark.parametrize("shard,block,deal", [(3000, 3000, 20_000), (120, 60, 50)])
def test_embedding_graph(spark, monkeypatch, shard, block, deal):
    monkeypatch.setattr(embedding_graph, "SHARD", shard)
    monkeypatch.setattr(embedding_graph, "AIM", shard // 3)
    monkeypatch.setattr(embedding_graph, "BLOCK", block)
    monkeypatch.setattr(embedding_graph, "DEAL", deal)
    rows = vectors(np.random.default_rng(3))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    out = embedding_graph.link_vectors(clashing(df))
    got = {r.vec_id: r for r in out.collect()}
    assert len(got) == len(rows)
    unit = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = (label, x / np.sqrt(x @ x))
    links, root = Counter(), {i: i for i, _, _ in rows}

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for i, (a, x) in unit.items():
        for j, (b, y) in unit.items():
            if i < j and a == b and len(x) == len(y) and x @ y >= 0.98:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    assert all(got[i].n_links <= links[i] for i in got) and sum(r.n_links for r in got.values()) % 2 == 0
    assert sum(r.n_links for r in got.values()) >= 0.999 * sum(links.values())
    wrong = sum(got[i].component_id != find(i) for i in got)
    assert wrong <= 0.002 * len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in got if i not in unit)
    told, there = embedding_graph.audit(df, out)
    assert there and told >= 0.9 * there
    assert embedding_graph.link_vectors(df.where("false")).count() == 0
