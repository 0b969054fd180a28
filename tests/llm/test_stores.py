"""Centroids, Merkle manifest and archives against plain Python, and on hostile rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from quadrille.llm import centroids, merkle, warc

# --- 11 ---------------------------------------------------------------------------------------------------------------


def plain_clusters(rows, dims=64, clusters=8, rounds=10, scale=1024, seed=3):
    """All against all in whole numbers of any size."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), p) for i, p in kept if i is not None)
    centre = [p for _, p in first[:clusters]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p: min((apart(p, c), k) for k, c in enumerate(centre))
    for _ in range(rounds):
        mine = defaultdict(list)
        for _, p in kept:
            mine[near(p)[1]].append(p)
        centre = [[sum(c) // len(mine[k]) for c in zip(*mine[k], strict=True)] if mine[k] else centre[k] for k in range(len(centre))]
    placed = [(i, *near(p)[::-1]) for i, p in kept]
    inertia = Counter()
    for _, k, d in placed:
        inertia[k] += d
    return Counter((i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centre[k])).encode()).hexdigest()) for i, k, d in placed)


def clustered(df, **more):
    rows = centroids.cluster_vectors(df, **more)
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.sha) for r in rows.withColumn("sha", centroids.centroid_digest()).collect())


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_centroids(spark, monkeypatch):
    """Clusters, a very common vector, ties, repeats, and vectors that take no part; trees of several levels."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(centroids, "TREE", 300)
    middle = rng.normal(size=(12, 64))
    vectors = (middle[rng.integers(0, 12, 900)] + 0.1 * rng.normal(size=(900, 64))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0]) for i in range(450)] + [(i, vectors[i]) for i in range(5)] + [(7, vectors[8])]
    odd = [None, [], [0.5] * 63, [0.5] * 65, [None] + [0.5] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    rows += [(2000 + i, v) for i, v in enumerate(odd)] + [(None, vectors[3]), (3000, [0.0] * 64), (3001, [-3.7] * 64)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    want = plain_clusters(exact)
    assert clustered(df) == want and len(want) > 800
    clash = df.withColumns({c: F.lit("x") for c in ("id", "v", "key", "cluster", "distance", "n", "s0", "points", "ids", "centroid", "inertia")})
    assert clustered(clash) == want
    assert clustered(df, clusters=3, rounds=2, scale=7) == plain_clusters(exact, clusters=3, rounds=2, scale=7)


def test_centroids_of_few_vectors(spark):
    assert centroids.cluster_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    only_null = spark.createDataFrame([(None, [0.25] * 64, 1), (3, None, 1)], SCHEMA)
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in centroids.cluster_vectors(only_null).collect()] == [(None, None, None, None)]
    few = [(i, [0.25 * i + 0.001 * k for k in range(64)]) for i in range(3)] + [(9, [3.0e38] * 64)]
    got = centroids.cluster_vectors(spark.createDataFrame([(i, v, 1) for i, v in few], SCHEMA)).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(0, 0), (1, 0), (2, 0), (9, 0)] and {max(r.centroid) for r in got if r.vec_id == 9} == {centroids.BOUND}


def test_trees_prune_and_stay_exact():
    """Nodes are counted whole, and pruning changes no assignment, also where points lie on a border."""
    rng = np.random.default_rng(2)
    for spread in (3, 40, 10_000_000):
        points = rng.integers(-spread, spread + 1, (2_000, 5)).astype(np.int32)
        centre = rng.integers(-spread, spread + 1, (9, 5)).astype(np.int64)
        centre[4] = centre[2]
        tree = centroids.Tree(points)
        d = ((points.astype(object)[:, None] - centre[None]) ** 2).sum(axis=2)
        want = d.argmin(axis=1)
        k, apart = centroids.assign(tree, centre)
        assert (k == want[tree.order]).all() and (apart == d.min(axis=1)[tree.order]).all()
        count, total = centroids.sums(tree, centre)
        assert (count == np.bincount(want, minlength=9)).all() and (total == np.array([points[want == c].sum(axis=0, dtype=np.int64) for c in range(9)])).all()
    groups = np.repeat(np.arange(8) * 1000, 500)[:, None] + rng.integers(0, 9, (4_000, 5))
    whole = [len(n) for n, alive in centroids.Tree(groups.astype(np.int32)).filter(np.arange(8)[:, None] * np.full((1, 5), 1000, np.int64)) for n in [n[alive.sum(axis=1) == 1]]]
    assert whole[:3] == [0, 0, 0] and whole[3] == 8  # eight groups are eight nodes of the third level below the root


# --- 12 ---------------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(r, text):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {g: plain_levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    above = plain_levels([below[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (known, doc, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            text = r["text"]
            if known and text is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            now, told = plain_leaf(r, text), ""
            for levels, p in ((below[g], i), (above, at)):
                for level in levels[:-1]:
                    run = level[p // 8 * 8 : p // 8 * 8 + 8]
                    told += "".join(run[: p % 8] + run[p % 8 + 1 :])
                    now, p = digest("".join(run[: p % 8]) + now + "".join(run[p % 8 + 1 :])), p // 8
            out.append((r["doc_id"], leaf, below[g][-1][0], above[-1][0], digest(told), now, now == above[-1][0]))
    return Counter(out)


def manifest(df):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return Counter(tuple(r[c] for c in names) for r in merkle.manifest(df, present=merkle.tampered()).collect())


def hostile_documents(spark):
    rng = random.Random(3)
    rows = [(i, f"Text {i} of É", "hot", "s", i) for i in range(700)]
    rows += [(i, f"t{i}", rng.choice(["ab", "é", "a", "", None, "z" * 50]), None, None) for i in range(900, 1000)]
    rows += [(i, "A" * i, f"one{i}", "s", 1) for i in range(2000, 2070)]
    rows += [(None, "No id", "hot", "s", 1), (None, None, None, None, None), (5, "Text again", "hot", "s", 5), (7, "A longer Text " * 4000, "hot", "", -3), (8, "", "hot", "s", 0)]
    rows += [(6, "The Same", "hot", "s", 5)] * 20
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest(spark, monkeypatch, levels):
    """Blocks of one, two and four levels: three tiers, two, and one."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8**levels)
    df = hostile_documents(spark)
    want = plain_manifest([r.asDict() for r in df.collect()])
    clash = df.withColumns({c: F.lit("x") for c in ("id", "name", "digest", "present", "group", "at", "n", "one", "before", "place", "block", "root", "path")})
    got = manifest(clash)
    assert got == want
    assert 0 < sum(not k[-1] for k in got) < len(got) / 2


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(1, "x", None, None, None)], DOCS)).collect()
    assert [(r.leaf, r.subroot, r.root, r.proof_sha256, r.verified, bytes(r.path)) for r in one] == [(one[0].root, one[0].root, one[0].root, digest(""), True, b"")]


def test_paths_prove_rows_and_nothing_else(spark):
    rows = merkle.manifest(hostile_documents(spark), with_path=True).collect()
    assert all(r.verified for r in rows)
    for r in rows[::50]:
        assert merkle.fold(r.leaf.encode(), bytes(r.path)).decode() == r.root
        assert merkle.fold(rows[0].leaf.encode() if r.leaf != rows[0].leaf else b"0" * 64, bytes(r.path)).decode() != r.root


def test_traversal_memory_is_logarithmic():
    """Every path of every size of block; and what the traversal holds stays a few runs a level."""
    for n in [*range(1, 80), 511, 512, 513, 700]:
        leaves = [digest(str(i)).encode() for i in range(n)]
        levels = [[x.decode() for x in leaves]]
        while len(levels) <= merkle.levels_of(n):
            levels.append([digest("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        for i, path in enumerate(merkle.traverse(leaves, merkle.levels_of(n))):
            assert [(at, [d.decode() for d in run]) for at, run in path] == [(i // 8**h % 8, levels[h][i // 8 ** (h + 1) * 8 :][:8]) for h in range(merkle.levels_of(n))]
    walk = merkle.traverse([digest(str(i)).encode() for i in range(4096)], 4)
    most = 0
    for _ in walk:
        held = walk.gi_frame.f_locals
        most = max(most, sum(map(len, held["runs"])) + sum(len(t.done) + sum(map(len, t.stack)) for t in held["coming"]))
    assert most <= 4 * 8 * (2 + 4)


# --- 13 ---------------------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def hostile_pages(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé<>\r\n ") for _ in range(rng.randint(1, 9)))
    hot = "<p>hot " + "x" * 200
    rows = [(i, f"http://h.org/{i}", " ".join(word() for _ in range(rng.randint(0, 200)))) for i in range(150)]
    rows += [(1000 - i, "http://hot.org/", hot) for i in range(300)] + [(i, "u", "short") for i in range(2000, 2005)]
    rows += [(3000, None, None), (3001, "", ""), (3002, "bad url\r\nX: y", "WARC/1.1\r\n\r\n" * 30), (3003, "http://é.org/ü", "é" * 50), (3004, "http://l", "long" * 300_000), (3005, "http://e", "é" * 49)]
    rows += [(None, "null", hot), (None, "a", "only null " * 20), (None, "b", "only null " * 20), (701, "again", hot), (5, "http://h.org/5", rows[5][2])]
    return spark.createDataFrame(rows, PAGES).repartition(4)


def plain_records(rows):
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[r.html or ""] = min(first.get(r.html or "", r.page_id), r.page_id)
    out = []
    for r in rows:
        body, least = (r.html or "").encode(), first.get(r.html or "")
        again = len(body) >= 100 and least is not None and r.page_id != least
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", least if again else None))
    return Counter(out)


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BUNDLE", 1 << 18)
    monkeypatch.setattr(warc, "FRAME", 1 << 14)
    pages = hostile_pages(spark)
    rows = pages.collect()
    clash = pages.withColumns({c: F.lit("x") for c in ("page", "body", "digest", "bytes", "first", "n", "part", "bundle", "ids", "record_id")})
    archives = warc.write_archives(clash)
    read = warc.read_archives(archives, with_payload=True).collect()
    assert Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read) == plain_records(rows)
    assert Counter(bytes(r.payload).decode() for r in read if r.payload is not None) == Counter(r.html or "" for r in rows if (r.page_id, hashlib.sha256((r.html or "").encode()).hexdigest()) in {(x.page, x.payload_digest) for x in read if x.payload is not None})
    # any Zstandard reader sees one stream of records; the table at the end leads to each frame by itself
    bundles = [bytes(r.body) for r in archives.collect()]
    assert len(bundles) > 3
    for b in bundles:
        stream = zstandard.ZstdDecompressor().stream_reader(b, read_across_frames=True).read()
        table = warc.seek_table(b)
        assert stream == b"".join(warc.read_frame(b, e) for e in table) and stream.startswith(b"WARC/1.1\r\n")
        assert all(xxhash.xxh64_intdigest(warc.read_frame(b, e)) & 0xFFFFFFFF == e[3] for e in table)
    # access by identifier
    places = warc.index(archives)
    assert places.count() == len(rows)
    wanted = {warc.record_id(r.page_id, hashlib.sha256((r.html or "").encode()).hexdigest()): r for r in rows if r.page_id in (3, 77, 3003, 3004, 900, 5)}
    got = warc.fetch(archives, spark.createDataFrame([(i,) for i in wanted], "record_id string")).collect()
    assert Counter(r.record_id for r in got) == Counter(warc.record_id(r.page_id, hashlib.sha256((r.html or "").encode()).hexdigest()) for r in rows if r.page_id in (3, 77, 3003, 3004, 900, 5))
    for r in got:
        headers, block, end = warc.read_record(bytes(r.record))
        assert end == len(r.record) and headers[b"warc-record-id"].decode() == r.record_id
        if headers[b"warc-type"] == b"response":
            assert warc.payload_of(block)[0].decode() == (wanted[r.record_id].html or "")
    # files
    files = warc.export(archives, f"file://{tmp_path}/out").collect()
    assert sorted((tmp_path / "out").iterdir()) and sum(f.bytes for f in files) == sum(map(len, bundles))
    assert Counter(p.read_bytes() for p in (tmp_path / "out").iterdir()) == Counter(bundles)


def test_archives_of_nothing_and_damage(spark):
    empty = warc.write_archives(spark.createDataFrame([], PAGES))
    assert empty.count() == 0 and warc.read_archives(empty).count() == 0
    body = bytearray(warc.write_archives(spark.createDataFrame([(1, "u", "payload" * 40)], PAGES)).first().body)
    body[30] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        warc.read_frame(bytes(body), warc.seek_table(bytes(body))[0])
