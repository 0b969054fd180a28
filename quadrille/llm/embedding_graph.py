"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors of one label are cut into overlapping cluster shards: a cell that is too large is split around centroids
fitted to a bounded sample of it.  The nearest centroid is a vector's home; it also joins every child whose border it
lies near.  The strip along a border is as wide as two linked vectors can lie apart, so whatever links with a vector is
a member of its home.  Where that would put the sample's vectors in more than ``OVERLAP`` children on the mean, the
strip is narrowed step by step (``STRIPS``), as long as no more than a share ``LOST`` of the links between the sample's
vectors gets lost: vectors of many independent components allow it, as a link's short way hardly points at a border.
Each shard builds a flat graph (nearest neighbours, pruned so that a kept neighbour is not close to
one kept before); a vector's adjacency lists from all its shards are united.  Then every vector is searched for from
its home shard's medoids and its own lists: a greedy search for the region, then expansion over all nodes in range.
Pairs found are verified by their cosine in double precision.  A pair whose ends have different homes belongs to that
home whose name comes first, so it is counted in one task, at both ends.

Equal vectors are one node with a count, so copies never form pairs.  A cell that does not come apart holds vectors
that are nearly the same.  Those within half the linking distance of its centroid all link with each other, which is
counted by arithmetic; the others are compared with all, exactly, in blocks of bounded size.  Tasks return a count for
each vector and a spanning set of links, not all pairs.

The graph is approximate in what it finds, never in what it reports; ``audit`` measures recall against brute force for
every id divisible by 100.

Defined results: a vector that is null or zero, or holds a null or non-finite component, or has a null label, links
with nothing; vectors of different lengths do not link.  Rows with equal label and vector link with each other, also
when they repeat an id.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise
from .components import connected_components

#: Largest shard and mean size aimed at; most children of one split; sampled vectors a child; vectors a task assigns.
SHARD, AIM, FAN, SAMPLE, DEAL = 3000, 1000, 32, 64, 20_000
#: Factors of a strip's full width, the memberships a vector should have on the mean, and the links it may cost.
STRIPS, OVERLAP, LOST = (1.0, 0.75, 0.5, 0.35, 0.25, 0.15), 2.25, 0.001
#: Candidates and degree of the graph, the pruning factor, and the beam of the greedy search.
CANDIDATES, DEGREE, ALPHA, BEAM = 48, 24, 1.2, 12
#: Expansion also passes through nodes this much below the threshold.
SLACK = 0.02
BLOCK = 3000


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of length one."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# --- shards -----------------------------------------------------------------------------------------------------------


def _outside(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and how far the row lies from the border to each other centroid."""
    dot = x @ centroids.T
    near = dot.argmax(axis=1)
    gap = np.sqrt(np.maximum(0, ((centroids[:, None] - centroids) ** 2).sum(axis=2)))[near]
    # the plane midway between two centroids of length one passes through the origin
    return near, (dot[np.arange(len(dot)), near][:, None] - dot) / np.maximum(gap, 1e-9)


def _fit(reach: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        c, x = _centroids(table)
        near, far = _outside(x, c)
        a, b = np.nonzero(x @ x.T >= 1 - reach * reach / 2)
        across = far[b, near[a]]  # how far each link's end lies outside the other's home
        strip = reach
        for f in STRIPS:
            if np.count_nonzero(across > reach * f) > LOST * len(a):
                break
            strip = reach * f
            if np.count_nonzero(far <= strip) <= OVERLAP * len(x):
                break
        return pa.table({"cell": [key[0].as_py()], "vec": pa.array([c.ravel().tolist()], pa.list_(pa.float64())), "strip": [strip]})

    return run


def _centroids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of a sample, by a few rounds of k-means from spread-out starts; and the sample."""
    x = _unit(table["vec"])
    k = min(len(x), int(table["children"][0].as_py()))
    start, far = [0], np.full(len(x), np.inf)
    for _ in range(k - 1):
        far = np.minimum(far, ((x - x[start[-1]]) ** 2).sum(axis=1))
        start.append(int(far.argmax()))
    c = x[start]
    for _ in range(8):
        near = (x @ c.T).argmax(axis=1)
        for j in range(k):
            if (near == j).any():
                m = x[near == j].mean(axis=0)
                if (size := np.sqrt((m * m).sum())) > 1e-6:
                    c[j] = m / size
    return c, x


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Children of rows that come sorted by cell and salt, each such group led by a row with the cell's centroids."""
    cell, centroids, strip = None, None, 0.0
    for batch in batches:
        heads = np.flatnonzero(np.asarray(batch["id"].is_null().to_numpy(zero_copy_only=False), bool)).tolist()
        for a, b in zip([None, *heads], [*heads, batch.num_rows], strict=True):
            if a is not None:
                cell, strip, flat = batch["cell"][a].as_py(), batch["strip"][a].as_py(), np.asarray(batch["vec"][a].values.to_numpy(), np.float64)
                centroids = flat.reshape(-1, int(batch["dim"][a].as_py()))
            part = batch.slice(0 if a is None else a + 1, b - (0 if a is None else a + 1))
            if not part.num_rows:
                continue
            x = _unit(part["vec"])
            near, far = _outside(x, centroids)
            row, child = np.nonzero(far <= strip + 1e-9)
            home = np.asarray(part["home"].to_numpy(zero_copy_only=False), bool)[row] & (near[row] == child)
            taken = part.take(pa.array(row))
            off = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,nd->n", x[row], centroids[child])))
            yield pa.RecordBatch.from_arrays([pa.array([f"{cell}.{j}" for j in child.tolist()]), taken["id"], pa.array(home), taken["n"], taken["vec"], pa.array(off)], names=["cell", "id", "home", "n", "vec", "off"])


#: ``off`` is the chord from the cell's centroid.
MEMBER = "cell string, id long, home boolean, n long, vec array<double>, off double"


def shards(nodes: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Members of shards, and members of cells that did not come apart; nodes are ``id, label, n, vec``."""
    members = nodes.select(F.concat_ws(":", "label", F.size("vec")).alias("cell"), "id", F.lit(True).alias("home"), "n", "vec", F.lit(None).cast("double").alias("off"))
    done, dense = [], []
    while True:
        sizes = members.groupBy("cell").agg(F.count("*").alias("size"))
        parent = F.regexp_replace("cell", r"\.\d+$", "")
        big = materialise(sizes.where(F.col("size") > SHARD).select("cell", "size", parent.alias("parent")), "big")
        done.append(members.join(big.select("cell"), "cell", "left_anti"))
        if not big.take(1):
            break
        if dense:
            # a child about as large as its parent shows vectors too alike to be split further
            stuck = big.join(before.select(F.col("cell").alias("parent"), F.col("size").alias("was")), "parent").where(F.col("size") > 0.7 * F.col("was"))
            stuck = materialise(stuck.select("cell"), "stuck")
            dense.append(members.join(stuck, "cell"))
            big = big.join(stuck, "cell", "left_anti")
        else:
            dense.append(members.where("false"))
        before = big
        split = big.withColumn("children", F.least(F.lit(FAN), F.ceil(F.col("size") / AIM)).cast("int"))
        split = split.withColumn("salts", F.ceil(F.col("size") / DEAL).cast("int"))
        chance = F.pmod(F.xxhash64("id", "cell"), F.lit(1 << 30)) / float(1 << 30) < F.col("children") * SAMPLE / F.col("size")
        large = members.join(split.select("cell", "size", "children", "salts"), "cell")
        centroids = large.where(chance).select("cell", "children", "vec").groupBy("cell").applyInArrow(_fit(reach), "cell string, vec array<double>, strip double")
        centroids = materialise(centroids, "centroids").join(split.select("cell", "salts"), "cell")
        dim = F.split_part("cell", F.lit(":"), F.lit(-1))
        dim = F.split_part(dim, F.lit("."), F.lit(1)).cast("int").alias("dim")
        heads = centroids.select("cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("boolean").alias("home"), F.lit(None).cast("long").alias("n"), "vec", dim, "strip")
        rows = large.select("cell", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), "id", "home", "n", "vec", dim, F.lit(None).cast("double").alias("strip"))
        dealt = heads.unionByName(rows).repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.col("id").asc_nulls_first())
        members = materialise(dealt.select("cell", "id", "home", "n", "vec", "dim", "strip").mapInArrow(_assign, MEMBER), "members")
    whole = done[0]
    for x in done[1:]:
        whole = whole.unionByName(x)
    stuck_rows = members.where("false")
    for x in dense:
        stuck_rows = stuck_rows.unionByName(x)
    return materialise(whole, "shards"), materialise(stuck_rows, "dense")


# --- graph ------------------------------------------------------------------------------------------------------------


def _prune(x: np.ndarray, part: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Robust pruning of the nodes ``part``, whose candidates ``near`` are sorted by distance; ``-1`` pads a list."""
    n, _ = near.shape
    rows, alive = np.arange(n), np.ones(near.shape, bool)
    out = np.full((n, DEGREE), -1, np.int64)
    candidates = x[near]
    own = 1 - np.einsum("nd,nmd->nm", part, candidates)
    for k in range(DEGREE):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        out[some, k] = near[rows, pick][some]
        gap = 1 - np.einsum("nd,nmd->nm", candidates[rows, pick], candidates)
        alive[rows, pick] = False
        alive &= ~((ALPHA * ALPHA * gap <= own) & some[:, None])
    return out


def _build(key: tuple, table: pa.Table) -> pa.Table:
    """Adjacency lists of a shard, and the shard's name for those whose home it is."""
    ids, x = np.asarray(table["id"].to_numpy()), _unit(table["vec"])
    owner = [key[0].as_py() if h else None for h in table["home"].to_pylist()]
    n = len(ids)
    lists: list[list[int]] = []
    for a in range(0, n, 256):
        part = x[a : a + 256]
        sim = part @ x.T
        sim[np.arange(len(part)), np.arange(a, a + len(part))] = -np.inf
        m = min(CANDIDATES, n - 1)
        if m <= 0:
            lists += [[]] * len(part)
            continue
        near = np.argpartition(-sim, m - 1, axis=1)[:, :m]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sim, near, 1), axis=1), 1)
        kept = _prune(x, part, near)
        lists += [ids[r[r >= 0]].tolist() for r in kept]
    return pa.table({"id": pa.array(ids), "near": pa.array(lists, pa.list_(pa.int64())), "owner": pa.array(owner, pa.string())})


def _entries(graph: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The medoid of every part of the graph that holds together."""
    n = len(graph)
    name = np.arange(n)
    row, column = np.nonzero(graph >= 0)
    to = graph[row, column]
    while True:
        low = name.copy()
        np.minimum.at(low, row, name[to])
        np.minimum.at(low, to, name[row])
        low = low[low]
        if (low == name).all():
            break
        name = low
    out = []
    for part in np.unique(name):
        inside = np.flatnonzero(name == part)
        out.append(inside[(x[inside] @ x[inside].mean(axis=0)).argmax()])
    return np.array(out)


def _search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, threshold: float) -> np.ndarray:
    """Cosines of all nodes visited by each query; minus infinity elsewhere."""
    n, q = len(x), len(queries)
    sim, expanded = np.full((q, n), -np.inf), np.zeros((q, n), bool)
    target = x[queries]
    sim[:, entries] = target @ x[entries].T
    sim[np.arange(q), queries] = 1.0  # a query is a node of the graph: its own lists are a way in beside the medoids

    def expand(chosen: np.ndarray) -> None:
        expanded[chosen] = True
        who, node = np.nonzero(chosen)
        to = graph[node]
        ok = to >= 0
        wanted = np.zeros((q, n), bool)
        wanted[np.broadcast_to(who[:, None], to.shape)[ok], to[ok]] = True
        wanted &= sim == -np.inf
        a, b = np.nonzero(wanted)
        for i in range(0, len(a), 1 << 15):
            s = slice(i, i + (1 << 15))
            sim[a[s], b[s]] = np.einsum("nd,nd->n", target[a[s]], x[b[s]])

    width = min(BEAM, n)
    while True:  # greedy: the best of the beam that are not yet expanded
        top = np.argpartition(-sim, width - 1, axis=1)[:, :width]
        chosen = np.zeros((q, n), bool)
        np.put_along_axis(chosen, top, True, axis=1)
        chosen &= ~expanded & (sim > -np.inf)
        if not chosen.any():
            break
        expand(chosen)
    while True:  # expansion over the range
        chosen = (sim >= threshold - SLACK) & ~expanded
        if not chosen.any():
            return sim
        expand(chosen)


FOUND = "a long, b long, links long"


def _merge(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Roots after the links ``(u, v)``; a root is the smallest index of its class."""
    while True:
        a, b = root[u], root[v]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _found(ids: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.Table:
    """Counts as rows ``(id, null, count)``, classes as rows ``(id, smallest of its class, null)``; ids are sorted."""
    some, moved = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(ids)))
    a = pa.array(np.concatenate([ids[some], ids[moved]]))
    b = pa.array(np.concatenate([ids[some], ids[root[moved]]]), mask=np.arange(len(a)) < len(some))
    return pa.table({"a": a, "b": b, "links": pa.array(np.concatenate([links[some], moved]), mask=np.arange(len(a)) >= len(some))})


def _search_shard(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table, cell = table.sort_by("id"), key[0].as_py()
        ids, x = np.asarray(table["id"].to_numpy()), _unit(table["vec"])
        n, home = np.asarray(table["n"].to_numpy()), np.asarray(table["home"].to_numpy(), bool)
        ours = home | np.array([o > cell for o in table["owner"].to_pylist()], bool)  # pairs with these are counted here
        size = len(ids)
        near = table["near"].combine_chunks()
        of = np.repeat(np.arange(size), np.asarray(near.value_lengths().to_numpy(zero_copy_only=False), np.int64))
        to = np.asarray(near.flatten().to_numpy(zero_copy_only=False), np.int64)
        at = np.minimum(np.searchsorted(ids, to), size - 1)
        of, to = of[ids[at] == to], at[ids[at] == to]  # lists from other shards also name nodes that are not here
        edge = np.unique(np.concatenate([of * size + to, to * size + of]))  # walked both ways
        of, to = edge // size, edge % size
        degree = np.bincount(of, minlength=size)
        graph = np.full((size, max(1, int(degree.max()))), -1, np.int64)
        graph[of, np.arange(len(of)) - (np.cumsum(degree) - degree)[of]] = to
        entries = _entries(graph, x)
        codes = [np.zeros(0, np.int64)]
        queries = np.flatnonzero(home)
        for s in range(0, len(queries), 256):
            part = queries[s : s + 256]
            row, node = np.nonzero((_search(x, graph, entries, part, threshold) >= threshold) & ours)
            u, v = np.minimum(part[row], node), np.maximum(part[row], node)
            codes.append(np.unique((u * size + v)[u < v]))
        pair = np.unique(np.concatenate(codes))  # a pair of this home is often found from both ends
        u, v = pair // size, pair % size
        links = np.where(home, n - 1, 0) + np.bincount(u, n[v], size).astype(np.int64) + np.bincount(v, n[u], size).astype(np.int64)
        return _found(ids, links, _merge(np.arange(size), u, v))

    return run


def _compare_blocks(threshold: float):
    """Counts between two blocks, or within one whose rows come as ``both``."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, x, n = np.asarray(table["id"].to_numpy()), _unit(table["vec"]), np.asarray(table["n"].to_numpy())
        home, side = np.asarray(table["home"].to_numpy(), bool), np.array(table["side"].to_pylist())
        left, right = np.flatnonzero(side != "right"), np.flatnonzero(side != "left")
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for s in range(0, len(left), 256):
            part = left[s : s + 256]
            hit = (x[part] @ x[right].T >= threshold) & (home[part][:, None] | home[right])
            hit &= (side[part] != "both")[:, None] | (part[:, None] < right)
            links[part] += hit @ n[right]
            links[right] += n[part] @ hit
            row, column = np.nonzero(hit)
            root = _merge(root, part[row], right[column])
        return _found(ids, links, root)

    return run


def _dense(members: DataFrame, threshold: float, reach: float) -> DataFrame:
    """What :func:`_search_shard` returns, for cells that do not come apart; members have an ``owner``.

    Members within half the reach of the centroid, the core, all link with each other: their counts are sums over the
    cell.  The rest is cut into blocks, which are compared with each other and with those of the core.
    """
    members = materialise(members.where(F.col("home") | (F.col("owner") > F.col("cell"))).withColumn("core", F.col("off") <= reach / 2 - 1e-6), "dense")
    w = lambda c: F.coalesce(F.sum(F.when(F.col("core") & c, F.col("n"))), F.lit(0))
    count = lambda c: F.ceil(F.count_if(c) / BLOCK).cast("int")
    cells = members.groupBy("cell").agg(w(F.col("home")).alias("own"), w(~F.col("home")).alias("others"), F.min(F.when(F.col("core"), F.col("id"))).alias("first"), count(~F.col("core")).alias("loose"), count(F.col("core")).alias("tight"), F.count("*").alias("rows"))
    rows = heavy_join(members, materialise(cells, "cells"), ["cell"], "rows")
    core = rows.where("core")
    links = F.when(F.col("home"), F.col("own") + F.col("others") - 1).otherwise(F.col("own"))
    out = core.select(F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), links.alias("links"))
    out = out.unionByName(core.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"), F.lit(None).cast("long").alias("links")))
    loose = rows.where("not core").withColumn("block", F.pmod(F.xxhash64("id"), F.col("loose")).cast("int"))
    out = out.unionByName(loose.where("home and n > 1").select(F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), (F.col("n") - 1).alias("links")))
    side = F.when(F.col("i") == F.col("j"), "both").when(F.col("i") == F.col("block"), "left").otherwise("right")
    place = ["cell", "kind", "i", "j", "id", "home", "n", "vec"]
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    pairs = loose.withColumn("other", upto("loose")).withColumns({"kind": F.lit(0), "i": F.least("block", "other"), "j": F.greatest("block", "other")}).select(*place, side.alias("side"))
    to_core = loose.where("tight > 0").withColumns({"kind": F.lit(1), "i": F.col("block"), "j": upto("tight")}).select(*place, F.lit("left").alias("side"))
    tight = core.where("loose > 0").withColumns({"kind": F.lit(1), "i": upto("loose"), "j": F.pmod(F.xxhash64("id"), F.col("tight")).cast("int")}).select(*place, F.lit("right").alias("side"))
    blocks = pairs.unionByName(to_core).unionByName(tight)
    return out.unionByName(blocks.groupBy("cell", "kind", "i", "j").applyInArrow(_compare_blocks(threshold), FOUND))


def link_vectors(rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Return ``id_col, n_links, component_id, kept`` for every row."""
    reach = math.sqrt(2 - 2 * threshold)
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    base = base.withColumn("usable", F.col("label").isNotNull() & usable(F.col("vec")))
    base = materialise(base.withColumns({"v1": F.xxhash64("label", "vec"), "v2": F.xxhash64(F.lit(1), "vec", "label")}), "vectors")
    same = ["v1", "v2"]
    nodes = base.where("usable").groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    nodes = materialise(nodes.where("id is not null"), "nodes")
    members, dense = shards(nodes.select("id", "label", "n", "vec"), reach)
    lists = members.groupBy("cell").applyInArrow(_build, "id long, near array<long>, owner string")
    lists = lists.unionByName(dense.where("home").select("id", F.array().cast("array<long>").alias("near"), F.col("cell").alias("owner")))
    graph = materialise(lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.max("owner").alias("owner")), "graph")
    found = members.join(graph, "id").select("cell", "id", "home", "n", "vec", "near", "owner").groupBy("cell").applyInArrow(_search_shard(threshold), FOUND)
    found = found.unionByName(_dense(dense.join(graph.select("id", "owner"), "id"), threshold, reach))
    found = materialise(found, "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("n_links"))
    classes = materialise(connected_components(found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v"))), "classes")
    named = nodes.select(*same, "id", "n").join(counts, "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left")
    named = materialise(named.select(*same, "n", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component")), "named")
    out = heavy_join(base.where("usable"), named, same, "n", "left").select("id", "n_links", "component")
    out = out.unionByName(base.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component")))
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def audit(rows: DataFrame, result: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[int, int]:
    """Links reported and links there are, for ids divisible by 100 against all rows, compared in blocks by SQL."""
    base = rows.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vec")).where(F.col("label").isNotNull() & usable(F.col("vec")))
    most = F.array_max(F.transform("vec", F.abs))  # keeps squares of very large or small components in range
    base = base.select("id", "label", F.transform("vec", lambda x: x / most).alias("vec"))
    size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    unit = base.select("id", "label", F.transform("vec", lambda x: x / size).alias("vec"))
    asked = unit.where("id % 100 = 0").select(F.col("id").alias("q"), "label", F.col("vec").alias("qv"))
    dot = F.aggregate(F.zip_with("vec", "qv", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    there = asked.join(unit, "label").where((F.col("q") != F.col("id")) & (F.size("vec") == F.size("qv")) & (dot >= threshold)).count()
    told = result.join(asked.select(F.col("q").alias(id_col)), id_col).agg(F.coalesce(F.sum("n_links"), F.lit(0))).first()[0]
    return told, there
