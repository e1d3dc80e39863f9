"""Near-duplicate embeddings by NN-descent.

Vectors with the same label and length are linked when their cosine, in double
precision, is at least the threshold (0.93).

1. Equal vectors are collapsed to one node with a weight.
2. First lists: the nodes are sorted several times by random sign keys; each
   run of ``BLOCK`` neighbours in such an order is compared, and a node keeps
   its ``K`` best.
3. Refinement: for every node, its neighbours and the nodes that list it are
   compared with each other (in blocks of bounded size), so that neighbours of
   neighbours enter the lists; repeated while new links appear.
4. Saturated lists: a node all of whose ``K`` neighbours are links may have
   more. Links between two saturated nodes are counted exactly, cell against
   cell in numpy, without emitting their pairs: cells are parts of a component,
   and only pairs of cells whose centers and radii rule out a link are left out.
   Components that such links join become one.
5. Audit: exact links of sampled nodes against all nodes; the sample grows
   until it has seen ``AUDIT_LINKS`` links, holds ``AUDIT_MOST`` nodes, or is
   the whole table. Below ``RECALL``, more sort orders and rounds follow.
6. If recall stays below ``RECALL``, or links are so rare that the audit has
   seen too few of them, all pairs are compared block against block.

The number of sort orders grows with the largest label: an isolated pair at the
threshold meets in one order with about ``bit ** log2(n / BLOCK)``, ``bit``
being the chance that a random sign agrees, and orders are made until such a
pair is missed by all of them with at most ``1 - RECALL``.

Edges below the threshold are dropped at the end; kept edges are exact.

Defined results: vectors that are null, empty, all zero or hold null, NaN or
infinite components, and rows without a label or id, link with nothing: 0
links, their own component. Rows that repeat a ``vec_id`` are one vector (the
smallest by label and components) and get the same result each. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .components import components
from .kernels import key_runs, mix

THRESHOLD = 0.93
K = 10
BLOCK = 64
TABLES = 8
ROUNDS = 4
DENSE_BLOCK = 512
AUDIT, AUDIT_MOST, AUDIT_LINKS = 256, 16384, 1000
MORE = 4
EXACT_BLOCK = 2048
RECALL = 0.995
EDGE_SCHEMA = "u long, v long, cos double"


def _unit(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _edges(u: np.ndarray, v: np.ndarray, cos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(cos, pa.float64())], ["u", "v", "cos"])


def _best(node: np.ndarray, gram: np.ndarray, k: int, threshold: float, floor: np.ndarray | None = None) -> tuple:
    """For each row of a block: its k best others, and its smallest link."""
    n = len(node)
    np.fill_diagonal(gram, -2)
    k = min(k, n - 1)
    top = np.argpartition(gram, n - k, axis=1)[:, n - k :]
    u = np.repeat(np.arange(n), k)
    v = top.ravel()
    value = gram[u, v]
    keep = value > (floor[u] if floor is not None else -1.5)
    link = np.where(gram >= threshold, node[None, :], np.iinfo(np.int64).max)
    least = link.argmin(axis=1)
    linked = gram[np.arange(n), least] >= threshold
    u = np.concatenate([u[keep], np.flatnonzero(linked)])
    v = np.concatenate([v[keep], least[linked]])
    return node[u], node[v], gram[u, v]


def _sign_keys(first: int, tables: int, dim_seed: int = 7):
    """(table, domain, key, node, vector) for each sort order of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.diff(batch.column("vec").offsets.to_numpy())
            for d in np.unique(lengths).tolist():
                rows = batch.take(pa.array(np.flatnonzero(lengths == d)))
                if d not in planes:
                    cell = np.arange(32 * tables * d, dtype=np.uint64) + np.uint64((dim_seed + first) << 40)
                    u = (mix(cell) >> np.uint64(11)).astype(np.float64) / (1 << 53)
                    w = (mix(cell + np.uint64(1 << 39)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
                    planes[d] = (np.sqrt(-2 * np.log(u + 1e-18)) * np.cos(2 * np.pi * w)).reshape(d, tables, 32)
                x = _unit(rows.column("vec"))
                bits = np.einsum("nd,dtk->ntk", x, planes[d], optimize=True) > 0
                keys = bits.astype(np.int64) @ (1 << np.arange(31, -1, -1, dtype=np.int64))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(rows.num_rows, first + t, np.int32)), rows.column("domain"), pa.array(keys[:, t]), rows.column("node"), rows.column("vec")],
                        ["order", "domain", "key", "node", "vec"],
                    )

    return run


def _comparekey_runs(k: int, threshold: float):
    """Blocks of BLOCK consecutive rows of one order and domain, each starting
    half-way through the one before."""

    def compare(rows: pa.Table) -> pa.RecordBatch:
        x = _unit(rows.column("vec"))
        return _edges(*_best(rows.column("node").to_numpy(), x @ x.T, k, threshold))

    def blocks(rows: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
        """Full blocks, and the rows that the next block starts with."""
        out, at = [], 0
        while rows.num_rows - at >= BLOCK:
            out.append(rows.slice(at, BLOCK))
            at += BLOCK // 2
        rest = rows.slice(at)
        if last and rest.num_rows > (BLOCK // 2 if out else 1):
            out.append(rest)
        return out, rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for part in key_runs(iter([batch]), ["order", "domain"]):
                now = (part.column("order")[0].as_py(), part.column("domain")[0].as_py())
                if held is not None and now != key:
                    yield from map(compare, blocks(held, True)[0])
                    held = None
                held = part if held is None else pa.concat_tables([held, part])
                key = now
                full, held = blocks(held, False)
                yield from map(compare, full)
        if held is not None:
            yield from map(compare, blocks(held, True)[0])

    return run


def _first_lists(nodes: DataFrame, first: int, tables: int, threshold: float) -> DataFrame:
    schema = "order int, domain string, key long, node long, vec " + nodes.schema["vec"].dataType.simpleString()
    keyed = materialise(nodes.select("node", "domain", "vec").mapInArrow(_sign_keys(first, tables), schema), "orders")
    ordered = keyed.repartitionByRange("order", "domain", "key", "node").sortWithinPartitions("order", "domain", "key", "node")
    return ordered.mapInArrow(_comparekey_runs(K, threshold), EDGE_SCHEMA)


def _local_join(threshold: float):
    """Members of one block of a node's neighbourhood, against each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["w", "block"]):
            if rows.num_rows < 2:
                continue
            node = rows.column("node").to_numpy()
            _, one = np.unique(node, return_index=True)
            rows, node = rows.take(pa.array(one)), node[one]
            fresh = rows.column("fresh").to_numpy(zero_copy_only=False)
            if len(node) < 2 or not fresh.any():
                continue
            x = _unit(rows.column("vec"))
            yield _edges(*_best(node, x @ x.T, 4, threshold, rows.column("floor").to_numpy()))

    return run


def _top(edges: DataFrame) -> DataFrame:
    """The K best distinct neighbours of each node. The rank limit is applied
    in every task before the shuffle, so a hub's candidates never meet."""
    each = edges.groupBy("u", "v").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cos"), "v"))
    return each.withColumn("rank", rank).where(F.col("rank") <= K).drop("rank")


def _refine(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Candidate edges among the neighbourhoods of all nodes."""
    floor = graph.groupBy("u").agg(F.when(F.count("*") >= K, F.min("cos")).otherwise(F.lit(-2.0)).alias("floor"))
    state = nodes.select("node", "vec").join(floor.withColumnRenamed("u", "node"), "node")
    member = graph.select(F.col("u").alias("w"), F.col("v").alias("node"), "fresh").unionByName(
        graph.select(F.col("v").alias("w"), F.col("u").alias("node"), "fresh")
    )
    # neighbourhoods above BLOCK members are dealt to blocks by hash
    size = member.groupBy("w").agg(F.count("*").alias("n"), F.max("fresh").alias("any")).where("any").drop("any")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK // 2)).cast("long")
    dealt = member.join(size, "w").select("w", "node", "fresh", F.pmod(F.xxhash64("node", "w"), blocks).alias("block"))
    with_vec = dealt.join(state, "node").select("w", "block", "node", "fresh", "floor", "vec")
    grouped = with_vec.repartition("w", "block").sortWithinPartitions("w", "block")
    return grouped.mapInArrow(_local_join(threshold), EDGE_SCHEMA)


def sort_orders(n: int, threshold: float) -> int:
    """Sort orders for a label of n nodes, a multiple of ``TABLES``."""
    bit = 1 - np.arccos(threshold) / np.pi
    meet = bit ** np.log2(max(n, 2 * BLOCK) / BLOCK)
    return TABLES * int(np.ceil(np.log(1 - RECALL) / np.log(1 - meet) / TABLES))


def _audit(nodes: DataFrame, graph: DataFrame, threshold: float, n_nodes: int) -> tuple[float, bool]:
    """(recall, enough): the share of the exact links of sampled nodes that
    lists hold from either side, and whether enough links or all nodes were
    looked at; all links between two saturated nodes are counted later, so only
    links with an unsaturated side are audited."""
    size, full = AUDIT, _saturated(graph, threshold).withColumn("full", F.lit(True))
    marked = nodes.select("node", "domain", "vec").join(full, "node", "left").withColumn("full", F.coalesce("full", F.lit(False)))
    marked = materialise(marked, "marked")
    held = graph.where(F.col("cos") >= threshold)
    held = held.select("u", "v").unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    while True:
        exact = _exact_links(marked, threshold, size)
        row = exact.join(held.withColumn("held", F.lit(1)), ["u", "v"], "left").agg(F.count("*").alias("n"), F.count("held").alias("k")).first()
        enough = row["n"] >= AUDIT_LINKS or size >= n_nodes
        if enough or size >= AUDIT_MOST:
            return (row["k"] / row["n"] if row["n"] else 1.0), enough
        size = min(8 * size, AUDIT_MOST)


def _exact_links(nodes: DataFrame, threshold: float, size: int) -> DataFrame:
    """All links of the ``size`` nodes with the smallest hashes, but for those
    between two nodes marked as ``full``."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(size).toArrow()
    shared = nodes.sparkSession.sparkContext.broadcast(sample)  # at most AUDIT_MOST vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        domain = np.array(queries.column("domain").to_pylist())
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.array(batch.column("domain").to_pylist())
            for d in np.unique(own).tolist():
                q, r = np.flatnonzero(domain == d), np.flatnonzero(own == d)
                rows = batch.take(pa.array(r))
                x, node = _unit(rows.column("vec")) if len(q) else None, rows.column("node").to_numpy()
                full = rows.column("full").to_numpy(zero_copy_only=False)
                for at in range(0, len(q), 1024):
                    some = queries.take(pa.array(q[at : at + 1024]))
                    gram = _unit(some.column("vec")) @ x.T
                    both = some.column("full").to_numpy()[:, None] & full[None, :]
                    i, j = np.nonzero((gram >= threshold) & ~both)
                    a, b = some.column("node").to_numpy()[i], node[j]
                    yield _edges(a[a != b], b[a != b], gram[i, j][a != b])

    return nodes.mapInArrow(run, EDGE_SCHEMA)


def _all_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """Each node's best links (and its smallest) in every block of its domain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["domain", "low", "high"]):
            low, high, side = (rows.column(c).to_numpy() for c in ("low", "high", "own"))
            node, x = rows.column("node").to_numpy(), _unit(rows.column("vec"))
            a, b = np.flatnonzero(side == low[0]), np.flatnonzero(side == high[0])
            if not len(a) or not len(b):
                continue
            hit = x[a] @ x[b].T >= threshold
            linked = np.concatenate([a[hit.any(axis=1)], b[hit.any(axis=0)]]) if low[0] != high[0] else a[hit.sum(axis=1) > 1]
            if len(linked) > 1:
                y = x[linked]
                u, v, cos = _best(node[linked], y @ y.T, K, threshold)
                yield _edges(u[cos >= threshold], v[cos >= threshold], cos[cos >= threshold])

    return _met(nodes.select("node", "domain", "vec"), EXACT_BLOCK, "node").mapInArrow(run, EDGE_SCHEMA)


def _saturated(graph: DataFrame, threshold: float) -> DataFrame:
    return graph.where(F.col("cos") >= threshold).groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= K).select(F.col("u").alias("node"))


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cell a center and the greatest angle of a member to it."""
    for rows in key_runs(batches, ["domain", "cell"]):
        x = _unit(rows.column("vec"))
        center = x.sum(axis=0)
        size = np.sqrt(center @ center)
        center = center / size if size > 1e-9 else x[0]
        radius = np.arccos(np.clip(x @ center, -1, 1)).max()
        columns = [rows.column("domain")[:1].combine_chunks(), rows.column("cell")[:1].combine_chunks(), pa.array([center.tolist()], pa.list_(pa.float64())), pa.array([radius])]
        yield pa.RecordBatch.from_arrays(columns, ["domain", "cell", "vec", "radius"])


def _close_cells(threshold: float):
    """Pairs of cells (a cell with itself included) whose members may be linked:
    the angle of the centers is at most both radii and the threshold's angle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["domain", "low", "high"]):
            low, high, side = (rows.column(c).to_numpy() for c in ("low", "high", "own"))
            cell, radius, x = rows.column("cell").to_numpy(), rows.column("radius").to_numpy(), _unit(rows.column("vec"))
            a, b = np.flatnonzero(side == low[0]), np.flatnonzero(side == high[0])
            angle = np.arccos(np.clip(x[a] @ x[b].T, -1, 1)) if len(a) and len(b) else np.zeros((len(a), len(b)))
            near = angle <= radius[a][:, None] + radius[b][None, :] + np.arccos(threshold) + 1e-6
            near |= cell[a][:, None] == cell[b][None, :]
            i, j = np.nonzero(near)
            one, two = cell[a][i], cell[b][j]
            keep = one <= two if low[0] == high[0] else np.ones(len(one), bool)
            one, two = np.minimum(one, two)[keep], np.maximum(one, two)[keep]
            domain = pa.array([rows.column("domain")[0].as_py()] * len(one), pa.string())
            yield pa.RecordBatch.from_arrays([domain, pa.array(one), pa.array(two)], ["domain", "low", "high"])

    return run


def _count_block(threshold: float):
    """Links between two cells (or within one): for each node the weight of its
    links; for two cells, one of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["domain", "low", "high"]):
            low, high, side = (rows.column(c).to_numpy() for c in ("low", "high", "own"))
            node, weight, x = rows.column("node").to_numpy(), rows.column("weight").to_numpy(), _unit(rows.column("vec"))
            a, b = np.flatnonzero(side == low[0]), np.flatnonzero(side == high[0])
            pairs = [(a, a)] if low[0] == high[0] else [(a, b), (b, a)]
            for p, q in pairs:
                if not len(p) or not len(q):
                    continue
                hit = (x[p] @ x[q].T >= threshold) & (node[p][:, None] != node[q][None, :])
                some = hit.any(axis=1)
                if not some.any():
                    continue
                n = hit @ weight[q]
                bridge = np.zeros(int(some.sum()), np.int64)
                bridge[0] = node[q][hit[some][0].argmax()]
                none = np.arange(len(bridge)) > 0 if low[0] != high[0] else np.ones(len(bridge), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[p][some]), pa.array(n[some].astype(np.int64)), pa.array(bridge, mask=none)], ["node", "n_links", "bridge"]
                )

    return run


def _met(rows: DataFrame, size: int, by: str) -> DataFrame:
    """``rows`` dealt by hash to blocks of about ``size`` of a domain, each row
    once for every pair of blocks (``low``, ``high``) that its own is part of."""
    blocks = rows.groupBy("domain").agg(F.ceil(F.count("*") / F.lit(size)).cast("long").alias("blocks"))
    dealt = rows.join(blocks, "domain").withColumn("own", F.pmod(F.xxhash64(by), F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other", "blocks")
    return met.repartition("domain", "low", "high").sortWithinPartitions("domain", "low", "high")


def _dense(nodes: DataFrame, full: DataFrame, part: DataFrame, threshold: float) -> DataFrame:
    """``node, n_links, bridge`` (several rows a node) of all links between
    saturated nodes. Each component's nodes are dealt to cells of about
    ``DENSE_BLOCK``; all pairs of cells of a domain, of whatever components, are
    counted unless their centers are too far apart to let any members link."""
    inside = nodes.join(full, "node").join(part, "node")
    size = inside.groupBy("component").agg(F.ceil(F.count("*") / F.lit(DENSE_BLOCK)).cast("long").alias("blocks"))
    cell = F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("blocks")))
    inside = materialise(inside.join(size, "component").select("domain", cell.alias("cell"), "node", "weight", "vec"), "saturated")
    sorted_ = inside.select("domain", "cell", "vec").repartition("domain", "cell").sortWithinPartitions("domain", "cell")
    balls = materialise(sorted_.mapInArrow(_balls, "domain string, cell long, vec array<double>, radius double"), "balls")
    pairs = _met(balls, 2 * DENSE_BLOCK, "cell").mapInArrow(_close_cells(threshold), "domain string, low long, high long")
    pairs = materialise(pairs, "cells")
    sides = pairs.withColumn("own", F.col("low")).unionByName(pairs.where("low <> high").withColumn("own", F.col("high")))
    met = sides.join(inside.withColumnRenamed("cell", "own"), ["domain", "own"])
    grouped = met.repartition("domain", "low", "high").sortWithinPartitions("domain", "low", "high")
    return grouped.mapInArrow(_count_block(threshold), "node long, n_links long, bridge long")


def usable(vec: Column) -> Column:
    """Neither null nor empty nor all zero, and every component finite."""
    finite = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def near_vectors(
    table: DataFrame, threshold: float = THRESHOLD, id_: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, DataFrame, float]:
    """(result, links, recall). ``result``: ``vec_id, n_links, component_id``
    per row; ``links``: ``u, v, cos`` edges of the neighbour lists between
    distinct vectors; ``recall``: of the last audit."""
    spark = table.sparkSession
    # a row's vector is its bulk: about 8 MB a batch at 1024 doubles
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    rows = table.select(F.col(id_).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    valid = rows.where(usable(F.col("vec")) & F.col("id").isNotNull() & F.col("label").isNotNull())
    domain = F.concat_ws(":", F.col("label").cast("string"), F.size("vec").cast("string"))
    one = valid.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.*").withColumn("domain", domain)
    keyed = materialise(one.select("id", "domain", "vec", F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(1), "vec").alias("k2")), "vectors")
    same = keyed.groupBy("domain", "k1", "k2").agg(F.min("id").alias("node"), F.count("*").cast("long").alias("weight"))
    member = keyed.select("id", "domain", "k1", "k2").join(same, ["domain", "k1", "k2"]).select("id", "node", "weight")
    member = materialise(member, "members")
    nodes = keyed.join(member.where("id = node").select("node", "weight"), keyed["id"] == F.col("node"))
    nodes = materialise(nodes.select("node", "domain", "vec", "weight"), "nodes")

    row = nodes.groupBy("domain").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n")).first()
    n_nodes, wanted = row["n"] or 0, sort_orders(row["most"] or 0, threshold)
    tables, recall, enough = 0, 0.0, False
    seen = None  # links met on the way, for the components of saturated nodes
    graph = None
    while tables < wanted or (recall < RECALL and tables < MORE * wanted):
        found = materialise(_first_lists(nodes, tables, TABLES, threshold), "first")
        tables += TABLES
        fresh = found.withColumn("fresh", F.lit(True))
        merged = fresh if graph is None else fresh.unionByName(graph.withColumn("fresh", F.lit(False)))
        graph = materialise(_top(merged), "graph")
        star = found.where(F.col("cos") >= threshold)
        seen = star if seen is None else seen.unionByName(star)
        if tables < wanted:
            continue
        for _ in range(ROUNDS):
            before = graph.where(F.col("cos") >= threshold).count()
            found = materialise(_refine(graph, nodes, threshold), "refined")
            seen = seen.unionByName(found.where(F.col("cos") >= threshold))
            old = graph.withColumn("fresh", F.lit(False))
            graph = materialise(_top(old.unionByName(found.withColumn("fresh", F.lit(True)))), "graph")
            if graph.where(F.col("cos") >= threshold).count() == before:
                break
        recall, enough = _audit(nodes, graph, threshold, n_nodes)
    if recall < RECALL or not enough:
        found = materialise(_all_links(nodes, threshold), "all")
        seen = seen.unionByName(found)
        fresh = found.withColumn("fresh", F.lit(True))
        graph = materialise(_top(graph.withColumn("fresh", F.lit(False)).unionByName(fresh)), "graph")
        recall = 1.0  # every pair was compared

    links = graph.where(F.col("cos") >= threshold).select("u", "v", "cos")
    seen = materialise(seen.unionByName(links).select("u", "v").distinct(), "seen")
    full = materialise(_saturated(graph, threshold), "full")
    part = components(seen, "u", "v")
    counted = materialise(_dense(nodes, full, part, threshold), "dense")
    dense = counted.groupBy("node").agg(F.sum("n_links").alias("n_links"))

    # links with an unsaturated side come from the lists, from either side
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = both.join(full.select(F.col("node").alias("u"), F.lit(True).alias("su")), "u", "left")
    both = both.join(full.select(F.col("node").alias("v"), F.lit(True).alias("sv")), "v", "left").where("su IS NULL OR sv IS NULL")
    listed = both.join(nodes.select(F.col("node").alias("v"), "weight"), "v").groupBy("u").agg(F.sum("weight").alias("n_listed"))

    bridges = counted.where("bridge IS NOT NULL").select(F.col("node").alias("u"), F.col("bridge").alias("v"))
    every = seen.unionByName(bridges)
    final = components(every, "u", "v")
    per_node = (
        nodes.select("node")
        .join(listed.withColumnRenamed("u", "node"), "node", "left")
        .join(dense.select("node", "n_links"), "node", "left")
        .join(final, "node", "left")
    )
    placed = member.join(per_node, "node").select(
        "id",
        (F.coalesce("n_listed", F.lit(0)) + F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    result = rows.select("id").join(placed, "id", "left").select(
        F.col("id").alias(id_), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return result, links, recall
