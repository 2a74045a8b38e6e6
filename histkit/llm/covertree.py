"""Embedding near-dedup: exact cosine links by dual traversal of cover trees.

The vectors of a label go to the nearest of its routing centres, the top level of the search: two
cells are brought together only if their centres and radii allow a link. A cell is cut into blocks of bounded size and
each block gets a cover tree: nested levels whose radii halve, every node with the largest distance to a descendant. For
each pair of blocks in reach the two trees are walked together. With d the distance
of two nodes' centres and r, s their radii, a pair is dropped if d - r - s is beyond the
threshold, linked as a whole if d + r + s is within it, and opened otherwise. Undecided pairs
of points are decided by their cosine. Distances are between unit vectors in double
precision: a cosine of c is a distance of sqrt(2 - 2c).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import bounded_batches, store
from histkit.llm.graph import components, local_components

BLOCK = 2048
#: Routing centres of all labels together, at most, and vectors that are compared with them at once.
CENTRES = 4096
#: Vectors drawn for each of them.
SAMPLED = 4
ROUTED = 512
#: Bounds closer to the threshold than this are not trusted: the pair is opened or compared.
MARGIN = 1e-6


def usable(vector: Column) -> Column:
    """Neither null nor empty, all components finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


class CoverTree:
    """Nodes in arrays: centre (a position), radius, span of positions, span of children."""

    def __init__(self, vectors: np.ndarray):
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        self.order = np.arange(len(unit))
        nodes: list[list[float]] = []  # centre, radius, begin, end, first child, children
        cells = [(np.arange(len(unit)), 0, 2.0)]  # points with the centre first, node's begin, covering radius
        order = self.order
        nodes.append([0, 0.0, 0, len(unit), 0, 0])
        at = 0
        while at < len(cells):
            points, begin, cover = cells[at]
            away = np.sqrt(np.maximum(0.0, ((unit[points] - unit[points[0]]) ** 2).sum(axis=1)))
            node = nodes[at]
            node[1] = away.max()
            if node[1] > 0:
                while cover / 2 >= node[1]:  # levels that would hold this node alone
                    cover /= 2
                node[4], rest, children, start = len(nodes), points, 0, begin
                while len(rest):
                    near = away if not children else np.sqrt(((unit[rest] - unit[rest[0]]) ** 2).sum(axis=1))
                    inside = near <= cover / 2
                    own, rest = rest[inside], rest[~inside]
                    nodes.append([start, 0.0, start, start + len(own), 0, 0])
                    cells.append((own, start, cover / 2))
                    start, children = start + len(own), children + 1
                node[5] = children
            else:
                order[begin : begin + len(points)] = points
            at += 1
        table = np.array(nodes)
        self.radius = table[:, 1]
        self.begin, self.end, self.child, self.children = (table[:, k].astype(np.int64) for k in (2, 3, 4, 5))
        self.points = unit[order]
        self.vectors = vectors[order]

    @property
    def centres(self) -> np.ndarray:
        """Positions of the nodes' centres: the first point of each node's span."""
        return self.begin


def _expand(tree, other, p, q, same):
    """Open both nodes of each pair (a childless node stays)."""
    if not len(p):
        return p, q
    n_p, n_q = np.maximum(1, tree.children[p]), np.maximum(1, other.children[q])
    size = n_p * n_q
    pair = np.repeat(np.arange(len(p)), size)
    k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    x = np.where(tree.children[p[pair]] > 0, tree.child[p[pair]] + k // n_q[pair], p[pair])
    y = np.where(other.children[q[pair]] > 0, other.child[q[pair]] + k % n_q[pair], q[pair])
    keep = (p[pair] != q[pair]) | (x <= y) if same else slice(None)
    return x[keep], y[keep]


def _distinct(nodes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes, and each one's place among them."""
    place = np.zeros(n, np.int64)
    place[nodes] = 1
    distinct = np.flatnonzero(place)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[nodes]


def dual_links(a: CoverTree, b: CoverTree, least: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of each point of a and b (by position), and a spanning forest (i, j) of the links;
    b's positions follow a's unless the trees are the same."""
    limit = math.sqrt(max(0.0, 2 - 2 * least))
    n, m = len(a.points), len(b.points)
    shift = 0 if same else n
    gain_a, gain_b = np.zeros(n + 1, np.int64), np.zeros(m + 1, np.int64)
    left, right = [], []

    def linked(p, q):
        """All points of p with all of q; p = q stands for all pairs within the node."""
        size_p, size_q = a.end[p] - a.begin[p], b.end[q] - b.begin[q]
        own = (p == q) & same
        np.add.at(gain_a, a.begin[p], size_q - own)
        np.add.at(gain_a, a.end[p], own - size_q)
        gain, x, y, n_x = (gain_a, a.begin[p], b.begin[q], size_p) if same else (gain_b, a.begin[p], b.begin[q], size_p)
        if same:
            x, y, n_x, q_ = x[~own], y[~own], n_x[~own], q[~own]
        else:
            q_ = q
        np.add.at(gain, b.begin[q_], n_x)
        np.add.at(gain, b.end[q_], -n_x)
        for begin, size, to in ((a.begin[p], size_p, b.begin[q] + shift), (b.begin[q] + shift, size_q, a.begin[p])):
            left.append(np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
            right.append(np.repeat(to, size))

    p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(p):
        rows, of_row = _distinct(p, len(a.radius))
        cols, of_col = _distinct(q, len(b.radius))
        cos = (a.points[a.centres[rows]] @ b.points[b.centres[cols]].T)[of_row, of_col]
        d = np.sqrt(np.maximum(0.0, 2 - 2 * cos))
        d[(p == q) & same] = 0.0
        reach = a.radius[p] + b.radius[q]
        near = d - reach <= limit + MARGIN
        whole = near & (d + reach < limit - MARGIN)
        if whole.any():
            linked(p[whole], q[whole])
        open_ = near & ~whole
        single = open_ & (a.children[p] == 0) & (b.children[q] == 0)
        if single.any():
            x, y = p[single], q[single]
            u, v = a.vectors[a.centres[x]], b.vectors[b.centres[y]]
            cosine = (u * v).sum(axis=1) / (np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))
            yes = (cosine >= least) | ((x == y) & same)
            linked(x[yes], y[yes])
        open_ &= ~single
        p, q = _expand(a, b, p[open_], q[open_], same)
    total = n if same else n + m
    if left:
        root = local_components(np.concatenate(left), np.concatenate(right), total)
        i = np.nonzero(root != np.arange(total))[0]
        j = root[i]
    else:
        i = j = np.zeros(0, np.int64)
    return np.cumsum(gain_a)[:-1], np.cumsum(gain_b)[:-1], i, j


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Scaled by their largest component first, so extreme components neither overflow nor vanish."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))


def routing_centres(rows: DataFrame, block: int, most: int) -> dict[tuple[str, int], np.ndarray]:
    """Unit vectors that stand for the regions of labels with more than one block: of a sample in the order
    of a hash, those farthest from each other, about one per block and at most ``most`` of them at any size."""
    sizes = rows.groupBy("label_key", "dims").agg(F.ceil(F.count("*") / block).alias("blocks")).where("blocks > 1")
    wanted = min(most, sizes.agg(F.sum("blocks")).first()[0] or 0)
    if not wanted:
        return {}
    large = rows.join(sizes.select("label_key", "dims"), ["label_key", "dims"], "left_semi")
    drawn = large.orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLED * wanted).select("label_key", "dims", "embedding").collect()
    found: dict[tuple[str, int], list] = {}
    for r in drawn:
        found.setdefault((r.label_key, r.dims), []).append(r.embedding)
    return {k: farthest_first(unit_vectors(np.array(v, float)), -(-len(v) // SAMPLED)) for k, v in found.items()}


def farthest_first(unit: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the vectors: the first, then always the one farthest from all before."""
    chosen, away = [0], np.sqrt(((unit - unit[0]) ** 2).sum(axis=1))
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.sqrt(((unit - unit[chosen[-1]]) ** 2).sum(axis=1)))
    return unit[chosen]


def routed(rows: DataFrame, centres: dict[tuple[str, int], np.ndarray]) -> DataFrame:
    """``rows`` with the cell of each vector (its nearest centre) and its distance there; labels without
    centres have one cell, as wide as the sphere."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(zip(batch.column("label_key").to_pylist(), batch.column("dims").to_pylist()))
            cell, far = np.zeros(len(names), np.int32), np.full(len(names), 2.0)
            column = batch.column("embedding")
            for name in {n for n in names if n in shared.value}:
                at = np.array([k for k, n in enumerate(names) if n == name])
                own = shared.value[name]
                for start in range(0, len(at), ROUTED):
                    some = at[start : start + ROUTED]
                    unit = unit_vectors(_matrix(column.take(pa.array(some)), name[1]))
                    cosine = unit @ own.T
                    cell[some] = cosine.argmax(axis=1)
                    far[some] = np.sqrt(((unit - own[cell[some]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return rows.mapInArrow(route, "uid long, vec_id long, label_key string, dims int, embedding array<double>, cell int, far double")


def cells_in_reach(cells: DataFrame, centres: dict[tuple[str, int], np.ndarray], least: float) -> DataFrame:
    """Pairs (x_cell <= y_cell) of a label's cells that may hold a link: with d the distance of their
    centres and r, s their radii, those with d - r - s within the threshold."""
    limit = math.sqrt(max(0.0, 2 - 2 * least))
    reach: dict[tuple[str, int], np.ndarray] = {k: np.full(len(c), -np.inf) for k, c in centres.items()}
    for r in cells.where("several").select("label_key", "dims", "cell", "radius").collect():  # at most one row per centre
        reach[r.label_key, r.dims][r.cell] = r.radius
    shared = cells.sparkSession.sparkContext.broadcast((centres, reach))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, radii = shared.value
        for batch in batches:
            label, dims, x, y = [], [], [], []
            for name, size, cell in zip(*(batch.column(k).to_pylist() for k in range(3))):
                others = [cell]
                if (name, size) in known:
                    own, r = known[name, size], radii[name, size]
                    d = np.sqrt(((own - own[cell]) ** 2).sum(axis=1))
                    others = np.flatnonzero((d - r - r[cell] <= limit + MARGIN) & (np.arange(len(own)) >= cell)).tolist()
                label += [name] * len(others)
                dims += [size] * len(others)
                x += [cell] * len(others)
                y += others
            types = (pa.string(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((label, dims, x, y), types)], names=["label_key", "dims", "x_cell", "y_cell"])

    return cells.select("label_key", "dims", "cell").mapInArrow(near, "label_key string, dims int, x_cell int, y_cell int")


def near_embeddings(vectors: DataFrame, least: float = 0.98, block: int = BLOCK, most_centres: int = CENTRES) -> DataFrame:
    """One row per vector (vec_id, embedding, label): n_links, component_id and kept.

    Only vectors of one label and length are compared. Null labels, null or empty vectors,
    zero vectors and those with null or non-finite components link with nothing. Repeated
    rows are vectors of their own and link with each other, and an empty table gives no rows. The vectors of a
    large label go to the nearest of a bounded number of centres, cells of more than a block are cut by a hash, and
    pairs of cells that are too far apart for a link are never brought together.
    """
    bounded_batches(vectors)
    vector = F.col("embedding").cast("array<double>")
    valid = F.col("label").isNotNull() & usable(vector)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(valid, F.col("label").cast("string")).alias("label_key"),
        F.when(valid, F.size(vector)).otherwise(0).cast("int").alias("dims"),
        F.when(valid, vector).alias("embedding"),
    )
    centres = routing_centres(rows.where("label_key is not null"), block, most_centres)
    rows = store(routed(rows, centres), "vectors")
    placed = rows.where("label_key is not null")
    several = F.concat("label_key", F.lit("/"), F.col("dims").cast("string")).isin([f"{label}/{dims}" for label, dims in centres])
    cells = placed.groupBy("label_key", "dims", "cell").agg(F.ceil(F.count("*") / block).cast("long").alias("chunks"), F.max("far").alias("radius"))
    cells = store(cells.withColumn("several", several), "vector-cells")
    number = lambda cell, chunk: (F.col(cell).cast("long") * (1 << 32) + F.col(chunk)).alias("block")
    dealt = placed.join(cells.select("label_key", "dims", "cell", "chunks"), ["label_key", "dims", "cell"])
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks"))).withColumn("block", number("cell", "chunk"))
    schema = "label_key string, dims int, block long, uids binary, vectors binary"

    def gather(key: tuple, group: pa.Table) -> pa.Table:
        points = _matrix(group.column("embedding"), key[1].as_py())
        uids = group.column("uid").to_numpy()
        order = np.argsort(uids)
        return pa.table({"label_key": [key[0].as_py()], "dims": pa.array([key[1].as_py()], pa.int32()), "block": [key[2].as_py()], "uids": [uids[order].tobytes()], "vectors": [points[order].tobytes()]})

    blocks = store(dealt.select("label_key", "dims", "block", "uid", "embedding").groupBy("label_key", "dims", "block").applyInArrow(gather, schema), "vector-blocks")
    cut = cells.select("label_key", "dims", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    numbered = cut.select("label_key", "dims", "cell", number("cell", "chunk"))
    pairs = cells_in_reach(cells, centres, least)
    for side in ("x", "y"):
        pairs = pairs.join(numbered.withColumnsRenamed({"cell": f"{side}_cell", "block": side}), ["label_key", "dims", f"{side}_cell"])
    pairs = pairs.where("x <= y").select("label_key", "dims", "x", "y")
    for side in ("x", "y"):
        payload = blocks.select("label_key", "dims", F.col("block").alias(side), F.col("uids").alias(f"{side}_uids"), F.col("vectors").alias(f"{side}_vectors"))
        pairs = pairs.join(payload, ["label_key", "dims", side])
    pairs = pairs.select("label_key", "x", "y", "dims", "x_uids", "x_vectors", "y_uids", "y_vectors")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, CoverTree] = {}

        def tree(name: tuple, payload: bytes, dims: int) -> CoverTree:
            if name not in known:
                if len(known) > 3:
                    known.clear()
                known[name] = CoverTree(np.frombuffer(payload).reshape(-1, dims))
            return known[name]

        for batch in batches:
            for row in batch.to_pylist():
                same = row["x"] == row["y"]
                a = tree((row["label_key"], row["dims"], row["x"]), row["x_vectors"], row["dims"])
                b = a if same else tree((row["label_key"], row["dims"], row["y"]), row["y_vectors"], row["dims"])
                ids = [np.frombuffer(row[f"{s}_uids"], np.int64)[t.order] for s, t in (("x", a), ("y", b))]
                of_a, of_b, i, j = dual_links(a, b, least, same)
                nodes = ids[0] if same else np.concatenate(ids)
                n = of_a + of_b if same else np.concatenate([of_a, of_b])
                some = n > 0
                none = pa.nulls(int(some.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), none, pa.array(n[some])], names=["a", "b", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j]), pa.nulls(len(i), pa.int64())], names=["a", "b", "n"])

    found = store(pairs.mapInArrow(compare, "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("n_links"))
    roots = components(found.where("b is not null").select("a", "b"))
    own = rows.select("uid", "vec_id")
    members = own.join(roots, F.col("uid") == F.col("node")).select("uid", "vec_id", "root")
    least_id = members.groupBy("root").agg(F.min("vec_id").alias("least_id"))
    named = members.join(least_id, "root").select(F.col("uid").alias("member"), "least_id")
    out = own.join(counts, F.col("uid") == F.col("counted"), "left").join(named, F.col("uid") == F.col("member"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("least_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
