"""Near-duplicate embeddings by a subspace pigeonhole join: every pair of one label with cosine of at least 0.98.

For unit vectors a cosine of c is a squared distance of 2 - 2c. The vectors are rotated at random and cut into `BLOCKS`
blocks of coordinates; of two linked vectors at least one block is within its share of the squared distance, in
proportion to its size. Each block is range-joined under that budget: its space is divided among pivots, a vector has
its home with the nearest one, and it visits every other pivot whose region its range reaches into (the distance to the
dividing plane is at most the range). Linked vectors therefore meet where one is at home and the other visits. What
meets is compared exactly, in double precision over all coordinates; a pair counts in the first of its blocks that is
within budget, so each pair counts once and no pairs need to be gathered or made distinct.

Equal vectors of a label are one node with a count. Regions are dealt into chunks, and every pair of a chunk of homes and
a chunk of visitors is a task's group of bounded size. A group returns the numbers of links and only as many edges as
connect its members; components are found over those.

Pivots are a sample of the vectors whose number grows with the square root of the table's up to `MOST_PIVOTS`; they
decide how well the work is divided and not what is found.

Defined results: rows whose label or vector is NULL, whose vector is empty, zero, or holds NULL or non-finite components
link with nothing and are components of their own. Vectors of different lengths link with nothing. Repeated rows are
vectors of their own that link with each other, and so are different rows with one vec_id: a node is a label and a vector,
never a vec_id. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, slices
from tidemark.llm.graph import connected_components
from tidemark.workspace import materialise

COSINE = 0.98
BLOCKS = 4
MOST_PIVOTS = 2048
CHUNK = 1024
REGION = ["label", "size", "block", "cell"]


def comparable(vector: Column) -> Column:
    """True for vectors that can have a cosine."""
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Rotation:
    """The turn of vectors of one size and the bounds of its blocks."""

    def __init__(self, size: int):
        self.turn = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]
        edges = np.linspace(0, size, min(BLOCKS, size) + 1).astype(int)
        self.blocks = [slice(a, b) for a, b in zip(edges, edges[1:])]
        self.size = size

    def budget(self, block: int, cosine: float) -> float:
        part = self.blocks[block]
        return (2 - 2 * cosine) * (part.stop - part.start) / self.size * (1 + 1e-6) + 1e-9


def nodes(vectors: DataFrame) -> DataFrame:
    """One row per label and distinct comparable vector: a number of its own, its smallest vec_id and its count.

    The numbers are unique, but hold only within one written table.
    """
    rows = vectors.where(F.col("label").isNotNull() & comparable(F.col("embedding")))
    found = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("smallest"), F.count("*").alias("copies"))
    return found.withColumn("node", F.monotonically_increasing_id())


def pivots(found: DataFrame, n: int) -> dict[int, list[list[float]]]:
    """A sample of at most `MOST_PIVOTS` vectors, by vector size."""
    most = min(MOST_PIVOTS, max(16, math.isqrt(4 * n)))
    sample = bounded_sample(found.select("label", "embedding"), F.xxhash64("label", "embedding"), most)
    out: dict[int, list[list[float]]] = {}
    for row in sorted(sample.collect(), key=lambda row: (str(row["label"]), row["embedding"])):
        out.setdefault(len(row["embedding"]), []).append(row["embedding"])
    return out


def regions(found: DataFrame, centres: dict[int, list[list[float]]], cosine: float, wide: bool) -> DataFrame:
    """One row per node and region where it is at home or visits; with the vectors where `wide`."""
    kind = found.schema["embedding"].dataType.simpleString()
    names = ["node", "label", "copies", "embedding", "size", "block", "cell", "home"]

    def run(batches):
        at_centres, rotations = {}, {}
        for batch in slices(batches, 512):
            vectors = batch.column("embedding").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                if size not in rotations:
                    rotations[size] = Rotation(size)
                    centre = unit(centres[size]) if size in centres else np.ones((1, size)) / math.sqrt(size)
                    at_centres[size] = centre @ rotations[size].turn
                rotation, centre = rotations[size], at_centres[size]
                turned = unit([vectors[i] for i in rows]) @ rotation.turn
                for block, part in enumerate(rotation.blocks):
                    x, p = turned[:, part], centre[:, part]
                    far = (x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * (x @ p.T)
                    home = far.argmin(axis=1)
                    apart = np.sqrt(np.maximum(0, (p * p).sum(1)[:, None] + (p * p).sum(1) - 2 * (p @ p.T)))
                    reach = math.sqrt(rotation.budget(block, cosine)) + 1e-6
                    near = far - far[np.arange(len(x)), home][:, None] <= 2 * reach * apart[home] + 1e-9
                    who, cell = np.nonzero(near)
                    who, cell = np.r_[np.arange(len(x)), who], np.r_[home, cell]
                    at_home = np.arange(len(who)) < len(x)
                    taken = pa.array(rows[who])
                    columns = [batch.column(c).take(taken) for c in (names[:4] if wide else names[1:2])]
                    count = len(who)
                    columns += [pa.array(np.full(count, size, np.int32)), pa.array(np.full(count, block, np.int32)),
                                pa.array(cell.astype(np.int32)), pa.array(at_home)]
                    yield pa.RecordBatch.from_arrays(columns, names=(names if wide else names[1:2] + names[4:]))

    label = found.schema["label"].dataType.simpleString()
    schema = f"label {label}, size int, block int, cell int, home boolean"
    if wide:
        schema = f"node long, label {label}, copies long, embedding {kind}, size int, block int, cell int, home boolean"
    return found.select("node", "label", "copies", "embedding").mapInArrow(run, schema)


def _compare(table: pa.Table, cosine: float) -> pa.Table:
    """Links between homes and visitors of one region: the numbers by node, and edges that connect them."""
    size, block = table.column("size")[0].as_py(), table.column("block")[0].as_py()
    rotation = Rotation(size)
    home = table.column("home").to_numpy()
    node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
    x = unit(table.column("embedding").to_pylist())
    turned = x @ rotation.turn
    h, v = np.flatnonzero(home), np.flatnonzero(~home)
    links = np.zeros(len(node), np.int64)
    roots, edges = {}, []

    def root(i):
        while roots.get(i, i) != i:
            i = roots[i]
        return i

    for start in range(0, len(v), 256):
        part = v[start : start + 256]
        a, b = np.nonzero((x[part] @ x[h].T >= cosine) & (node[part][:, None] < node[h]))
        a, b = part[a], h[b]
        apart = turned[a] - turned[b]
        apart *= apart
        within = np.stack([apart[:, s].sum(1) <= rotation.budget(i, cosine) for i, s in enumerate(rotation.blocks)])
        first = within.argmax(axis=0) == block
        a, b = a[first & within[block]], b[first & within[block]]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        for i, j in zip(node[a].tolist(), node[b].tolist()):
            p, q = root(i), root(j)
            if p != q:
                roots[max(p, q)] = min(p, q)
                edges.append((i, j))
    some = np.flatnonzero(links)
    none = [None] * len(edges)
    return pa.table({
        "node": pa.array([*node[some].tolist(), *none], pa.int64()), "links": pa.array([*links[some].tolist(), *none], pa.int64()),
        "a": pa.array([None] * len(some) + [e[0] for e in edges], pa.int64()),
        "b": pa.array([None] * len(some) + [e[1] for e in edges], pa.int64())})


def _chunked(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Deals large regions into chunks: a home meets every chunk of visitors, a visitor every chunk of homes."""
    rows = rows.join(counts, REGION, "left")
    homes, visitors = (F.coalesce(F.ceil(F.col(c) / F.lit(CHUNK)), F.lit(1)).cast("int") for c in ("homes", "visitors"))
    own = F.when(F.col("home"), homes).otherwise(visitors)
    other = F.when(F.col("home"), visitors).otherwise(homes)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), own)).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), other) - 1)))
    return rows.select(
        "node", "copies", "embedding", *REGION, "home",
        F.when(F.col("home"), F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("home"), F.col("other")).otherwise(F.col("own")).alias("j"))


def link(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors`."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    found = materialise(nodes(rows), "nodes")
    centres = pivots(found, found.count())
    counts = regions(found, centres, cosine, wide=False).groupBy(*REGION).agg(
        F.sum(F.col("home").cast("long")).alias("homes"), F.sum((~F.col("home")).cast("long")).alias("visitors"))
    large = materialise(counts.where((F.col("homes") > CHUNK) | (F.col("visitors") > CHUNK)), "regions")
    met = _chunked(regions(found, centres, cosine, wide=True), large)
    compared = met.groupBy(*REGION, "i", "j").applyInArrow(
        lambda t: _compare(t, cosine), "node long, links long, a long, b long")
    compared = materialise(compared, "links")
    n = compared.where(F.col("node").isNotNull()).groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(compared.where(F.col("a").isNotNull()).select("a", "b"))
    components = components.select(F.col("id").alias("node"), "component")
    members = materialise(found.select("node", "smallest").join(components, "node"), "members")
    least = members.groupBy("component").agg(F.min("smallest").alias("least"))
    named = members.join(least, "component").select("node", "least")
    answers = found.join(n, "node", "left").join(named, "node", "left").select(
        F.col("label").alias("n_label"), F.col("embedding").alias("n_embedding"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "smallest").alias("component_id"))
    same = (F.col("label") == F.col("n_label")) & (F.col("embedding") == F.col("n_embedding"))
    out = rows.join(answers, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
