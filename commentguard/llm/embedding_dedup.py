"""Near-duplicate embeddings by an inverted multi-index.

Equal vectors of a label form one class; only classes are compared. Two codebooks, fitted by
k-means on the two halves of at most ``SAMPLE`` unit vectors (classes chosen by hash), form a
product grid of cells; every class is indexed in the cell of its two nearest codewords. Each
class then visits cells of its label in the order of a multi-sequence traversal (nearest sum of
the two half distances first). How many cells are visited is calibrated twice over, and the greater
number counts. For ``CALIBRATION`` classes all true neighbours are found by brute force over the whole
index, and the visits must reach ``RECALL`` of them. Because a table may hold hardly any pair, the same
classes also get ``PLANTED`` neighbours each, planted in random directions at a cosine of exactly the
threshold, the hardest there are, and the visits must reach ``PLANTED_RECALL`` of those. There is no
upper limit: where the recall asks for it, all cells of the label are visited. All classes of a visited
cell are verified by cosine in double precision.

A pair is looked for from the class with the lesser key only, so it is counted once. Cells and
their visitors are cut into parts of at most about ``PART`` rows; each pair of parts is a group
of its own. Tasks return link counts and a spanning forest, not pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors
with a null label, link with nothing and are components of their own; vectors of unlike
length never link; very long vectors and components of any finite size are compared like others (each
vector is scaled by a power of two first); cells at equal distances are visited in the order of their
codewords; repeated rows and ids count as vectors each; an empty table gives an empty result. Only the
columns named are read, so others may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentguard.llm.common import materialise, read_table, small
from commentguard.llm.components import components

THRESHOLD = 0.93
SAMPLE = 20_000
CALIBRATION = 400
RECALL = 0.9999
PLANTED = 8
PLANTED_RECALL = 0.99
MIN_VISITS = 4
CELL_ROWS = 64  # classes per grid cell over all labels, on average
MAX_WORDS = 256
PART = 2048
_SMALL_ROWS = 200_000


def _unit(blobs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    words = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(15):
        near = _distances(x, words).argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, j], minlength=k) for j in range(x.shape[1])], 1)
        words = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], words)
    return words


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ words.T + (words ** 2).sum(1)[None, :], 0)


class Grid:
    """Codebooks of both halves, per vector length."""

    def __init__(self, books: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.books = books

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.books[x.shape[1]]
        return _distances(x[:, :x.shape[1] // 2], a), _distances(x[:, x.shape[1] // 2:], b)

    def cell(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.halves(x)
        return d1.argmin(1) * MAX_WORDS + d2.argmin(1)

    def visits(self, x: np.ndarray, count: int) -> np.ndarray:
        """The nearest ``count`` cells of each vector in the order of the traversal.

        The cell at ranks (a, b) of the two sorted sequences comes after the (a+1)(b+1)-1 cells at
        lower ranks, so only ranks with (a+1)(b+1) <= count can be among the first.
        """
        d1, d2 = self.halves(x)
        o1, o2 = d1.argsort(1, kind="stable"), d2.argsort(1, kind="stable")
        a, b = np.meshgrid(np.arange(d1.shape[1]), np.arange(d2.shape[1]), indexing="ij")
        front = (a + 1) * (b + 1) <= count
        a, b = a[front], b[front]
        near = np.take_along_axis(d1, o1, 1)[:, a] + np.take_along_axis(d2, o2, 1)[:, b]
        first = near.argsort(1, kind="stable")[:, :count]
        return np.take_along_axis(o1[:, a] * MAX_WORDS + o2[:, b], first, 1)

    @staticmethod
    def ranks(d1: np.ndarray, d2: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells each vector (a row of half distances) visits before its given cell, those at the same distance included."""
        first, second = np.divmod(cells, MAX_WORDS)
        out = np.empty(len(cells), np.int64)
        for k in range(0, len(cells), 64):
            near = d1[k:k + 64, :, None] + d2[k:k + 64, None, :]
            own = near[np.arange(len(near)), first[k:k + 64], second[k:k + 64]]
            out[k:k + 64] = (near <= own[:, None, None]).sum((1, 2)) - 1
        return out


def _by_size(batch: pa.RecordBatch, limit: int = 4096):
    """Rows of a batch by vector length, in pieces: (row numbers, unit vectors)."""
    blobs = batch.column("vec").to_pylist()
    size = np.array([len(b) for b in blobs])
    for s in np.unique(size):
        rows = np.flatnonzero(size == s)
        for k in range(0, len(rows), limit):
            at = rows[k:k + limit]
            yield at, _unit([blobs[i] for i in at])


def _index(shared):
    def go(batches):
        grid = shared.value
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for at, x in _by_size(batch):
                cell[at] = grid.cell(x)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), pa.array(cell)], ["node", "label", "cell"])
    return go


def _probe(shared, count: int):
    def go(batches):
        grid = shared.value
        for batch in batches:
            for at, x in _by_size(batch, max(1, min(4096, (1 << 22) // count))):
                cells = grid.visits(x, count)
                rows = pa.array(np.repeat(at, cells.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column("node").take(rows), batch.column("label").take(rows),
                                                  pa.array(cells.ravel().astype(np.int32))], ["node", "label", "cell"])
    return go


def _true_ranks(shared):
    """For calibration queries against all classes of the batch: how often a true neighbour's cell is visited at each rank."""
    def go(batches):
        grid, queries, halves = shared.value
        for batch in batches:
            label = np.array(batch.column("label").to_pylist(), object)
            node = np.array(batch.column("node").to_pylist(), object)
            found: dict[int, int] = {}
            for at, x in _by_size(batch):
                cell = grid.cell(x)
                for key, (names, q) in queries.items():
                    mine = np.flatnonzero(label[at] == key[0])
                    if key[1] != x.shape[1] or not len(mine):
                        continue
                    i, j = np.nonzero(q @ x[mine].T >= THRESHOLD)
                    other = np.array([names[a] != node[at[mine[b]]] for a, b in zip(i, j)], bool)
                    asked, n = np.unique(np.stack([i[other], cell[mine[j[other]]]], 1), axis=0, return_counts=True)
                    for r, times in zip(grid.ranks(*(d[asked[:, 0]] for d in halves[key]), asked[:, 1]).tolist(), n.tolist()):
                        found[r] = found.get(r, 0) + times
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["rank", "n"])
    return go


def fit_grid(classes: DataFrame, n: int) -> Grid:
    rate = min(1.0, SAMPLE / max(n, 1))
    sample = classes.where(F.pmod(F.xxhash64(F.lit(7), "node"), F.lit(1 << 30)) < rate * (1 << 30)).select("vec").collect()
    words = int(min(MAX_WORDS, max(4, math.ceil(math.sqrt(n / CELL_ROWS)))))
    by: dict[int, list[bytes]] = {}
    for r in sample:
        by.setdefault(len(r["vec"]) // 8, []).append(bytes(r["vec"]))
    books = {}
    for dim, blobs in by.items():
        x = _unit(sorted(blobs))
        books[dim] = _kmeans(x[:, :dim // 2], words, 1), _kmeans(x[:, dim // 2:], words, 2)
    for r in classes.select(F.octet_length("vec").alias("b")).distinct().collect():  # lengths that the sample missed
        dim = r["b"] // 8
        books.setdefault(dim, (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))))
    return Grid(books)


def _planted(unit: np.ndarray, times: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Each unit vector so often, with a neighbour at a cosine of the threshold in a random direction."""
    x = np.repeat(unit, times, 0)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    return x, THRESHOLD * x + math.sqrt(1 - THRESHOLD ** 2) * side


def _fewest(count: np.ndarray, recall: float) -> int:
    """Fewest visits that reach the recall, given how many neighbours lie at each rank."""
    return int(np.argmax(np.cumsum(count) >= recall * count.sum())) + 1 if count.sum() else 1


def calibrate(classes: DataFrame, grid: Grid, n: int, recall: float = RECALL, planted_recall: float = PLANTED_RECALL) -> tuple[int, float]:
    """Fewest visits that reach both recalls on a sample of queries, and the lesser recall reached (true or planted neighbours)."""
    sc = classes.sparkSession.sparkContext
    rate = min(1.0, CALIBRATION / max(n, 1))
    rows = classes.where(F.pmod(F.xxhash64(F.lit(8), "node"), F.lit(1 << 30)) < rate * (1 << 30)).select("node", "label", "vec").collect()
    groups: dict[tuple, tuple[list, list]] = {}
    for r in sorted(rows, key=lambda r: bytes(r["node"])):
        names, blobs = groups.setdefault((r["label"], len(r["vec"]) // 8), ([], []))
        names.append(bytes(r["node"]))
        blobs.append(bytes(r["vec"]))
    queries = {key: (names, _unit(blobs)) for key, (names, blobs) in groups.items()}
    halves = {key: grid.halves(q) for key, (_, q) in queries.items()}
    cells = max((len(a) * len(b) for a, b in grid.books.values()), default=1)
    true, planted = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    got = classes.select("node", "label", "vec").mapInArrow(_true_ranks(sc.broadcast((grid, queries, halves))), "rank int, n bigint") \
        .groupBy("rank").agg(F.sum("n").alias("n")).collect()
    for r in got:
        true[r["rank"]] += r["n"]
    rng = np.random.default_rng(9)
    for _, unit in queries.values():
        if unit.shape[1] > 1:  # in one dimension there is no direction to move in
            x, y = _planted(unit, PLANTED, rng)
            np.add.at(planted, grid.ranks(*grid.halves(x), grid.cell(y)), 1)
    visits = min(cells, max(MIN_VISITS, _fewest(true, recall), _fewest(planted, planted_recall)))
    reached = [float(c[:visits].sum() / c.sum()) for c in (true, planted) if c.sum()]
    return visits, min(reached, default=1.0)


def _labels(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a bipartite mask: least row number that each row and column reaches."""
    rows, none = np.arange(len(mask)), len(mask)
    while True:
        cols = np.where(mask, rows[:, None], none).min(0)
        new = np.minimum(rows, np.where(mask, cols[None, :], none).min(1))
        if (new == rows).all():
            return rows, cols
        rows = new


def _verify(group: pa.Table) -> pa.Table:
    """One group: members of a cell and visitors. Links per class, and a spanning forest."""
    visitor = group.column("visitor").to_numpy(zero_copy_only=False)
    node = np.array(group.column("node").to_pylist(), object)
    weight, blobs = group.column("weight").to_numpy(), np.array(group.column("vec").to_pylist(), object)
    size = np.array([len(b) for b in blobs])
    out_node, out_root, out_links = [], [], []
    for s in np.unique(size):
        p, m = np.flatnonzero(visitor & (size == s)), np.flatnonzero(~visitor & (size == s))
        if not len(p) or not len(m):
            continue
        mask = _unit(list(blobs[p])) @ _unit(list(blobs[m])).T >= THRESHOLD
        names, rank = np.unique(node[np.concatenate([p, m])], return_inverse=True)
        mask &= rank[:len(p)][:, None] < rank[len(p):][None, :]
        if not mask.any():
            continue
        rows, cols = _labels(mask)
        for at, links, root in ((p, mask @ weight[m], rows), (m, weight[p] @ mask, cols)):
            hit = np.flatnonzero(links)
            out_node += list(node[at[hit]])
            out_root += list(node[p[root[hit]]])
            out_links += links[hit].tolist()
    return pa.table({"node": pa.array(out_node, pa.binary()), "root": pa.array(out_root, pa.binary()), "links": pa.array(out_links, pa.int64())})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: id, label, n_links, component_id, kept, and visits and recall of the calibration."""
    x = F.col(vector).cast("array<double>")
    usable = (F.col(label).isNotNull() & x.isNotNull() & (F.size(x) > 0)
              & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.when(F.coalesce(usable, F.lit(False)), x).alias("x"))
    rows = rows.withColumn("node", F.when(F.col("x").isNotNull(), F.unhex(F.md5(
        F.concat_ws(",", F.col("label").cast("string"), F.col("x").cast("array<string>")).cast("binary")))))
    rows = rows.mapInArrow(_pack, f"id {vectors.schema[id_col].dataType.simpleString()}, label {vectors.schema[label].dataType.simpleString()}, "
                                  "node binary, vec binary")
    rows = materialise(rows, "emb-rows")
    classes = materialise(rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("weight"), F.min("id").alias("low")), "emb-classes")
    n = classes.count()
    sc = vectors.sparkSession.sparkContext
    grid = fit_grid(classes, n)
    visits, reached = calibrate(classes, grid, n)
    shared = sc.broadcast(grid)
    kind = vectors.schema[label].dataType.simpleString()
    index = materialise(classes.select("node", "label", "vec").mapInArrow(_index(shared), f"node binary, label {kind}, cell int"), "emb-index")
    probes = classes.select("node", "label", "vec").mapInArrow(_probe(shared, visits), f"node binary, label {kind}, cell int")
    # visits of cells with another class than the visitor's own
    cells = index.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("members"), F.max("node").alias("top"))
    cells = small(materialise(cells, "emb-cells"), _SMALL_ROWS)
    probes = materialise(probes.join(cells, ["label", "cell"]).where(F.col("node") < F.col("top")).select("node", "label", "cell", "members"), "emb-probes")
    asked = materialise(probes.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("visitors"), F.max("members").alias("members")), "emb-asked")
    mparts, pparts = F.ceil(F.col("members") / PART).cast("int"), F.ceil(F.col("visitors") / PART).cast("int")

    def deal(side: DataFrame, visitor: bool) -> DataFrame:
        mine, other = (pparts, mparts) if visitor else (mparts, pparts)
        part = F.pmod(F.xxhash64(F.lit(int(visitor)), "node"), mine).cast("int")
        names = ("p", "m") if visitor else ("m", "p")
        return (side.select("node", "label", "cell").join(small(asked, _SMALL_ROWS), ["label", "cell"])
                .select("node", "label", "cell", part.alias(names[0]), F.explode(F.sequence(F.lit(0), other - 1)).alias(names[1]))
                .select("node", "label", "cell", "p", "m", F.lit(visitor).alias("visitor")))

    both = deal(probes, True).unionByName(deal(index, False)).join(classes.select("node", "vec", "weight"), "node")
    found = materialise(both.groupBy("label", "cell", "p", "m").applyInArrow(_verify, "node binary, root binary, links bigint"), "emb-links")
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "emb-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("node", "weight", "low").join(links, "node", "left").join(roots, "node", "left") \
        .select("node", "low", F.coalesce("root", "node").alias("root"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    known = materialise(known, "emb-known")
    lows = known.groupBy("root").agg(F.min("low").alias("component"))
    result = rows.select("id", "label", "node").join(known.join(lows, "root").select("node", "component", "n_links"), "node", "left")
    component = F.when(F.col("node").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return result.select(F.col("id").alias(id_col), F.col("label").alias(label), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
                         F.lit(visits).alias("visits"), F.lit(reached).alias("recall"))


def _pack(batches):
    for batch in batches:
        x = batch.column("x")
        vec = [None if v is None else np.asarray(v, np.float64).tobytes() for v in x.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("node"), pa.array(vec, pa.binary())],
                                         ["id", "label", "node", "vec"])


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: near-duplicate vectors of all embeddings."""
    found = near_duplicates(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept", "visits", "recall")


QUERIES = {"op2_embedding_dedup": (op2_embedding_dedup, None)}
