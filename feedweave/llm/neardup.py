"""Near-duplicate embeddings by an inverted multi-index.

Vectors are scaled to length one and cut into halves; a codebook for each half, fitted on a bounded sample, makes a
grid of cells. A vector's traversal visits cells in the order of a lower bound of the distance to anything in them
(from the planes between the codebook's cells) and ends where the bound exceeds the distance that the wanted
cosine allows: nothing beyond can be linked, so the target recall is 1. Every pair of cells is visited from one side only.

Cells are cut into blocks of bounded size; a block's own vectors are held, visitors stream past. Blocks return
counts of links and a spanning set of edges, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.graph import components
from feedweave.llm.vectors import matrix, sample, usable
from feedweave.session import fresh_dir, stage

#: Vectors a codebook is fitted on at most, vectors wanted in a cell and in a block of one.
FITTED, IN_CELL, IN_BLOCK, MOST_CODES = 20_000, 512, 1024, 256


def codebook(points: np.ndarray, codes: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means centres."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.choice(len(distinct), min(codes, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)
        for c in range(len(centres)):
            mine = points[near == c]
            if len(mine):
                centres[c] = mine.mean(0)
    return np.unique(centres, axis=0)


def bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre, and a lower bound of the squared distance to each centre's cell."""
    distance = ((points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T)
    near = np.argmin(distance, axis=1)
    gap = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(2), 1e-300))
    beyond = (distance - distance[np.arange(len(points)), near][:, None]) / (2 * gap[near])
    beyond[np.arange(len(points)), near] = 0
    return near, np.maximum(beyond, 0) ** 2


def _visits(vectors: DataFrame, books, radius2: float) -> DataFrame:
    """Every vector with its own cell, and the later cells its traversal visits, nearest first."""

    def run(batches):
        one, two = books.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                unit = matrix(part.column(3))
                unit /= np.linalg.norm(unit, axis=1)[:, None]
                half = (unit.shape[1] + 1) // 2
                (a, low_a), (b, low_b) = bounds(unit[:, :half], one), bounds(unit[:, half:], two)
                own = a * len(two) + b
                low = (low_a[:, :, None] + low_b[:, None, :]).reshape(len(unit), -1)
                row, cell = np.nonzero(low <= radius2 + 1e-9)
                later = cell > own[row]
                row, cell = row[later], cell[later]
                order = np.lexsort((low[row, cell], row))
                row, cell = row[order], cell[order]
                offsets = np.searchsorted(row, np.arange(len(unit) + 1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(own.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cell.astype(np.int32)))],
                    names=["id", "label", "copies", "vec", "cell", "visits"])

    return vectors.mapInArrow(run, "id long, label string, copies long, vec array<float>, cell int, visits array<int>")


class _Block:
    """The vectors of one block: compares with each other and with visitors."""

    def __init__(self, cosine: float):
        self.cosine, self.parts, self.ready = cosine, [], False

    def hold(self, ids, copies, vectors) -> None:
        self.parts.append((ids, copies, vectors))

    def _linked(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return (vectors @ self.vectors.T) / (norms[:, None] * self.norms) >= self.cosine

    def settle(self):
        """Compare the block's own vectors; gives (ids, counts, edges)."""
        self.ids, self.copies, self.vectors = (np.concatenate(c) for c in zip(*self.parts))
        self.norms = np.sqrt((self.vectors**2).sum(1))
        self.root, self.ready = np.arange(len(self.ids)), True
        edges, counts = [], np.zeros(len(self.ids), np.int64)
        for a in range(0, len(self.ids), 256):
            linked = self._linked(self.vectors[a : a + 256], self.norms[a : a + 256])
            linked[np.arange(len(linked)), np.arange(a, a + len(linked))] = False
            counts[a : a + 256] = linked @ self.copies
            for i in np.flatnonzero(linked.any(1)):
                edges += self._join(np.append(np.flatnonzero(linked[i]), a + i))
        return self.ids, counts, edges

    def _join(self, members: np.ndarray) -> list[tuple[int, int]]:
        """Edges between the members that were not connected in this block."""
        roots = np.unique(self.root[members])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]
        return [(int(self.ids[r]), int(self.ids[roots[0]])) for r in roots[1:]]

    def visit(self, ids, copies, vectors):
        linked = self._linked(vectors, np.sqrt((vectors**2).sum(1)))
        edges = []
        for i in np.flatnonzero(linked.any(1)):
            met = np.flatnonzero(linked[i])
            edges += self._join(met)
            edges.append((int(ids[i]), int(self.ids[met[0]])))
        return np.concatenate([ids, self.ids]), np.concatenate([linked @ self.copies, linked.T @ copies]), edges


def _compared(rows: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n): counts of links (b null) and edges (n null), from blocks that come past in order."""

    def run(batches):
        key, block = None, None

        def table(ids, counts, edges):
            some = counts > 0
            a = [*ids[some].tolist(), *(e[0] for e in edges)]
            b = [*([None] * int(some.sum())), *(e[1] for e in edges)]
            n = [*counts[some].tolist(), *([None] * len(edges))]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
                                              names=["a", "b", "n"])

        for batch in batches:
            labels, cells, blocks, roles = (batch.column(i).to_pylist() for i in range(4))
            keys = list(zip(labels, cells, blocks, roles))
            lengths = batch.column(6).value_lengths().to_numpy(zero_copy_only=False)
            even = matrix(batch.column(6)) if len(lengths) and (lengths == lengths[0]).all() else None
            ids, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            first = 0
            while first < len(keys):
                last = first
                while last < len(keys) and keys[last] == keys[first]:
                    last += 1
                for at in range(first, last, 512):
                    part = slice(at, min(at + 512, last))
                    # Vectors of several lengths can come in one batch, not in one block.
                    vectors = even[part] if even is not None else matrix(batch.column(6).slice(at, part.stop - at))
                    if keys[first][:3] != key:
                        if block is not None and not block.ready:
                            yield table(*block.settle())
                        key, block = keys[first][:3], _Block(cosine)
                    if keys[first][3] == 0:
                        block.hold(ids[part], copies[part], vectors)
                    else:
                        if not block.ready:
                            yield table(*block.settle())
                        yield table(*block.visit(ids[part], copies[part], vectors))
                first = last
        if block is not None and not block.ready:
            yield table(*block.settle())

    ordered = rows.repartition("label", "cell", "block").sortWithinPartitions("label", "cell", "block", "role", "id")
    return ordered.select("label", "cell", "block", "role", "id", "copies", "vec").mapInArrow(run, "a long, b long, n long")


def near_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``.

    Rows link if their labels are equal and not null and the cosine of their vectors is ``cosine`` or more. Vectors
    that are null, zero or hold null or non-finite components link with nothing, neither do rows with a null id. Only
    vectors of equal length are compared. Equal vectors are copies: each links with all others. Ids are
    unique; rows that share an id count as copies or links of their own. Other columns are ignored. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    folder = fresh_dir(spark, "neardup")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("vec"),
                          F.col(label_col).alias("label"))
    part = usable("vec") & F.col("label").isNotNull() & F.col("id").isNotNull()
    # Vectors of different lengths are never compared.
    rows = rows.withColumn("label", F.when(part, F.concat(F.col("label").cast("string"), F.lit("/"), F.size("vec").cast("string"))))
    taking = rows.filter("label IS NOT NULL")
    singles = stage(taking.groupBy("label", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                    .select("id", "label", "copies", "vec"), "distinct", folder)

    found = None
    sizes = singles.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"), F.countDistinct("label").alias("labels")).collect()
    for d, n, labels in ((r.d, r.n, r.labels) for r in sizes):
        mine = singles.filter(F.size("vec") == d)
        points = sample(mine, FITTED, "id", "vec")
        points /= np.linalg.norm(points, axis=1)[:, None]
        codes = int(min(MOST_CODES, max(1, round((n / labels / IN_CELL) ** 0.5))))
        half = (d + 1) // 2
        books = spark.sparkContext.broadcast((codebook(points[:, :half], codes), codebook(points[:, half:], codes)))
        placed = _visits(mine, books, 2 - 2 * cosine)
        found = placed if found is None else found.unionByName(placed)
    if found is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))

    placed = stage(found, "placed", folder)
    cells = placed.groupBy("label", "cell").agg(F.ceil(F.count("*") / IN_BLOCK).cast("int").alias("blocks"))
    own = placed.join(cells, ["label", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    fields = ["label", "cell", "block", "role", "id", "copies", "vec"]
    homes = own.withColumn("role", F.lit(0)).select(fields)
    # The later blocks of the own cell, and all blocks of the cells visited.
    inner = (own.filter("block + 1 < blocks").withColumn("block", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)))
             .withColumn("role", F.lit(1)).select(fields))
    outer = (placed.select("label", F.explode("visits").alias("cell"), "id", "copies", "vec").join(cells, ["label", "cell"])
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("role", F.lit(1)).select(fields))
    compared = stage(_compared(homes.unionByName(inner).unionByName(outer), cosine), "compared", folder)

    counts = compared.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "id")
    classes = components(compared.filter("b IS NOT NULL").select("a", "b"))
    singles = (singles.join(counts, "id", "left").join(classes, "id", "left")
               .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component", "id").alias("component_id")))
    joined = rows.join(singles, ["label", "vec"], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
