"""Approximate nearest neighbours by stable projections and a kd-tree.

The largest inner product is made the smallest distance: a further coordinate brings every vector to the length of
the longest. Gaussian (2-stable) projections to a few dimensions keep distances up to a chi-square factor; a kd-tree over
them, split on a bounded sample, holds every row. A query first searches its own leaf, which bounds its k-th
distance; then leaves and rows are taken as long as the chi-square test allows a nearer one there with more than
``miss`` probability, and are verified on the vectors themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.vectors import matrix, sample, usable
from feedweave.session import fresh_dir, stage

DIMENSIONS = 8
#: Rows the tree is split on at most, rows wanted in a leaf and in a block of one, most leaves.
FITTED, IN_LEAF, MOST_LEAVES = 20_000, 2048, 4096


def chi_square_bound(miss: float, dimensions: int = DIMENSIONS) -> float:
    """What a chi-square variable of an even number of degrees exceeds with probability ``miss``."""

    def beyond(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, dimensions // 2):
            term *= x / 2 / i
            total += term
        return math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) > miss else (low, middle)
    return high


class Tree:
    """Splits of the projected space; leaf numbers are the paths, read as binary numbers."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth, self.splits = depth, {}
        groups = {1: points}
        for _ in range(depth):
            following = {}
            for node, mine in groups.items():
                axis = int(np.argmax(np.ptp(mine, axis=0))) if len(mine) else 0
                value = float(np.median(mine[:, axis])) if len(mine) else 0.0
                self.splits[node] = (axis, value)
                right = mine[:, axis] > value
                following[2 * node], following[2 * node + 1] = mine[~right], mine[right]
            groups = following

    def leaves(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        axes = np.zeros(1 << self.depth, dtype=np.int64)
        values = np.zeros(1 << self.depth)
        for k, (axis, value) in self.splits.items():
            axes[k], values[k] = axis, value
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), axes[node]] > values[node])
        return node


def _placed(rows: DataFrame, shared) -> DataFrame:
    """Rows with their place in the projected space and their leaf."""

    def run(batches):
        projection, longest2, tree = shared.value
        for batch in batches:
            vectors = matrix(batch.column(1))
            if not len(vectors):
                continue
            rest = np.sqrt(np.maximum(longest2 - (vectors**2).sum(1), 0))
            place = vectors @ projection[:-1]
            query = place  # the further coordinate of a query is 0
            place = place + rest[:, None] * projection[-1]
            flat = lambda x: pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, flat(place), flat(query), pa.array(tree.leaves(place)), pa.array(tree.leaves(query))],
                names=["id", "vec", "place", "asked", "leaf", "first_leaf"])

    return rows.select("id", "vec").mapInArrow(
        run, "id long, vec array<float>, place array<double>, asked array<double>, leaf long, first_leaf long")


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, summed in one order whatever stands beside a row."""
    return (vectors * query).sum(axis=1)


def _searched(rows: DataFrame, k: int, limit: float, longest2: float) -> DataFrame:
    """(query_id, vec_id, score): up to ``k`` best and ties of each query in each block that it visits."""

    def run(batches):
        key, held = None, None
        parts: list = []
        for batch in batches:
            leaves, blocks, roles = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            ids, least = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            vectors, places = matrix(batch.column(5)), matrix(batch.column(6))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i in range(batch.num_rows):
                mine = (leaves[i], blocks[i])
                if mine != key:
                    key, parts, held = mine, [], None
                if roles[i] == 0:
                    parts.append((ids[i], vectors[i], places[i]))
                    continue
                if held is None:
                    held = (np.array([p[0] for p in parts]), np.array([p[1] for p in parts]), np.array([p[2] for p in parts])) \
                        if parts else (np.zeros(0, np.int64), np.zeros((0, vectors.shape[1])), np.zeros((0, places.shape[1])))
                own, candidates, projected = held
                if not len(own):
                    continue
                # The chi-square test on the rows: farther projections are not verified.
                far = longest2 + (vectors[i] ** 2).sum() - 2 * least[i]
                near = ((projected - places[i]) ** 2).sum(1) <= limit * far + 1e-9
                near &= own != ids[i]
                chosen = np.flatnonzero(near)
                score = exact(vectors[i], candidates[chosen])
                good = score >= least[i]
                chosen, score = chosen[good], score[good]
                if len(chosen) > k:
                    best = np.lexsort((own[chosen], -score))[:k]
                    chosen, score = chosen[best], score[best]
                out.append((np.full(len(chosen), ids[i]), own[chosen], score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["query_id", "vec_id", "score"])

    ordered = rows.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "role", "id")
    return ordered.select("leaf", "block", "role", "id", "least", "vec", "at").mapInArrow(
        run, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, miss: float = 0.02, id_col: str = "vec_id",
            vec_col: str = "embedding", dimensions: int = DIMENSIONS, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` rows of largest inner product that are found.

    A row is no neighbour of the query with its id. Rows are ranked by score, ties by the smaller id; a query has
    fewer than ``k`` only if there are fewer candidates. Vectors that are null, zero or hold null or non-finite components take no part, nor
    do rows with a null id or of another length than most. Ids are unique. Other columns are ignored. Empty tables
    give no rows. ``miss`` bounds the probability that a nearer row is left out by the test.
    """
    spark = vectors.sparkSession
    folder = fresh_dir(spark, "nearest")

    def taking(df):
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))
        return df.filter(usable("vec") & F.col("id").isNotNull())

    rows, asked = taking(vectors), taking(queries)
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"), F.max(length).alias("longest2"))
    size = sizes.orderBy(F.col("n").desc(), "d").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, asked = rows.filter(F.size("vec") == size.d), asked.filter(F.size("vec") == size.d)
    longest2 = float(size.longest2)

    projection = np.random.default_rng(seed).standard_normal((size.d + 1, dimensions))
    points = sample(rows, FITTED, "id", "vec")
    points = points @ projection[:-1] + np.sqrt(np.maximum(longest2 - (points**2).sum(1), 0))[:, None] * projection[-1]
    depth = max(0, min(math.ceil(math.log2(max(size.n / IN_LEAF, 1))), int(math.log2(MOST_LEAVES))))
    shared = spark.sparkContext.broadcast((projection, longest2, Tree(points, depth)))

    index = stage(_placed(rows, shared).drop("asked", "first_leaf"), "index", folder)
    places = stage(_placed(asked, shared).drop("place", "leaf"), "queries", folder)
    box = [f(F.element_at("place", i + 1)).alias(f"{n}{i}") for i in range(dimensions) for n, f in (("low", F.min), ("high", F.max))]
    leaves = index.groupBy("leaf").agg(F.ceil(F.count("*") / IN_LEAF).cast("int").alias("blocks"), *box)
    # One row for each leaf, MOST_LEAVES at most.
    boxes = leaves.orderBy("leaf").toPandas()
    blocks = leaves.select("leaf", "blocks")
    homes = index.join(blocks, "leaf").select(
        "leaf", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "id",
        F.lit(0.0).alias("least"), "vec", F.col("place").alias("at"))

    def visiting(df):
        return (df.join(blocks, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("leaf", "block", F.lit(1).alias("role"), "id", "least", "vec", F.col("asked").alias("at")))

    # First the leaf nearest to the query, whole.
    low = boxes[[f"low{i}" for i in range(dimensions)]].to_numpy()
    high = boxes[[f"high{i}" for i in range(dimensions)]].to_numpy()
    numbers, limit = boxes["leaf"].to_numpy(), chi_square_bound(miss, dimensions)
    frame = spark.sparkContext.broadcast((low, high, numbers))

    def route(df: DataFrame, later: bool) -> DataFrame:
        def run(batches):
            lows, highs, names = frame.value
            for batch in batches:
                asked_at = matrix(batch.column(2))
                if not batch.num_rows:
                    continue
                beside = np.maximum(np.maximum(lows[None] - asked_at[:, None], asked_at[:, None] - highs[None]), 0)
                away = (beside**2).sum(2)
                nearest_leaf = np.argmin(away, axis=1)
                taken = np.zeros(away.shape, dtype=bool)
                if later:
                    vectors, least = matrix(batch.column(1)), batch.column(3).to_numpy(zero_copy_only=False)
                    taken = away <= (limit * (longest2 + (vectors**2).sum(1) - 2 * least))[:, None] + 1e-9
                    taken[np.arange(len(taken)), nearest_leaf] = False
                else:
                    taken[np.arange(len(taken)), nearest_leaf] = True
                row, leaf = np.nonzero(taken)
                order = np.lexsort((away[row, leaf], row))
                row, leaf = row[order], leaf[order]
                yield pa.RecordBatch.from_arrays([c.take(pa.array(row)) for c in batch.columns] + [pa.array(names[leaf])],
                                                 names=["id", "vec", "asked", "least", "leaf"])

        return df.select("id", "vec", "asked", "least").mapInArrow(
            run, "id long, vec array<float>, asked array<double>, least double, leaf long")

    # Without a bound yet: everything in the leaf is verified.
    start = route(places.withColumn("least", F.lit(-1e300)), later=False)
    first = stage(_best(_searched(homes.unionByName(visiting(start)), k, limit, longest2), k).drop("rank"), "first", folder)
    bound = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    bounded = (places.join(bound, places.id == bound.query_id, "left")
               .withColumn("least", F.coalesce("bound", F.lit(-1e300))))
    second = _searched(homes.unionByName(visiting(route(bounded, later=True))), k, limit, longest2)
    return _best(first.unionByName(second), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
