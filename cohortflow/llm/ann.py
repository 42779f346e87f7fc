"""Nearest vectors by inner product: inverted lists, scanned with adaptive sampling of dimensions.

Method (Gao and Long 2023, "High-dimensional approximate nearest neighbor search"): largest inner product becomes
nearest distance by one more dimension that levels all norms; vectors are rotated at random, so that the first
``d`` dimensions estimate the whole distance; they are stored in blocks of columns. Within each probed list a
candidate is dropped as soon as a hypothesis test on its partial distance says that it lies beyond the worst
of the best so far. Those that pass all columns are scored exactly, in double precision, on the original vectors.

The number of lists grows with the root of the number of vectors. Up to a tenth of ``SAMPLE``, their centroids are fitted on at
most ``SAMPLE`` vectors (those with the smallest hash of their row); beyond that these give coarse lists, and each coarse list is
split by centroids that a task fits on at most ``FINE_SAMPLE`` of its own vectors. How many lists to probe is measured: what covers
the nearest of a few sampled vectors among the sample. Every vector is indexed.

Lists are split into blocks of about ``BLOCK`` vectors and probing queries are dealt to each block, so a list that holds a
third of all vectors is many units of work. A task takes up a block once and lets all groups of queries for it pass by; of what they
find, Spark keeps the best ``k`` of a query before anything is sent on.

Defined results: vectors that are missing, zero, or hold missing or non-finite numbers take no part, nor do rows
without an ID, nor vectors of another size than the most frequent one (of equally frequent ones the largest).
Rows with the same ID are rows of their own, as candidates and as queries. Ties go to the smaller ID. A query probes on until its lists
hold enough candidates, so it gets all there are if these are fewer than ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.frames import few_rows_at_once, map_arrow, written

K = 20
SAMPLE = 20_000
FINE_SAMPLE = 1000
MOST_LISTS = 1 << 16
# Share of a sampled query's nearest that its probed lists must hold, and how many queries are sampled.
COVERED = 0.96
TRIALS = 256
BLOCK = 2048
QUERY_BLOCK = 256
COLUMNS = 16
# Width of the test in the units of the paper: larger keeps more candidates.
EPSILON = 2.1


def clean(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``row, vec_id, vector`` (doubles) of the rows that take part. Rows are named when they are first written down."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size("vector") == (size["size"] if size else 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector")


@dataclass
class Layout:
    """Rotation, centroids (rotated), the squared length that all vectors are levelled to, and lists to probe.

    With coarse lists, ``coarse`` are their centroids and ``owner`` the coarse list of each of ``centroids``, in order.
    """

    rotation: np.ndarray
    centroids: np.ndarray
    level: float
    probes: int = 1
    coarse: np.ndarray | None = None
    owner: np.ndarray | None = None

    def rotated(self, exact: np.ndarray, query: bool = False) -> np.ndarray:
        last = np.zeros(len(exact)) if query else np.sqrt(np.maximum(self.level - (exact * exact).sum(axis=1), 0))
        return (np.column_stack([exact, last]) @ self.rotation).astype(np.float32)

    def distances(self, rotated: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return _distances(rotated, self.centroids)

    def lists(self, rotated: np.ndarray) -> np.ndarray:
        """The list of each vector: the nearest centroid, inside its coarse list if there are any."""
        out = np.empty(len(rotated), np.int32)
        step = max(1, CELLS // len(self.centroids))
        if self.coarse is None:
            for at in range(0, len(rotated), step):
                out[at : at + step] = self.distances(rotated[at : at + step]).argmin(axis=1)
            return out
        coarse = _distances(rotated, self.coarse).argmin(axis=1)
        for one in np.unique(coarse):
            mine = np.flatnonzero(coarse == one)
            first, last = np.searchsorted(self.owner, [one, one + 1])
            out[mine] = first + _distances(rotated[mine], self.centroids[first:last]).argmin(axis=1)
        return out


# Distances that are held at once.
CELLS = 1 << 24


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(axis=1)[None, :]


def centroids_of(points: np.ndarray, lists: int, random: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from random points; a list that runs empty starts again from another point."""
    centroids = points[random.choice(len(points), lists, replace=False)]
    for _ in range(rounds):
        nearest = _distances(points, centroids).argmin(axis=1)
        size = np.bincount(nearest, minlength=lists)
        sums = np.zeros_like(centroids, np.float64)
        np.add.at(sums, nearest, points)
        full = size > 0
        centroids[full] = (sums[full] / size[full, None]).astype(np.float32)
        centroids[~full] = points[random.choice(len(points), int((~full).sum()))]
    return centroids


def _split_lists(vectors: DataFrame, layout: Layout, each: int, seed: int) -> None:
    """Centroids inside the coarse lists, fitted list by list in tasks."""
    shared = vectors.sparkSession.sparkContext.broadcast(layout)

    def of_coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = shared.value.rotated(_matrix(batch.column("vector")))
                coarse = _distances(points, shared.value.centroids).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(coarse, pa.int32()), batch.column("row"), pa.array(list(points), pa.list_(pa.float32()))],
                    names=["coarse", "row", "point"],
                )

    def fit(table: pa.Table) -> pa.Table:
        points = _matrix(table.column("point").combine_chunks())
        random = np.random.default_rng([seed, table.column("coarse")[0].as_py()])
        found = centroids_of(points, min(each, max(1, len(points) // 4)), random)
        return pa.table({"coarse": table.column("coarse").slice(0, 1).take([0] * len(found)), "centroid": list(found)})

    placed = vectors.mapInArrow(of_coarse, "coarse int, row bigint, point array<float>")
    order = Window.partitionBy("coarse").orderBy(F.xxhash64("row"), "row")
    some = placed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= FINE_SAMPLE).drop("place")
    fine = some.groupBy("coarse").applyInArrow(fit, "coarse int, centroid array<float>").collect()
    # At most MOST_LISTS rows. A coarse list without vectors keeps its own centroid.
    empty = set(range(len(layout.centroids))) - {row["coarse"] for row in fine}
    listed = sorted([(row["coarse"], row["centroid"]) for row in fine] + [(k, layout.centroids[k].tolist()) for k in empty])
    layout.coarse = layout.centroids
    layout.owner = np.array([k for k, _ in listed])
    layout.centroids = np.array([one for _, one in listed], np.float32)


def fit_layout(vectors: DataFrame, sample: int = SAMPLE, seed: int = 7) -> Layout | None:
    some = vectors.orderBy(F.xxhash64("row"), "row").limit(sample).toArrow()
    if len(some) == 0:
        return None
    exact = np.array(some.column("vector").to_pylist(), np.float64)
    count, level = vectors.agg(F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).first()
    random = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(random.standard_normal((exact.shape[1] + 1, exact.shape[1] + 1)))
    layout = Layout(rotation, np.zeros((1, rotation.shape[0]), np.float32), level)
    points = layout.rotated(exact)
    wanted = int(min(MOST_LISTS, max(1, np.sqrt(count) / 2)))
    direct = max(1, len(points) // 10)
    if wanted <= direct:
        layout.centroids = centroids_of(points, wanted, random)
    else:
        coarse = int(np.ceil(np.sqrt(wanted)))
        layout.centroids = centroids_of(points, min(coarse, direct), random)
        _split_lists(vectors, layout, -(-wanted // len(layout.centroids)), seed)
    layout.probes = _probes_needed(layout, exact, points)
    return layout


def _probes_needed(layout: Layout, exact: np.ndarray, points: np.ndarray, k: int = K) -> int:
    """How many lists hold ``COVERED`` of the true nearest of the first ``TRIALS`` sampled vectors."""
    trial = exact[:TRIALS]
    scores = trial @ exact.T
    scores[np.arange(len(trial)), np.arange(len(trial))] = -np.inf
    k = min(k, len(exact) - 1)
    if k < 1:
        return 1
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    order = layout.distances(layout.rotated(trial, query=True)).argsort(axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    lists = layout.lists(points)
    return int(np.quantile(np.take_along_axis(rank, lists[best], axis=1), COVERED)) + 1


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(batches: Iterator[pa.RecordBatch], layout) -> Iterator[pa.RecordBatch]:
    layout = layout.value
    for batch in batches:
        if batch.num_rows:
            nearest = layout.lists(layout.rotated(_matrix(batch.column("vector"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], names=[*batch.schema.names, "list"])


def _blocks(batches: Iterator[pa.RecordBatch], layout) -> Iterator[pa.RecordBatch]:
    """Each block with its rotated vectors by columns, and the original ones by rows."""
    layout = layout.value
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.array([(one["vec_id"], one["row"]) for one in row["members"]], np.int64)
            exact = np.array([one["vector"] for one in row["members"]], np.float64)
            order = np.lexsort((ids[:, 1], ids[:, 0]))
            exact = exact[order]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["list"]], pa.int32()),
                    pa.array([row["block"]], pa.int32()),
                    pa.array([ids[order].tobytes()], pa.binary()),
                    pa.array([np.ascontiguousarray(layout.rotated(exact).T).tobytes()], pa.binary()),
                    pa.array([exact.tobytes()], pa.binary()),
                ],
                names=["list", "block", "ids", "columns", "exact"],
            )


def _probe(batches: Iterator[pa.RecordBatch], layout, sizes: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    layout = layout.value
    for batch in batches:
        if batch.num_rows == 0:
            continue
        vectors = _matrix(batch.column("vector"))
        step = max(1, CELLS // 4 // len(sizes))
        for at in range(0, len(vectors), step):
            order = layout.distances(layout.rotated(vectors[at : at + step], query=True)).argsort(axis=1)
            held = np.cumsum(sizes[order], axis=1)
            # The query itself may be among the candidates.
            enough = np.maximum(layout.probes, (held < k + 1).sum(axis=1) + 1)
            query, place = np.nonzero(np.arange(order.shape[1])[None, :] < enough[:, None])
            yield pa.RecordBatch.from_arrays(
                [*(one.take(pa.array(at + query)) for one in batch.columns), pa.array(order[query, place], pa.int32())],
                names=[*batch.schema.names, "list"],
            )


def scan(
    query: np.ndarray, exact_query: np.ndarray, columns: np.ndarray, exact: np.ndarray, ids: np.ndarray, own: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of a block and their exact scores; ``ids``, by which ties are settled, ascend."""
    size = columns.shape[0]
    left = np.flatnonzero(ids != own)

    def score(which: np.ndarray) -> np.ndarray:
        return (exact[which] * exact_query).sum(axis=1)

    first = left[: 2 * k]
    left = left[2 * k :]
    best, scores = first, score(first)
    if len(left) and len(best) >= k:
        # Squared distance of the k-th best so far, from its score.
        away = ((columns[:, best] - query[:, None]) ** 2).sum(axis=0)
        limit = np.partition(away, k - 1)[k - 1]
        part = np.zeros(len(left), np.float32)
        for begin in range(0, size, COLUMNS):
            done = min(begin + COLUMNS, size)
            part += ((columns[begin:done, left] - query[begin:done, None]) ** 2).sum(axis=0)
            slack = (1 + EPSILON / np.sqrt(done)) ** 2 if done < size else 1 + 1e-5
            keep = part * (size / done) <= limit * slack + 1e-6
            left, part = left[keep], part[keep]
            if len(left) > 4 * k:
                # A few complete distances of the most promising candidates tighten the limit.
                near = left[np.argpartition(part, k)[:k]]
                full = ((columns[:, near] - query[:, None]) ** 2).sum(axis=0)
                limit = min(limit, np.max(full))
        best = np.concatenate([best, left])
        scores = np.concatenate([scores, score(left)])
    order = np.lexsort((ids[best], -scores))[:k]
    return ids[best][order], scores[order]


_FOUND = "query bigint, query_id bigint, row bigint, vec_id bigint, score double"


def _search(batches: Iterator[pa.RecordBatch], layout, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block: first the block itself, then the groups of queries for it, one after the other."""
    layout = layout.value
    size = layout.rotation.shape[0]
    names = [field.split()[0] for field in _FOUND.split(", ")]
    for batch in batches:
        for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            if row["ids"] is not None:
                ids = np.frombuffer(row["ids"], np.int64).reshape(-1, 2)
                columns = np.frombuffer(row["columns"], np.float32).reshape(size, -1)
                exact = np.frombuffer(row["exact"], np.float64).reshape(len(ids), -1)
                places = np.arange(len(ids))
                continue
            queries = np.array([one["vector"] for one in row["queries"]], np.float64)
            rotated = layout.rotated(queries, query=True)
            for j, one in enumerate(row["queries"]):
                own = np.flatnonzero(ids[:, 1] == one["row"])
                place, score = scan(rotated[j], queries[j], columns, exact, places, own[0] if len(own) else -1, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(place), one["row"], np.int64)),
                        pa.array(np.full(len(place), one["vec_id"], np.int64)),
                        pa.array(ids[place, 1]),
                        pa.array(ids[place, 0]),
                        pa.array(score),
                    ],
                    names=names,
                )


RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row for which ``is_query`` (over ``vec_id``) holds."""
    spark = vectors.sparkSession
    rows = written(clean(vectors, id_column, vector_column), "vectors")
    fitted = fit_layout(rows)
    if fitted is None:
        return spark.createDataFrame([], RESULT)
    layout = spark.sparkContext.broadcast(fitted)
    lists = len(fitted.centroids)
    schema = "row bigint, vec_id bigint, vector array<double>, list int"
    assigned = written(map_arrow(rows, _assign, schema, layout), "assigned")
    sizes = np.zeros(lists, np.int64)
    for one in assigned.groupBy("list").count().collect():
        sizes[one["list"]] = one["count"]
    # One row per list.
    parts = np.maximum(-(-sizes // BLOCK), 1)
    parts_of = F.broadcast(
        spark.createDataFrame(pa.table({"list": pa.array(range(lists), pa.int32()), "parts": pa.array(parts, pa.int64())}))
    )
    one = F.struct("row", "vec_id", "vector")
    block = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    packed = assigned.join(parts_of, "list").groupBy("list", block.alias("block")).agg(F.collect_list(one).alias("members"))
    index = map_arrow(packed, _blocks, "list int, block int, ids binary, columns binary, exact binary", layout)

    asking = rows.where(is_query)
    probing = map_arrow(asking, _probe, schema, layout, sizes, k)
    lanes = max(1, -(-asking.count() // QUERY_BLOCK))
    lane = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(lanes)).cast("int")
    asked = probing.groupBy("list", lane.alias("lane")).agg(F.collect_list(one).alias("queries"))
    # Each group of queries goes to each block of its list.
    last = (F.col("parts") - 1).cast("int")
    spread = asked.join(parts_of, "list").select(
        "list", F.explode(F.sequence(F.lit(0), last)).alias("block"), "lane", "queries"
    )
    both = index.withColumn("lane", F.lit(-1)).unionByName(spread, allowMissingColumns=True)
    dealt = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "list", "block")
    found = map_arrow(dealt.sortWithinPartitions("list", "block", "lane"), _search, _FOUND, layout, k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # Blocks are large rows, and so are groups of queries.
    with few_rows_at_once(spark, 16):
        return written(ranked.select("query_id", "rank", "vec_id", "score"), "nearest")
