"""Approximate nearest neighbours by balanced posting lists.

1. A bounded sample of the vectors (``most_sample`` rows, first by a hash of vec_id) is clustered by k-means with a
   penalty on crowded clusters; about one centroid per ``list_size`` rows of the table, as far as the sample goes.
2. The centroids are linked into a neighbour graph that fits in memory and is searched best-first for batches of
   vectors; centroids and graph are broadcast (at most ``most_sample`` / 8 vectors).
3. Every vector is written to the list of its nearest centroid, and a vector near a boundary also to the lists of
   further centroids that are almost as near. ``TOGETHER`` lists make a bundle, and bundles are
   split into parts of about ``part_rows`` rows, so that no list, however many copies of one vector or vectors of one
   vec_id it holds, meets in one task. Exact repeats of a row are dropped before. The queries that search a bundle are
   dealt into slots of about ``slot_queries``, for the same reason.
4. A query searches the lists whose centroids are at most ``ratio`` times as far as the nearest one. The ratio is the
   smallest that reaches ``target`` recall, by the lower bound of what the number of trials can tell: up to ``TRIALS``
   of the queries are compared with all rows, and their neighbours are looked for by the very search that follows, with
   what the graph fails to meet. If no ratio reaches the target, or with fewer than ``FEW_LISTS`` lists, all are searched.
5. Parts and queries are joined; a part compares a query with the rows of the lists it searches and returns the
   nearest, which are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import at_most, hashed_place, pin, runs

NEAREST = 10
MOST_SAMPLE = 16_384
LIST_SIZE = 128
PART_ROWS = 4096
SLOT_QUERIES = 16_384
TOGETHER = 8
MOST_COPIES = 2
BOUNDARY = 1.1
TARGET = 0.95
FEW_LISTS = 16
TRIALS = 400  # queries that are compared with all rows, to choose the ratio by
TRIAL_ROWS = 8192
DEGREE = 24
BREADTH = 64
ROUNDS = 8


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means in which a centroid's distance grows with the rows it held in the round before."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), k, replace=False)].copy()
    crowd = np.zeros(k)
    for _ in range(rounds):
        distance = squared(sample, centroids)
        penalty = 0.1 * distance.min(1).mean() * crowd * k / len(sample)
        own = (distance + penalty).argmin(1)
        crowd = np.bincount(own, minlength=k).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        full = crowd > 0
        centroids[full] = sums[full] / crowd[full, None]
        if (~full).any():
            centroids[~full] = sample[rng.choice(len(sample), int((~full).sum()))]
    return centroids


@dataclass(frozen=True)
class Graph:
    """Centroids, their neighbours, and where every search begins."""

    centroids: np.ndarray
    links: np.ndarray
    entry: np.ndarray

    @staticmethod
    def build(centroids: np.ndarray, degree: int = DEGREE, seed: int = 7) -> Graph:
        k = len(centroids)
        rng = np.random.default_rng(seed)
        near = np.argsort(squared(centroids, centroids), axis=1, kind="stable")[:, 1 : degree + 1]
        far = rng.integers(0, k, (k, max(2, degree // 4)))  # long links keep the graph in one piece
        # A search only goes downhill, so it begins all over the space: each entry is the centroid farthest from the others.
        entry = [0]
        away = squared(centroids, centroids[:1])[:, 0]
        while len(entry) < min(k, max(8, 2 * math.isqrt(k))):
            entry.append(int(away.argmax()))
            away = np.minimum(away, squared(centroids, centroids[entry[-1:]])[:, 0])
        return Graph(centroids, np.concatenate([near, far], 1).astype(np.int32), np.array(entry))

    def search(self, vectors: np.ndarray, breadth: int, ratio: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``breadth`` centroids met per vector, nearest first, and their distances.

        Four unopened centroids are opened per round, for ``ROUNDS`` rounds and, with a ``ratio``, for as long after as
        one lies within that many times the nearest distance.
        """
        k, n = len(self.centroids), len(vectors)
        breadth = min(breadth, k)
        known = np.full((n, k), np.inf)
        opened = np.zeros((n, k), bool)
        row = np.arange(n)[:, None]

        def look(at: np.ndarray) -> None:
            diff = self.centroids[at] - vectors[:, None, :]
            known[row, at] = np.einsum("nbd,nbd->nb", diff, diff)

        look(np.broadcast_to(self.entry, (n, len(self.entry))))
        for number in range(ROUNDS if ratio is None else ROUNDS + k):
            waiting = np.where(opened, np.inf, known)
            if number >= ROUNDS:
                waiting[waiting > known.min(1, keepdims=True) * ratio**2] = np.inf
            best = np.argpartition(waiting, min(4, k - 1), axis=1)[:, :4]
            if not np.isfinite(waiting[row, best]).any():
                break
            opened[row, best] = True
            look(self.links[best].reshape(n, -1))
        order = np.argsort(known, axis=1, kind="stable")[:, :breadth]
        return order, np.sqrt(known[row, order])

    def nearest(
        self, vectors: np.ndarray, breadth: int = BREADTH, ratio: float | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.search(vectors[i : i + 512], breadth, ratio) for i in range(0, len(vectors), 512)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def searched_lists(distance: np.ndarray, ratio: float) -> np.ndarray:
    """Which of the found centroids (nearest first) a query searches."""
    return distance <= np.maximum(distance[:, :1], 1e-12) * ratio


def copies(distance: np.ndarray, boundary: float, most: int) -> np.ndarray:
    """Which of the found centroids (nearest first) a vector is written to: the nearest, and up to ``most`` in all that
    are within ``boundary`` times its distance."""
    chosen = distance <= boundary * distance[:, :1]
    chosen[:, 0] = True
    chosen[:, most:] = False
    return chosen


def exact_neighbours(vectors: DataFrame, queries: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The nearest rows (query_id, vec_id, score, vector) of a few queries (query_id, query), by comparison with all rows.

    The tasks send ``nearest`` rows a query, and so does Spark's merge.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(queries.assign(lists=[[0]] * len(queries)))
    schema = "query_id long, vec_id long, score double, vector array<double>"

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["query_id", "score", "vec_id"], kind="stable").drop_duplicates(["query_id", "vec_id"])
        return rows.groupby("query_id").head(nearest)

    def closest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "vector": []})
        for batch in batches:
            for at in range(0, len(batch), TRIAL_ROWS):
                held = batch.iloc[at : at + TRIAL_ROWS].assign(list=0).sort_values("vec_id", ignore_index=True)
                near = _nearest_rows(held, shared.value, nearest)
                near = near.assign(vector=held["vector"].to_numpy()[near["row"].to_numpy(np.int64)]).drop(columns="row")
                found = best(pd.concat([found, near])) if len(found) else near
        if len(found):
            yield found

    single = vectors.select("vec_id", "vector").mapInPandas(closest, schema)
    first = F.min_by(F.struct("score", "vector"), "score").alias("first")
    single = single.groupBy("query_id", "vec_id").agg(first).select("query_id", "vec_id", "first.*")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).drop("rank").toPandas()


def calibrated_ratio(graph: Graph, queries: pd.DataFrame, exact: pd.DataFrame, boundary: float, most: int, target: float) -> float:
    """The smallest distance ratio by which a search finds ``target`` of the exact neighbours of the trial queries.

    The aim is raised by two standard errors of the recall over the trials, so that it holds for other queries too.
    """
    if not len(exact):
        return math.inf
    k = len(graph.centroids)
    asked = np.array(queries["query"].tolist(), float)
    of = queries.reset_index().set_index("query_id")["index"].loc[exact["query_id"]].to_numpy()
    found, distance = graph.nearest(np.array(exact["vector"].tolist(), float))
    held = copies(distance, boundary, most)[:, :most]
    lists = found[:, :most]
    number = np.bincount(of, minlength=len(asked))
    with_rows = number > 0

    def reached(ratio: float) -> bool:
        near, away = graph.nearest(asked, k, ratio)
        at, which = np.nonzero(searched_lists(away, ratio))
        searched = np.zeros((len(asked), k), bool)
        searched[at, near[at, which]] = True
        hit = (searched[of[:, None], lists] & held).any(1)
        recall = np.bincount(of, hit, len(asked))[with_rows] / number[with_rows]
        return recall.mean() - 2 * recall.std() / math.sqrt(len(recall)) >= target

    # The ratio at which each true neighbour is met through the nearest of its lists, if the graph leads there.
    to_list = np.sqrt(squared(asked, graph.centroids))
    to_list /= np.maximum(to_list.min(1, keepdims=True), 1e-12)
    needed = np.where(held, to_list[of[:, None], lists], np.inf).min(1)
    steps = np.unique(np.quantile(needed, np.linspace(target, 1, 101), method="higher")) + 1e-9
    steps = np.concatenate([steps, steps[-1] * np.array([1.25, 1.5, 2])])
    low, high = 0, len(steps)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if reached(steps[middle]) else (middle + 1, high)
    return float(steps[low]) if low < len(steps) else math.inf


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (array of double) of the rows that can be searched: finite, without nulls, not all zero."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull()).where(~odd & F.exists("vector", lambda x: x != 0))


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def fit_graph(vectors: DataFrame, rows: int, most_sample: int, list_size: int) -> Graph:
    """The graph of centroids of the different vectors of a sample."""
    place = hashed_place("vec_id", "vector")
    drawn = at_most(vectors, place, rows, most_sample).orderBy(place, "vec_id").limit(min(rows, most_sample)).toPandas()
    points = np.unique(np.array(drawn["vector"].tolist(), float), axis=0)  # copies look near
    points = points[np.random.default_rng(7).permutation(len(points))]
    k = int(min(max(1, rows // list_size), max(1, len(points) // 8)))
    return Graph.build(balanced_centroids(points, k))


def trial_queries(asked: DataFrame) -> pd.DataFrame:
    """query_id and query of up to ``TRIALS`` queries, one per vec_id: an id with most of the rows must not speak for all.

    The hash that chooses them is another one than the sample's, so that they are in it as often as the others.
    """
    first = F.min_by("vector", F.xxhash64("vector")).alias("query")
    single = asked.groupBy(F.col("vec_id").alias("query_id")).agg(first)
    place = hashed_place(F.lit(TRIALS), "query_id")
    return at_most(single, place, single.count(), TRIALS).orderBy(place, "query_id").limit(TRIALS).toPandas()


def _nearest_rows(held: pd.DataFrame, wanted: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The nearest rows of a part, ordered by vec_id, for each query that searches one of its lists.

    Distances by matrix product choose the candidates, with a margin for rounding; they are then measured exactly. The
    nearest row of each vec_id decides how far the candidates reach, so that ``nearest`` different ones are among them.
    """
    none = np.zeros(0, np.int64)
    out = [pd.DataFrame({"query_id": none, "vec_id": none, "score": np.zeros(0), "row": none})]
    if len(held) and len(wanted):
        ids, lists = held["vec_id"].to_numpy(), held["list"].to_numpy()
        head, _ = runs(ids)
        most = min(nearest, len(head)) - 1
        block = np.array(held["vector"].tolist(), float)
        for at in range(0, len(wanted), 256):
            some = wanted.iloc[at : at + 256]
            queries = np.array(some["query"].tolist(), float)
            rough = squared(queries, block)
            margin = 1e-9 * ((queries * queries).sum(1).max() + (block * block).sum(1).max())
            for query_id, query, own, row in zip(some["query_id"], queries, some["lists"], rough):
                usable = np.isin(lists, own) & (ids != query_id)
                row = np.where(usable, row, np.inf)
                reach = np.partition(np.minimum.reduceat(row, head), most)[most] + margin
                near = np.flatnonzero(usable & (row <= reach))
                score = np.sqrt(((block[near] - query) ** 2).sum(1))
                order = np.lexsort((ids[near], score))
                best = near[order]
                _, first = np.unique(ids[best], return_index=True)
                kept = np.sort(first)[:nearest]
                best = best[kept]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[best], "score": score[order[kept]], "row": best}))
    return pd.concat(out)


def _scan(held: pd.DataFrame, wanted: pd.DataFrame, nearest: int) -> pd.DataFrame:
    return _nearest_rows(held.sort_values("vec_id"), wanted, nearest).drop(columns="row")


def nearest_neighbours(
    embeddings: DataFrame,
    queries: DataFrame | None = None,
    nearest: int = NEAREST,
    most_sample: int = MOST_SAMPLE,
    list_size: int = LIST_SIZE,
    part_rows: int = PART_ROWS,
    slot_queries: int = SLOT_QUERIES,
    boundary: float = BOUNDARY,
    target: float = TARGET,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance, double) for each row of ``queries``.

    ``embeddings`` and ``queries`` have vec_id and embedding (array of numbers); without ``queries`` the rows whose
    vec_id is divisible by 100 are asked. A query's own row is no candidate. Ties go to the smaller vec_id. Vectors
    that are null, empty, all zero, or hold null or non-finite components take no part, nor do rows with a null vec_id.
    Vectors of different lengths have no distance: only those of the most frequent length take part (of equally
    frequent ones the longest). Repeated rows of one vec_id count once (of several vectors of one vec_id, each is
    compared and the nearest counts). An empty table gives an empty result; other columns are not read.

    Lists are approximate, distances are exact. If no list that a query may search holds more than ``nearest`` different
    vec_ids, all lists are searched for it.
    """
    spark = embeddings.sparkSession
    vectors = pin(usable_vectors(embeddings).distinct(), "vectors")
    lengths = vectors.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    one_length = F.size("vector") == lengths["length"]
    vectors, rows = vectors.where(one_length), lengths["count"]
    asked = vectors.where("vec_id % 100 = 0") if queries is None else usable_vectors(queries).distinct().where(one_length)
    graph = fit_graph(vectors, rows, most_sample, list_size)
    ratio = math.inf
    if len(graph.centroids) >= FEW_LISTS:
        trials = trial_queries(asked)
        ratio = calibrated_ratio(graph, trials, exact_neighbours(vectors, trials, nearest), boundary, MOST_COPIES, target)
    shared = spark.sparkContext.broadcast(graph)

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found, distance = shared.value.nearest(_matrix(batch["vector"]))
            chosen = copies(distance, boundary, MOST_COPIES)
            at, which = np.nonzero(chosen)
            taken = pa.array(at)
            yield pa.record_batch(
                [pa.array(found[at, which], pa.int32()), batch["vec_id"].take(taken), batch["vector"].take(taken)],
                ["list", "vec_id", "vector"],
            )

    postings = pin(vectors.mapInArrow(post, "list int, vec_id long, vector array<double>"), "postings")
    sizes, different = np.zeros((2, len(graph.centroids)), np.int64)  # rows and vec_ids
    by_id = postings.groupBy("list", "vec_id").count().groupBy("list")
    for row in by_id.agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("ids")).collect():  # two numbers a centroid
        sizes[row["list"]], different[row["list"]] = row["rows"], row["ids"]
    bundles = -(-len(sizes) // TOGETHER)
    parts = np.maximum(1, -(-np.bincount(np.arange(len(sizes)) // TOGETHER, sizes, bundles).astype(np.int64) // part_rows))
    split = F.broadcast(spark.createDataFrame(list(enumerate(parts.tolist())), "bundle int, parts long"))
    bundle = F.floor(F.col("list") / TOGETHER).cast("int")
    postings = postings.withColumn("bundle", bundle).join(split, "bundle")
    postings = postings.withColumn("part", F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts"))).drop("parts")

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            if math.isinf(ratio):
                found, few = None, np.ones(len(batch), bool)
            else:
                found, distance = shared.value.nearest(_matrix(batch["vector"]), len(sizes), ratio)
                wanted = searched_lists(distance, ratio)
                few = np.where(wanted, different[found], 0).max(1) <= nearest  # one may be the query's own
            rows: list[tuple[int, int, int, list[int]]] = []
            for at in range(len(batch)):
                lists = np.arange(len(sizes)) if few[at] else np.sort(found[at, wanted[at]])
                head, count = runs(lists // TOGETHER)
                for first, n in zip(head.tolist(), count.tolist()):
                    own = int(lists[first]) // TOGETHER
                    rows += [(own, part, at, lists[first : first + n].tolist()) for part in range(int(parts[own]))]
            taken = pa.array([row[2] for row in rows], pa.int64())
            yield pa.record_batch(
                [
                    pa.array([row[0] for row in rows], pa.int32()),
                    pa.array([row[1] for row in rows], pa.int64()),
                    pa.array([row[3] for row in rows], pa.list_(pa.int32())),
                    batch["vec_id"].take(taken),
                    batch["vector"].take(taken),
                ],
                ["bundle", "part", "lists", "query_id", "query"],
            )

    probes = asked.repartition(max(2, spark.sparkContext.defaultParallelism), "vec_id").mapInArrow(
        probe, "bundle int, part long, lists array<int>, query_id long, query array<double>"
    )
    probes = pin(probes, "probes")
    # A bundle that many queries search is repeated once per slot of them, and only that one.
    counts = probes.where("part = 0").groupBy("bundle").count()
    slots = F.ceil(F.col("count") / slot_queries).cast("int")
    dealt = F.broadcast(pin(counts.select("bundle", slots.alias("slots")), "slots"))  # one row per bundle
    probes = probes.join(dealt, "bundle").withColumn("slot", F.pmod(F.xxhash64("query_id"), F.col("slots")).cast("int")).drop("slots")
    postings = postings.join(dealt, "bundle").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).drop("slots")
    hits = (
        postings.groupBy("bundle", "part", "slot")
        .cogroup(probes.groupBy("bundle", "part", "slot"))
        .applyInPandas(lambda held, wanted: _scan(held, wanted, nearest), "query_id long, vec_id long, score double")
    )
    single = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        single.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
