"""Approximate nearest neighbours by inner product, abandoning candidates early.

Vectors get one more component that makes their lengths equal, so that the largest inner
product is the smallest distance; a random rotation then spreads a distance evenly over
the components. Lists of neighbouring vectors are probed nearest first. Within a list,
columns are added block by block, and a candidate whose partial distance, scaled to all
columns, is beyond the query's bound by more than chance allows is given up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 20
SAMPLE_ROWS = 8192
CHUNK_ROWS = 2048
QUERY_ROWS = 4096
COLUMNS = 16
DOUBT = 2.1
RECALL = 0.97
# Share of live pairs from which on only these are looked at.
SPARSE = 0.1
ROUNDING = 1e-4
# If the longest vector's squared length is so many times the median, distances are added up
# in double, as single precision would no longer tell candidates apart.
UNEVEN = 100
# Pairs whose exact products are taken at a time.
PAIRS = 1 << 16


@dataclass(frozen=True)
class Index:
    """What tasks need to know; its size is bounded by the sample's."""

    rotation: np.ndarray
    centroids: np.ndarray
    length2: float  # the largest squared length
    probes: int
    sample_ids: np.ndarray
    sample: np.ndarray

    def turned(self, rows: np.ndarray, as_query: bool) -> np.ndarray:
        rest = np.zeros(len(rows)) if as_query else np.sqrt(
            np.maximum(self.length2 - (rows ** 2).sum(axis=1), 0))
        return np.column_stack([rows, rest]) @ self.rotation

    def order(self, turned: np.ndarray) -> np.ndarray:
        """Lists by distance, nearest first."""
        far = (self.centroids ** 2).sum(axis=1) - 2 * turned @ self.centroids.T
        return np.argsort(far, axis=1, kind="stable")


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` of rows whose vector is whole, finite and not zero."""
    v = F.col("embedding")
    good = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.where(v.isNotNull() & F.col("vec_id").isNotNull()).where(
        good & F.exists(v, lambda x: x != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, equal for equal rows."""
    return (left * right).sum(axis=1)


def allowance(squares: np.ndarray | float, kind: type) -> np.ndarray:
    """What rounding may add to a distance, given both squared lengths' sum."""
    return np.maximum(ROUNDING, 2 * COLUMNS * np.finfo(kind).eps * np.asarray(squares))


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the largest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:most]


def fit(vectors: DataFrame, nearest: int, *, sample_rows: int = SAMPLE_ROWS,
        recall: float = RECALL, seed: int = 3) -> Index | None:
    """Lists from at most ``sample_rows`` vectors, the first by hash; None without vectors.

    The lists grow as the root of the table. How many to probe follows from the
    sample's own neighbours: as many as hold ``recall`` of them.
    """
    rows, length2 = vectors.agg(
        F.count(F.lit(1)), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not rows:
        return None
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    ids, sample = drawn["vec_id"].to_numpy(), np.stack(drawn["vector"].to_list())
    wide = sample.shape[1] + 1
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(wide, wide)))[0]
    blank = Index(rotation, np.zeros((1, wide)), length2 * (1 + 1e-12), 1, ids, sample)
    lists = int(np.clip(np.sqrt(rows) / 4, 1, min(1024, len(sample) / 8 + 1)))
    turned = blank.turned(sample, False)
    centroids = turned[:lists].copy()
    for _ in range(10):
        home = Index(rotation, centroids, length2, 1, ids, sample).order(turned)[:, 0]
        for i in range(lists):
            if (home == i).any():
                centroids[i] = turned[home == i].mean(axis=0)
    whole = Index(rotation, centroids, length2 * (1 + 1e-12), lists, ids, sample)
    home = whole.order(turned)[:, 0]
    asked = np.arange(min(256, len(sample)))
    found = sample[asked] @ sample.T
    found[asked, asked] = -np.inf
    near = np.argsort(-found, axis=1)[:, :nearest]
    place = np.argsort(whole.order(whole.turned(sample[asked], True)), axis=1)
    needed = np.sort(np.take_along_axis(place, home[near], axis=1), axis=None)
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1
    return Index(rotation, centroids, whole.length2, min(lists, probes), ids, sample)


def scan(index: Index, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray,
         ids: np.ndarray, vectors: np.ndarray, nearest: int) -> pd.DataFrame:
    """Each query's best candidates of one list part that reach the query's bound."""
    kind = np.float64 if index.length2 > UNEVEN * np.median((index.sample ** 2).sum(axis=1)) else np.float32
    turned = index.turned(vectors, False).astype(kind)
    asked = index.turned(queries, True).astype(kind)
    squares = (queries ** 2).sum(axis=1) + index.length2
    spare = allowance(squares, kind).astype(kind)
    limit = (squares - 2 * bounds).astype(kind)
    wide = turned.shape[1]
    partial = np.zeros((len(asked), len(turned)), dtype=kind)
    alive = np.ones(partial.shape, dtype=bool)
    pairs = None
    for first in range(0, wide, COLUMNS):
        last = min(first + COLUMNS, wide)
        q, x = asked[:, first:last], turned[:, first:last]
        # The hypothesis that a candidate is within the bound, given `last` columns.
        most = limit * (last / wide) * (1 + DOUBT / np.sqrt(last)) ** 2 if last < wide else limit
        most = most + spare
        if pairs is None:
            partial += (q ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1) - 2 * (q @ x.T)
            alive &= partial <= most[:, None]
            if alive.mean() < SPARSE or last == wide:
                pairs = np.nonzero(alive)
                held = partial[pairs]
        else:
            held = held + ((q[pairs[0]] - x[pairs[1]]) ** 2).sum(axis=1)
            keep = held <= most[pairs[0]]
            pairs, held = (pairs[0][keep], pairs[1][keep]), held[keep]
    of, at = pairs
    other = ids[at] != query_ids[of]
    of, at = of[other], at[other]
    scores = np.concatenate([np.zeros(0), *[
        products(vectors[at[i:i + PAIRS]], queries[of[i:i + PAIRS]])
        for i in range(0, len(of), PAIRS)]])
    near = scores >= bounds[of]
    of, at, scores = of[near], at[near], scores[near]
    order = np.lexsort((ids[at], -scores, of))
    of, at, scores = of[order], at[order], scores[order]
    top = np.arange(len(of)) - np.searchsorted(of, of, "left") < nearest
    return pd.DataFrame({"query_id": query_ids[of[top]], "vec_id": ids[at[top]],
                         "score": scores[top]})


def search(vectors: DataFrame, queries: DataFrame, *, nearest: int = NEAREST,
           chunk_rows: int = CHUNK_ROWS, query_rows: int = QUERY_ROWS,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The ``nearest`` found rows of ``vectors`` for each row of ``queries``.

    Both have ``vec_id`` and ``embedding``. Returns ``query_id``, ``rank`` from 1,
    ``vec_id`` and ``score``, the inner product in double precision on the original
    vectors; ties go to smaller ids. A query does not find rows of its own id. Rows
    without an id, and vectors that are null, zero, or hold null or non-finite
    components, take no part, nor do vectors of another dimension than the most
    frequent. A query id that repeats is asked once. Other columns are not looked at.

    The index is fitted to a bounded sample and holds every row. A query starts with
    its nearest in the sample, which bound what the lists need to return; so a query
    finds as many as there are, up to ``nearest``. A list is cut into parts of about
    ``chunk_rows`` rows, and queries into blocks, so no vector that repeats makes a
    large group; a part returns ``nearest`` rows per query at most.
    """
    spark = vectors.sparkSession
    whole = usable(vectors)
    sizes = whole.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "d").first()
    dimension = common["d"] if common else 0
    whole = whole.where(F.size("vector") == dimension)
    asked = usable(queries).where(F.size("vector") == dimension).dropDuplicates(["vec_id"])
    result = "query_id long, vec_id long, score double"
    index = fit(whole, nearest, sample_rows=sample_rows)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    held = spark.sparkContext.broadcast(index)

    @F.pandas_udf("int")
    def home(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype="int32")
        turned = held.value.turned(np.stack(column.to_list()), False)
        return pd.Series(held.value.order(turned)[:, 0].astype(np.int32))

    @F.pandas_udf("bound double, lists array<int>, first array<struct<vec_id:long,score:double>>")
    def opening(id_: pd.Series, column: pd.Series) -> pd.DataFrame:
        known, rows = held.value, []
        lists = known.order(known.turned(np.stack(column.to_list()), True))[:, :known.probes] \
            if len(column) else []
        for own, vector, probed in zip(id_, column, lists):
            others = np.flatnonzero(known.sample_ids != own)
            rough = known.sample[others] @ vector
            if len(rough) > nearest:
                least = np.partition(rough, -nearest)[-nearest]
                spare = allowance(known.length2 + float((np.asarray(vector) ** 2).sum()), np.float64)
                others = others[rough >= least - spare]
            scores = products(known.sample[others], np.asarray(vector)[None, :])
            ids = known.sample_ids[others]
            top = best(scores, ids, nearest)
            bound = float(scores[top[-1]]) if len(top) == nearest else -np.inf
            rows.append((bound, probed.tolist(), [
                {"vec_id": int(i), "score": float(s)} for i, s in zip(ids[top], scores[top])]))
        return pd.DataFrame(rows, columns=["bound", "lists", "first"])

    listed = whole.withColumn("list", home("vector"))
    counts = {r["list"]: r["n"] for r in
              listed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    lists = len(index.centroids)
    parts = F.array(*[F.lit(-(-counts.get(i, 0) // chunk_rows)) for i in range(lists)])
    blocks = max(1, -(-asked.count() // query_rows))
    mixed = F.xxhash64("vec_id", F.lit(5))
    in_parts = listed.withColumn("part", F.pmod(mixed, F.element_at(parts, F.col("list") + 1)))
    in_parts = in_parts.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    opened = asked.withColumn("_open", opening("vec_id", "vector")).select(
        "vec_id", "vector", "_open.*")
    probing = opened.select("vec_id", "vector", "bound", F.explode("lists").alias("list"),
                            F.pmod(mixed, F.lit(blocks)).cast("int").alias("block"))
    probing = probing.where(F.element_at(parts, F.col("list") + 1) > 0).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("list") + 1) - 1)))

    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"),
                                 "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        return scan(held.value, queries["vec_id"].to_numpy(), np.stack(queries["vector"].to_list()),
                    queries["bound"].to_numpy(), rows["vec_id"].to_numpy(),
                    np.stack(rows["vector"].to_list()), nearest)

    keys = ["list", "part", "block"]
    cast = [F.col(k).cast("long").alias(k) for k in keys]
    found = probing.select("vec_id", "vector", "bound", *cast).groupBy(*keys).cogroup(
        in_parts.select("vec_id", "vector", *cast).groupBy(*keys)).applyInPandas(compare, result)
    first = opened.select(F.col("vec_id").alias("query_id"), F.explode("first").alias("f")).select(
        "query_id", "f.vec_id", "f.score")
    # A row of the sample is found twice.
    each = found.unionByName(first).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(ranked)).where(
        F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
