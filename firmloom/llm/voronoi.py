"""Exact top-k by inner product as a Voronoi kNN join.

Inner products become distances: with one more coordinate sqrt(M^2 - |x|^2), M the
largest norm, all vectors have the same length, and the nearest neighbours of a query
(whose extra coordinate is 0) are those with the highest inner products. Pivots cut
the space into cells. Per cell, a summary (count, range of distances to the pivot,
smallest distances) gives an upper bound on the distance of each query's k-th neighbour.
A query goes only to cells that may hold something nearer: neither the range of distances to the
cell's pivot nor the plane between its own pivot and that one may be farther than the bound. Of a
cell, only vectors at distances that some query still asks for are sent. Cells are solved
locally and the short lists merged.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmloom.llm.common import stored

#: Rounding of distances may not cut a tie: bounds are widened by this share.
SLACK = 1e-6


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id long, vec array<double>): rows with an id whose vector has only finite components."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(whole, F.lit(False))
    )


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _distances(rows: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    full = np.column_stack([rows, extra])
    square = (full**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def knn_join(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    pivots: int = 32,
    slice_rows: int = 8192,
    query_rows: int = 4096,
) -> DataFrame:
    """The `k` vectors of highest inner product for each query, its own id left out.

    `vectors` and `queries` hold (vec_id, vec); `finite_vectors` makes such tables. Returns
    (query_id, rank from 1, vec_id, score double), ties to the smaller vec_id. `pivots` bounds
    what the driver sees (that many vectors and pivots * (k + 1) distances), `slice_rows` and
    `query_rows` the rows of one local problem: larger cells are cut into slices. Repeated ids
    count as one, the smallest vector; shorter vectors are filled with zeros. Fewer than k
    candidates give all of them; empty tables give an empty result.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    vectors = vectors.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    queries = queries.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    dim, most = vectors.agg(F.max(F.size("vec")), F.max(norm)).first()
    longest, n_queries = queries.agg(F.max(F.size("vec")), F.count("*")).first()
    if most is None or not n_queries:
        return spark.createDataFrame([], result)
    dim = max(dim, longest)
    chosen = vectors.orderBy(F.xxhash64(F.lit(17), "vec_id"), "vec_id").limit(pivots).toPandas()
    rows = _matrix(chosen["vec"], dim)
    centres = np.column_stack([rows, np.sqrt(np.maximum(most - (rows**2).sum(1), 0))])

    def assign(is_query: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                m = _matrix(frame["vec"], dim)
                extra = np.zeros(len(m)) if is_query else np.sqrt(np.maximum(most - (m**2).sum(1), 0))
                d = _distances(m, extra, centres)
                cell = d.argmin(1)
                yield frame.assign(cell=cell.astype(np.int32), dist=d[np.arange(len(m)), cell])

        return run

    layout = "vec_id long, vec array<double>, cell int, dist double"
    data = stored(vectors.mapInPandas(assign(False), layout), "cells")
    asked = stored(queries.mapInPandas(assign(True), layout), "queries")

    # Summaries: k + 1 distances a cell, since a query's own row may be among them.
    nearest = Window.partitionBy("cell").orderBy("dist")
    summary = (
        data.select("cell", "dist")
        .withColumn("n", F.row_number().over(nearest))
        .where(F.col("n") <= k + 1)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("dist")).alias("near"))
        .collect()
    )
    ranges = {r["cell"]: r for r in data.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()}
    cells = sorted(ranges)
    low, high = (np.array([ranges[c][x] for c in cells]) for x in ("low", "high"))
    near = np.full((len(cells), k + 1), np.inf)
    for r in summary:
        near[cells.index(r["cell"]), : len(r["near"])] = r["near"]
    apart = _distances(centres[:, :-1], centres[:, -1], centres)[:, cells]
    cuts = {c: -(-ranges[c]["n"] // slice_rows) for c in cells}
    blocks = -(-n_queries // query_rows)

    def bounds(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances of queries to the cells' pivots, bounds on their k-th neighbours, and whether a
        cell may hold something nearer."""
        m = _matrix(frame["vec"], dim)
        d = _distances(m, np.zeros(len(m)), centres[cells])
        own, cell = frame["dist"].to_numpy()[:, None], frame["cell"].to_numpy()
        upper = (d[:, :, None] + near[None]).reshape(len(m), -1)
        kth = np.partition(upper, k, axis=1)[:, k : k + 1] if upper.shape[1] > k else np.full((len(m), 1), np.inf)
        kth = kth * (1 + SLACK) + SLACK
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.nan_to_num((d**2 - own**2) / (2 * apart[cell]), nan=0.0, posinf=0.0, neginf=0.0)
        farther = np.maximum(np.maximum(d - high, low - d), plane * (1 - SLACK) - SLACK)
        return d, kth, farther <= kth

    def wanted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            d, kth, may = bounds(frame)
            yield pd.DataFrame({
                "cell": np.array(cells, dtype=np.int32), "least": np.where(may, d - kth, np.inf).min(axis=0),
                "largest": np.where(may, d + kth, -np.inf).max(axis=0), "n": may.sum(axis=0),
            })

    # Distances to its pivot that queries ask a cell for: at most a row a pivot.
    span = asked.mapInPandas(wanted, "cell int, least double, largest double, n long").groupBy("cell").agg(
        F.min("least").alias("least"), F.max("largest").alias("largest"), F.sum("n").alias("n")
    ).collect()
    least, largest = np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    for r in span:
        least[r["cell"]], largest[r["cell"]] = r["least"], r["largest"]
    went = sum(r["n"] for r in span) / (n_queries * len(cells))
    logging.getLogger(__name__).info("%.3f of all pairs of query and cell are skipped", 1 - went)

    def route_data(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell = frame["cell"].to_numpy()
            keep = (frame["dist"] >= least[cell]) & (frame["dist"] <= largest[cell])
            yield frame[keep].assign(
                slice=(frame["vec_id"].abs() % frame["cell"].map(cuts))[keep].astype(np.int32)
            )[["vec_id", "vec", "cell", "slice"]]

    def route_queries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            may = bounds(frame)[2]
            for j, cell in enumerate(cells):
                part = frame.loc[may[:, j], ["vec_id", "vec"]]
                for s in range(cuts[cell] if len(part) else 0):
                    yield part.assign(cell=np.int32(cell), slice=np.int32(s))

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    right = data.mapInPandas(route_data, "vec_id long, vec array<double>, cell int, slice int").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    left = asked.mapInPandas(route_queries, "vec_id long, vec array<double>, cell int, slice int").select(
        "*", block.alias("block")
    )

    def solve(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        d = d.sort_values("vec_id")
        ids, asked_ids = d["vec_id"].to_numpy(), q["vec_id"].to_numpy()
        m, w = _matrix(d["vec"], dim), _matrix(q["vec"], dim)
        out = []
        for at in range(0, len(w), 512):
            own = asked_ids[at : at + 512]
            scores = w[at : at + 512] @ m.T
            scores[own[:, None] == ids[None, :]] = -np.inf
            # ids ascend, so a stable sort of the negated scores leaves ties to the smaller id
            if len(ids) > k:
                cut = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                who, what = np.nonzero((scores >= cut[:, None]) & (scores > -np.inf))
            else:
                who, what = np.nonzero(scores > -np.inf)
            s = scores[who, what]
            order = np.lexsort((ids[what], -s, who))
            who, what, s = who[order], what[order], s[order]
            first = np.searchsorted(who, who)
            top = np.arange(len(who)) - first < k
            out.append(pd.DataFrame({"query_id": own[who[top]], "vec_id": ids[what[top]], "score": s[top]}))
        return pd.concat(out)

    keys = ["cell", "slice", "block"]
    local = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(solve, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
