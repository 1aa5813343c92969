"""Exact nearest-neighbour join over a pivot index.

Reference rows belong to the cell of their nearest pivot; a cell is cut into rings by
distance to the pivot, and (cell, ring) is a unit. A query row first meets one unit near it,
which gives an upper bound on its k-th distance. It then visits only the units whose lower
bound is not above that. Three bounds hold in every metric, with u the distance from the query to
the unit's pivot, c the one to its nearest pivot and [lo, hi] the ring:

    d >= u - hi        d >= lo - u        d >= (u - c) / 2

The last one because a row of the cell is no farther from its own pivot than from any other.
Bounds are loosened by 1e-9 of their terms, so rounding can't lose a neighbour or a tie.

The driver holds ``max_pivots`` vectors and ``max_units`` unit records, at any table size. Units
that grow beyond ``block_rows`` are read in slices, and so are the queries that visit one unit, so a
task holds two blocks even where one cell holds a third of all rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.operators.distance import _CHUNK, INDEX_DIMS, _matrix, block_size, nearest_in_block, pair_distances
from segmetric.sources.tables import kernel_partitions, spread

_FOUND = "query_id long, vec array<double>, home int, tau double, visits array<int>, near array<long>, dist array<double>"


@dataclass
class PivotIndex:
    """``rows`` is (id, vec, unit); unit u lies in cell ``cell[u]``, holds ``n[u]`` rows at
    distances ``lo[u]``..``hi[u]`` from the pivot."""

    rows: DataFrame | None
    pivots: np.ndarray
    cell: np.ndarray
    n: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    p: int
    block_rows: int

    def slices(self) -> np.ndarray:
        return np.maximum(1, -(-self.n // self.block_rows))

    def first_pass(self, query: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
        """One row a query: its bound ``tau`` on the k-th distance, what the first slice of unit
        ``home`` holds (``near``, ``dist``) and the units that it has to visit."""
        spark = query.sparkSession
        pivots, cell, n, lo, hi, p = self.pivots, self.cell, self.n, self.lo, self.hi, self.p
        need = k + 1 if exclude_self else k

        def upper(d):
            """(bound on the k-th distance, unit that gives it or is near) of pivot distances."""
            up = d[:, cell] + hi
            up[np.isnan(up)] = np.inf
            whole = n >= need
            if whole.any():
                up[:, ~whole] = np.inf
                at = np.argmin(up, axis=1)
                return up[np.arange(len(d)), at], at
            order = np.argsort(up, axis=1, kind="stable")
            enough = np.cumsum(n[order], axis=1) >= need
            last = np.where(enough.any(axis=1), enough.argmax(axis=1), 0)
            bound = np.take_along_axis(up, np.take_along_axis(order, last[:, None], 1), 1)[:, 0]
            return np.where(enough.any(axis=1), bound, np.inf), order[:, 0]

        step = max(1, _CHUNK // max(1, len(cell)))

        def send_home(batches):
            for b in batches:
                x = _matrix(b["vec"])
                at = [upper(pair_distances(x[s:s + step], pivots, p))[1] for s in range(0, len(x), step)]
                yield b.assign(unit=np.concatenate(at) if at else np.zeros(0, int))

        sent = spread(query.where(F.col("vec").isNotNull()).select(F.col("id").alias("query_id"), "vec")).mapInPandas(
            send_home, "query_id long, vec array<double>, unit int").checkpoint(eager=True)
        left, right, groups = self._dealt(sent.withColumn("slice", F.lit(0)), self.rows_in_slices().where("slice = 0"))

        def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            x, ids = _matrix(left["vec"]), left["query_id"].to_numpy()
            near, dist, tau, visits = [], [], [], []
            rid, y = right["id"].to_numpy(), _matrix(right["vec"])
            for s in range(0, len(x), step):
                at = x[s:s + step]
                d = pair_distances(at, pivots, p)
                bound = upper(d)[0] * (1 + 1e-9)
                if len(rid):
                    of, to, far = nearest_in_block(ids[s:s + step], at, rid, y, k, p, exclude_self)
                    cuts = np.searchsorted(of, np.arange(len(at) + 1))
                    for i in range(len(at)):
                        a, b = cuts[i], cuts[i + 1]
                        near.append(to[a:b])
                        dist.append(far[a:b])
                        if b - a == k:
                            bound[i] = min(bound[i], far[b - 1])
                else:
                    near += [np.zeros(0, int)] * len(at)
                    dist += [np.zeros(0)] * len(at)
                u = d[:, cell]
                own = d.min(axis=1)[:, None]
                with np.errstate(invalid="ignore"):
                    least = np.maximum(np.maximum(u - hi, lo - u), (u - own) / 2)
                    out = least > bound[:, None] + 1e-9 * (u + hi)  # false for what is no number: visited
                out |= n == 0
                visits += [np.flatnonzero(~o) for o in out]
                tau += list(bound)
            return pd.DataFrame({"query_id": ids, "vec": left["vec"], "home": int(key[0]), "tau": tau, "visits": visits,
                                 "near": near, "dist": dist})

        n_parts = kernel_partitions(spark, groups)
        keys = ["unit", "slice", "part"]
        return left.repartition(n_parts, *keys).groupBy(*keys).cogroup(
            right.repartition(n_parts, *keys).groupBy(*keys)).applyInPandas(_with_left(meet, _FOUND), _FOUND).checkpoint(eager=True)

    def knn(self, query: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
        """k nearest indexed rows of every query row: (query_id, neighbor_id, distance, rank), ties to the
        smaller id. Ids are unique on each side; rows without a vector take no part, and neither do
        pairs without a finite distance. An empty side gives no rows."""
        spark, p = query.sparkSession, self.p
        schema = "query_id long, neighbor_id long, distance double"
        if self.rows is None or k < 1:
            return spark.createDataFrame([], schema + ", rank int")
        found = self.first_pass(query, k, exclude_self)
        first = found.select("query_id", F.explode(F.arrays_zip("near", "dist")).alias("r")).select(
            "query_id", F.col("r.near").alias("neighbor_id"), F.col("r.dist").alias("distance"))
        slices = self._unit_table(spark, self.slices(), "n_slices")
        ask = found.select("query_id", "vec", "tau", "home", F.explode("visits").alias("unit")).join(slices, "unit").select(
            "query_id", "vec", "tau", "unit", "home", F.explode(F.sequence(F.lit(0), F.col("n_slices") - 1)).alias("slice"))
        ask = ask.where((F.col("unit") != F.col("home")) | (F.col("slice") != 0)).drop("home")
        left, right, groups = self._dealt(ask, self.rows_in_slices())

        def rest(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if right.empty:
                return pd.DataFrame({"query_id": [], "neighbor_id": [], "distance": []})
            ids = left["query_id"].to_numpy()
            of, to, far = nearest_in_block(ids, _matrix(left["vec"]), right["id"].to_numpy(), _matrix(right["vec"]), k, p, exclude_self)
            ok = far <= left["tau"].to_numpy()[of]
            return pd.DataFrame({"query_id": ids[of[ok]], "neighbor_id": to[ok], "distance": far[ok]})

        n_parts = kernel_partitions(spark, groups)
        keys = ["unit", "slice", "part"]
        more = left.repartition(n_parts, *keys).groupBy(*keys).cogroup(
            right.repartition(n_parts, *keys).groupBy(*keys)).applyInPandas(_with_left(rest, schema), schema)
        w = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
        return first.unionByName(more).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    def rows_in_slices(self) -> DataFrame:
        """(id, vec, unit, slice), each slice of about ``block_rows`` rows."""
        slices = self._unit_table(self.rows.sparkSession, self.slices(), "n_slices")
        return self.rows.join(slices, "unit").select(
            "id", "vec", "unit", F.pmod(F.xxhash64("id"), F.col("n_slices")).cast("int").alias("slice"))

    def _unit_table(self, spark, values: np.ndarray, name: str) -> DataFrame:
        """(unit, value), at most ``max_units`` rows."""
        return F.broadcast(spark.createDataFrame([(i, int(v)) for i, v in enumerate(values)], f"unit int, {name} int"))

    def _dealt(self, ask: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
        """Both sides with ``part``: the queries that meet one unit are dealt to parts of about
        ``block_rows``, and the unit's rows are copied to each part that has queries."""
        seen = ask.groupBy("unit", "slice").count().groupBy("unit").agg(F.max("count").alias("count")).collect()
        parts = np.zeros(len(self.n), int)
        for r in seen:
            parts[r["unit"]] = -(-r["count"] // self.block_rows)
        table = self._unit_table(ask.sparkSession, parts, "n_parts")
        left = ask.join(table, "unit").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("n_parts")).cast("int"))
        right = rows.join(table.where("n_parts > 0"), "unit").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        return left.drop("n_parts"), right.drop("n_parts"), max(1, int((parts * self.slices()).sum()))


def _with_left(kernel, schema: str):
    """The kernel, with no output for a group without queries."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({c: [] for c in names}) if left.empty else kernel(key, left, right)

    return run


def pivot_index(ref: DataFrame, p: int = 2, block_rows: int = 512, max_pivots: int = 512, max_units: int = 16_384) -> PivotIndex:
    """Index of (id, vec). Pivots are the rows of smallest id hash, one for every ``block_rows`` rows
    up to ``max_pivots``; every row is indexed. In many dimensions, where bounds prune little, units are larger
    on larger tables (``block_size``), so that rows are copied to fewer of them."""
    ref = ref.where(F.col("vec").isNotNull()).select("id", "vec")
    spark = ref.sparkSession
    none = np.zeros(0)
    count = ref.count()
    if not count:
        return PivotIndex(None, none, none, none, none, none, p, block_rows)
    if ref.select(F.size("vec").alias("n")).first()["n"] > INDEX_DIMS:
        block_rows = block_size(count, block_rows)
    m = min(max_pivots, math.ceil(count / block_rows))
    chosen = ref.select(F.xxhash64("id").alias("h"), "id", "vec").orderBy("h", "id").limit(m).collect()
    pivots = np.array([r["vec"] for r in chosen], dtype=np.float64)

    def place(batches):
        for b in batches:
            d = pair_distances(_matrix(b["vec"]), pivots, p)
            cell = np.argmin(np.where(np.isnan(d), np.inf, d), axis=1)
            yield b.assign(cell=cell, far=d[np.arange(len(d)), cell])

    placed = spread(ref).mapInPandas(place, "id long, vec array<double>, cell int, far double").checkpoint(eager=True)
    stats = [F.count(F.lit(1)).alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")]
    rings, first, cells = [], 0, []
    for r in sorted(placed.groupBy("cell").agg(*stats).collect(), key=lambda r: r["cell"]):
        width = r["hi"] - r["lo"]
        k = min(max(1, max_units // m), math.ceil(r["n"] / block_rows)) if math.isfinite(width) and width > 0 else 1
        rings.append((r["cell"], first, k, r["lo"], width if k > 1 else 1.0))
        cells += [r["cell"]] * k
        first += k
    table = F.broadcast(spark.createDataFrame(rings, "cell int, first int, k int, lo double, width double"))
    ring = F.floor((F.col("far") - F.col("lo")) / F.col("width") * F.col("k")).cast("int")
    ring = F.when(F.col("k") > 1, F.greatest(F.lit(0), F.least(F.col("k") - 1, ring))).otherwise(0)
    rows = placed.join(table, "cell").select("id", "vec", "far", (F.col("first") + ring).alias("unit"))
    n, lo, hi = np.zeros(first, np.int64), np.zeros(first), np.zeros(first)
    for r in rows.groupBy("unit").agg(*stats).collect():
        u = r["unit"]
        n[u] = r["n"]
        lo[u], hi[u] = (r["lo"], r["hi"]) if math.isfinite(r["hi"]) else (0.0, np.inf)
    return PivotIndex(rows.drop("far"), pivots, np.array(cells, int), n, lo, hi, p, block_rows)
