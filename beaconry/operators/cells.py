"""Exact nearest vectors from stored cells: most of the table is never read.

Vectors are scaled to length 1 and dealt to the nearest of a few centres (k-means);
each cell is a partition of the stored table. The distance of a vector from the
query is at least the centre's distance less the cell's radius, so cells are read
in the order of that bound until it exceeds the k-th distance found.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.functions.text import once
from beaconry.session import scratch_path
from beaconry.sources.tables import replace_table

#: Most numbers of all centres together, which the driver reads for every query: 64 MB.
MOST_NUMBERS = 8_000_000
#: What rounding may add to a bound, in units of distance.
SLACK = 1e-6
#: Cell of vectors without a direction (null, zero, or with components that are no numbers).
NOWHERE = -1
SPHERE = "_unit"


def _unit(vectors: DataFrame, vector: str) -> DataFrame:
    """``vectors`` with ``_unit``: scaled to length 1, null where there is no direction."""
    v = F.transform(vector, lambda x: x.cast("double"))
    total = F.aggregate(F.transform("_v", lambda x: x * x), F.lit(0.0), lambda a, x: a + x)
    held = once(once(vectors, "_v", v), "_sq", total)
    sound = F.col("_sq").isNotNull() & (F.col("_sq") > 0) & (F.col("_sq") < F.lit(float("inf")))
    return held.withColumn(SPHERE, F.when(sound, F.transform("_v", lambda x: x / F.sqrt("_sq")))).drop("_v", "_sq")


def build_cells(vectors: DataFrame, vector: str, path: str, cells: int, sample: int = 1_000_000, seed: int = 42) -> None:
    """Store all rows of ``vectors`` below ``path`` by cell, and the cells' centres and radii.

    The centres are fitted on about ``sample`` rows chosen by a hash (all, if fewer);
    every row is stored, and radii are those of all rows, so searches are exact
    whatever the centres. Rows without a direction get a cell of their own.
    """
    spark = vectors.sparkSession
    unit = _unit(vectors, vector)
    whole = unit.filter(F.col(SPHERE).isNotNull())
    n = whole.count()
    chosen = whole.filter(F.pmod(F.xxhash64(vector), F.lit(max(1, n // sample))) == 0)
    dense = chosen.select(array_to_vector(SPHERE).alias("features"))
    size = max(1, min(cells, chosen.count()))
    # k-means runs its rounds over a stored table.
    dense = replace_table(dense, scratch_path(spark, "unit-vectors"))
    centres = ([c.tolist() for c in KMeans(k=size, seed=seed, maxIter=10).fit(dense).clusterCenters()] if n else [])
    if len(centres) * len(centres[0] if centres else []) > MOST_NUMBERS:
        raise ValueError(f"centres of more than {MOST_NUMBERS} numbers are not read by the driver")
    shared = spark.sparkContext.broadcast(np.array(centres))

    @F.pandas_udf("struct<cell:int,distance:double>")
    def nearest(units):
        import pandas as pd

        cell, far = np.full(len(units), NOWHERE, np.int32), np.zeros(len(units))
        some = [k for k, u in enumerate(units) if u is not None]
        if some:
            x = np.stack([units.iloc[k] for k in some])
            square = (x ** 2).sum(1)[:, None] - 2 * x @ shared.value.T + (shared.value ** 2).sum(1)
            cell[some] = square.argmin(1)
            far[some] = np.sqrt(((x - shared.value[cell[some]]) ** 2).sum(1))
        return pd.DataFrame({"cell": cell, "distance": far})

    dealt = unit.withColumn("_near", nearest(SPHERE)).select("*", "_near.*").drop("_near", SPHERE)
    # A cell's rows may fill many files; their number follows the data.
    dealt.repartition("cell", F.pmod(F.xxhash64(vector), F.lit(1 + n // 1_000_000))).drop("distance").write.partitionBy("cell").parquet(f"{path}/rows")
    far = dealt.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame(list(enumerate(centres)), "cell int, centre array<double>")
    far.join(F.broadcast(known), "cell", "left").write.parquet(f"{path}/cells")


def nearest_in_cells(spark: SparkSession, path: str, key: str, vector: str, query: list[float], k: int,
                     columns: list[str] = (), digits: int = 6, first: int = 4) -> tuple[DataFrame, int, int]:
    """The ``k`` rows of highest cosine with ``query`` (rounded; ties by key; rows without a
    direction last), how many cells were read, and how many there are."""
    rows = spark.read.parquet(f"{path}/rows")
    cells = spark.read.parquet(f"{path}/cells").collect()  # at most MOST_NUMBERS numbers
    q = np.array(query, dtype=float)
    q = q / np.sqrt((q ** 2).sum())
    bounds = sorted((max(0.0, float(np.sqrt(((q - r["centre"]) ** 2).sum())) - r["radius"]) if r["centre"] else np.inf, r["cell"])
                    for r in cells)
    cosine = F.aggregate(F.zip_with(SPHERE, F.array(*[F.lit(float(v)) for v in q]), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)

    def top(visited: list[int]) -> DataFrame:
        scored = _unit(rows.filter(F.col("cell").isin(visited)), vector).select(
            key, *columns, F.round(cosine, digits).alias("vector_score"))
        return scored.orderBy(F.desc_nulls_last("vector_score"), key).limit(k)

    read = first
    while True:
        visited = [c for _, c in bounds[:read]]
        found = [r["vector_score"] for r in top(visited).select("vector_score").collect()]
        if len(found) == k and found[-1] is not None:
            # Rounding may have taken half a unit of the last digit.
            reach = np.sqrt(max(0.0, 2 - 2 * (found[-1] - 0.5 * 10.0 ** -digits))) + SLACK
            need = sum(b <= reach for b, _ in bounds)
        else:
            need = len(bounds)
        if need <= read:
            return top(visited), min(read, len(bounds)), len(bounds)
        read = min(need, 4 * read)


def cells_for(n: int) -> int:
    """About the square root of the number of rows."""
    return max(1, min(65_536, int(n ** 0.5)))
