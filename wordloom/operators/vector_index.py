"""A stored inverted-file index over word vectors, with exact answers.

Unit vectors are dealt to cells by their nearest centroid, and a cell knows
its radius, the largest distance of its vectors from the centroid.  A vector
of a cell is at least (distance of the query from the centroid - radius) away
from the query, which bounds its cosine; cells are read in the order of that
bound until none that is left can hold a better word.  Rows lie in one folder
per cell, words in one folder per bucket of their hash, so a question opens
only the folders it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C

#: Cells at most: their centroids come to the driver with every question.
MAX_CELLS = 4096
#: The cell of vectors without direction (all zero); it is read last.
NO_CELL = -1


def _centroids(sample, cells: int, rounds: int):
    import numpy as np

    centres = sample[:cells].copy()
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(1)
        for j in range(len(centres)):
            mine = sample[near == j]
            if len(mine):
                centres[j] = mine.mean(0)
    return centres


class VectorIndex:
    """The index stored at ``path``; ``cells_read`` tells how many cells the
    last question opened."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.cells_read = spark, path.rstrip("/"), 0
        rows = spark.read.parquet(f"{self.path}/cells").collect()  # at most MAX_CELLS + 1
        self.cells = {r.cell: (r.centre, r.radius, r.n) for r in rows}
        self.buckets = spark.read.parquet(f"{self.path}/shape").first().buckets

    @classmethod
    def build(cls, vectors: DataFrame, path: str, cells: int | None = None, rounds: int = 4, sample: int = 20_000) -> VectorIndex:
        """Index ``vectors (word, vector)``.  The centroids are fitted on at
        most ``sample`` vectors (the smallest hashes of the word); every row
        is indexed.  About the square root of the rows is the number of cells."""
        import numpy as np
        import pyarrow as pa

        spark, path = vectors.sparkSession, path.rstrip("/")
        n = vectors.count()
        cells = min(MAX_CELLS, cells or max(1, round(n ** 0.5)))
        units = vectors.select("word", "vector", C.unit_vector("vector").alias("u"))
        solid = units.filter(F.col("u").isNotNull() & ~F.exists("u", lambda x: x.isNull() | F.isnan(x)))
        few = solid.orderBy(F.xxhash64("word"), "word").limit(max(cells, sample)).select("u").toArrow().column("u").to_pylist()
        centres = _centroids(np.array(few, np.float64).reshape(len(few), -1), cells, rounds)
        held = spark.sparkContext.broadcast(centres)

        def assign(batches):
            for batch in batches:
                cell, far = np.full(batch.num_rows, NO_CELL, np.int32), np.zeros(batch.num_rows)
                units = batch.column("u").to_pylist()
                at = [i for i, u in enumerate(units) if u is not None and all(x is not None and x == x for x in u)]
                if at:
                    u = np.array([units[i] for i in at], np.float64)
                    near = ((u ** 2).sum(1)[:, None] - 2 * u @ held.value.T + (held.value ** 2).sum(1)).argmin(1)
                    cell[at], far[at] = near, np.sqrt(((u - held.value[near]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("vector"), pa.array(cell), pa.array(far)],
                                                 names=["word", "vector", "cell", "far"])

        dealt = units.mapInArrow(assign, "word string, vector array<double>, cell int, far double")
        # a full cell is several files, none holds the rows of more than one
        (dealt.repartition(F.col("cell"), F.pmod(F.xxhash64("word"), F.lit(8))).sortWithinPartitions("cell")
         .write.partitionBy("cell").parquet(f"{path}/rows"))
        rows = spark.read.parquet(f"{path}/rows")
        size = rows.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n"))
        middle = spark.createDataFrame([(j, c.tolist()) for j, c in enumerate(centres)] + [(NO_CELL, [])], "cell int, centre array<double>")
        size.join(F.broadcast(middle), "cell").coalesce(1).write.parquet(f"{path}/cells")
        bucket = F.pmod(F.xxhash64("word"), F.lit(cells)).cast("int").alias("bucket")
        rows.select("word", "vector", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/words")
        spark.createDataFrame([(cells,)], "buckets int").coalesce(1).write.parquet(f"{path}/shape")
        return cls(spark, path)

    def vectors(self, words: Sequence[str]) -> DataFrame:
        """The rows of some words, from their buckets only."""
        asked = self.spark.createDataFrame([(w,) for w in words], "word string")
        buckets = [r[0] for r in asked.select(F.pmod(F.xxhash64("word"), F.lit(self.buckets)).cast("int")).distinct().collect()]
        held = self.spark.read.parquet(f"{self.path}/words")
        return held.filter(F.col("bucket").isin(buckets) & F.col("word").isin(list(words))).select("word", "vector")

    def _read(self, cells: list[int], q: list[float], exclude: Sequence[str]) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/rows").filter(F.col("cell").isin(cells))
        return (rows.filter(~F.col("word").isin(list(exclude)))
                .select("word", C.cosine("vector", F.array(*[F.lit(float(x)) for x in q])).alias("similarity")))

    def nearest(self, q: Sequence[float], n: int = 10, exclude: Sequence[str] = ()) -> DataFrame:
        """``(word, similarity)`` of the ``n`` words with the highest cosine
        to ``q``, ties by word: the rows that a scan of all vectors gives."""
        import numpy as np

        unit = np.array(q, np.float64) / np.linalg.norm(q)
        bound = {c: -2.0 if c == NO_CELL else 1 - max(0.0, float(np.linalg.norm(unit - np.array(centre))) - radius) ** 2 / 2
                 for c, (centre, radius, _) in self.cells.items()}
        order = sorted(self.cells, key=lambda c: -bound[c])
        first, found = [], 0
        while order and found < n + len(exclude):
            first.append(order.pop(0))
            found += self.cells[first[-1]][2]
        best = self._read(first, q, exclude).orderBy(F.desc("similarity"), "word").limit(n)
        kth = best.agg(F.count("similarity"), F.min("similarity")).first()
        more = [c for c in order if kth[0] < n or bound[c] >= kth[1] - 1e-9]
        self.cells_read = len(first) + len(more)
        if more:
            best = self._read(first + more, q, exclude).orderBy(F.desc("similarity"), "word").limit(n)
        return best

    def most_similar(self, positive: Sequence[str], negative: Sequence[str] = (), n: int = 10) -> DataFrame:
        """Words nearest to the mean of signed unit vectors, inputs excluded,
        as :func:`.vectors.most_similar` gives them from a scan."""
        from .vectors import query_vector
        words = [*positive, *negative]
        return self.nearest(query_vector(self.vectors(words), positive, negative), n, words)
