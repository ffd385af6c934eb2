"""The stored vector index against a scan of all vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import vectors as VE
from wordloom.operators.vector_index import NO_CELL, VectorIndex


def _table(spark, rows):
    return spark.createDataFrame([(w, [float(x) for x in v]) for w, v in rows], "word string, vector array<double>")


def _same(got, want):
    a, b = ([(r.word, r.similarity) for r in x.collect()] for x in (got, want))
    assert [w for w, _ in a] == [w for w, _ in b]
    assert all(x == y or abs(x - y) < 1e-12 for (_, x), (_, y) in zip(a, b))


def test_clustered_vectors_read_few_cells(spark, tmp_path):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 12)) * 5
    rows = [(f"w{i:04d}", centres[i % 30] + rng.normal(size=12) * 0.2) for i in range(1500)]
    vectors = _table(spark, rows).repartition(5)
    index = VectorIndex.build(vectors, str(tmp_path / "i"))
    assert sum(n for _, _, n in index.cells.values()) == 1500
    for positive, negative in ((["w0001"], []), (["w0100", "w0130"], ["w0007"])):
        _same(index.most_similar(positive, negative, 7), VE.most_similar(vectors, positive, negative, 7))
        assert 1 <= index.cells_read <= 8 < len(index.cells)
    again = VectorIndex(spark, str(tmp_path / "i"))  # from its folder alone
    _same(again.most_similar(["w0500"], n=1), VE.most_similar(vectors, ["w0500"], n=1))


@pytest.mark.parametrize("cells", [1, 7, None])
def test_any_vectors(spark, tmp_path, cells):
    """No clusters, ties, equal vectors, zero vectors, more answers than words."""
    rng = np.random.default_rng(2)
    rows = [(f"w{i:03d}", rng.normal(size=5).round(1)) for i in range(120)]
    rows += [(f"t{i}", rows[3][1]) for i in range(6)] + [("zero", np.zeros(5)), ("zero2", np.zeros(5))]
    vectors = _table(spark, rows)
    index = VectorIndex.build(vectors, str(tmp_path / "i"), cells=cells)
    assert index.cells[NO_CELL][2] == 2
    for words, n in ((["w003"], 9), (["w010", "t1"], 3), (["w050"], 500)):
        _same(index.most_similar(words, n=n), VE.most_similar(vectors, words, n=n))
    q = [1.0, 0.0, 0.0, 0.0, 0.0]
    u = {w: v[0] / np.linalg.norm(v) for w, v in rows if np.linalg.norm(v) > 0}
    want = sorted(u, key=lambda w: (-u[w], w))[:4]
    assert np.allclose([r.similarity for r in index.nearest(q, 4).collect()], [u[w] for w in want])


def test_only_some_folders_are_read(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = _table(spark, [(f"w{i}", rng.normal(size=4) + 9 * (i % 2)) for i in range(400)])
    index = VectorIndex.build(vectors, str(tmp_path / "i"), cells=10)
    held = index.vectors(["w5", "w6", "none"])
    assert sorted(r.word for r in held.collect()) == ["w5", "w6"]
    assert "PartitionFilters: [isnotnull(bucket" in held._jdf.queryExecution().executedPlan().toString() or "bucket" in \
        held._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    with pytest.raises(KeyError):
        index.most_similar(["none"])
    assert VectorIndex.build(vectors.filter(F.col("word") == "w1"), str(tmp_path / "one")).most_similar(["w1"]).count() == 0
