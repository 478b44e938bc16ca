import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from obsflow.llm.components import Forest, cells, components, pairs_within, whole_cells
from tests.llm.helpers import smallest_reachable


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def test_components_equal_brute_force(spark):
    dice = random.Random(3)
    pairs = [(dice.randrange(60), dice.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    both = {frozenset(p) for p in pairs}
    nodes = sorted({n for p in pairs if p[0] != p[1] for n in p})
    expected = smallest_reachable(nodes, lambda a, b: frozenset((a, b)) in both)
    assert {r["node"]: r["component"] for r in components(edges(spark, pairs)).collect()} == expected


def test_no_edges_give_no_rows(spark):
    assert components(edges(spark, [])).collect() == []
    assert components(edges(spark, [(1, 1)])).collect() == []


def test_cells_form_each_pair_of_a_key_once(spark):
    rows = spark.range(50).withColumn("key", F.when(F.col("id") < 40, 1).otherwise(F.col("id") % 3))
    dealt = cells(rows, F.col("key"), F.col("id"), limit=7).select("cell", "part", "id").toArrow()
    found = []
    for table in whole_cells(iter(dealt.to_batches(max_chunksize=9))):
        cell, part, ids = (np.concatenate([c.to_numpy() for c in table.column(n).chunks]) for n in ("cell", "part", "id"))
        for i, j in pairs_within(cell, part):
            found += [tuple(sorted(p)) for p in zip(ids[i].tolist(), ids[j].tolist())]
        assert max(np.unique(cell, return_counts=True)[1]) <= 30
    key = {i: 1 if i < 40 else i % 3 for i in range(50)}
    assert sorted(found) == sorted((a, b) for a in range(50) for b in range(a + 1, 50) if key[a] == key[b])


def test_whole_cells_of_single_row_batches():
    batches = [pa.record_batch({"cell": pa.array([c], pa.int64())}) for c in (1, 1, 2, 3, 3)]
    assert [t.column("cell").to_pylist() for t in whole_cells(iter(batches))] == [[1, 1], [2], [3, 3]]


def test_forest_joins_to_the_smallest_row():
    forest = Forest(6)
    forest.join(np.array([4, 1]), np.array([5, 4]))
    forest.join(np.array([5, 2]), np.array([1, 3]))
    assert [x.tolist() for x in forest.edges()] == [[3, 4, 5], [2, 1, 1]]
