"""What a task holds, or a job moves, does not grow faster than the tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from brightloom.operators import tune


def test_nodes_of_a_tree_come_as_a_table(spark):
    """not by a call to the JVM for each node; cut errors equal those of trees grown to each depth."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(
        [(Vectors.dense(v), float(y)) for v, y in zip(rng.normal(size=(300, 4)), rng.integers(0, 3, 300))], ["features", "label"])
    grow = lambda depth: RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=depth, seed=7).fit(df).trees[0]
    model, asked = grow(6), []
    call = model._call_java
    model._call_java = lambda name, *a: (asked.append(name), call(name, *a))[1]
    errors = tune._errors_by_depth(model, [df], "label")[0]
    assert "rootNode" not in asked
    for depth in (0, 2, 6):
        assert errors[depth] == pytest.approx(grow(depth).transform(df).agg(F.avg((F.col("prediction") != F.col("label")).cast("double"))).first()[0])
