from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from contrail.llm import op6_quality as Q
from contrail.llm.queries import op6_quality
from tests.llm.helpers import no_docs, odd_docs


def walk(trees, x):
    """Node by node, for one row."""
    total = trees.base
    inner = trees.feature.shape[1]
    for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
        node = 0
        while node < inner:
            node = 2 * node + (2 if x[f[node]] > c[node] else 1)
        total += leaf[node - inner]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def test_flattened_trees_equal_a_walk_and_learn():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    t = Q.fit(x[:600], y[:600], trees=30)
    got = t.score(x[600:])
    assert np.allclose(got, [walk(t, r) for r in x[600:]])
    assert ((got > 0.5) == y[600:]).mean() > 0.95


def test_one_class_and_no_rows():
    assert 0 < Q.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3)))[0] < 1
    assert Q.fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((1, 3)))[0] > 0.85


def test_statistics_by_hand():
    x = dict(zip(Q.FEATURES, Q.statistics(pa.array(["Ab ab, 1|\nab x.\nab x."]))[0]))
    assert np.isclose(x["log_words"], np.log1p(7)) and np.isclose(x["digits"], 1 / 21) and np.isclose(x["pipes"], 1 / 21)
    assert np.isclose(x["distinct"], 4 / 7) and np.isclose(x["top_word"], 3 / 7) and np.isclose(x["same_lines"], 1 / 3)
    assert np.isclose(x["stops_a_word"], 2 / 7) and np.isclose(x["same_as_last"], 0)
    assert (Q.statistics(pa.array(["", None, " \n"]))[:2] == Q.statistics(pa.array([""]))).all()


def test_statistics_do_not_depend_on_the_batch(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    whole = Q.statistics(pa.array(texts))
    assert np.allclose(whole, np.vstack([Q.statistics(pa.array([t])) for t in texts]))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op6_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert seen.n > 50 and seen.a > 0.95
    assert got.count() == 1000


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (4, 1, 0), (6, 1, 0), (6, None, 1), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = Q.train(docs, labels, "quality", F.lit(True))
    got = Q.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert Q.score(no_docs(spark), Q.train(no_docs(spark), labels.limit(0), "quality", F.lit(True))).count() == 0
