import zlib

import numpy as np
from pyspark.sql import functions as F

from casewatch.llm import quality_gam as gam

from .helpers import documents, prose, tuples

LABELS = "doc_id bigint, quality int, toxic int"


def junk(seed, n):
    return " ".join(w + "###" for w in prose(seed, n).split())


def corpus():
    rows = [(i, prose(i, 60 + i % 90) if i % 3 else junk(i, 60 + i % 90), "en", "s", 1) for i in range(400)]
    return rows, [(i, int(i % 3 > 0), 0) for i in range(400)]


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    frame = documents(spark, rows, ("score", "row", "label", "values"))
    model = gam.train(frame, spark.createDataFrame(labels, LABELS))
    scored = gam.score(frame, model).select("row.doc_id", "score", "predicted", gam.held_out(F.col("row.doc_id"))).collect()
    truth = dict((i, q) for i, q, _ in labels)
    held = [r for r in scored if r[3]]
    assert {r[0] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    kept = gam.keep_good(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(r.predicted for r in scored)


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    frame = documents(spark, rows)
    one, two = (gam.train(frame, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert one.base == two.base and all(np.array_equal(a, b) for a, b in zip(one.tables, two.tables))


def test_sample_is_bounded_and_independent_of_row_order(spark):
    rows, labels = corpus()
    given = spark.createDataFrame(labels, LABELS)
    one = gam.train(documents(spark, rows), given, max_rows=50)
    two = gam.train(documents(spark, rows[::-1]).repartition(5), given.repartition(3), max_rows=50)
    assert all(np.array_equal(a, b) for a, b in zip(one.tables, two.tables))
    assert all(len(e) < 50 for e in one.edges)


def test_awkward_rows_and_labels(spark):
    rows, labels = corpus()
    awkward = [(None, None, None, None, None), (None, "", None, None, None), (1, prose(1, 61), "en", "s", 1), (900, "x" * 200_000, "", "", 1)]
    frame = documents(spark, rows + awkward)
    more = labels + [(None, 1, 0), (5, None, 0), (6, 0, 0), (7777, 1, 1)]
    model = gam.train(frame, spark.createDataFrame(more, LABELS))
    scored = gam.score(frame, model)
    assert scored.count() == len(rows) + 4 and scored.filter("score is null or isnan(score)").count() == 0


def test_without_labels_or_with_one_class(spark):
    rows, labels = corpus()
    frame = documents(spark, rows[:20])
    nothing = gam.train(frame, spark.createDataFrame([], LABELS))
    assert {r.score for r in gam.score(frame, nothing).collect()} == {0.5}
    single = gam.train(frame, spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS))
    assert all(r.score > 0.5 for r in gam.score(frame, single).collect())
    assert tuples(gam.score(documents(spark, []), nothing)) == []


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(gam.FEATURES)))
    x[:, 2:4] = rng.random((4000, 2))
    y = ((x[:, 2] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert (2, 3) in model.pairs
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.9


def test_text_is_the_only_input():
    assert gam.features(None) == gam.features("") == gam.features(" \n") == [0.0] * len(gam.FEATURES)
    assert len(gam.features("One two\nTHREE!")) == len(gam.FEATURES)
