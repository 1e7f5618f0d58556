import hashlib

import pytest
from pyspark.sql import functions as F

from regiocast.llm.quality_classifier import learn


def frames(spark, long_ids):
    rows = [(i, ("good words here " if i % 2 else "bad $$ junk ## ") * (900 if i in long_ids else 5))
            for i in range(40)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string"),
            spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int"))


def test_a_long_text_does_not_end_the_sample(spark):
    order = sorted(range(40), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    firsts = {next(i for i in order if i % 2 == q) for q in (0, 1)}
    docs, labels = frames(spark, firsts)
    model = learn(docs, labels, F.lit(True), max_bytes=4000)
    assert model.good and model.bad
    good, bad = model.scores(["good words here " * 5, "bad $$ junk ## " * 5])
    assert good > bad


def test_without_texts_that_fit_the_labels_share_is_the_score(spark):
    docs, labels = frames(spark, {i for i in range(40) if i % 2})
    model = learn(docs, labels, F.lit(True), max_bytes=4000)
    assert model.scores(["any"])[0] == pytest.approx(0.5)
