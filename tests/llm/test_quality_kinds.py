import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality


def pattern(**votes):
    return sum(v << 2 * quality.LABELLERS.index(k) for k, v in votes.items())


def nothing_found(**votes):
    looked = dict.fromkeys(quality.LABELLERS[:-1], quality.GOOD)
    return pattern(**(looked | votes))


def test_labellers_of_other_kinds_do_not_clear_a_document():
    """Kinds of junk exclude each other: one accuser against five that find nothing."""
    kinds = quality.LABELLERS[:-1]
    patterns = np.array([nothing_found(), *(nothing_found(**{k: quality.WRONG}) for k in kinds)])
    counts = np.array([7600.0, *[400.0] * len(kinds)])
    bad = quality.estimate(patterns, counts)
    assert bad[0] < 0.11 and (bad[1:] > 0.8).all()


def test_given_labels_are_observed():
    accused = nothing_found(shout=quality.WRONG)
    patterns = np.array([
        nothing_found(), nothing_found(given=quality.WRONG), nothing_found(given=quality.GOOD),
        accused, accused + pattern(given=quality.GOOD), accused + pattern(given=quality.WRONG), 0,
    ])
    bad = quality.estimate(patterns, np.array([900.0, 50, 300, 60, 20, 5, 10]))
    assert bad[1] == 1 and bad[2] == 0 and bad[4] == 0 and bad[5] == 1
    assert bad[0] < 0.11 and bad[6] < 0.11
    # Given labels show that this labeller accuses good documents, four times out of five.
    assert bad[3] < 0.5
    assert len(quality.estimate(patterns[:0], np.empty(0))) == 0


def test_labels_that_were_not_given(spark):
    docs, labels = (
        spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")
    )
    hidden = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    told = quality.judged(docs, labels.where(~hidden)).join(labels.where(hidden), "doc_id")
    rows = told.selectExpr("keep", "quality = 0 AS junk", "toxic = 1 AS toxic").toPandas()
    # Insults beyond the list are only found where labels show them, of which there are few.
    assert rows["keep"][rows["junk"]].mean() < 0.1
    assert rows["keep"][~rows["junk"] & ~rows["toxic"]].mean() > 0.97
