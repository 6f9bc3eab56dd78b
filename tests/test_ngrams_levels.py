"""Longer n-grams are counted only where shorter ones leave them a place."""

import random

import pytest
from pyspark.sql import functions as F

from bitacora.operators import ngrams


@pytest.mark.parametrize("listed", [200, 0])
def test_top_ngrams_are_those_of_all_counts(spark, monkeypatch, listed):
    monkeypatch.setattr(ngrams, "MOST_LISTED", listed)
    counted, longer = [], ngrams._longer

    def seen(words, n, ends):
        found = longer(words, n, ends)
        counted.append(found.count() if found is not None else 0)
        return found

    monkeypatch.setattr(ngrams, "_longer", seen)
    rng = random.Random(3)
    words = [f"p{k}" for k in range(12)]
    texts = [(" ".join(rng.choices(words, k=rng.randrange(30))),) for _ in range(150)] + [(None,), ("p1 p2 p3 p4 " * 30,)]
    df = spark.createDataFrame(texts, "text string")
    for sizes, least, k in (((2, 4), 5, 10), ((1, 3), 0.02, 25)):
        found = [tuple(r) for r in ngrams.top_ngrams(df, ngram_range=sizes, min_df=least, top_k=k).collect()]
        every = ngrams.ngram_counts(df, ngram_range=sizes)
        enough = every.where(F.col("docs") >= (least * len(texts) if isinstance(least, float) else least))
        want = enough.orderBy(F.col("freq").desc(), "phrase").limit(k).select("phrase", "freq")
        assert found == [tuple(r) for r in want.collect()]
    assert len(counted) >= 2 and counted[0] < 200
