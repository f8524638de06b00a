"""The most frequent values against plain counting, and edge cases."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.llm.threshold_topk import threshold_topk


@pytest.mark.parametrize("chunk", [7, 64, 100_000])
def test_topk_equals_counting(spark, chunk):
    values = [f"v{int((i * 7919 % 1000) ** 0.5)}" for i in range(3000)] + ["hot"] * 900 + [None] * 50 + [""] * 40
    frame = spark.createDataFrame([(v,) for v in values], "item string").repartition(5)
    want = sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [tuple(r) for r in threshold_topk(frame, F.col("item"), 10, chunk).collect()] == want


def test_topk_ties_and_few(spark):
    frame = spark.createDataFrame([(v,) for v in "bbaacc"], "x string")
    assert [tuple(r) for r in threshold_topk(frame, F.col("x"), 2).collect()] == [("a", 2), ("b", 2)]
    assert len(threshold_topk(frame, F.col("x"), 99).collect()) == 3
    assert threshold_topk(frame.limit(0), F.col("x"), 3).collect() == []
    assert threshold_topk(spark.createDataFrame([(None,)], "x string"), F.col("x"), 3).collect() == []
    with pytest.raises(ValueError):
        threshold_topk(frame, F.col("x"), 0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([f"k{i}" for i in range(30)]), min_size=1, max_size=400), st.integers(1, 12), st.integers(1, 90))
def test_topk_any(spark, values, k, chunk):
    frame = spark.createDataFrame([(v,) for v in values], "x string").repartition(3)
    want = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0]))[:k]
    assert [tuple(r) for r in threshold_topk(frame, F.col("x"), k, chunk).collect()] == want
