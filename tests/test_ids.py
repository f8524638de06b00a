"""Spellings of works and identifiers in text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citeloom.functions.arxiv import arxiv_dois, arxiv_ids, likely_arxiv, normalize_arxiv_id, partition_key
from citeloom.functions.ids import canonical_work_id, doi_key, work_key


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "key"),
    [
        ("10.48550/arXiv.2403.00001", "10.48550/arxiv.2403.00001"), (" doi:10.48550/ARXIV.2403.00001\t", "10.48550/arxiv.2403.00001"), ("DOI: 10.1/X", "10.1/x"), ("info:doi/10.1/x", "10.1/x"),
        ("https://doi.org/10.1/X", "10.1/x"), ("http://dx.doi.org/10.1/x", "10.1/x"), (" ​10.1/x﻿", "10.1/x"), ("doi:doi:10.1/x", "10.1/x"), ("10.1/doi:x", "10.1/doi:x"),
        ("", None), ("  ", None), ("doi:", None), (None, None),
    ],
)
def test_work_key(spark, text, key):
    assert one(spark, text, work_key) == key


def test_canonical(spark):
    assert one(spark, "doi:10.48550/ARXIV.HEP-TH/9901001 ", canonical_work_id) == "10.48550/arXiv.hep-th/9901001"
    assert one(spark, "10.5/ABC", canonical_work_id) == "10.5/abc"
    assert one(spark, " 10.5 /A B", doi_key) == "10.5/ab"


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ("arXiv:2403.03542", ["2403.03542"]), ("arXiv:2403.03542v2", ["2403.03542"]), ("10.48550/arXiv.2403.03542", ["2403.03542"]), ("https://arxiv.org/abs/2403.03542", ["2403.03542"]),
        ("arXiv:hep-ph/9901234", ["hep-ph/9901234"]), ("arXiv:cs.DM/9910013", ["cs.dm/9910013"]), ("arXiv:cs.DM/ 9910013", ["cs.dm/9910013"]), ("ArXiv. 2206.153252", ["2206.153252"]),
        ("Some paper 2403.03542", []), ("arXiv:solv-int/9901234v2", ["solv-int/9901234v2"]), ("arXiv:cs.CV/0001234v1", ["cs.cv/0001234v1"]), ("arXiv:2403.123456789", ["2403.123456"]),
        ("arXiv:2403.00002 and arxiv.org/pdf/2403.00001v3 and ARXIV 2403.00002", ["2403.00001", "2403.00002"]), ("arXiv 2403.00001", ["2403.00001"]), ("", []), (None, None),
    ],
)
def test_arxiv_ids(spark, text, ids):
    assert one(spark, text, arxiv_ids) == ids


def test_small_functions(spark):
    assert one(spark, "arXiv:2403.00001", arxiv_dois) == ["10.48550/arXiv.2403.00001"]
    assert one(spark, "cs.DM/ 99 10013V12", normalize_arxiv_id) == "cs.dm/9910013"
    assert one(spark, "see ArXiV", likely_arxiv) is True
    assert one(spark, "none", likely_arxiv) is False


@pytest.mark.parametrize(("text", "key"), [("2403.12345", "2403"), ("hep-ph/9901234", "hep-"), ("cs/9901234", "cs_9"), ("10.48550/arXiv.2403.12345", "2403"), ("10.1234/example", "10.1234"), ("10.1", "10.1"), ("a", "a"), ("", ""), (None, None)])
def test_partition_key(spark, text, key):
    assert one(spark, text, partition_key) == key
