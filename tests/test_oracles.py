"""Every query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

from tessera.oracles import ORACLES
from tessera.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    problem, _ = compare(spark, duck, QUERIES[name], ORACLES[name], SF_DIR)
    assert not problem
