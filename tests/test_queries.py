"""Every registered query against its SQL, plain and with chunks so small that all split paths run."""

import oracle
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_point
from millrace.queries import ORACLES, QUERIES

BATCH = [n for n in QUERIES if n.split("_")[0] not in ("stream", "wm") or n == "wm_per_record_trace"]
STREAMS = [n for n in QUERIES if n not in BATCH]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_SMALL)


def check(spark, con, name):
    problem = oracle.compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["window_end", "item", "n", "rk"]


@pytest.mark.parametrize("name", BATCH)
def test_batch(spark, con, name):
    check(spark, con, name)


@pytest.mark.parametrize("name", [n for n in BATCH if n not in ("wordcount", "flat_map_tokens")])
def test_batch_in_chunks(spark, con, name, small_chunks):
    check(spark, con, name)


@pytest.mark.parametrize("name", STREAMS)
def test_stream(spark, con, name):
    check(spark, con, name)
