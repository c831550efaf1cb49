"""Streaming patterns wait for late rows: with too short a delay the same query is wrong."""

import oracle
from conftest import SF_SMALL

from millrace.queries import ORACLES
from millrace.queries.stream_patterns import stream_cep_times
from millrace.session import prepare


def test_a_short_delay_is_seen(spark):
    out = stream_cep_times(prepare(spark), SF_SMALL, "0 seconds")
    assert oracle.compare(out, oracle.connect(SF_SMALL), ORACLES["stream_cep_times"]) is not None
