"""The watermark checks fail when the delay or the policy is another than the one they state.

The smallest tables have too few late rows to tell 12 hours from 18.
"""

import oracle
import pytest
from conftest import SF

from millrace.queries import ORACLES, QUERIES
from millrace.queries.watermarks import hourly_views
from millrace.session import RUNTIME_CONF, prepare


@pytest.mark.parametrize(("name", "delay"), [("wm_ascending", "6 hours"), ("wm_bounded", "0 seconds"), ("wm_bounded", "18 hours")])
def test_another_delay_is_seen(spark, name, delay):
    con = oracle.connect(SF)
    assert oracle.compare(hourly_views(spark, SF, delay), con, ORACLES[name]) is not None


def test_another_policy_is_seen(spark, monkeypatch):
    con = oracle.connect(SF)
    monkeypatch.setitem(RUNTIME_CONF, "spark.sql.streaming.multipleWatermarkPolicy", "max")
    assert oracle.compare(QUERIES["wm_min_of_inputs"](spark, SF), con, ORACLES["wm_min_of_inputs"]) is not None
    monkeypatch.undo()
    prepare(spark)
