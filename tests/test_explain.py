import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from millrace.plans.explain import explained, summary
from millrace.sources.tables import table


def test_plan_text_and_summary(spark):
    events = table(spark, SF_SMALL, "events")
    views = events.where(F.col("event_type") == "view").groupBy("user_id").agg(F.count("*").alias("n"))
    assert "== Physical Plan ==" in explained(views) and "== Analyzed Logical Plan ==" in explained(views, "extended")
    found = summary(views.join(table(spark, SF_SMALL, "customer").hint("merge"), F.col("user_id") == F.col("c_custkey")))
    assert found.joins == ("SortMergeJoin",) and found.exchanges == 2 and found.broadcasts == found.python_steps == 0
    assert any("EqualTo(event_type,view)" in p for p in found.pushed)
    assert any(set(c.split(":")[0] for c in r.split(",")) == {"user_id", "event_type"} for r in found.read)
    with pytest.raises(ValueError, match="mode"):
        explained(views, "pretty")
