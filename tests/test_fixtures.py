"""The control log derived from the events, and what Spark builds on it without the SQL view."""

import os

import pytest

from ackline.operators import epochs
from ackline.plans.fixtures import Inputs, with_views
from compare import duck_rows, spark_rows

SF_DIR = os.environ.get("ACKLINE_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def test_every_error_event_is_in_the_control_log(spark):
    inputs = Inputs(spark, SF_DIR)
    log, events = inputs["assignment_events"], inputs["events"]
    errors = events.filter("event_type = 'error'").count()
    assert errors and log.filter("event = 'error'").count() == errors
    assert log.filter("event = 'revoked' and topic = 'events'").count() == 2 * errors


def test_log_ends_while_records_are_open(spark):
    inputs = Inputs(spark, SF_DIR)
    live = epochs.live_events(inputs["deliveries"], inputs.intervals("assignment_events"))
    done = inputs["completions"].filter("outcome = 'succeeded'")
    open_ = live.join(done, ["topic", "partition_id", "epoch", "record_offset"], "left_anti")
    assert open_.groupBy("topic", "partition_id").count().filter("topic = 'steady'").count() == 4
    assert live.count() > 100 * 4


@pytest.mark.parametrize("name", ["fx_epochs", "deliveries"])
def test_scans_equal_the_view(spark, name):
    df = Inputs(spark, SF_DIR)[name]
    rows = spark_rows(df)
    assert rows == duck_rows(SF_DIR, with_views([name], f"SELECT * FROM {name}"))
    assert rows[1]
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
