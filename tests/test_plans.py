"""No registered query may hold a cross join, Python per row, or raw rows in one partition."""

import re
from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "FullOuter", "CollectLimit")
# Streams and multi-write queries are covered by their own tests.
SKIPPED = ("stream_", "scan_", "roundtrip_")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(SKIPPED)))
def test_plan(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for word in BANNED:
        assert word not in text
    lines = text.splitlines()
    for number, line in enumerate(lines):
        if "SinglePartition" in line:
            # Only partial aggregates without keys may meet in one partition.
            assert re.search(r"HashAggregate\(keys=\[\]", lines[number + 1]), text


def test_payout_reads_items_once_and_joins_invoices_twice(spark, plan):
    text = plan(QUERIES["influencer_payout"](spark, FOLDER))
    assert text.count("/lineitem.parquet") == 1
    # The third join resolves recipes per campaign.
    assert len(re.findall(r"(?:SortMergeJoin|HashJoin)\b", text)) == 3
