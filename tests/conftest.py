import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from adlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r]
        )

    return collect


@pytest.fixture
def plan():
    """The physical plan as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def scanned():
    """What each file scan of a frame reads when it runs: partitions (0 if there are none) and rows."""

    def leaves(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return leaves(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return leaves(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            metrics = node.metrics()
            read = lambda name: metrics.apply(name).value() if metrics.contains(name) else 0
            return [{"partitions": read("numPartitions"), "rows": read("numOutputRows")}]
        children = node.children()
        return [x for i in range(children.size()) for x in leaves(children.apply(i))]

    def run(df):
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        return leaves(execution.executedPlan())

    return run
