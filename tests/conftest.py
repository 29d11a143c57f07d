import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from featurelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("featurelake-tests", "local[8]", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def base(spark, tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    """Rows as sorted tuples, floats rounded, for comparing frames of any order."""
    names = list(columns) or df.columns

    def plain(v):
        return round(v, 9) + 0.0 if isinstance(v, float) else v

    out = [tuple(plain(r[n]) for n in names) for r in df.select(*names).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count_jobs(spark, action) -> int:
    """Number of Spark jobs an action runs."""
    import uuid

    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
