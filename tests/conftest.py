import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tractscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", spark__driver__memory="4g")


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def either_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def values(spark):
    """Column expression applied to texts: input -> result."""

    def apply(expression, texts, kind="string"):
        frame = spark.createDataFrame([(t,) for t in texts], f"v {kind}")
        return {row.v: row.r for row in frame.select("v", expression("v").alias("r")).collect()}

    return apply
