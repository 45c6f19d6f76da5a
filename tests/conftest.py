from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fojas.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4, "4g")


@pytest.fixture(scope="session")
def one(spark):
    """one(build, *values): a column expression evaluated over rows of strings."""

    def run(build, *values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        out = [r["x"] for r in rows.select("i", build(rows["v"]).alias("x")).orderBy("i").collect()]
        return out[0] if len(values) == 1 else out

    return run
