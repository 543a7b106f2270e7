import contextlib
import io
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import build_session  # noqa: E402
from millrace.sources.tables import Tables  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def tables(spark, folder):
    return Tables(spark, folder)


@pytest.fixture
def plan():
    """The plan text of a DataFrame; the final one if it has run."""

    def text(df) -> str:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        return out.getvalue()

    return text


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples, for comparing multisets."""

    def of(df) -> list[tuple]:
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return of
