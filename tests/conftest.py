import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from opslens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, name="opslens-tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A one-column frame of texts, in order: ``texts(expression, values)`` → results."""

    def run(expression, values, dtype="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, c {dtype}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return run
