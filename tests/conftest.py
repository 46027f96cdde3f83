import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from airwave.schema import RAW_COLUMNS  # noqa: E402
from airwave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "2",
            # Compiling a plan takes longer than running it on a few rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw rows from dicts; columns not given are null, rows land in list order."""

    def build(*rows, columns=None):
        names = columns or RAW_COLUMNS
        schema = ", ".join(f"{n} string" for n in names) + ", ingest_seq bigint"
        data = [
            tuple(None if r.get(n) is None else str(r[n]) for n in names) + (i,)
            for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture
def local():
    """Rows of a frame as dicts, in a fixed order."""

    def collect(df, *order):
        return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]

    return collect
