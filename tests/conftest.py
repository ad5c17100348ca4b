import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratafold.plans.lake import Lake  # noqa: E402
from stratafold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "stratafold-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path)).create_tables()


@pytest.fixture
def put_raw(lake):
    """Write a raw file the way an extraction does: one JSON array per account and day."""

    def put(kind, account, day, content, source="meta"):
        path = f"{lake.root}/raw/{source}/{kind}/{account}/{day}/data.json"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(content if isinstance(content, str) else json.dumps(content, indent=2))
        return f"raw/{source}/{kind}/{account}/{day}/data.json"

    return put


@pytest.fixture
def rows_of():
    """Rows of a frame as dicts, sorted by their text."""

    def rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((r.asDict(recursive=True) for r in picked.collect()), key=repr)

    return rows
