from __future__ import annotations

import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.schemas import raw_schema  # noqa: E402
from ordermill.session import local_session  # noqa: E402

LOADED = datetime(2020, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = local_session(
        "tests", 4, **{"spark.checkpoint.dir": scratch, "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw table of literal rows: dicts with the columns that matter, the rest NULL."""

    def make(table: str, *rows: dict):
        schema = raw_schema(table)
        full = [tuple(_fit({"ingested_at": LOADED, **r}.get(f.name), f) for f in schema.fields) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


def _fit(value, field):
    if value is None:
        return None
    kind = field.dataType.typeName()
    if kind == "decimal":
        return Decimal(str(value))
    if kind == "timestamp_ntz" and isinstance(value, str):
        return datetime.fromisoformat(value)
    return value
