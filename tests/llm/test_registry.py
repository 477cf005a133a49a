"""Registered queries against their SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

from ordermill.llm import registry
from tools import check_oracle

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_matches_sql(spark, name):
    db = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    assert check_oracle.compare(spark, db, name, SF, registry.ORACLE[name]) == []
