"""Every query of the library against its SQL, and the properties of those that SQL can't express."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import oracle

from orograph.plans import registry


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_rows_are_those_of_sql(spark, sf, con, name):
    assert oracle.compare(registry.QUERIES[name](spark, sf), con, registry.ORACLE[name]) == ""


def test_meshes_come_back_from_their_bytes(spark, sf):
    rows = registry.QUERIES["mesh_roundtrip"](spark, sf).collect()
    assert rows and all(r["same"] and r["near"] for r in rows)


def test_flagship_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
