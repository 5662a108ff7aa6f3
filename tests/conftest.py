"""One local Spark session for the whole test run."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import local_session

    warehouse = tempfile.mkdtemp(prefix="salesmart-wh-")
    session = local_session(
        "salesmart-tests",
        cores="*",
        shuffle_partitions=8,
        # spark.checkpoint.dir comes from the environment's defaults; the
        # library sets a local one only when none is configured.
        extra={"spark.sql.warehouse.dir": warehouse},
    )
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="salesmart-t-")
