from __future__ import annotations

import tempfile

import pytest

from fieldtally.session import CHECKPOINT_KEY, build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.maxMetadataStringLength": "10000",
    })
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get(CHECKPOINT_KEY, None):
        session.conf.set(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="fieldtally-test-"))
    yield session
    session.stop()
