from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Treat nearly every key as hot, so the split plans run on small tables."""
    from tidemark.operators import hotkeys

    spark.conf.set(hotkeys.MIN_ROWS_CONF, "1")
    spark.conf.set(hotkeys.BUCKETS_CONF, "8")
    yield
    spark.conf.unset(hotkeys.MIN_ROWS_CONF)
    spark.conf.unset(hotkeys.BUCKETS_CONF)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def duck():
    from tests.compare import connect

    return connect(FOLDER)


def rows(df, *columns):
    """Sorted tuples of the given columns (all by default)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
