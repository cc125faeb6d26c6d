"""One local session for all tests, with small shuffles."""

from __future__ import annotations

import pytest

from tillmarts.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app_name="tests",
        master="local[4]",
        shuffle_partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()),
            key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r),
        )

    return collect
