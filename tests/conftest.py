import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freshet.session import ROCKSDB_PROVIDER, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__session__timeZone="UTC",
        spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """JSON lines (dicts become text) as a one-column frame."""
    import json

    def make(*rows):
        texts = [row if row is None or isinstance(row, str) else json.dumps(row) for row in rows]
        return spark.createDataFrame([(text,) for text in texts], "value string")

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
