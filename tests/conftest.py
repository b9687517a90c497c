import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from freshet.session import build_session

    session = build_session(
        "freshet-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file:{tmp_path_factory.mktemp('shared')}",
            "spark.sql.warehouse.dir": f"file:{tmp_path_factory.mktemp('warehouse')}",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def open_ws(spark):
    """Opens workspaces and closes them after the test."""
    from freshet.workspace import open_workspace

    opened = []

    def make(path=None, config=None):
        opened.append(open_workspace(spark, path, config))
        return opened[-1]

    yield make
    for workspace in opened:
        workspace.close()
