import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusml.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", 4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="corpusml-tests-"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    return session


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "out")
