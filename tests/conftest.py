import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coinfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def land(spark, tmp_path):
    """Write blocks (objects or lines of text) to a file and read them as raw blocks."""
    from coinfold.sources.raw import read_raw_blocks

    def write(*blocks):
        path = tmp_path / "blocks.json"
        lines = [b if isinstance(b, str) else json.dumps(b) for b in blocks]
        path.write_text("\n".join(lines))
        return read_raw_blocks(spark, str(path))

    return write
