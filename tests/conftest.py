import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        # Two attempts per task, to test repeats.
        SparkSession.builder.master("local[4,2]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def keys(spark):
    from filehaul.functions.crypto import generate_key_pair

    return generate_key_pair(spark)


@pytest.fixture
def make_tree(tmp_path):
    """Write a dict of relative path -> bytes below a new directory; returns its path."""

    def make(files, name="source"):
        root = tmp_path / name
        root.mkdir()
        for path, content in files.items():
            (root / path).parent.mkdir(parents=True, exist_ok=True)
            (root / path).write_bytes(content)
        return str(root)

    return make
