import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
CLASHING = "node long, words string, size int, source string, s string, key string, row string, bits int, shard string, label int, turn int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from panelkit.session import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def texts_frame(spark):
    """Frame of (doc_id, text) rows with further columns whose names operators might use."""

    def build(rows):
        wide = [(i, t, 1, "w", 2, "src", "s", "k", "r", 3, "x", 4, 5) for i, t in rows]
        return spark.createDataFrame(wide, f"doc_id long, text string, {CLASHING}")

    return build
