import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.png import write_png  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RED, GREEN, BLUE = (250, 10, 10), (10, 250, 10), (10, 10, 250)


@pytest.fixture(scope="session")
def tree(tmp_path_factory):
    """Class folders with solid images of several kinds and sizes, and one file of junk each."""
    root = tmp_path_factory.mktemp("tree")
    for name, colour in (("alpha", RED), ("beta", GREEN), ("gamma", BLUE)):
        folder = root / name
        folder.mkdir()
        for i in range(8):
            shade = tuple(c - 3 * i if c > 100 else c for c in colour)
            write_png(folder / f"rgb{i}.png", [[shade] * (8 + i)] * (9 + i % 3))
        write_png(folder / "rgba.PNG", [[(*colour, 128)] * 10] * 10)
        (folder / "junk.png").write_bytes(b"this is not a picture")
        (folder / "notes.txt").write_text("not a picture either")
    write_png(root / "beta" / "gray.png", [[100, 200]] * 6)
    return root
