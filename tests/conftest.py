import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from maskline.sources.staging import staging  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    with staging(session):
        yield session
    left = list(shared.glob("maskline/*"))
    session.stop()
    assert not left, f"staged tables left behind: {left[:3]}"


@pytest.fixture
def docs(spark):
    def make(*texts, lang="pl"):
        return spark.createDataFrame(
            [(i, lang, t) for i, t in enumerate(texts)], "doc_id bigint, lang string, text string"
        )

    return make
