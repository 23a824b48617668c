import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from benchbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a column function over a list of inputs, in order."""

    def run(function, inputs, kind="string"):
        rows = [(i, v) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").repartition(3)
        found = {r[0]: r[1] for r in df.select("i", function(df["x"]).alias("y")).collect()}
        return [found[i] for i in range(len(rows))]

    return run
