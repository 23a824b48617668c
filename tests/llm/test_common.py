import pyarrow as pa
import pytest

from benchbook.llm import common


def largest_batch(spark) -> int:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    found = spark.range(0, 3 * int(common.BATCH_ROWS), 1, 1).mapInArrow(run, "n long")
    return max(r["n"] for r in found.collect())


@pytest.mark.parametrize("stated, most", [(common.SPARK_ROWS, int(common.BATCH_ROWS)), ("3000", 3000)])
def test_rows_handed_to_python_at_once(spark, stated, most):
    """Fewer than by Spark's default; a number the session states stays."""
    before = spark.conf.get(common.ROWS_SETTING)
    try:
        spark.conf.set(common.ROWS_SETTING, stated)
        common.ready(spark)
        assert largest_batch(spark) == most
    finally:
        spark.conf.set(common.ROWS_SETTING, before)
