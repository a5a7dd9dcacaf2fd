import pyarrow as pa

from footfall.llm.common import BATCH_BYTES, map_batches


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    def sizes(batches):  # in here, as workers do not import tests
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id % 10 as string), 10000) as text")
    found = map_batches(texts, sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 3000
    assert max(r["bytes"] for r in found) < BATCH_BYTES + 100_000
    spark.conf.set(name, 1 << 20)  # a session's own limit stays
    found = map_batches(texts, sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 3000 and max(r["bytes"] for r in found) < (1 << 20) + 100_000
    spark.conf.unset(name)
