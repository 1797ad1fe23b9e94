from pyspark.sql import functions as F

from feedweave.llm import stars


def test_a_pair_is_told_once_and_rows_carry_smaller_keys_only(spark):
    shares = [(k, i, i, 3) for k in (-7, 4, 9) for i in (1, 2, 3)] + [(5, i, i, 3) for i in (2, 3, 4)]
    shares = spark.createDataFrame(shares, "key long, id long, c long, n long")
    contents = spark.range(1, 5).select("id", F.lit(b"x").alias("content"))
    found = stars.opened(shares, contents, lambda c: c, lambda item, held, wanted: range(len(held)), False)
    assert sorted(map(tuple, found.collect())) == [(2, 1), (3, 1), (3, 2), (4, 2), (4, 3)]
    assert "slice(keys" in found._jdf.queryExecution().optimizedPlan().toString()
