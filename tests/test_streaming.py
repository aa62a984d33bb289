from pyspark.sql import functions as F

from tallyloom.sources import files
from tallyloom.streaming import capture


def test_backfill_of_unseen_keys(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "u1"), (2, "u2"), (3, None)], "i int, url string").write.parquet(src)
    known = spark.createDataFrame([("u1",), ("u1",)], "url string")
    stream = spark.readStream.schema("i int, url string").parquet(src)
    capture.run_available(capture.unseen(stream, known, "url"), str(tmp_path / "state"), lambda df, _: df.write.mode("append").parquet(out))
    assert sorted(r.i for r in spark.read.parquet(out).collect()) == [2, 3]


def test_loose_json(spark):
    df = spark.createDataFrame([("Here:\n```json\n{\"a\": 1}\n```",), ("none",)], "t string")
    assert [r[0] for r in df.select(F.from_json(files.loose_json(F.col("t")), "a int")["a"]).collect()] == [1, None]
