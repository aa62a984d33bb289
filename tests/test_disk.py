"""How often operators shuffle."""

from tallyloom.operators import products


def test_named_bases_take_one_shuffle_and_equal_the_full_bases(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/product.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = products.named_bases(p)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1
    named = products.named_bases(p)
    full = products.base_rows(p).select(*named.columns)
    assert sorted(map(str, named.collect())) == sorted(map(str, full.collect()))
