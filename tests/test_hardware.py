import pytest

from pyspark.sql import functions as F

from tallyloom.functions import hardware as H


def score(spark, a, b, kind="kit_device", ref_a=None, ref_b=None):
    df = spark.createDataFrame([(a, b, ref_a, ref_b, kind)], "a string, b string, ra string, rb string, kind string")
    f = lambda t, r: H.product_features(F.col(t), [F.lit("Lost Vape")], F.col("kind"), reference=F.col(r))
    return df.select(f("a", "ra").alias("x"), f("b", "rb").alias("y")).select(H.product_pair_score(F.col("x"), F.col("y"))).first()[0]


def test_golden_cases_of_the_base_matcher(spark):
    assert score(spark, "Lost Vape Ursa Nano S3 Pod Kit", "Ursa Nano 800mAh - Lost Vape") == 0.0
    assert score(spark, "Lost Vape Ursa Nano S3 Pod Kit", "Ursa Nano S3 Kit - Lost Vape") == pytest.approx(0.98)


def test_what_rules_a_pair_out_and_what_adds(spark):
    for a, b, kind in [
        ("Orion Boost 2 ml", "Orion Boost 3 ml", "kit_device"), ("Orion Boost pack 3", "Orion Boost 5 pcs", "kit_device"), ("Orion Boost V2", "Orion Boost", "kit_device"),
        ("Orion Boost Top", "Orion Boost Side", "kit_device"), ("Orion rba", "Orion coil", "coil"), ("Orion", "Boost", "kit_device"),
        ("Mango Ice", "Mango Ice Fresa", "aroma_concentrate"), ("Mango Ice Salt", "Mango Ice", "aroma_concentrate"),
    ]:
        assert score(spark, a, b, kind) == 0.0, (a, b)
    assert score(spark, "Orion Boost", "Zeta", ref_a="K-12", ref_b="k12") == 1.0
    # the number of a reference names no coil, so the tokens are equal and only the bonus is in question
    assert score(spark, "Orion Boost Alfa", "Orion Boost Beta", "coil", "900", "900 77") == pytest.approx(score(spark, "Orion Boost Alfa", "Orion Boost Beta", "coil") + 0.05)
    plain = score(spark, "Orion Boost Alfa", "Orion Boost Beta")
    assert score(spark, "Orion Boost Alfa 2 ml", "Orion Boost Beta 2ml") == pytest.approx(plain + 0.03)
    assert score(spark, "Orion Boost Alfa pack 3", "Orion Boost Beta 3 pcs") == pytest.approx(plain + 0.02)
