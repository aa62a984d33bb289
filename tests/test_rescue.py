import pytest

from pyspark.sql import functions as F

from tallyloom.functions import rescue as R

SCHEMA = (
    "name string, variants map<string,string>, reference string, synthetic_reference string, brand string, brand_candidates array<string>, "
    "commercial_brand string, category string, category_id string, breadcrumb_path array<string>, description string, meta_description string, url string"
)


def test_pairs_are_scored_by_their_own_evidence(spark):
    def product(name, brand, category, description, **variants):
        return (name, variants, None, None, brand, None, None, category, None, None, description, None, "u")

    left = product("Orion Coil 0.6 ohm", "Lumo", "Resistencias", "malla fina")
    others = [
        (product("Orion Coil 0.6 ohm", "Lumo", "Resistencias", "malla fina"), False, False),
        (product("Orion Coil 0.8 ohm", "Lumo", "Resistencias", "malla fina"), True, False),
        (product("Orion Kit", "Zeta", "Kit", "cuerpo ligero"), False, True),
    ]
    f = lambda rows: [r.f for r in spark.createDataFrame(rows, SCHEMA).select(R.captured_features().alias("f")).collect()]
    kind = spark.createDataFrame([left], SCHEMA).select(R.captured_features().alias("f")).schema["f"].dataType
    a, bs = f([left])[0], f([o[0] for o in others])
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("a", kind), T.StructField("b", kind), T.StructField("same", T.BooleanType()), T.StructField("split", T.BooleanType())])
    df = spark.createDataFrame([(i, a, b, o[1], o[2]) for i, (b, o) in enumerate(zip(bs, others, strict=True))], schema)
    got = [r.r for r in df.select("i", R.pair_audit(F.col("a"), F.col("b"), F.col("same"), F.col("split")).alias("r")).orderBy("i").collect()]
    assert got[0].score == pytest.approx(0.14 + 0.16 + 0.24 + 0.32 + 0.08) and not got[0].hard_conflict
    assert got[1].hard_conflict and got[1].score < 0.20 + 0.14 + 0.16 + 0.24 + 0.32
    assert got[2].score < 0.35
