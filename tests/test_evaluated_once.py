"""What is made from a text of every row is made once, and the same values come out."""

from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators import products


def _folds(df):
    return df._jdf.queryExecution().analyzed().toString().count("translate(")


def test_spellings_are_folded_once_and_the_first_of_equal_ones_stays(spark):
    rows = [(["Ábaco", "abaco", None, " ", "--", "B-1", "b1", "Ñu"],), ([],), (None,), ([None, "  "],), (["x", "X", "y", "x"],)]
    got = spark.createDataFrame(rows, "v array<string>").select(products.unique_spellings(F.col("v")).alias("u"))
    assert _folds(got) == 1
    assert [r.u for r in got.collect()] == [["Ábaco", "B-1", "Ñu"], [], [], [], ["x", "y"]]


def test_dimension_names_are_folded_once(spark):
    rows = [("Colour",), (" Tamaño ",), ("VG/PG",), ("Sales de Nicotina",), ("Otra Cosa",), ("",), (" ",), (None,)]
    got = spark.createDataFrame(rows, "k string").select(T.variant_name(F.col("k")).alias("n"))
    assert _folds(got) == 1
    assert [r.n for r in got.collect()] == ["color", "capacidad", "base_ratio", "nicotina", "otra cosa", "variante", "variante", "variante"]
