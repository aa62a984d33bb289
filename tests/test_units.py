import pytest

from tallyloom.operators import units

CASES = [
    ("ML", "10 ml", None, 10_000), ("ML", "2,5cl", None, 25_000), ("ML", "5.000ml", None, 5_000_000), ("ML", "0.012 L", None, 12_000), ("ML", "½ L", None, 500_000),
    ("ML", "3/4 l", None, 750_000), ("ML", "3.4 fl. oz", None, 100_550), ("ML", "4000µL", None, 4_000), ("ML", "12", "Mango 12 cl", 120_000), ("ML", "12", "Mango 120 cl", 12_000),
    ("ML", "0,12", "x 0.12 litros", 120_000), ("ML", "único", None, None), ("ML", "", None, None), ("ML", None, None, None),
    ("MG", "1,8 %", None, 18_000), ("MG", "20 ‰", None, 20_000), ("MG", "0.012g/mL", None, 12_000), ("MG", "200mg/10ml", None, 20_000), ("MG", "12 mg por 2 ml", None, 6_000),
    ("MG", "9000 mcg/ml", None, 9_000), ("MG", "cero", None, 0), ("MG", "sin nicotina", None, 0), ("MG", "0 nic", None, 0), ("MG", "2", "Kiwi 2%", 20_000), ("MG", "11 mg sales", None, 11_000),
    ("OHM", "0R15", None, 150), ("OHM", ".5 ohm", None, 500), ("RESISTENCIA", "RDL - 0,3 Ω", None, 300), ("OHM", "600mohm", None, 600), ("OHM", "800", "Coil 800mΩ", 800),
    ("OHM", "800", "Coil", 800_000), ("COLOR", "Red", None, None),
]


def test_amounts(spark):
    rows = [(i, t, {k: v}, "x") for i, (k, v, t, _) in enumerate(CASES)] + [(99, None, None, "x")]
    df = spark.createDataFrame(rows, "pair_id bigint, b_title string, b_variants map<string,string>, amount string")
    got = {r.pair_id: r.amount for r in units.pair_spec_amounts(df).collect()}
    assert got == {i: c[3] for i, c in enumerate(CASES) if c[3] is not None}


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a 5 cl 5 l", {"ML": "5"}), (2, "a 5 cl", {"ML": "5"}), (3, None, {"ML": "5"})], "pair_id bigint, b_title string, b_variants map<string,string>")
    assert {r.pair_id: (r.how, r.unique) for r in units.pair_spec_amounts(df).collect()} == {1: ("context", False), 2: ("context", True), 3: ("default", False)}


def test_columns_constrain_each_other(spark):
    """A bare resistance takes the unit under which it equals the other resistance of the pair."""
    df = spark.createDataFrame([(1, None, {"OHM": "800", "RESISTENCIA": "0.8 ohm"}), (2, "x 600mΩ", {"OHM": "600", "RESISTENCIA": "600"})], "pair_id bigint, b_title string, b_variants map<string,string>")
    got = {(r.pair_id, r.field): (r.amount, r.unique) for r in units.pair_spec_amounts(df).collect()}
    assert got == {(1, "OHM"): (800, True), (1, "RESISTENCIA"): (800, True), (2, "OHM"): (600, True), (2, "RESISTENCIA"): (600, True)}


def test_empty_table_and_zero(spark):
    schema = "pair_id bigint, b_title string, b_variants map<string,string>"
    assert units.pair_spec_amounts(spark.createDataFrame([], schema)).collect() == []
    got = units.pair_spec_amounts(spark.createDataFrame([(1, "0 mg", {"MG": "0", "ML": "10"})], schema)).collect()
    assert {(r.field, r.amount) for r in got} == {("MG", 0), ("ML", 10_000)}


def test_column_units(spark):
    rows = [("a", 800.0, 0.8, 1.0), ("a", 1600.0, 0.8, 2.0), ("a", None, 0.8, 2.0), ("b", 0.8, 0.8, 1000.0), ("c", None, None, None)]
    df = spark.createDataFrame(rows, "src string, mass double, density double, volume double")
    got = units.infer_column_units(
        df, "src", {"mass": {"kg": 1.0, "g": 0.001}, "density": {"kg/l": 1.0}, "volume": {"l": 1.0, "ml": 0.001}}, [{"mass": 1, "density": -1, "volume": -1}]
    ).collect()
    assert {(r.src, r.mass_unit, r.volume_unit, r.unique) for r in got if r.src != "c"} == {("a", "g", "l", True), ("b", "kg", "ml", True)}
    assert [r.unique for r in got if r.src == "c"] == [False]
    with pytest.raises(ValueError):
        units.infer_column_units(df, "src", {"mass": {str(i): 1.0 for i in range(5000)}}, [{"mass": 1}])
