from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.functions import variants as V
from tallyloom.operators import loading, products

SCHEMA = (
    "row_id bigint, distributor string, name string, url string, variants map<string,string>, sku string, brand string, brand_candidates array<string>, commercial_brand string, product_line string, reference string, "
    "synthetic_reference string, category_id string, category string, breadcrumb_path array<string>, price_tax_excluded double, description string, meta_description string, "
    "derived struct<matched_reference_color:string,matched_brand_alias:string>, source_file string, base_id string"
)


def frame(spark, *rows):
    names = [f.split()[0] for f in ["row_id", "distributor", "name", "url", "variants", "sku", "brand", "brand_candidates", "commercial_brand", "product_line", "reference", "synthetic_reference", "category_id", "category", "breadcrumb_path", "price_tax_excluded", "description", "meta_description", "derived", "source_file", "base_id"]]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMA)


def test_types_by_the_first_rule(spark):
    cases = {
        ("Kit desechable", None): "kit_device", ("Vaper desechable", None): "disposable", ("Coil pod recambio", None): "coil", ("Pod recambio", None): "pod_replacement", ("Base neutra", "x"): "base_booster",
        ("Deposito de pyrex", None): "pyrex", ("Algo", "K-GTX"): "kit_device", ("Algo", "M.VINCI"): "mod_device", ("Mod Vinci", None): "mod_device", ("Tank RTA", None): "atomizer_tank", ("Bolsa", None): "unknown",
    }
    df = frame(spark, *[{"row_id": i, "name": n, "reference": r} for i, (n, r) in enumerate(cases)])
    kind = S.product_kind(*[F.col(c) for c in ("name", "category", "category_id", "reference", "synthetic_reference", "variants")])
    got = {(r["name"], r["reference"]): r["k"] for r in df.select("name", "reference", kind.alias("k")).collect()}
    assert got == cases


def test_brand_from_the_title_and_the_breadcrumb(spark):
    df = frame(
        spark, {"row_id": 1, "name": "Aqua Mix - Koplia - 10 ml"}, {"row_id": 2, "name": "Aqua", "breadcrumb_path": ["Inicio", "Zor", "Aromas"]}, {"row_id": 3, "name": "Aqua", "brand_candidates": [" ", None, "Mip"], "brand": "x"}, {"row_id": 4}
    )
    assert {r.row_id: r.brand_found for r in products.profiled(df).collect()} == {1: "Koplia", 2: "Zor", 3: "Mip", 4: None}


def test_liquid_contents(spark):
    cases = {
        ("eliquid", "aroma 20 ml / 60 longfill"): ("20 ml", "60 ml"), ("eliquid", "30 ml en bote de 120 ml"): ("30 ml", "120 ml"), ("nicotine_salt", "sales 10 ml"): ("10 ml", "10 ml"),
        ("nicotine_salt", "bote de 60 ml con 50 ml"): ("50 ml", ""), ("aroma_concentrate", "aroma: 2,50 ml"): ("2.5 ml", ""), ("kit_device", "5 ml"): ("", ""),
    }
    df = spark.createDataFrame([(k, t) for k, t in cases], "k string, t string")
    none = F.create_map().cast("map<string,string>")
    got = {(r.k, r.t): (r.p.contenido_ml, r.p.bote_ml) for r in df.select("k", "t", products.liquid_parts(none, F.col("k"), F.col("t")).alias("p")).collect()}
    assert got == cases


def test_rows_of_empty_null_and_repeated_input(spark):
    empty = frame(spark)
    assert products.base_rows(empty).count() == products.variant_rows(empty).count() == 0
    row = {"row_id": 1, "distributor": "a", "name": "Kit X - red", "url": "u#r", "variants": {"COLOR": " blue ", "x": None}}
    df = frame(spark, row, {**row, "row_id": 2}, {"row_id": 3})
    v = {r.row_id: r for r in products.variant_rows(df).collect()}
    assert v[1].variant_label == "color: blue" and v[1].id == v[2].id and len(v) == 3
    b = {r.distributor: r for r in products.base_rows(df).collect()}
    assert b["a"].variant_count == 2 and b["a"].variant_values == "color: blue" and b["a"].min_price is None


def test_variant_scores(spark):
    empty = dict.fromkeys(products.FIELDS, "")
    schema = f"a struct<{','.join(f'{f}:string' for f in products.FIELDS)}>, b struct<{','.join(f'{f}:string' for f in products.FIELDS)}>"
    cases = [
        ({}, {}, 0.75, "base_only"), ({"resistencia": "0.6 ohm"}, {"resistencia": "0.6 ohm - 0.8 ohm"}, 0.72, "possible_variant_match"), ({"resistencia": "0.6 ohm mesh"}, {"resistencia": "0.6 ohm dual"}, 0.72, "possible_variant_match"),
        ({"capacidad": "2 ml"}, {}, 0.35, "no_variant_match"), ({"nicotina": "20mg", "sabor": "Mint"}, {"nicotina": "20 mg", "sabor": "mint"}, 1.0, "variant_match"),
    ]
    df = spark.createDataFrame([(tuple({**empty, **a}.values()), tuple({**empty, **b}.values())) for a, b, _, _ in cases], schema)
    got = [(r.s.confidence, r.s.decision) for r in df.select(V.variant_score(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [(c, d) for _, _, c, d in cases]


def test_safe_merges(spark):
    """Survivors, dependents and colliding links."""
    refs = [("g1", 20), ("g1", 10), ("g2", 110), ("g2", 120), ("g3", 210), ("g3", 220), ("g4", 310), ("g4", 320), ("g5", 1)]
    links = [(91, 320, "d", "v", "u1"), (92, 310, "d", "v", "u2"), (1, 10, "d", "v", "u"), (2, 20, "d", "w", "u")]
    deps = [(120,), (120,), (120,), (210,), (220,), (None,)]

    def run(links, dedupe):
        frames = spark.createDataFrame(refs, "group string, reference_id int"), spark.createDataFrame(links, "link_id int, reference_id int, distributor string, variant string, url string"), spark.createDataFrame(deps, "reference_id int")
        return {r.group: (r.merged, r.survivor, r.reason, r.deleted) for r in loading.safe_merges(*frames, dedupe).collect()}

    many, collision = "multiple_references_have_business_dependencies", "distributor_variant_collision"
    assert run(links, False) == {"g1": (True, 10, None, 0), "g2": (True, 120, None, 0), "g3": (False, None, many, 0), "g4": (False, None, collision, 0)}
    alike = [(91, 320, "d", "v", "u1"), (92, 310, "d", "v", "u1")]
    assert run(alike, True)["g4"] == (True, 310, None, 1) and run(alike, False)["g4"] == (False, None, collision, 0)


def test_checkpoints_follow_content_and_settings(spark):
    rows = spark.createDataFrame([("g", i, f"t{i}") for i in range(5)], "g string, i int, t string")
    make = lambda df, settings: loading.batches(df, "g", "i", ["t"], 2, settings)
    base = make(rows, "m1")
    actions = lambda wanted: [r.action for r in loading.checkpoint_plan(wanted, base, ["g", "batch"]).orderBy("batch").collect()]
    assert actions(make(rows, "m1")) == ["reuse"] * 3 and actions(make(rows, "m2")) == ["rerun"] * 3
    changed = rows.withColumn("t", F.when(F.col("i") == 3, "new").otherwise(F.col("t"))).unionByName(spark.createDataFrame([("g", 9, "x"), ("g", 10, "y")], "g string, i int, t string"))
    assert actions(make(changed, "m1")) == ["reuse", "rerun", "rerun", "run"]


def test_master_guard_against_brute_force(spark):
    import random

    rnd = random.Random(4)
    edges = [(f"a{rnd.randrange(12)}", f"b{rnd.randrange(12)}", float(rnd.randrange(3))) for _ in range(60)]
    edges = list({(a, b): (a, b, p, f"{a}|{b}") for a, b, p in edges}.values())
    taken_a, taken_b, want = set(), set(), {}
    for a, b, _, k in sorted(edges, key=lambda e: (-e[2], e[3])):
        on_a, on_b = a in taken_a, b in taken_b
        want[k] = None if not (on_a or on_b) else "both" if on_a and on_b else "a" if on_a else "b"
        if want[k] is None:
            taken_a.add(a)
            taken_b.add(b)
    got = {r.k: (r.accepted, r.conflict_side) for r in loading.master_guard(spark.createDataFrame(edges, "a string, b string, p double, k string"), "a", "b", ["p"], "k").collect()}
    assert got == {k: (s is None, s) for k, s in want.items()}
