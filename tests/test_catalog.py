import random

from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.functions import variants as V
from tallyloom.functions import text as T
from tallyloom.operators import assign, catalog, products
from tallyloom.sources import files, sinks


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in cols.items())).select(expr).first()[0]


def test_text(spark):
    assert one(spark, T.canonical_url(F.col("u")), u="https://x/a/?utm_source=1&page=2#t") == "https://x/a?page=2"
    assert one(spark, T.ean13(F.col("u")), u="2000001256992") == "2000001256992"
    assert one(spark, T.ean13(F.col("u")), u="2000001256991") is None
    assert one(spark, products.stripped_title(F.col("u"), F.create_map(F.lit("a"), F.lit("10 ml"), F.lit("b"), F.lit("red"))), u="Kit - RED - 10 ml") == "Kit"
    assert one(spark, T.variant_name(F.col("u")), u="Tamaño") == "capacidad"
    assert one(spark, T.redacted_diagnostics(F.col("u")), u="x a@b.es api_key=zz") == "x [EMAIL_REDACTED] api_key=[REDACTED]"


def test_similarity(spark):
    pairs = [("", "", 1.0), ("red", "", 0.35), ("Grey", "gray", 1.0), ("matte", "mattered", 0.45), ("dark red", "red", 0.72), ("a b c d", "e", 0.0)]
    for a, b, want in pairs:
        assert one(spark, V.value_similarity(F.col("a"), F.col("b")), a=a, b=b) == want
    assert one(spark, S.numeric_similarity(S.numeric_set(F.col("a"), "ohm"), S.numeric_set(F.col("b"), "ohm")), a="0.6 ohm", b="0.6 ohm - 0.8 ohm") == 0.72
    assert one(spark, S.numeric_similarity(S.numeric_set(F.col("a"), "ohm"), S.numeric_set(F.col("b"), "ohm")), a="0.6 ohm", b="0.8 ohm") == 0.0
    assert one(spark, S.js_round(F.col("x")), x=1.005) == 1.0
    assert one(spark, S.js_round(F.lit(0.72) * F.col("x"), 3), x=0.95) == 0.684


def test_greedy_equals_sequential(spark):
    rnd = random.Random(3)
    for size in (9, 25):
        edges = sorted({(rnd.randrange(size), rnd.randrange(size)): rnd.randrange(4) / 4 for _ in range(40)}.items())
        rows = [(a, b, w) for (a, b), w in edges]
        kept, left, right = set(), set(), set()
        for a, b, w in sorted(rows, key=lambda e: (-e[2], e[0], e[1])):
            if a not in left and b not in right:
                kept.add((a, b))
                left.add(a)
                right.add(b)
        df = spark.createDataFrame(rows, "a int, b int, w double")
        got = assign.greedy_one_to_one(df, "a", "b", [("w", True), ("a", False), ("b", False)]).collect()
        assert {(r.a, r.b) for r in got} == kept


def test_greedy_on_a_chain_and_components(spark):
    chain = spark.createDataFrame([(i, i + d, 100.0 - 2 * i - d) for i in range(30) for d in (0, 1)], "a int, b int, w double")
    got = assign.greedy_one_to_one(chain, "a", "b", [("w", True), ("a", False), ("b", False)]).collect()
    assert {(r.a, r.b) for r in got} == {(i, i) for i in range(30)}
    assert assign.greedy_one_to_one(chain.limit(0), "a", "b", [("w", True), ("a", False), ("b", False)]).collect() == []
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (None, 5)], "x int, y int")
    assert {(r.node, r.component) for r in assign.components(edges, "x", "y").collect()} == {(i, 1) for i in range(1, 61)} | {(100, 100), (101, 100), (102, 100)}
    assert assign.components(edges.limit(0), "x", "y").collect() == []


def test_merges(spark):
    m = spark.createDataFrame([(1, 10), (1, 20), (2, 30), (2, 40), (3, 50), (3, 60)], "g int, id int")
    deps = spark.createDataFrame([(20,), (20,), (50,), (60,)], "id int")
    got = {r.g: r.survivor for r in catalog.merge_survivors(m, "g", "id", deps).collect()}
    assert got == {1: 20, 2: 30, 3: None}
    cur, inc = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, o int")
    assert {(r.k, r.v, r.action) for r in catalog.upserted(cur, inc, "k", ["v"], "o").collect()} == {(1, "a", "keep"), (2, "c", "update"), (3, "e", "insert")}


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.JSON").write_text('﻿{"items": [{"name": "x", "distributor": "D", "url": "u", "variants": {"ML": "1"},},]}')
    (tmp_path / "b.json").write_text('[{"name": "y", "distributor": "e", "url": "v"}]')
    rows = files.products(spark, str(tmp_path))
    assert {(r.source_file, r.name) for r in rows.collect()} == {("a.JSON", "x"), ("b.json", "y")}
    assert files.products(spark, str(tmp_path), distributor=" d ").count() == 1
    (tmp_path / "t.csv").write_text('A b;C\n"x;""q""";\n;\n')
    got = files.delimited(spark, str(tmp_path / "t.csv"), ";", True)
    assert got.columns == ["a_b", "c"] and [tuple(r) for r in got.collect()] == [('x;"q"', "")]
    assert files.optional(spark, str(tmp_path / "none.json"), "a int").count() == 0
    (tmp_path / "blocks.txt").write_text("# c\nVozol=>Vozol2:kit, SMOK:coil\n")
    assert [tuple(r) for r in files.blocks(spark, str(tmp_path / "blocks.txt")).collect()] == [("Vozol", "Vozol2", "kit"), ("SMOK", "SMOK", "coil")]
    page = spark.createDataFrame([('<h1>A <b>B</b></h1><meta name="description" content="m"><select name="s"><option>Choose</option><option>1 &amp; 2</option></select><a href="/x#y">',)], "p string")
    f = page.select(files.page_fields("p").alias("f"), files.links(F.col("p")).alias("l")).first()
    assert (f.f.name, f.f.meta, f.f.options, f.l) == ("A B", "m", {"s": ["1 & 2"]}, ["/x"])
    assert sinks.batch_rows(1000, 30001) == 1 and sinks.batch_rows(3, 1) == 3
    sinks.refreshed(spark.createDataFrame([("a", 1), ("b", 2)], "side string, v int"), str(tmp_path / "t"), "side")
    sinks.refreshed(spark.createDataFrame([("a", 9)], "side string, v int"), str(tmp_path / "t"), "side")
    assert {(r.side, r.v) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("a", 9), ("b", 2)}


def test_stream_equals_batch(spark):
    from tallyloom.plans import reference

    d = "/root/testdata/sf0.001"
    e = spark.read.parquet(f"{d}/events.parquet")
    want = e.select(F.concat_ws("|", F.col("user_id").cast("string"), F.to_date("ts").cast("string"), "event_type")).distinct().count()
    assert reference.q_stream_dedup(spark, d).count() == want
