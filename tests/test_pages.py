from pyspark.sql import functions as F

from tallyloom.sources import pages, sinks

PAGE = """<html><link rel="next" href="/c?page=3"><script type="application/ld+json">{broken</script>
<script type="application/ld+json">{"@graph": [{"@type": "Thing"}, {"@type": ["Product"], "name": "Kit &amp; X", "brand": {"name": "Zor"}, "offers": [{"price": 12.5}], "gtin13": "2000001256992"}]}</script>
<script>var productEan13='2000001196786'; x = {"id_category": 12}</script>
<fieldset><legend>Nicotina:</legend><label>10 mg</label><label>20 mg</label></fieldset><select name="Color"><option>Elige</option><option>Red</option></select> 1 - 24 de 40</html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>25 - 40 de 40</p>"), (4, "<p>1 - 24 de 40</p>")], "i int, p string")
    got = {
        r.i: r for r in df.select("i", pages.structured_product("p").alias("s"), pages.options("p").alias("o"), pages.inline_value(F.col("p"), "productEan13").alias("e"), pages.inline_value(F.col("p"), "id_category").alias("c"), pages.next_page(F.col("p"), F.lit(2)).alias("n")).collect()
    }
    assert (got[1].s["name"], got[1].s["brand"], got[1].s["price"], got[1].s["gtin"]) == ("Kit & X", "Zor", "12.5", "2000001256992")
    assert got[1].o == {"Nicotina": ["10 mg", "20 mg"], "Color": ["Red"]} and (got[1].e, got[1].c) == ("2000001196786", "12")
    assert [got[i].n for i in (1, 2, 3, 4)] == [3, None, None, 3] and got[2].s["name"] is None and got[2].e is None


def test_combinations_join_by_values_in_any_order(spark):
    combos = '[{"attributes":{"c":"10 ml","n":"10 mg"},"ean13":"2000001256992"},{"attributes":{"n":"20 mg","c":"10 ml"},"ean13":"2000001257005"}]'
    df = spark.createDataFrame([("10 mg", combos), ("20 mg", combos), ("20 mg", '[{"attributes":{"n":"20 mg","c":"10 ml"}}]'), ("30 mg", None)], "n string, j string").withColumn("d", F.create_map(F.lit("Nicotina"), "n", F.lit("Capacidad"), F.lit("10 ml")))
    assert [r.combination_reference for r in pages.combination_codes(df, "d", "j").collect()] == ["2000001256992", "2000001257005", None, None]
    lookup = F.create_map(F.lit("Nicotina"), F.create_map(F.lit("10 mg"), F.lit("low")))
    assert [r[0] for r in df.select(pages.derived_value(lookup, F.col("d"), "Nicotina")).collect()] == ["low", None, None, None]


def test_report_says_what_it_leaves_out(spark):
    df = spark.range(5).orderBy("id")
    assert sinks.markdown(df, "T", limit=3).rstrip().endswith("2 more rows") and "more rows" not in sinks.markdown(df, "T")


def test_writers(spark, tmp_path):
    v = spark.createDataFrame([(1, "a", 0.5, None), (1, "b", 0.9, "x")], "p int, v string, c double, n string")
    doc = sinks.nested_pairs(v, ["p"], "c").first().document
    assert doc.index('"b"') < doc.index('"a"') and '"n":"x"' in doc
    sinks.json_lines(v, str(tmp_path / "j"), ["p"])
    sinks.delimited(v.na.fill(""), str(tmp_path / "c"), ["v", "c"], sep=";")
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and spark.read.csv(str(tmp_path / "c"), sep=";", header=True).columns == ["v", "c"]
    assert sinks.upsert_statement("t", ["id", 'n"x'], ["id"]) == 'insert into t ("id", "n""x") values (%s, %s) on conflict ("id") do update set "n""x" = excluded."n""x"'
