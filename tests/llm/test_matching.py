import itertools
import random

import numpy as np

from tallyloom.llm import canonical, listings, same_item


def test_brand_mapping(spark):
    ref = spark.createDataFrame(
        [(1, "Brefiapliam Uno", "Brefiapliam Uno S.A."), (2, "Plediam Nation", "x"), (3, "Plediam Vapor", "y"), (4, "Koplia", None), (None, "Nope", None), (5, None, None)], "brand_id int, brand_name string, legal_name string"
    )
    texts = {
        "brefiapliam uno": 1, "Uno, Brefiapliam": 1, "Bre fiapliam Uno": 1, "BREFIAPLIAM": 1, "Brefiapl1am Uno - Sales": 1, "Brefiapliam U.": 1, "by Brefialiam Uno": 1, "Brefiapliam Uno S.A.": 1,
        "Plediam": None, "Plediam Vap": 3, "kpolia": 4, "Kopliá™": 4, "Ofertas": None, "?": None, "Brefiapliam Labs": None, "x" * 5000: None,
    }
    got = {r.text: r.id for r in canonical.map_to_canonical(spark.createDataFrame([(t,) for t in texts], "text string"), ref, "brand_id", ["brand_name", "legal_name"]).collect()}
    assert got == texts


def test_five_letters_and_beginnings(spark):
    ref = spark.createDataFrame([(1, "Abcde", None), (2, "Zomira Fabrica", None), (3, "Zomira Factor", None), (4, "Fghi", None)], "brand_id int, brand_name string, legal_name string")
    texts = {"abxde": 1, "acbde": 1, "abcd": 1, "abcdee": 1, "abxye": None, "Zomira Fa": None, "Zomira Fab": 2, "Fabrica Zomira": 2, "fabrica zomirra": 2, "Fghi": 4, "Fgh": None, "": None, None: None}
    got = {r.text: r.id for r in canonical.map_to_canonical(spark.createDataFrame([(t,) for t in texts], "text string"), ref, "brand_id", ["brand_name", "legal_name"]).collect()}
    assert got == texts


def test_every_single_error_reaches_the_least_jaccard():
    rnd = random.Random(7)
    for _ in range(400):
        n = rnd.randrange(5, 14)
        name = "".join(rnd.choice("abcdefgh") for _ in range(n))
        i = rnd.randrange(n - 1)
        for other in (name[:i] + name[i + 1 :], name[:i] + "z" + name[i + 1 :], name[:i] + "z" + name[i:], name[:i] + name[i] + name[i:], name[:i] + name[i + 1] + name[i] + name[i + 2 :]):
            a, b = set(canonical.token_set(name)), set(canonical.token_set(other))
            assert canonical.one_error(other, name) < 2 and len(a & b) / len(a | b) >= (2 * n - 4) / (2 * n + 2) - 1e-9


def test_brand_rows(spark):
    ref = spark.createDataFrame([(4, "Koplia", None)], "brand_id int, brand_name string, legal_name string")
    p = spark.createDataFrame(
        [(1, "Koplia", None, ["", "Koplia", None, "zzz"], "x"), (2, " ", "koplia", None, "x"), (2, " ", "koplia", None, "x")],
        "row_id bigint, brand string, commercial_brand string, brand_candidates array<string>, text string",
    )
    got = sorted((r.row_id, r.field, r.pos, r.brand_id) for r in canonical.product_brands(p, ref).collect())
    assert got == [(1, "brand", 0, 4), (1, "brand_candidates", 1, 4), (1, "brand_candidates", 3, -1), (2, "commercial_brand", 0, 4), (2, "commercial_brand", 0, 4)]
    assert {r.brand_id for r in canonical.product_brands(p, ref.limit(0)).collect()} == {-1}


def test_set_join_against_brute_force(spark):
    rnd = random.Random(4)
    a = {i: {rnd.randrange(14) for _ in range(rnd.randrange(1, 9))} for i in range(40)}
    b = {i: {rnd.randrange(14) for _ in range(rnd.randrange(1, 9))} for i in range(40)}
    frame = lambda d: spark.createDataFrame([(i, [f"t{x}" for x in s]) for i, s in d.items()], "id int, tokens array<string>")
    got = {(r.left_id, r.right_id) for r in canonical.similar_pairs(frame(a), frame(b), 0.55).collect()}
    assert got == {(i, j) for i in a for j in b if len(a[i] & b[j]) / len(a[i] | b[j]) >= 0.55}


def test_assignment_against_brute_force():
    rnd = np.random.default_rng(1)
    for n, m in [(1, 3), (3, 3), (4, 2), (5, 5)]:
        w = rnd.integers(-2, 9, (n, m)).astype(float)
        got = same_item.assignment(w)
        assert len({i for i, _ in got}) == len(got) == len({j for _, j in got})
        best = max(sum(max(0.0, w[i, j]) for i, j in zip(rows, cols)) for k in [min(n, m)] for rows in itertools.permutations(range(n), k) for cols in itertools.combinations(range(m), k))
        assert sum(w[i, j] for i, j in got) == best


def test_parse():
    p = listings.parse("★ Recomendado RAPATI PIÑA Z​ERO Sales de Nicotina | Steopleglin Labs 1 CL - 2 %", None, None, {"steopleglin", "labs"})
    assert (p["model"], p["edition"], p["volume"], p["strength"]) == ("pineapple rapati", "zero", 10.0, 20.0)
    p = listings.parse("Jacoco Mesh V.3 Coil - (4 uds)", "<p>Resistencia: 0,2 ohm.</p>", {"Resistencia": "200mohm"}, set())
    assert (p["model"], p["edition"], p["ohm"], p["pack"]) == ("jacoco mesh", "v3", 0.2, 4)
    assert listings.parse(None, None, None)["model"] == ""


def test_item_groups(spark):
    rows = [
        (1, "a", "Rapati Piña Zero Salts | Koplia 10 ml 20mg", "Koplia"), (2, "a", "KOPLIA Rapati Piña Zero Sales 1cl - 2%", "Koplia"), (3, "b", "Rapati Pineapple Zero Nic Salt 10ml 20 mg", None),
        (4, "b", "Rapati Pineapple V2 Nic Salt 10ml 20 mg", None), (5, "c", "Rapati Piña V.2 Sales 10ml 20mg Koplia", "koplia"), (6, "c", "Rapati Piña Zero Sales 10ml 10mg", None), (7, "c", None, None), (8, None, "Rapati Piña Zero Sales 10ml 20mg", None),
    ]
    df = spark.createDataFrame([(*r, None, None, None, None, "x") for r in rows], "row_id bigint, distributor string, name string, brand string, commercial_brand string, brand_candidates array<string>, description string, variants map<string,string>, item_id string")
    ref = spark.createDataFrame([(1, "Koplia")], "brand_id int, brand_name string")
    got = sorted(tuple(r) for r in same_item.item_pairs(same_item.item_groups(df, ref)).collect())
    assert got == [(1, 3), (2, 3), (4, 5)]
    assert same_item.item_groups(df.limit(0), ref).count() == 0


_PRODUCT = "row_id bigint, distributor string, name string, brand string, commercial_brand string, brand_candidates array<string>, description string, variants map<string,string>, item_id string"


def _catalogue():
    """80 items of two sellers; half of the second seller's names carry a word no list knows."""
    rnd = random.Random(8)
    syllables = ["ka", "lu", "mi", "to", "ne", "ra", "so", "fi", "du", "pe"]
    names = list({("".join(rnd.choices(syllables, k=3)), "".join(rnd.choices(syllables, k=2))) for _ in range(80)})
    rows, want = [], set()
    for i, (x, y) in enumerate(names):
        rows.append((i + 1, "a", f"Koplia {x} {y} Sales 10ml 20mg", "Koplia"))
        rows.append((i + 1001, "b", f"{x} {y} {'superventas ' if i % 2 else ''}Nic Salt 1cl 2%", "koplia"))
        want.add((i + 1, i + 1001))
    return rows, want


def test_words_of_no_list_and_groups_of_a_tenfold_table(spark):
    rows, want = _catalogue()
    ref = spark.createDataFrame([(1, "Koplia")], "brand_id int, brand_name string")
    frame = lambda rs: spark.createDataFrame([(*r, None, None, None, None, "x") for r in rs], _PRODUCT)
    pairs = lambda rs: {tuple(r) for r in same_item.item_pairs(same_item.item_groups(frame(rs), ref)).collect()}
    assert pairs(rows) == want
    tenfold = [(i + 10_000 * k, *r) for k in range(10) for i, *r in rows]
    got = pairs(tenfold)
    assert {p for p in got if max(p) < 10_000} == want and len(got) == 100 * len(want)


def test_brand_words_sent_or_joined_give_the_same(spark, monkeypatch):
    rows, want = _catalogue()
    ref = spark.createDataFrame([(1, "Koplia")], "brand_id int, brand_name string")
    df = spark.createDataFrame([(*r, None, None, None, None, "x") for r in rows], _PRODUCT)
    monkeypatch.setattr(same_item, "MAX_BROADCAST", 0)
    assert {tuple(r) for r in same_item.item_pairs(same_item.item_groups(df, ref)).collect()} == want


def test_listing_without_a_name_or_model_words(spark):
    ref = spark.createDataFrame([(1, "Koplia")], "brand_id int, brand_name string")
    rows = [(1, "a", None, "Koplia", None, None, "Descubre Rapati Boreal: una mezcla. Contenido: 10 ml.", None, "x"), (2, "b", "Rapati Boreal Sales 10ml", "Koplia", None, None, None, None, "x"),
            (3, "a", "Koplia Kit", "Koplia", None, None, None, None, "x"), (4, "b", "Kit Koplia", "Koplia", None, None, None, None, "x"), (5, "b", None, None, None, None, None, None, "x")]
    got = {tuple(r) for r in same_item.item_pairs(same_item.item_groups(spark.createDataFrame(rows, _PRODUCT), ref)).collect()}
    assert got == {(1, 2), (3, 4)}


def test_brand_words_are_a_share_of_the_rows(spark):
    ref = spark.createDataFrame([(1, "Zor Labs"), (2, "Mip Labs"), (3, None)], "brand_id int, brand_name string")
    rows = [(i, "a", "Kanto Rapati ice", "Kanto" if i % 2 else None) for i in range(10)] + [(20, "a", "ice dos", "ice")]
    df = spark.createDataFrame([(*r, None, None, None, None, "x") for r in rows], _PRODUCT)
    assert {(r.word, r.generic) for r in same_item.brand_words(df, ref).collect()} == {("kanto", False), ("zor", False), ("mip", False), ("labs", True)}


def test_scored_pairs_against_brute_force(spark):
    rnd = random.Random(6)
    nodes = [(i, rnd.choice("abc"), " ".join(sorted(set(rnd.choices([f"w{k}" for k in range(9)], k=rnd.randrange(1, 4))))), "", rnd.choice([None, 10.0, 20.0]), None, None, None, None, None) for i in range(90)]
    df = spark.createDataFrame(nodes, "node bigint, seller string, model string, edition string, volume double, strength double, ohm double, pack int, colour string, brand string")
    count = {}
    for n in nodes:
        for w in n[2].split():
            count[w] = count.get(w, 0) + 1
    weight = lambda ws: sum(np.log1p(90 / count[w]) for w in ws)
    want = {}
    for x, y in itertools.permutations(nodes, 2):
        a, b = set(x[2].split()), set(y[2].split())
        j = weight(a & b) / weight(a | b)
        if x[1] < y[1] and j >= same_item.SIMILAR and not (x[4] and y[4] and x[4] != y[4]):
            g = 1.0 if x[4] and y[4] else 0.0 if not x[4] and not y[4] else -0.25
            want[x[0], y[0]] = round(j + g, 6)
    got = {(r.a, r.b): round(r.weight, 6) for r in same_item.scored_pairs(df).collect()}
    assert got == want and len(want) > 20
