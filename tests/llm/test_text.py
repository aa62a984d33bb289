import datetime as dt
import random

from tallyloom.llm import leaks, mixing, pii, unify


def test_consistent_forms():
    cases = {
        "Ｐｏｄ　Ｋｉｔ": "Pod Kit", "Sаles Flaіvisur Јuice": "Sales Flaivisur Juice", "Роԁ": "Pod", "Дым": "Дым", "Φλόγα": "Φλόγα", "雲 0.2 Ω": "雲 0.2 Ω",
        "café": "café", "a​b­c﻿": "abc", "x y z": "x y z", "3mg ‑ 10": "3mg - 10", "№7 ½ ™ ®": "№7 ½ ™ ®", "ν2": "v2", "ﬁn": "fin", "Çeşme Über": "Çeşme Über", "": "",
    }
    for given, want in cases.items():
        assert unify.consistent(given) == want
        assert unify.consistent(want) == want


def test_letters_of_other_scripts():
    cases = {"ᏟᎪᏢ": "CAP", "ꓐrand": "Brand", "ⲟil": "oil", "ſale": "sale", "Kit ǃ": "Kit !", "ĳs": "ijs", "ゴー": "ゴー", "雲海": "雲海", "Ǆ": "DŽ"}
    for given, want in cases.items():
        assert unify.consistent(given) == want, given
    assert unify.scripts("ー") == {"HIRAGANA", "KATAKANA", "JPAN"} and unify.scripts("雲") >= {"HAN", "KORE"} and unify.scripts("7") is None


def test_a_value_of_the_usual_class_never_changes(spark):
    import re

    rng = random.Random(1)
    usual = re.compile(unify.usual_class())
    quick = re.compile(unify.QUICK_CLASS)
    assert all(usual.match(chr(c)) for c in range(0x20, 0x3000) if quick.match(chr(c)))
    pool = [chr(c) for c in range(0x20, 0x3000) if usual.match(chr(c))]
    assert not [w for w in ("".join(rng.choices(pool, k=10)) for _ in range(3000)) if unify.consistent(w) != w]
    values = ["ſale", "ĳs", "Kit ǃ", "ǆ", "Ŀ", "ŉ", "plain", "Çeşme", None]
    df = spark.createDataFrame(list(enumerate(values)), "row_id int, name string")
    assert {r.row_id: r.name for r in unify.normalized(df, ["row_id"], ["name"]).collect()} == {i: v and unify.consistent(v) for i, v in enumerate(values)}


def test_disguised_values(spark):
    long = "a" * 50_000 + "​"
    df = spark.createDataFrame([(1, "Роԁ", None, "x"), (2, "Дым", "", "x"), (3, long, "ok", "x"), (3, long, "ok", "x")], "row_id bigint, name string, reference string, value string")
    got = sorted((r.row_id, r.field) for r in unify.disguised_values(df, ["row_id"], ["name", "reference"]).select("row_id", "field").collect())
    assert got == [(1, "name"), (3, "name"), (3, "name")]
    assert unify.normalized(df, ["row_id"], ["name"]).where("row_id = 1").first().name == "Pod"


TEXT = (
    "Contacto: Ana Belén Urzuyra, hannah+pedidos @ tienda dot example. DNI 99602350-E? Preguntad por nuria beldorndo en el 0034 996 21 33 44. "
    "Enviadlo a C/ Mirlos 64, bajo dcha., 02478 Campoumbra de Urz; tel. 614450421. Regards, Valzusby, Phoebe. Código interno 648370064704. "
    "Lote 44443308-X. Doctor Melquíades Custard. number QQ 34 41 62 C. 20W@0.6ohm. Ver calle de entrada, pasillo 4. Ship it to Flat 6, 172 Oatfield Close, Little Thrawn ZZ56 3ZZ. según N. Zartacho (Z9114050Y)."
)


def test_pii_kinds():
    got = {(k, TEXT[a:b]) for a, b, k in pii.find(TEXT)}
    nie = "Z9114050Y"
    valid = pii.valid_dni("2" + nie[1:8], nie[-1])
    want = {
        ("person", "Ana Belén Urzuyra"), ("email", "hannah+pedidos @ tienda dot example"), ("person", "nuria beldorndo"), ("phone", "0034 996 21 33 44"),
        ("address", "C/ Mirlos 64, bajo dcha., 02478 Campoumbra de Urz"), ("phone", "614450421"), ("person", "Valzusby, Phoebe"), ("id_number", "QQ 34 41 62 C"),
        ("address", "Flat 6, 172 Oatfield Close, Little Thrawn ZZ56 3ZZ"), ("person", "N. Zartacho"),
    } | ({("id_number", nie)} if valid else set()) | ({("id_number", "99602350-E")} if pii.valid_dni("99602350", "E") else set())
    assert got == want
    assert pii.find("") == [] and pii.find(None) == []


def test_feistel_and_redaction():
    key = b"k"
    for n in range(1, 10):
        xs = {str(i * 7919 % 10**n).zfill(n) for i in range(50)}
        ys = {pii.feistel(x, key, "t") for x in xs}
        assert len(ys) == len(xs) and all(len(y) == n and pii.unfeistel(y, key, "t") == x for x, y in ((x, pii.feistel(x, key, "t")) for x in xs))
    assert len({pii.pseudonym_date(d, key) for d in range(300)}) == 300
    a, b = pii.pseudonym("+34 614 450 421", "phone", key), pii.pseudonym("614450421", "phone", key)
    assert a.startswith("+34 ") and a.replace(" ", "").endswith(b)
    out = pii.pseudonym("99602350-E", "id_number", key)
    assert out[8] == "-" and pii.valid_dni(out[:8], out[-1])
    red = pii.redact("tel. 614450421 y fin", key)
    assert red.startswith("tel. [PHONE ") and red.endswith("] y fin")


def test_names_by_context_numbers_and_dates():
    found = lambda t, **k: {(kind, t[a:b]) for a, b, kind in pii.find(t, **k)}
    assert found("Un saludo, Zbigniew Kowalski. Sr. Xavier Dupont, a nombre de Ngozi Okafor y factura: LIEV SHREIBER") == {("person", "Zbigniew Kowalski"), ("person", "Xavier Dupont"), ("person", "Ngozi Okafor"), ("person", "LIEV SHREIBER")}
    assert found("Saludos, Equipo Vapeo. Es mi cuenta de cliente. Lodeno Lite encaja. gracias Zosugo Halo") == set()
    ok = f"28/12345678/{int('2812345678') % 97:02d}"
    assert found(f"afiliación {ok} y 28/12345678/99 lote") == {("id_number", ok)}
    assert pii.valid_social(*[pii.pseudonym(ok, "id_number", b"k").split("/")[i] for i in (0, 1, 2)])
    assert found("nacido el 29/02/1980, no el 30/02/1980", dates=True) == {("date", "29/02/1980")} and found("29/02/1980") == set()
    moved = pii.pseudonym("29/02/1980", "date", b"k")
    assert pii.DATE.fullmatch(moved) and moved == pii.pseudonym("29/02/1980", "date", b"k") != "29/02/1980" and 1900 <= int(moved[-4:]) <= 2000
    far = "Ana" + "x" * 80
    assert ("person", f"Mendieta-{far.capitalize()}, Hugo") in found(f"según Mendieta-{far.capitalize()}, Hugo.")


def test_pii_operator(spark):
    df = spark.createDataFrame([(1, "tel. 614450421 o 614450421", "k"), (1, "tel. 614450421 o 614450421", "k"), (2, None, "k"), (3, "", "k")], "doc_id bigint, text string, kind string")
    assert [tuple(r)[:3] for r in pii.personal_data(df, b"k").collect()] == [(1, "phone", "614450421")]
    assert pii.redacted(df, b"k").count() == 4


def brute(item, doc, window=20, every=10):
    n = len(item)
    need = min(window, n)
    for a in range(n - need + 1):
        row = [0] * (len(doc) + 1)
        for size in range(1, n - a + 1):
            new = [size] * (len(doc) + 1)
            for j in range(1, len(doc) + 1):
                new[j] = min(row[j - 1] + (item[a + size - 1] != doc[j - 1]), row[j] + 1, new[j - 1] + 1)
            row = new
            if size >= need and min(row) <= size // every:
                return True
    return False


def test_longest_run_against_brute_force():
    rnd = random.Random(11)
    hits = 0
    for _ in range(150):
        item = [f"w{rnd.randrange(60)}" for _ in range(rnd.choice([7, 14, 25, 34]))]
        part = item[rnd.randrange(3) : len(item) - rnd.randrange(6)]
        for _ in range(rnd.randrange(5)):
            i = rnd.randrange(max(1, len(part)))
            part[i : i + 1] = rnd.choice([[], ["zz"], [*part[i : i + 1], "yy"]])
        doc = [f"d{rnd.randrange(9)}" for _ in range(8)] + part + [f"d{rnd.randrange(9)}" for _ in range(8)]
        at = {}
        for j in range(len(doc) - 4):
            at.setdefault(tuple(doc[j : j + 5]), []).append(j)
        anchors = [(i, j) for i in range(len(item) - 4) for j in at.get(tuple(item[i : i + 5]), [])]
        want = brute(item, doc)
        hits += want
        assert leaks.longest_run(item, doc, anchors) == want
    assert 30 < hits < 130


def test_leaked(spark):
    item = " ".join(f"palabra{i}" for i in range(30))
    docs = [
        (1, "x " + item.upper() + " y"), (2, "> " + item.replace(" palabra9 ", "\n> otra ")), (3, " ".join(item.split()[:15])), (4, None), (5, ""),
        (6, "<p>uno dos, tres</p>"), (7, " ".join(reversed(item.split()))), (1, "x " + item.upper() + " y"),
    ]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, item_id int")
    e = spark.createDataFrame([(10, item), (11, "Uno; dos tres"), (12, None), (13, ""), (14, item)], "item_id bigint, text string")
    assert sorted(tuple(r) for r in leaks.leaked(d, e).collect()) == [(1, 10), (1, 14), (2, 10), (2, 14), (6, 11)]
    assert leaks.leaked(d.limit(0), e).count() == 0 and leaks.leaked(d, e.limit(0)).count() == 0


def test_a_long_tag_inside_a_leak(spark):
    item = [f"palabra{i}" for i in range(24)]
    tag = '<a title="' + "muchas otras cosas " * 20 + '">'
    d = spark.createDataFrame([(1, " ".join([*item[:12], tag, *item[12:]]))], "doc_id bigint, text string")
    e = spark.createDataFrame([(10, " ".join(item))], "item_id bigint, text string")
    assert len(tag) > 300 and leaks.leaked(d, e).count() == 1


def test_more_items_than_fit_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(leaks, "MAX_BROADCAST", 20)
    item = " ".join(f"palabra{i}" for i in range(30))
    d = spark.createDataFrame([(i, f"{i} {item}") for i in range(40)], "doc_id bigint, text string")
    e = spark.createDataFrame([(10, item), (11, "una sola frase corta de seis")], "item_id bigint, text string")
    assert leaks.leaked(d, e).count() == 40


def test_words_agree(spark):
    t = "Água-9 <br/>Ñandú&nbsp;x_y 3 < 5 y 7 > 6 ÉTÉ​z"
    row = spark.createDataFrame([(t,)], "t string").select(leaks.words_of(leaks.F.col("t"))).first()[0]
    assert row == leaks.words(t)


def test_mix(spark):
    rnd = random.Random(2)
    docs = [(i, rnd.choice(["a", "b", "b", "c"]), "palabra " * rnd.randrange(1, 60), dt.datetime(2026, 1, 1)) for i in range(800)] + [(900, None, "x", None), (901, "a", None, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string, copies timestamp")
    t = spark.createDataFrame([("a", 0.5, 3), ("b", 0.3, 1), ("z", 0.2, 2), ("y", None, 1)], "source string, target_share double, max_repeats int")
    mix = mixing.mixed(df, t).collect()
    assert {r.source for r in mix} == {"a", "b"}
    assert all(0 <= r.copies <= {"a": 3, "b": 1}[r.source] for r in mix)
    tokens = {s: sum(r.tokens * r.copies for r in mix if r.source == s) for s in "ab"}
    assert abs(tokens["a"] / sum(tokens.values()) - 0.625) < 0.002
    for s in "ab":  # up to every size, copies and rates differ by less than one
        seen = 0.0
        for size in sorted({r.tokens for r in mix if r.source == s}):
            seen += sum(r.copies - r.rate for r in mix if r.source == s and r.tokens == size)
            assert abs(seen) < 1.01
    assert mixing.mixed(df.limit(0), t).count() == 0
