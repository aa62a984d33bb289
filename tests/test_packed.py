import itertools
import math
import random

from tallyloom.operators import packed

CASES = {
    "a | b; c, d / e · f\tg\nh": [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f"), (7, "g"), (8, "h")],
    "80/20;2,5 mm;Blue-Green|Fresa+Nata": [(1, "80/20"), (2, "2,5 mm"), (3, "Blue-Green"), (4, "Fresa+Nata")],
    '"x; y" ; color: "El ""K"", z"': [(1, "x; y"), (2, 'color: El "K", z')],
    '«70/30» |"sabor: Cuarto d\'Oro"; ': [(1, "70/30"), (2, "sabor: Cuarto d'Oro")],
    "nicotina: 0mg |  ; Capacidad: 2 ml": [(1, "nicotina: 0mg"), (3, "Capacidad: 2 ml")],
    '"open; b': [(1, '"open'), (2, "b")],
    "Captain's Mix;d'Oro": [(1, "Captain's Mix"), (2, "d'Oro")],
    " ; ": [],
}


def test_rules(spark):
    rows = [(i, t, None, "extra") for i, t in enumerate(CASES)] + [(90, None, "  ", "x"), (91, "", None, "x")]
    df = spark.createDataFrame(rows, "match_id bigint, a_variant string, b_variant string, pos string")
    got = {}
    for r in packed.split_packed(df, ["match_id"], {"a": "a_variant", "b": "b_variant"}).collect():
        got.setdefault(r.match_id, []).append((r.pos, r.item))
    assert {i: sorted(v) for i, v in got.items()} == {i: v for i, v in enumerate(CASES.values()) if v}


def test_model_learns_separators(spark):
    rows = [(i, t) for i, t in enumerate(["red", "blue", "10 ml"] * 30 + ["red•blue", "blue•10 ml", "10 ml•red"] * 5)]
    df = spark.createDataFrame(rows, "match_id bigint, v string")
    got = packed.split_packed(df, ["match_id"], {"v": "v"}).where("match_id = 90").collect()
    assert sorted((r.pos, r.item) for r in got) == [(1, "red"), (2, "blue")]


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "match_id bigint, v string")
    assert packed.split_packed(df, ["match_id"], {"v": "v"}).collect() == []
    long = spark.createDataFrame([(1, "; ".join(f"v{i}" for i in range(5000)))], "match_id bigint, v string")
    assert packed.split_packed(long, ["match_id"], {"v": "v"}).count() == 5000


def _brute(lengths, kinds, support, odds, novel):
    """(log weight, cuts, edges used) of every segmentation."""
    n = len(lengths)
    at = {e: i for i, e in enumerate(packed.layout(n))}
    for mask in itertools.product([0, 1], repeat=n - 1):
        cuts = [j for j in range(n - 1) if mask[j]]
        ends, w, used = [*cuts, n - 1], 0.0, []
        for a, b in zip([0, *[c + 1 for c in cuts]], ends):
            f = support[at[a, b - a]] if (a, b - a) in at else 0.0
            length = sum(lengths[a : b + 1]) + (b - a + 1)
            w += math.log(f + math.exp(novel - packed.PER_CHARACTER * length)) + sum(odds[kinds[j]][1] for j in range(a, b))
            used.append((a, b - a))
        yield w + sum(odds[kinds[j]][0] for j in cuts), cuts, used


def test_expectation_and_viterbi_agree_with_all_segmentations():
    rng = random.Random(3)
    for n in (2, 3, 6, 8):
        lengths = [rng.randint(0, 4) for _ in range(n)]
        kinds = [rng.choice("|&") for _ in range(n - 1)]
        support = [rng.choice([0.0, rng.random()]) for _ in packed.layout(n)]
        odds = {"|": packed._log_odds(0.8), "&": packed._log_odds(0.3)}
        every = list(_brute(lengths, kinds, support, odds, -1.0))
        total = sum(math.exp(w) for w, _, _ in every)
        post, cuts = packed.expectation(lengths, kinds, support, odds, -1.0)
        for e, p in zip(packed.layout(n), post):
            assert abs(p - sum(math.exp(w) for w, _, used in every if e in used) / total) < 1e-9
        for j, p in enumerate(cuts):
            assert abs(p - sum(math.exp(w) for w, c, _ in every if j in c) / total) < 1e-9
        assert packed.viterbi(lengths, kinds, support, odds, -1.0) == max(every)[1]


def test_rounds_change_the_result(spark):
    """A sign inside values starts like any other; only the column tells it from a separator."""
    rng = random.Random(1)
    values = ["red", "navy", "10 ml", "3 mg", "70/30", "salt & lime", "B&W", "mint", "fig", "50 ml"]
    truth = [[rng.choice(values) for _ in range(rng.randint(1, 4))] for _ in range(400)]
    rows = [(i, rng.choice(["; ", " ¦ ", "|"]).join(v)) for i, v in enumerate(truth)]
    df = spark.createDataFrame(rows, "match_id bigint, v string")
    want = sorted((i, p, x) for i, v in enumerate(truth) for p, x in enumerate(v, 1))
    got = {n: sorted((r.match_id, r.pos, r.item) for r in packed.split_packed(df, ["match_id"], {"v": "v"}, rounds=n).collect()) for n in (0, 2)}
    assert got[2] == want and got[0] != want


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a; b", "k", 5)], "match_id bigint, v string, items string, k1 int")
    assert packed.split_packed(df, ["match_id"], {"v": "v"}).count() == 2
