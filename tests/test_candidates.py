import random

from tallyloom.operators import candidates


def test_shared_tokens_equal_brute_force_for_frequent_tokens(spark):
    rnd = random.Random(7)
    rows = [(i, "xyz"[i % 3], ["common"] + [f"w{rnd.randrange(25)}" for _ in range(rnd.randrange(6))]) for i in range(240)]
    rows += [(900, "x", ["alone"]), (901, "y", []), (902, "x", ["common"])]
    want = set()
    for a, s, t in rows:
        for side in {"x", "y", "z"} - {s}:
            best = sorted((-len(set(t) & set(u)), b) for b, v, u in rows if v == side and set(t) & set(u))[:7]
            want |= {(a, side, b, -n, i) for i, (n, b) in enumerate(best, 1)}
    df = spark.createDataFrame(rows, "id bigint, side string, tokens array<string>")
    for block_rows in (1000, 30):
        got = candidates.shared_token_best(df, "id", "side", "tokens", 7, block_rows).collect()
        assert {(r.a_id, r.b_side, r.b_id, r.shared, r.position) for r in got} == want and len(got) == len(want)


def test_no_row_loses_its_candidates_to_a_posting_cap(spark):
    rows = [(i, "a" if i < 500 else "b", ["liquido", "envase"]) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, side string, tokens array<string>")
    got = candidates.shared_token_best(df, "id", "side", "tokens", 120)
    assert got.select("a_id").distinct().count() == 1000 and got.count() == 120_000


def test_counts_over_a_byte_and_rare_words_equal_brute_force(spark):
    rnd = random.Random(3)
    many = [f"m{i}" for i in range(300)]
    rows = [(i, "xy"[i % 2], many[: rnd.choice([0, 5, 254, 300])] + [f"r{rnd.randrange(200)}" for _ in range(4)]) for i in range(160)]
    want = set()
    for a, s, t in rows:
        best = sorted((-len(set(t) & set(u)), b) for b, v, u in rows if v != s and set(t) & set(u))[:9]
        want |= {(a, b, -n, i) for i, (n, b) in enumerate(best, 1)}
    df = spark.createDataFrame(rows, "id bigint, side string, tokens array<string>")
    got = candidates.shared_token_best(df, "id", "side", "tokens", 9).collect()
    assert {(r.a_id, r.b_id, r.shared, r.position) for r in got} == want and len(got) == len(want)


def test_no_row_is_shuffled_per_block_it_meets(spark):
    rows = [(i, "xyz"[i % 3], [f"w{i % 7}", f"v{i % 11}", "common"]) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, side string, tokens array<string>")
    best = candidates.shared_token_best(df, "id", "side", "tokens", 5, 20)
    assert "Exchange" not in best._jdf.queryExecution().executedPlan().toString()
    assert best.count() == 200 * 2 * 5


def test_rows_without_words_have_no_candidates(spark):
    df = spark.createDataFrame([(1, "x", []), (2, "y", [])], "id bigint, side string, tokens array<string>")
    assert candidates.shared_token_best(df, "id", "side", "tokens", 5).collect() == []
