import random

from pyspark.sql import functions as F

from tallyloom.functions import hardware as H
from tallyloom.operators import base_match, near

BASE = "id string, distributor string, title string, block string, keys array<string>"
SCORED = f"{BASE}, f struct<tokens array<string>, caps array<double>, packs array<double>, subtype string, salt boolean, key string, ref string, aroma boolean>"


def _bases(spark, n, seed):
    rnd = random.Random(seed)
    some = lambda xs, k: rnd.sample(xs, rnd.randrange(k + 1))
    words = [f"w{chr(97 + i)}" for i in range(12)] + ["coilx", "mesho", "x7", "dtl", "mtl", "v2", "pro", "s1"]
    out = []
    for i in range(n):
        block = rnd.choice(["kit_device", "coil", "aroma_concentrate"])
        key = rnd.choice([None, f"k{rnd.randrange(30)}"])
        own = ["example", *some(words, 6)] if rnd.random() < 0.9 else []
        f = (own, some([2.0, 3.0], 1), some([4.0], 1), block, rnd.random() < 0.5, key, key, block == "aroma_concentrate")
        out.append((f"{seed}:{i % (n - 5)}", "d", f"t{i}", block, some(["p", "q", "r"], 2), f))
    return spark.createDataFrame(out, SCORED)


def test_scored_bases_equal_all_pairs_of_their_blocks(spark):
    a, b = _bases(spark, 150, 1), _bases(spark, 150, 2)
    for threshold in (0.72, 0.5, 0.9):
        x, y = (df.select(F.struct("*").alias(n)) for df, n in ((a, "a"), (b, "b")))
        every = x.crossJoin(y).where((F.col("a.block") == F.col("b.block")) & F.arrays_overlap("a.keys", "b.keys"))
        scored = every.groupBy("a.id", "b.id").agg(F.round(F.max(H.product_pair_score(F.col("a.f"), F.col("b.f"))), 6).alias("s"), F.min("b.title"))
        want = {tuple(r) for r in scored.where(F.col("s") >= threshold).collect()}
        got = [(r.a_id, r.b_id, r.score, r.b_title) for r in base_match.scored_bases(a, b, threshold).collect()]
        assert set(got) == want and len(got) == len(want) > 20


def test_a_word_of_all_rows_brings_no_pair_together(spark):
    def side(n):
        words = F.array(F.lit("example"), F.lit("kit"), *[F.concat(F.lit(x), F.col("id") * n % 997) for x in ("left", "mid", "right")])
        none = F.lit(0).cast("bigint")
        return spark.range(1000).select(F.col("id").alias("_id"), F.lit(1).cast("bigint").alias("_group"), F.lit(1).cast("bigint").alias("_by"), near.coded(words).alias("_words"), F.array().cast("array<bigint>").alias("_drop"), none.alias("_key"), none.alias("_bits"), none.alias("_kind"))

    bound = near.Bound(0.72, 0.62, 0.28, 0.13, floor=0.68)
    met = near.near_pairs(side(1), side(1), bound, buckets=4)
    assert met.where("_a = _b").count() == 1000 and met.count() < 1100


INVERSE = "id string, distributor string, title string, keys array<string>, f struct<tokens array<string>, brand_words array<string>, kind string, group string, key string, ml array<double>, ohm array<double>, packs array<double>, promo boolean>"


def _inverse_bases(spark, n, seed):
    rnd = random.Random(seed)
    some = lambda xs, k: rnd.sample(xs, rnd.randrange(k + 1))
    words = [f"w{chr(97 + i)}" for i in range(9)] + ["mesho", "x7", "dtl", "brefi", "gumito"]
    out = []
    for i in range(n):
        kind, group = rnd.choice([("coil", "parts"), ("pod", "parts"), ("eliquid", "liquidos"), ("aroma_concentrate", "liquidos")])
        brands = some(["brefi", "gumito", "wa"], 2)
        own = [w for w in ["example", *some(words, 6)] if w not in brands]
        f = (own, brands, kind, group, rnd.choice([None, f"k{rnd.randrange(30)}"]), some([2.0, 3.0], 1), some([1.0], 1), some([4.0], 1), rnd.choice([None, False, False, True]))
        out.append((f"{seed}:{i}", "d", f"t{i}", some(["p", "q", "r"], 2), f))
    return spark.createDataFrame(out, INVERSE)


def test_inverse_candidates_equal_all_pairs_of_their_brands(spark):
    a, b = _inverse_bases(spark, 150, 1), _inverse_bases(spark, 150, 2)
    for threshold in (0.4, 0.88):
        x, y = (df.select(F.struct("*").alias(n)) for df, n in ((a, "a"), (b, "b")))
        every = x.crossJoin(y).where(F.arrays_overlap("a.keys", "b.keys") | ((F.size("a.keys") == 0) & (F.size("b.keys") == 0)))
        scored = every.select("a.id", "b.id", "b.title", base_match.inverse_score(F.col("a.f"), F.col("b.f")).alias("s"))
        want = {tuple(r) for r in scored.where(F.col("s") >= threshold).collect()}
        got = [(r.a_id, r.b_id, r.b_title, r.score) for r in base_match.inverse_candidates(a, b, threshold).collect()]
        assert set(got) == want and len(got) == len(want) > 20


def test_hardly_more_inverse_pairs_are_met_than_score(spark, monkeypatch):
    met, real = [], near.near_pairs
    monkeypatch.setattr(near, "near_pairs", lambda *sides: met.append(real(*sides)) or met[-1])
    got = base_match.inverse_candidates(_inverse_bases(spark, 300, 1), _inverse_bases(spark, 300, 2), 0.4).count()
    assert got > 1000 and met[0].count() < 1.5 * got
