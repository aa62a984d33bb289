"""Pairs of rows whose shared words may reach a score, found in their groups without shuffling pairs."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: By the two lowest bits of a coded word.
WEIGHTS = [1.0, 0.75, 1.4, 1.45]
_OUT = "_a bigint, _b bigint"


class Bound(NamedTuple):
    """The most that a score can be: common * shared / union + larger * (the larger of the shares) + bonuses.

    floor: this share of the smaller row's weight is enough by itself where two words are shared.
    bonuses: what equal values in that place of the bits add; alike: what equal kinds add; always: what any pair may get.
    """

    least: float
    common: float
    larger: float
    always: float
    bonuses: Sequence[float] = ()
    alike: float = 0.0
    floor: float | None = None


#: Bits of the hashes of one set of values; up to three sets and the two flags fit a bigint.
_SET = 20
_WHOLE, _TWO = 60, 61


def bits(sets: Sequence[Column], whole: Column | None = None, two: Column | None = None) -> Column:
    """Sets of values by their hashes, and what a row demands of a pair: whole: that all words are shared; two: at least two."""
    held = lambda p: lambda s, v: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.pmod(F.xxhash64(v), F.lit(_SET)) + p * _SET).cast("int")))
    out = F.lit(0).cast("bigint")
    for p, values in enumerate(sets):
        out = F.aggregate(values, out, held(p))
    for at, flag in ((_WHOLE, whole), (_TWO, two)):
        if flag is not None:
            out = out.bitwiseOR(F.when(flag, F.lit(1 << at)).otherwise(0).cast("bigint"))
    return out


def coded(words: Column, heavy: Sequence[str] = ()) -> Column:
    """64-bit codes of words, the class of the weight in the two lowest bits."""
    kind = lambda w: F.when(w.isin(*heavy), 3).when(w.rlike("[0-9]"), 2).when(F.length(w) <= 2, 1).otherwise(0).cast("bigint")
    return F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-4).cast("bigint")).bitwiseOR(kind(w)))


def near_pairs(a: DataFrame, b: DataFrame, bound: Bound, buckets: int = 64, split: int = 2) -> DataFrame:
    """_a, _b (distinct ids) of the pairs that the bound does not exclude, and of those with equal keys.

    Sides have _id, _group (rows of other groups never pair), _by (the same, or narrower for pairs
    without equal keys), _words (coded), _drop (coded words that do not count in rows they meet), _key
    (0 for none), _bits (of bits()) and _kind. Two filled sets without a value in common rule a pair out. Groups are spread over buckets by their hash and rows of a over
    `split` parts; a task holds the postings of its rows. A pair in reach shares one of the words of
    its lighter row that remain after the most frequent ones too light to reach the least share, so
    only those look up the other side.
    """
    bucket = F.pmod(F.xxhash64(F.lit(7), "_group"), F.lit(buckets)).cast("int").alias("_bucket")
    left = a.select("*", bucket, F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(split)).cast("int").alias("_part"))
    right = b.select(*[F.col(c).alias(f"r{c}") for c in b.columns], bucket.alias("_bucket"), F.explode(F.array(*[F.lit(i) for i in range(split)])).alias("_part"))
    return left.groupBy("_bucket", "_part").cogroup(right.groupBy("_bucket", "_part")).applyInPandas(_near(bound), _OUT).distinct()


def _near(bound: Bound):
    weights, chunk = WEIGHTS, 1_000_000

    def run(left, right):
        import numpy as np
        import pandas as pd

        odd, other = np.int64(-7046029254386353131), np.int64(-4417276706812531889)
        weight = np.array(weights)

        def flat(lists):
            lens = np.array([len(x) for x in lists], "int64")
            return np.repeat(np.arange(len(lens)), lens), np.concatenate([np.asarray(x, "int64") for x in lists] or [np.array([], "int64")])

        class Held:
            """A set of numbers that says yes for some others too, which only lets more pairs through to the score."""

            def __init__(self, values):
                self.mask = (1 << max(10, (24 * len(values)).bit_length())) - 1
                self.seen = np.zeros(self.mask + 1, bool)
                for at in self.places(values):
                    self.seen[at] = True

            def places(self, values):
                return (values >> 20) & self.mask, (values ^ (values >> 33)) & self.mask

            def has(self, values):
                one, two = self.places(values)
                return self.seen[one] & self.seen[two]

        class Side:
            def __init__(self, df, p):
                self.n, (self.id, self.group, self.by, self.key, self.bits, self.kind) = len(df), (df[f"{p}{c}"].to_numpy("int64") for c in ("_id", "_group", "_by", "_key", "_bits", "_kind"))
                self.row, word = flat(df[f"{p}_words"])
                self.w, self.k = weight[word & 3], self.by[self.row] ^ (word * odd)
                at, drop = flat(df[f"{p}_drop"])
                drop = self.by[at] ^ (drop * odd)
                self.drop, self.drops = np.unique(drop), Held(drop + at * other)

            def lighten(self, drop):
                """The least weight of a row, without the words that rows of the other side may drop; those by row."""
                loose = np.isin(self.k, drop)
                self.least = np.bincount(self.row, weights=self.w * ~loose, minlength=self.n)
                self.whole = np.bincount(self.row, weights=self.w, minlength=self.n)
                self.loose_k, self.loose_w = self.k[loose], self.w[loose]
                self.loose = np.searchsorted(self.row[loose], np.arange(self.n + 1))

            def left(self, i, y, j):
                """The weight of rows i without the words that rows j of y drop."""
                pair, place = spans(np.arange(len(i)), self.loose[i], self.loose[i + 1] - self.loose[i])
                gone = self.loose_w[place] * y.drops.has(self.loose_k[place] + j[pair] * other)
                return self.whole[i] - np.bincount(pair, weights=gone, minlength=len(i))

        def filled(bits, p):
            return (bits >> (p * _SET)) & ((1 << _SET) - 1)

        def flag(bits, at):
            return (bits >> at) & 1 == 1

        def least_share(x):
            """The least share of its own weight that each row must have in common with one at least as heavy."""
            need = np.maximum(bound.least - bound.always - bound.alike - sum((v * (filled(x.bits, p) != 0) for p, v in enumerate(bound.bonuses)), np.zeros(x.n)), 0.0)
            c, l = bound.common, bound.larger
            b = c + 2 * l + need
            share = 4 * need / (b + np.sqrt(np.maximum(b * b - 8 * l * need, 0.0)))  # common * s / (2 - s) + larger * s = need
            if bound.floor is not None:
                share = np.minimum(share, bound.floor)
            return np.where(flag(x.bits, _WHOLE), 1.0, share) - 1e-9

        def within(x, y, i, j, c, u, v, n=None):
            """Whether pairs of at least the weights u and v that share at most c (and n words) may reach the score."""
            p, q = x.bits[i], y.bits[j]
            most = bound.common * np.minimum(1.0, c / np.maximum(u + v - c, np.maximum(c, 1e-9))) + bound.always + bound.alike * (x.kind[i] == y.kind[j])
            larger = np.minimum(1.0, c / np.maximum(np.minimum(u, v), 1e-9))
            apart = np.zeros(len(i), bool)
            for at, value in enumerate(bound.bonuses):
                f, g = filled(p, at), filled(q, at)
                both = (f & g) != 0
                apart |= (f != 0) & (g != 0) & ~both
                most = most + value * both
            ok = most + bound.larger * larger >= bound.least - 1e-6
            if bound.floor is not None:
                ok |= (larger >= bound.floor - 1e-6) & (n is None or n >= 2)
            if n is not None:
                ok &= ~flag(p | q, _TWO) | (n >= 2)
            return ok & ~apart & (~flag(p | q, _WHOLE) | (c >= np.maximum(u, v) - 1e-6))

        def spans(of, lo, n):
            """Entry and place of every place lo[i] .. lo[i] + n[i] - 1."""
            ends = np.cumsum(n)
            at = np.repeat(np.arange(len(n)), n)
            return of[at], np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n) + lo[at]

        def chunks(row, n):
            """Ranges of entries of whole rows with about `chunk` places."""
            if not len(row):
                return
            last = np.flatnonzero(np.append(row[1:] != row[:-1], True)) + 1
            at, done = 0, np.cumsum(n)
            while at < len(row):
                to = last[min(np.searchsorted(done[last - 1], (done[at - 1] if at else 0) + chunk, "left"), len(last) - 1)]
                yield at, to
                at = to

        def looked_up(x, y, keys, lighter):
            rows = y.row[np.argsort(y.at, kind="stable")]
            held = Held(y.k + y.row * other)
            each = np.bincount(y.at, minlength=keys)
            lo, n = (np.cumsum(each) - each)[x.at], each[x.at]
            at = np.flatnonzero(n > 0)
            at = at[np.lexsort((n[at], x.row[at]))]
            row, w, lo, n, k = x.row[at], x.w[at], lo[at], n[at], x.k[at]
            first = np.searchsorted(row, np.arange(x.n + 1))
            sums = np.concatenate([[0.0], np.cumsum(w)])
            rest = sums[first[row + 1]] - sums[:-1]
            all_shared = sums[first[1:]] - sums[first[:-1]]
            last = np.arange(len(row)) == first[row + 1] - 1
            few = np.flatnonzero((rest >= (least_share(x) * x.least)[row] - 1e-6) & ~(last & flag(x.bits[row], _TWO)))
            row_p, lo_p, n_p = row[few], lo[few], n[few]
            for start, end in chunks(row_p, n_p):
                i, place = spans(row_p[start:end], lo_p[start:end], n_p[start:end])
                j = rows[place]
                fits = np.flatnonzero(lighter(x.least[i], y.least[j]))
                fits = fits[within(x, y, i[fits], j[fits], all_shared[i[fits]], x.least[i[fits]], y.least[j[fits]])]
                pair = np.unique(i[fits] * y.n + j[fits])
                i, j = pair // y.n, pair % y.n
                for s in range(0, len(i), chunk // 8):
                    yield reached(x, y, i[s : s + chunk // 8], j[s : s + chunk // 8], first, w, k, held)

        def reached(x, y, i, j, first, w, k, held):
            if not len(i):
                return i, j
            pair, place = spans(np.arange(len(i)), first[i], first[i + 1] - first[i])
            want = k[place] + j[pair] * other
            hit = held.has(want)
            c = np.bincount(pair, weights=w[place] * hit, minlength=len(i))
            n = np.bincount(pair, weights=hit, minlength=len(i))
            ok = within(x, y, i, j, c, x.least[i], y.least[j], n)
            i, j, c, n = i[ok], j[ok], c[ok], n[ok]
            ok = within(x, y, i, j, c, x.left(i, y, j), y.left(j, x, i), n)
            return i[ok], j[ok]

        def same_key(x, y):
            p, q = np.flatnonzero(x.key), np.flatnonzero(y.key)
            ours, theirs = x.group[p] ^ (x.key[p] * odd), y.group[q] ^ (y.key[q] * odd)
            order = np.argsort(theirs, kind="stable")
            theirs, q = theirs[order], q[order]
            lo = np.searchsorted(theirs, ours, "left")
            i, place = spans(p, lo, np.searchsorted(theirs, ours, "right") - lo)
            return i, q[place]

        found = []
        if len(left) and len(right):
            a, b = Side(left, ""), Side(right, "r")
            a.lighten(b.drop)
            b.lighten(a.drop)
            known, at = np.unique(np.concatenate([a.k, b.k]), return_inverse=True)
            a.at, b.at = at[: len(a.k)], at[len(a.k) :]
            found = [(a.id[i], b.id[j]) for i, j in looked_up(a, b, len(known), np.less_equal)]
            found += [(a.id[i], b.id[j]) for j, i in looked_up(b, a, len(known), np.less)]
            i, j = same_key(a, b)
            found.append((a.id[i], b.id[j]))
        one, two = (np.concatenate([f[s] for f in found] or [np.array([], "int64")]) for s in (0, 1))
        return pd.DataFrame({"_a": one, "_b": two}).drop_duplicates()

    return run
