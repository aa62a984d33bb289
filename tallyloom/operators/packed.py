"""Several values packed in one field, split by a segmentation model learned from the column."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import checkpointed, lookup_join, release, salted_lookup

# Quote signs that open and close a span.
QUOTES = {'"': '"', "«": "»", "“": "”", "„": "“", "‘": "’", "'": "'", "`": "`"}
#: Signs that belong to the value whatever stands beside them, and signs that do without a blank beside them.
INSIDE = "-+:%‰"
INSIDE_UNSPACED = ",/."
NAMED = re.compile(r"[^\s\"«“„‘'`|;,/·:][^\"«“„‘'`|;,/·:\n\t]*:[ ]+")
_BLANK = "  "
#: Candidate delimiters a value of the learned table may run over; longer stretches are scored by their length alone.
REACH = 3
#: Before anything is learned a sign cuts with this probability, which counts as PRIOR occurrences.
START, PRIOR = 0.75, 2.0
#: The value table is broadcast up to this many rows (24 bytes each) and joined by salted keys beyond.
MAX_BROADCAST = 500_000
#: Cost in nats of a character of a value that the rest of the column does not hold.
PER_CHARACTER = 3.0


def sign(text: str, i: int) -> str | None:
    """The class of the candidate delimiter at i, or None: the sign, marked where a blank stands beside it."""
    ch = text[i]
    if ch in "\t\n\r  ":
        return ch
    if ch.isalnum() or ch in _BLANK or ch in INSIDE or ch in QUOTES or ch in "»”’":
        return None
    if unicodedata.category(ch) not in ("Po", "Sm", "So"):
        return None
    spaced = (i > 0 and text[i - 1] in _BLANK) or (i + 1 < len(text) and text[i + 1] in _BLANK)
    if ch in INSIDE_UNSPACED and not spaced:
        return None
    return ch + " " if spaced else ch


def lattice(text: str) -> tuple[list[tuple[int, str]], list[tuple[int, int]]]:
    """(position and class of every candidate delimiter outside quoted spans, the quoted spans).

    A quote opens a span only at the start of a piece or right after `name: `, and only if its
    closing sign is followed by the end, a blank or a sign; a doubled closing sign is part of
    the span. Which candidates cut is not known here: the model decides.
    """
    cuts: list[tuple[int, str]] = []
    spans: list[tuple[int, int]] = []
    i, n, start = 0, len(text), True
    while i < n:
        ch = text[i]
        if start and ch in _BLANK:
            i += 1
            continue
        if start:
            j = i
            if (m := NAMED.match(text, i)) and m.end() < n and text[m.end()] in QUOTES:
                j = m.end()
            if text[j] in QUOTES:
                close, k = QUOTES[text[j]], j + 1
                while k < n:
                    if text[k] == close:
                        if k + 1 < n and text[k + 1] == close:
                            k += 2
                            continue
                        break
                    k += 1
                after = text[k + 1 : k + 2]
                if k < n and (not after or after in _BLANK or after in INSIDE_UNSPACED or sign(text, k + 1)):
                    spans.append((j, k + 1))
                    i, start = k + 1, False
                    continue
            start = False
        if (kind := sign(text, i)) is not None:
            cuts.append((i, kind))
            start = True
        i += 1
    return cuts, spans


def unquoted(piece: str) -> str:
    """Trimmed; quotes round the whole piece or round all that follows `name: ` are dropped."""
    piece = piece.strip()
    m = NAMED.match(piece)
    head = m.group(0) if m and m.end() < len(piece) and piece[m.end()] in QUOTES else ""
    body = piece[len(head) :]
    if len(body) >= 2 and body[0] in QUOTES:
        close = QUOTES[body[0]]
        inner = body[1:-1]
        if body[-1] == close and close not in inner.replace(close * 2, ""):
            return (head + inner.replace(close * 2, close)).strip()
    return piece


def edges(text: str, cuts: Sequence[tuple[int, str]]) -> list[str]:
    """The values of all edges, in the order (first piece, pieces run over) that `layout` names."""
    at = [-1, *[p for p, _ in cuts], len(text)]
    n = len(at) - 1
    return [unquoted(text[at[a] + 1 : at[a + s + 1]]) for a, s in layout(n)]


def layout(pieces: int) -> list[tuple[int, int]]:
    return [(a, s) for a in range(pieces) for s in range(min(REACH, pieces - 1 - a) + 1)]


def prior_posteriors(pieces: int, p: float = START) -> list[float]:
    """Probability of each edge where every sign cuts independently."""
    return [(p if a else 1.0) * (1 - p) ** s * (p if a + s < pieces - 1 else 1.0) for a, s in layout(pieces)]


def _weights(lengths: Sequence[int], kinds: Sequence[str], support: Sequence[float], odds: Mapping[str, tuple[float, float]], novel: float):
    """Log weights of the edges of the table, of one more piece of an unknown value, and of cutting at each node.

    An edge is one value: its log frequency among the other texts (support) plus that of an
    unknown value of its length, the signs it runs over, and the cut that ends it.
    """
    n = len(lengths)
    cut = [odds[k][0] for k in kinds] + [0.0]
    over = [odds[k][1] for k in kinds]
    run = [0.0] * (n + 1)  # run[b] - run[a]: cost of the unknown value of pieces a .. b-1 but for the first `over`
    for b in range(n):
        run[b + 1] = run[b] - PER_CHARACTER * (lengths[b] + 1) + (over[b] if b < n - 1 else 0.0)
    table = []
    for (a, s), f in zip(layout(n), support):
        b = a + s
        unknown = novel + run[b + 1] - run[a] - (over[b] if b < n - 1 else 0.0)
        known = math.log(f) + sum(over[a:b]) if f > 0 else -math.inf
        hi, lo = (known, unknown) if known > unknown else (unknown, known)
        table.append(hi + math.log1p(math.exp(lo - hi)) + cut[b])
    return table, run, over, cut


def _plus(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -math.inf else x + math.log1p(math.exp(y - x))


def expectation(lengths, kinds, support, odds, novel) -> tuple[list[float], list[float]]:
    """(posterior of every edge of the table, posterior that each sign cuts), by forward and backward sums."""
    n = len(lengths)
    table, run, over, cut = _weights(lengths, kinds, support, odds, novel)
    where = layout(n)
    ending: list[list[int]] = [[] for _ in range(n)]
    starting: list[list[int]] = [[] for _ in range(n)]
    for i, (a, s) in enumerate(where):
        ending[a + s].append(i)
        starting[a].append(i)
    fore = [0.0] + [-math.inf] * n
    far = -math.inf
    for b in range(n):
        total = -math.inf
        for i in ending[b]:
            total = _plus(total, fore[where[i][0]] + table[i])
        if b > REACH:
            far = _plus(far, fore[b - REACH - 1] - run[b - REACH - 1])
            total = _plus(total, far + novel + run[b + 1] - (over[b] if b < n - 1 else 0.0) + cut[b])
        fore[b + 1] = total
    back = [-math.inf] * n + [0.0]
    far = -math.inf
    for a in range(n - 1, -1, -1):
        total = -math.inf
        for i in starting[a]:
            total = _plus(total, table[i] + back[a + where[i][1] + 1])
        b = a + REACH + 1
        if b < n:
            far = _plus(far, back[b + 1] + run[b + 1] - (over[b] if b < n - 1 else 0.0) + cut[b])
            total = _plus(total, far + novel - run[a])
        back[a] = total
    z = fore[n]
    return (
        [math.exp(min(0.0, fore[a] + w + back[a + s + 1] - z)) for (a, s), w in zip(where, table)],
        [math.exp(min(0.0, fore[j + 1] + back[j + 1] - z)) for j in range(n - 1)],
    )


def viterbi(lengths, kinds, support, odds, novel) -> list[int]:
    """The signs at which the likeliest segmentation cuts."""
    n = len(lengths)
    table, run, over, cut = _weights(lengths, kinds, support, odds, novel)
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for (a, s), w in zip(layout(n), table):
        ending[a + s].append((a, w))
    far, far_a = -math.inf, 0
    for b in range(n):
        for a, w in ending[b]:
            if best[a] + w > best[b + 1]:
                best[b + 1], back[b + 1] = best[a] + w, a
        if b > REACH:
            a = b - REACH - 1
            if best[a] - run[a] > far:
                far, far_a = best[a] - run[a], a
            w = far + novel + run[b + 1] - (over[b] if b < n - 1 else 0.0) + cut[b]
            if w > best[b + 1]:
                best[b + 1], back[b + 1] = w, far_a
    out, at = [], n
    while back[at]:
        at = back[at]
        out.append(at - 1)
    return out[::-1]


def pieces(text: str, cuts: Sequence[tuple[int, str]], chosen: Sequence[int]) -> list[tuple[int, str]]:
    """(position from 1, value) of the pieces between the chosen signs; blank pieces count but give nothing."""
    at = [-1, *[cuts[i][0] for i in chosen], len(text)]
    values = [unquoted(text[a + 1 : b]) for a, b in zip(at, at[1:])]
    return [(i, v) for i, v in enumerate(values, 1) if v]


def _log_odds(theta: float) -> tuple[float, float]:
    theta = min(1 - 1e-12, max(1e-12, theta))
    return math.log(theta), math.log1p(-theta)


def _value_hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


_BLANK_VALUE = _value_hash("")
_STATE = "k1 bigint, k2 bigint, kinds array<string>, lengths array<int>, vh array<bigint>, post array<float>"


def _lattices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for k1, k2, t in zip(pdf["k1"], pdf["k2"], pdf["_text"]):
            cuts, _ = lattice(t)
            at = [-1, *[p for p, _ in cuts], len(t)]
            lengths = [len(t[a + 1 : b].strip()) for a, b in zip(at, at[1:])]
            out.append((k1, k2, [k for _, k in cuts], lengths, [_value_hash(v) for v in edges(t, cuts)], prior_posteriors(len(lengths))))
        yield pd.DataFrame(out, columns=["k1", "k2", "kinds", "lengths", "vh", "post"])


class _Model:
    """What one round has learned, but for the table of values."""

    def __init__(self, texts: float, pieces: float, novel: float, theta: dict[str, float]):
        self.texts, self.pieces, self.novel, self.theta = texts, pieces, novel, theta

    def support(self, vh: Sequence[int], post: Sequence[float], known) -> list[float]:
        """How frequent each edge's value is in the other texts; a blank piece, among all pieces."""
        counted: dict[int, tuple[float, int]] = {vh[x["pos"]]: (x["c"], x["n"]) for x in known} if known is not None else {}
        own: Counter = Counter()
        times = Counter(vh)
        for v, x in zip(vh, post):
            own[v] += x
        out = []
        for v in vh:
            c, n = counted.get(v, (0.0, 0))
            out.append(max(0.0, c - own[v]) / (self.pieces if v == _BLANK_VALUE else self.texts) if n > times[v] else 0.0)
        return out

    def odds(self) -> dict[str, tuple[float, float]]:
        return {k: _log_odds(t) for k, t in self.theta.items()}


def _learn(state: DataFrame, theta: dict[str, float]) -> tuple[DataFrame, _Model]:
    """Maximisation: the values two or more edges have, with their expected counts, and the scalars of the model."""
    totals = state.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.aggregate("post", F.lit(0.0), lambda a, x: a + x)).alias("pieces")).first()
    values = checkpointed(
        state.select(F.explode(F.arrays_zip("vh", "post")).alias("e")).groupBy("e.vh").agg(F.sum(F.col("e.post").cast("double")).alias("c"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    texts, pieces_ = float(totals["texts"] or 0), float(totals["pieces"] or 0.0)
    shared = values.agg(F.sum("c")).first()[0] or 0.0
    return values, _Model(max(1.0, texts), max(1.0, pieces_), math.log((max(0.0, pieces_ - shared) + 1) / (pieces_ + 1)), theta)


def _with_known(state: DataFrame, values: DataFrame) -> DataFrame:
    """The state with pos, c and n of the edges whose value the table holds."""
    flat = state.select("k1", "k2", F.posexplode("vh").alias("pos", "vh"))
    found = lookup_join(flat, values, ["vh"], "k1", MAX_BROADCAST).groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "c", "n")).alias("known"))
    return state.drop("cuts").join(found, ["k1", "k2"], "left")


def split_packed(df: DataFrame, ids: list[str], columns: dict[str, str], rounds: int = 3) -> DataFrame:
    """ids, side, pos, item: one row per value packed in the columns (side name -> column).

    Expectation-maximisation over all distinct texts of the column together. Every sign outside
    quoted spans is a candidate delimiter, but for those that belong to the value whatever
    happens (INSIDE, and INSIDE_UNSPACED without a blank beside it). The model is the expected
    number of texts that hold each value and, for each class of sign, the probability that it
    cuts. A round sums over all segmentations of every text (forward-backward), where a value
    counts by its frequency in the other texts and otherwise by its length, and adds the
    posteriors up to the next model. Viterbi then decodes every text with the last model; with
    rounds=0 with the one from independent cuts. Quoted spans are atomic throughout.

    The value table stays distributed and is joined to the edges; it holds every value that two
    edges share. The driver gets one row per class of sign and the totals.
    pos is from 1 and counts blank pieces, which give no row. Null and blank texts give no row;
    repeated rows give their rows again; texts of any length are decoded whole.
    """
    sides = (
        df.select(*ids, F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("_text")) for s, c in columns.items()])).alias("_p"))
        .select(*ids, "_p.side", "_p._text")
        .where("_text is not null and _text rlike '\\\\S'")
        .withColumns({"k1": F.xxhash64("_text"), "k2": F.xxhash64(F.lit(1), "_text")})
    )
    texts = sides.select("k1", "k2", "_text").dropDuplicates(["k1", "k2"])
    state = checkpointed(texts.mapInPandas(_lattices, _STATE))
    values, model = _learn(state, {})
    kinds = [r[0] for r in state.select(F.explode("kinds").alias("k")).distinct().collect()]
    model.theta = {k: START for k in kinds}
    for _ in range(rounds):
        known = checkpointed(_with_known(state, values).mapInPandas(_expected(model), _STATE + ", cuts array<float>"))
        theta = {
            r["k"]: (r["s"] + START * PRIOR) / (r["n"] + PRIOR)
            for r in known.select(F.explode(F.arrays_zip("kinds", "cuts")).alias("e")).groupBy(F.col("e.kinds").alias("k")).agg(F.sum("e.cuts").alias("s"), F.count(F.lit(1)).alias("n")).collect()
        }
        release(state)
        release(values)
        state = known
        values, model = _learn(state, theta)
    chosen = _with_known(state, values).join(texts, ["k1", "k2"]).mapInPandas(_decoded(model), "k1 bigint, k2 bigint, items array<struct<pos:int,item:string>>")
    out = salted_lookup(sides.drop("_text").withColumn("_r", F.xxhash64(*ids)), chosen, ["k1", "k2"], "_r", how="inner")
    return out.select(*ids, "side", F.explode("items").alias("_i")).select(*ids, "side", "_i.pos", "_i.item")


def _expected(model: _Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds = model.odds()
        for pdf in batches:
            out = []
            for k1, k2, kinds, lengths, vh, post, known in zip(*(pdf[c] for c in ("k1", "k2", "kinds", "lengths", "vh", "post", "known"))):
                kinds, lengths, vh, post = list(kinds), lengths.tolist(), vh.tolist(), post.tolist()
                new, cuts = expectation(lengths, kinds, model.support(vh, post, known), odds, model.novel) if kinds else (post, [])
                out.append((k1, k2, kinds, lengths, vh, new, cuts))
            yield pd.DataFrame(out, columns=["k1", "k2", "kinds", "lengths", "vh", "post", "cuts"])

    return run


def _decoded(model: _Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds = model.odds()
        for pdf in batches:
            out = []
            for k1, k2, kinds, lengths, vh, post, known, text in zip(*(pdf[c] for c in ("k1", "k2", "kinds", "lengths", "vh", "post", "known", "_text"))):
                kinds, vh = list(kinds), vh.tolist()
                at = viterbi(lengths.tolist(), kinds, model.support(vh, post.tolist(), known), odds, model.novel) if kinds else []
                out.append((k1, k2, [{"pos": p, "item": v} for p, v in pieces(text, lattice(text)[0], at)]))
            yield pd.DataFrame(out, columns=["k1", "k2", "items"])

    return run
