"""Evaluation texts leaking into a corpus: prefix-filtered shingle join, exact windowed check."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.binding import let
from tallyloom.session import checkpointed, lookup_join

#: Words of a window and of a shingle; one edit is allowed per EDIT_EVERY words.
WINDOW, SHINGLE, EDIT_EVERY = 20, 5, 10
#: The items' prefix shingles are broadcast up to this many rows; more are shuffled.
MAX_BROADCAST = 400_000

# Accented letters and the letters they are compared as.
_ACCENTED = "àáâãäåāăąçćĉċčďèéêëēĕėęěĝğġģĥìíîïĩīĭįĵķĺļľñńņňòóôõöōŏőŕŗřśŝşšţťùúûüũūŭůűųŵýÿŷźżž"
_PLAIN = "aaaaaaaaacccccdeeeeeeeeegggghiiiiiiiijklllnnnnoooooooorrrssssttuuuuuuuuuuwyyyzzz"
_TAG = r"</?[a-z!][^<>]*>|&(?:[a-z]+[0-9]*|#[0-9]+|#x[0-9a-f]+);"


def words_of(text: Column) -> Column:
    """The words of a text; case, accents, punctuation, markup and layout do not count."""
    t = F.lower(text)
    t = F.regexp_replace(t, r"[̀-ͯ­​-‍⁠﻿]", "")
    t = F.regexp_replace(t, _TAG, " ")
    t = F.translate(t, _ACCENTED, _PLAIN)
    return F.filter(F.split(t, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def words(text: str) -> list[str]:
    """words_of in Python, for tests."""
    t = re.sub(r"[̀-ͯ­​-‍⁠﻿]", "", text.lower())
    t = re.sub(_TAG, " ", t).translate(str.maketrans(_ACCENTED, _PLAIN))
    return [w for w in re.split(r"[^\w]+|_", t) if w]


def shingles(ws: Column, sizes: tuple[int, ...] = (SHINGLE,)) -> Column:
    """array<struct<pos, h>> of the hashes of runs of words of the given sizes."""

    def of(w: Column, k: int) -> Column:
        n = F.size(w)
        runs = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.struct((i + 1).alias("pos"), F.xxhash64(F.lit(k), *[F.get(w, i + j) for j in range(k)]).alias("h")))
        return F.when(n >= k, runs).otherwise(F.array().cast("array<struct<pos:int,h:bigint>>"))

    return let(ws, lambda w: F.concat(*[of(w, k) for k in sizes]))


def longest_run(item: list[str], doc: list[str], anchors: list[tuple[int, int]], window: int = WINDOW, every: int = EDIT_EVERY) -> bool:
    """Whether doc holds enough of item: a run of at least `window` words of the item (all of it,
    if shorter) of which at most one in `every` is replaced, left out or added.

    Any such run holds an exact stretch of SHINGLE words, because its edits split the words
    they leave into stretches longer than that, so the run passes through one of the anchors
    (item position, doc position). From each maximal exact stretch both ends are extended, edit
    by edit, to the furthest item position any alignment reaches; the best split of the edits
    between the two ends is tried for every number of edits.
    """
    n = len(item)
    need = min(window, n)
    if not need:
        return False
    most = n // every
    seen: set[tuple[int, int]] = set()
    for i, j in sorted(anchors):
        if (i, j) in seen:
            continue
        a, b = i, j
        while a > 0 and b > 0 and item[a - 1] == doc[b - 1]:
            a, b = a - 1, b - 1
        x, y = i, j
        while x < n and y < len(doc) and item[x] == doc[y]:
            seen.add((x, y))
            x, y = x + 1, y + 1
        exact = x - a
        if exact >= need:
            return True
        left = _reach(item[:a][::-1], doc[max(0, b - n - most) : b][::-1], most)
        right = _reach(item[x:], doc[y : y + n + most], most)
        for e in range(most + 1):
            span = exact + max(left[k] + right[e - k] for k in range(e + 1))
            if span >= need and e <= span // every:
                return True
    return False


def _reach(item: list[str], doc: list[str], most: int) -> list[int]:
    """reach[e]: the most words of item covered from its start with at most e edits."""
    n, m = len(item), len(doc)
    front: dict[int, int] = {}
    out = []
    for e in range(most + 1):
        new: dict[int, int] = {}
        for d in range(-e, e + 1):
            if e == 0:
                i = 0
            else:
                i = max(front.get(d, -1) + 1, front.get(d - 1, -1) + 1, front.get(d + 1, -1))
                if i < 0:
                    continue
            i = min(i, n)
            j = i - d
            if j < 0:
                continue
            while i < n and j < m and item[i] == doc[j]:
                i, j = i + 1, j + 1
            new[d] = i
        front = {d: max(v, front.get(d, -1)) for d, v in new.items()} | {d: v for d, v in front.items() if d not in new}
        out.append(max([0, *front.values()]))
    return out


def leaked(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, item_id of every document that holds a test item, in full or in part.

    Shingles of five words are ordered by their global rarity (the number of documents that
    hold them, counted over all documents). A window of 20 words with two edits keeps at least
    6 of its 16 shingles, so one of its 11 rarest must be shared: only those prefix shingles of
    every item window are joined. Items shorter than a window give all their shingles. Each
    candidate is verified exactly, over windows of the item's size, from the anchors found.
    Positional bounds discard candidates whose anchors leave too few words on both sides.

    Null and empty texts match nothing; repeated rows of either table give their pair once.
    Identical items each get their own row.
    """
    its = checkpointed(
        items.select(F.col(item_id).alias("_i"), words_of(F.col(text)).alias("_iw")).where(F.size("_iw") > 0).dropDuplicates(["_i", "_iw"])
    )
    # an item shorter than a shingle is one run of all its words
    short = tuple(r[0] for r in its.where(F.size("_iw") < SHINGLE).select(F.size("_iw")).distinct().collect())
    n = F.size("_iw")
    item_shingles = its.where(n >= SHINGLE).select("_i", n.alias("_n"), F.inline(shingles(F.col("_iw"))))
    for k in short:
        item_shingles = item_shingles.unionByName(its.where(n == k).select("_i", n.alias("_n"), F.inline(shingles(F.col("_iw"), (k,)))))
    item_shingles = checkpointed(item_shingles)
    vocabulary = item_shingles.select("h").distinct()
    docs = documents.select(F.col(doc_id).alias("_d"), F.col(text).alias("_t")).where(F.col("_t").isNotNull() & F.col("_d").isNotNull())
    runs = docs.select("_d", F.inline(shingles(words_of(F.col("_t")), (SHINGLE, *short))))
    hits = checkpointed(lookup_join(runs, vocabulary, ["h"], "_d", MAX_BROADCAST))
    df = hits.groupBy("h").agg(F.approx_count_distinct("_d", 0.01).alias("df"))
    ranked = item_shingles.join(df, "h", "left").select("_i", "_n", "pos", "h", F.coalesce("df", F.lit(0)).alias("df"))
    kept_of_window = WINDOW - WINDOW // EDIT_EVERY
    # shingles of a window, those an edit may spoil, and so the prefix that must be joined
    per_window = WINDOW - SHINGLE + 1
    spoiled = SHINGLE * (WINDOW // EDIT_EVERY)
    prefix = spoiled + 1
    assert per_window >= prefix and kept_of_window > SHINGLE
    grouped = ranked.groupBy("_i", "_n").agg(F.array_sort(F.collect_list(F.struct("pos", "df", "h"))).alias("s"))
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("s") - per_window + 1, F.lit(1))),
        lambda w: F.slice(F.array_sort(F.transform(F.slice("s", w, per_window), lambda x: F.struct(x["df"].alias("df"), x["h"].alias("h"), x["pos"].alias("pos")))), 1, prefix),
    )
    prefixes = grouped.select("_i", "_n", F.inline(F.array_distinct(F.flatten(windows)))).select("_i", "_n", F.col("pos").alias("_ip"), "h")
    anchors = (
        lookup_join(hits, prefixes, ["h"], "_d", MAX_BROADCAST)
        .groupBy("_d", "_i")
        .agg(F.array_sort(F.collect_set(F.struct((F.col("_ip") - 1).alias("i"), (F.col("pos") - 1).alias("j")))).alias("_a"))
    )
    words_once = docs.join(anchors.select("_d").distinct(), "_d", "left_semi").select("_d", words_of(F.col("_t")).alias("_dw"))
    wanted = lookup_join(anchors.join(words_once, "_d").select("_d", "_i", "_a", "_dw"), its, ["_i"], "_d", MAX_BROADCAST // 20)
    positional = F.size("_dw") >= F.least(F.lit(WINDOW), F.size("_iw")) - F.floor(F.least(F.lit(WINDOW), F.size("_iw")) / EDIT_EVERY)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [
                longest_run(list(iw), list(dw), [(p["i"], p["j"]) for p in a]) for iw, dw, a in zip(pdf["_iw"], pdf["_dw"], pdf["_a"])
            ]
            yield pdf.loc[keep, ["_d", "_i"]]

    out = wanted.where(positional).mapInPandas(verify, wanted.select("_d", "_i").schema)
    return out.distinct().select(F.col("_d").alias(doc_id), F.col("_i").alias(item_id))
