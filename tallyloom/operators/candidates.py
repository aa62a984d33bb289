"""Candidates by shared tokens, exact for tokens of any frequency."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.session import stored

# Words the reference does not index.
STOP = (
    "a al and aroma aromas base bote botella by capacidad caracteristicas cartucho con de del descripcion distribuidor edition el en es este "
    "formato html http https la las liquido liquidos los marca marcas meta ml para pod producto que referencia scrapeada sin sweet the "
    "ultimate un una vapeo vaperalia eciglogistica venta y"
).split()

# The most rows of a slice, and one in how many rows of a block makes a word a column. Neither changes the result.
SLICE, DENSE = 8192, 500


def words(*texts: Column) -> Column:
    """Distinct words of two letters or more of the texts together, stop words left out."""
    stop = F.array(*[F.lit(w) for w in STOP])
    return F.array_distinct(F.filter(F.split(T.numbered(F.concat_ws(" ", *texts)), "[^a-z0-9]+"), lambda w: (F.length(w) > 1) & ~F.array_contains(stop, w)))


def product_words() -> Column:
    """Words of three letters or more of all fields that the reference indexes."""
    texts = [F.col(c) for c in ("name", "meta_description", "description", "reference", "synthetic_reference")]
    return F.filter(words(*texts, F.concat_ws(" ", F.map_values("variants")), F.col("url")), lambda w: F.length(w) >= 3)


def shared_token_top(rows: DataFrame, row_id: str, side: str, tokens: str, longest: int, keep: int) -> DataFrame:
    """a_id, b_side, b_id, shared, position: the `keep` rows of every other side that share most tokens,
    without tokens that more than `longest` rows of that side have. Both limits are part of this
    operator's result; shared_token_best is the one without the first."""
    flat = rows.select(F.col(row_id).alias("_id"), F.col(side).alias("_side"), F.explode(tokens).alias("_t")).where("_id is not null and _side is not null")
    posted = flat.groupBy("_side", "_t").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= longest).drop("_n")
    b = flat.join(posted, ["_side", "_t"]).select(F.col("_id").alias("b_id"), F.col("_side").alias("b_side"), "_t")
    shared = flat.join(b, "_t").where("_side <> b_side").groupBy(F.col("_id").alias("a_id"), "b_side", "b_id").agg(F.count(F.lit(1)).alias("shared"))
    w = Window.partitionBy("a_id", "b_side").orderBy(F.desc("shared"), "b_id")
    return shared.withColumn("position", F.row_number().over(w)).where(F.col("position") <= keep)


def shared_token_best(rows: DataFrame, row_id: str, side: str, tokens: str, keep: int, block_rows: int = 196_608) -> DataFrame:
    """a_id, b_side, b_id, shared, position: per row and other side the `keep` rows that share
    most tokens, equal ones by id. Every token counts, whatever its frequency.

    Each side is cut into ranges of ids, blocks of about block_rows rows, and each block's postings are written once to the
    shared folder, which the tasks read with pyarrow. A task has a slice of one block and goes through the blocks of every other side by
    id with the best so far of its rows; so no pair of rows and no partial best is shuffled or stored, disk grows as the rows do and memory is bounded by
    block and slice. Ids are unique.
    """
    spark = rows.sparkSession
    known = rows.where(F.col(row_id).isNotNull() & F.col(side).isNotNull()).select(F.col(row_id).cast("bigint").alias("_id"), F.col(side).alias("_side"), F.col(tokens).alias("_tokens"))
    sizes = {r[0]: r[1] for r in known.groupBy("_side").count().collect()}  # one row per side
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    kind = dict(known.dtypes)["_side"]
    if not blocks:
        return spark.createDataFrame([], f"a_id bigint, b_side {kind}, b_id bigint, shared int, position int")
    cuts = {s: [] for s in blocks}
    if (most := max(blocks.values())) > 1:
        fine = 8 * most  # a block is at most an eighth larger than meant
        steps = F.percentile_approx("_id", [i / fine for i in range(1, fine)], max(10_000, 100 * fine))
        for s, at in known.groupBy("_side").agg(steps).collect():
            cuts[s] = [at[round(j * fine / blocks[s]) - 1] for j in range(1, blocks[s])]
    sides, first = sorted(blocks), {}
    for s in sides:
        first[s] = sum(len(cuts[t]) + 1 for t in first)
    of = lambda v, as_type: F.element_at(F.create_map(*[x for s in sides for x in (F.lit(s), v(s))]), F.col("_side")).cast(as_type)
    before = F.filter(of(lambda s: F.array(*map(F.lit, cuts[s])).cast("array<bigint>"), "array<bigint>"), lambda c: c < F.col("_id"))
    hashed = F.transform(F.array_distinct("_tokens"), lambda w: F.xxhash64(w))
    flat = known.select("_id", hashed.alias("_tokens"), (of(lambda s: F.lit(first[s]), "int") + F.size(before)).alias("_block")).where(F.size("_tokens") > 0)
    posted = stored(flat.groupBy("_block").applyInArrow(_postings, "_block int, size int, ids binary, words binary, start binary, owner binary"), ["_block"])
    paths = {int(re.search(r"/_block=(\d+)/", p).group(1)): p for p in posted.inputFiles()}
    side_of = {first[s] + i: k for k, s in enumerate(sides) for i in range(len(cuts[s]) + 1)}
    step = max(512, min(SLICE, sum(sizes.values()) // (8 * spark.sparkContext.defaultParallelism)))
    slices = [(b, lo) for b, n in posted.select("_block", "size").collect() for lo in range(0, n, step)]  # one row per block
    best = spark.range(0, len(slices), 1, max(1, len(slices))).mapInArrow(_best_of_slices(slices, step, paths, side_of, keep), "a_id bigint, b_side int, b_ids array<bigint>, shared array<int>")
    listed = best.select("a_id", F.element_at(F.array(*map(F.lit, sides)), F.col("b_side") + 1).alias("b_side"), "shared", F.posexplode("b_ids").alias("_at", "b_id"))
    return listed.select("a_id", "b_side", "b_id", F.get("shared", F.col("_at")).alias("shared"), (F.col("_at") + 1).alias("position"))


def _postings(group):
    """A block's rows by id as one row: ids, distinct words, where each word's postings start, the postings."""
    import numpy as np
    import pyarrow as pa

    group = group.sort_by("_id")
    tokens = group["_tokens"].combine_chunks()
    n = len(group)
    words = tokens.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(n, dtype="uint16" if n <= 65_536 else "int32"), tokens.value_lengths().to_numpy(zero_copy_only=False))
    order = np.argsort(words, kind="stable")
    words, start = np.unique(words[order], return_index=True)
    start = np.append(start, len(order)).astype("int64")
    values = [group["_block"][0].as_py(), n, *(x.tobytes() for x in (group["_id"].to_numpy(), words, start, owner[order]))]
    return pa.table({c: pa.array([v], t) for c, v, t in zip(("_block", "size", "ids", "words", "start", "owner"), values, (pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)})


def _block(path: str):
    """ids, words, start and owner of a block."""
    import numpy as np
    from pyarrow import fs, parquet

    system, path = fs.FileSystem.from_uri(path)
    with system.open_input_file(path) as file:
        row = parquet.ParquetFile(file).read(["size", "ids", "words", "start", "owner"]).to_pylist()[0]
    ids, words, start = (np.frombuffer(row[c], "int64") for c in ("ids", "words", "start"))
    return ids, words, start, np.frombuffer(row["owner"], "uint16" if row["size"] <= 65_536 else "int32")


def _best_of_slices(slices: list, step: int, paths: dict, side_of: dict, keep: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for number in (x for batch in batches for x in batch.column(0).to_pylist()):
            block, low = slices[number]
            ids, words, start, owner = _block(paths[block])
            ids = ids[low : low + step]
            word = np.repeat(np.arange(len(words)), np.diff(start))
            here = (owner >= low) & (owner < low + step)
            word, row = word[here], owner[here] - low
            order = np.argsort(row, kind="stable")
            used, word = np.unique(word[order], return_inverse=True)
            for other in sorted(set(side_of.values()) - {side_of[block]}):
                places = [paths[b] for b in sorted(paths) if side_of[b] == other]
                rows, b_ids, shared = _best_of_side(words[used], word, row[order], len(ids), places, keep)
                sizes = np.bincount(rows, minlength=len(ids))
                found = np.flatnonzero(sizes)
                ends = np.append(0, np.cumsum(sizes[found]))
                for i in range(0, len(found), 1024):
                    part = found[i : i + 1024]
                    at, values = pa.array((ends[i : i + len(part) + 1] - ends[i]).astype("int32")), slice(ends[i], ends[i + len(part)])
                    lists = [pa.ListArray.from_arrays(at, pa.array(x[values])) for x in (b_ids, shared)]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(np.full(len(part), other, "int32")), *lists], ["a_id", "b_side", "b_ids", "shared"])

    return run


def _best_of_side(words, word, row, rows: int, paths: list[str], keep: int):
    """Row, id and count of the best of a side, by row, count and id. words: the slice's distinct words; word, row: its postings by row.

    A block has a bit a row: a word is a column of such bits, a count as many columns as it has binary places, and adding a word is a few operations
    on whole columns. The slice's rows are taken in the order of the words that more than one in DENSE rows of the block have, the slice's most frequent first, so that a row
    begins with the sum it has in common with the row before; what it has alone is added four words at a time. Blocks come by id: once a row has `keep`, only more shared tokens count.
    """
    import numpy as np

    best, least, seen, all_ids = np.array([], "int64"), np.zeros(rows, "int64"), 0, []  # best: row, 2**20 - 1 less count, place in the side
    for path in paths:
        ids, posted, start, owner = _block(path)
        n = -(-len(ids) // 64) * 64
        place = np.minimum(np.searchsorted(posted, words), len(posted) - 1)
        count = np.where(posted[place] == words, start[place + 1] - start[place], 0)
        dense = np.flatnonzero(count * DENSE > n)
        dense = dense[np.argsort(-np.bincount(word, minlength=len(words))[dense], kind="stable")]
        columns = []
        for w in place[dense]:
            has = np.zeros(n, bool)
            has[owner[start[w] : start[w + 1]]] = True
            columns.append(np.packbits(has, bitorder="little").view("<u8"))

        code = np.full(len(words), -1)
        code[dense] = np.arange(len(dense))
        code = code[word]
        at = code >= 0
        order = np.lexsort((code[at], row[at]))
        r, code = row[at][order], code[at][order]
        depth = np.bincount(r, minlength=rows)
        codes = np.full((rows, depth.max() + 1), len(dense))
        codes[r, np.arange(len(r)) - (np.cumsum(depth) - depth)[r]] = code
        order = np.lexsort(codes.T[::-1])
        codes = codes[order]
        other = codes[1:] != codes[:-1]
        common = [0, *np.where(other.any(1), other.argmax(1), depth[order[1:]]).tolist(), 0]
        rare = ((count > 0) & (count * DENSE <= n))[word]
        few = np.bincount(row[rare], minlength=rows)
        ends = np.append(0, np.cumsum(few)).tolist()
        rare, start = place[word[rare]].tolist(), start.tolist()

        deepest = int((depth + few).max())
        sums = np.zeros((deepest + 1, deepest.bit_length(), n // 64), "<u8")
        levels = [list(s[: j.bit_length()]) for j, s in enumerate(sums)]
        carry, even, over, *spare = np.zeros((6, n // 64), "<u8")
        posts = np.zeros((int(few.max()), n // 64), "<u8")
        hits, counts, hit_rows = [], [], []
        for i, (a, level, c, floor) in enumerate(zip(order.tolist(), depth[order].tolist(), codes.tolist(), least[order].tolist(), strict=True)):
            alone = min(level, max(common[i], common[i + 1]))
            for j in range(common[i], alone):
                _add(levels[j], columns[c[j]], levels[j + 1], carry)
            more, cleared = [columns[x] for x in c[alone:level]], []
            for w, post in zip(rare[ends[a] : ends[a + 1]], posts, strict=False):
                at = owner[start[w] : start[w + 1]]
                np.add.at(post, at >> 6, np.left_shift(np.uint64(1), (at & 63).astype("<u8")))  # a row is posted once a word
                more.append(post)
                cleared.append(at >> 6)
            level = alone
            while more:
                k = 4 if level > 1 and len(more) > 3 else 1
                (_add_four if k == 4 else _add)(levels[level], *more[:k], levels[level + k], carry, *spare)
                more, level = more[k:], level + k
            for at, post in zip(cleared, posts, strict=False):
                post[at] = 0
            if floor >= 1 << len(levels[level]):
                continue
            hit = _over(levels[level], floor, even, over, carry) if floor else None
            if hit is None or len(hit) > 4 * keep:
                hit = _highest(levels[level], keep)
            if len(hit):
                bits = sums[level, : len(levels[level])][:, hit >> 6] >> (hit & 63).astype("<u8") & np.uint64(1)
                hits.append(hit)
                counts.append(np.left_shift(bits.astype("int64"), np.arange(len(bits))[:, None]).sum(0))
                hit_rows.append(a)
        if hits:
            new = np.repeat(np.array(hit_rows), [len(h) for h in hits]) << 50 | 2**20 - 1 - np.concatenate(counts) << 30 | seen + np.concatenate(hits)
            best = np.concatenate([best, new])
            best.sort()
            of = best >> 50
            sizes = np.bincount(of, minlength=rows)
            stays = np.arange(len(best)) - (np.cumsum(sizes) - sizes)[of] < keep
            best, sizes = best[stays], np.minimum(sizes, keep)
            full = np.flatnonzero(sizes == keep)
            least[full] = 2**20 - 1 - (best[(np.cumsum(sizes) - 1)[full]] >> 30 & 2**20 - 1)
        all_ids.append(ids)
        seen += len(ids)
    all_ids = np.concatenate(all_ids) if all_ids else np.array([], "int64")
    return best >> 50, all_ids[best & 2**30 - 1], (2**20 - 1 - (best >> 30 & 2**20 - 1)).astype("int32")


def _add(low: list, column, high: list, carry, *_) -> None:
    """high = low + column, binary place by place."""
    import numpy as np

    for p, q in zip(low, high, strict=False):
        np.bitwise_xor(p, column, q)
        np.bitwise_and(p, column, carry)
        column = carry
    if len(high) > len(low):
        np.copyto(high[-1], column)


def _add_four(low: list, a, b, c, d, high: list, carry, twos, more_twos, rest) -> None:
    """high = low + a + b + c + d, where low has two binary places at least."""
    import numpy as np

    xor, both, either = np.bitwise_xor, np.bitwise_and, np.bitwise_or
    for x, y, z, twice, out in ((low[0], a, b, twos, high[0]), (high[0], c, d, more_twos, high[0]), (low[1], twos, more_twos, carry, high[1])):
        both(x, y, twice)
        xor(x, y, rest)
        xor(rest, z, out)
        both(rest, z, rest)
        either(twice, rest, twice)
    for p, q in zip(low[2:], high[2:], strict=False):
        xor(p, carry, q)
        both(p, carry, carry)
    if len(high) > len(low):
        np.copyto(high[-1], carry)


def _places(mask):
    """Places of the bits that are set."""
    import numpy as np

    at = mask.nonzero()[0]
    x, y = np.unpackbits(mask[at].view("uint8"), bitorder="little").reshape(-1, 64).nonzero()
    return at[x] * 64 + y


def _over(count: list, least: int, even, over, spare):
    """Places of the counts over `least`, which has no more binary places than they."""
    import numpy as np

    even.fill(2**64 - 1)
    over.fill(0)
    for b in range(len(count) - 1, -1, -1):
        if least >> b & 1:
            np.bitwise_and(even, count[b], even)
        else:
            np.bitwise_and(even, count[b], spare)
            np.bitwise_or(over, spare, over)
            np.bitwise_xor(even, spare, even)
    return _places(over)


def _highest(count: list, keep: int):
    """Places of the `keep` highest counts over 0, of equal ones the first."""
    import numpy as np

    if not count:
        return np.array([], "int64")
    even, over, least = np.full_like(count[0], 2**64 - 1), np.zeros_like(count[0]), 0
    for b in range(len(count) - 1, -1, -1):
        with_bit = even & count[b]
        reached = over | with_bit
        if int(np.bitwise_count(reached).sum()) >= keep:
            even, least = with_bit, least | 1 << b
        else:
            even, over = even ^ with_bit, reached
    hit = _places(over)
    if least and len(hit) < keep:
        at = even.nonzero()[0][: keep - len(hit)]  # a word of bits has at least one
        rest = np.zeros_like(even)
        rest[at] = even[at]
        hit = np.concatenate([hit, _places(rest)[: keep - len(hit)]])
    return hit
