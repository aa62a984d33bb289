"""Quantities in mixed units brought to common ones by unit candidates and physical identities."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.binding import let

# Notations of a unit and its factor to the common unit of its measure.
VOLUME_ML = [
    (r"fl\.?\s*oz\.?", 29.5735295625),
    (r"microlit(?:ros?|ers?|res?)|[uµμ]l", 0.001),
    (r"mililitros?|millilit(?:res?|ers?)|ml", 1.0),
    (r"centilitros?|centilit(?:res?|ers?)|cl", 10.0),
    (r"decilitros?|decilit(?:res?|ers?)|dl", 100.0),
    (r"c\.\s*c\.|cc|cm3|cm³", 1.0),
    (r"litros?|lit(?:res?|ers?)|ltrs?|lts?|l", 1000.0),
]
NICOTINE_MG_ML = [
    (r"%|por\s+ciento|por\s+cien|percent", 10.0),
    (r"‰|por\s+mil", 1.0),
    (r"(?:mcg|[uµμ]g)\s*/\s*ml", 0.001),
    (r"mg\s*/\s*l(?![a-z])", 0.001),
    (r"mg\s*/\s*ml", 1.0),
    (r"g\s*/\s*ml", 1000.0),
    (r"g\s*/\s*l(?![a-z])", 1.0),
    (r"mg", 1.0),
]
RESISTANCE_OHM = [
    (r"mili?ohm(?:ios?|s)?|milliohms?|m\s?ohm(?:ios?|s)?|mω", 0.001),
    (r"k\s?ohm(?:ios?|s)?|kω", 1000.0),
    (r"ohm(?:ios?|s)?|ω", 1.0),
]
MEASURES: Mapping[str, Sequence[tuple[str, float]]] = {
    "ML": VOLUME_ML,
    "MG": NICOTINE_MG_ML,
    "OHM": RESISTANCE_OHM,
    "RESISTENCIA": RESISTANCE_OHM,
}
NO_NICOTINE = r"(?:^|[^a-z])(?:cero|zero|sin\s+nic\w*|libre\s+de\s+nic\w*|nic\w*[\s-]*free|no\s+nic\w*|sem\s+nic\w*)(?:[^a-z]|$)"
NUMBER = r"\d+\s*/\s*\d+|\d+r\d+|\d[\d.,]*|[.,]\d[\d.,]*"
TOLERANCE = 1e-9


def plain(c: Column) -> Column:
    """Lower case, one notation for fractions and signs, blanks collapsed."""
    c = F.lower(F.translate(c, "\u00a0\u2126\u00b5", " \u03a9\u03bc"))
    for sign, text in (("½", "1/2"), ("¼", "1/4"), ("¾", "3/4")):
        c = F.replace(c, F.lit(sign), F.lit(text))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def number(c: Column) -> Column:
    """The value of one written number, or null.

    n/m is a fraction and 0r5 is 0.5. A point or comma before exactly three digits after a
    whole part that is not zero groups thousands; otherwise it is the decimal mark.
    """

    def read(t: Column) -> Column:
        fraction = let(
            F.struct(
                F.regexp_extract(t, r"^(\d+)\s*/", 1).try_cast("double").alias("n"),
                F.regexp_extract(t, r"/\s*(\d+)$", 1).try_cast("double").alias("d"),
            ),
            lambda q: F.when(q["d"] > 0, q["n"] / q["d"]),
        )
        grouped = F.regexp_replace(t, r"[.,](?=\d{3}(?:[.,]|$))", "")
        return (
            F.when(t.rlike(r"^\d+$"), t.try_cast("double"))
            .when(t.rlike("/"), fraction)
            .when(t.rlike("r"), F.replace(t, F.lit("r"), F.lit(".")).try_cast("double"))
            .when(t.rlike(r"^0*[.,]"), F.translate(t, ",", ".").try_cast("double"))
            .otherwise(F.translate(grouped, ",", ".").try_cast("double"))
        )

    return let(F.regexp_replace(c, r"[.,]+$", ""), read)


def any_unit(units: Sequence[tuple[str, float]]) -> str:
    return "|".join(p for p, _ in units)


def factor(unit: Column, units: Sequence[tuple[str, float]]) -> Column:
    """The factor of a unit as written, null for none of the list."""
    out = None
    for pattern, f in units:
        hit = unit.rlike(f"^(?:{pattern})$")
        out = F.when(hit, F.lit(f)) if out is None else out.when(hit, F.lit(f))
    return out


def observed(value: Column, units: Sequence[tuple[str, float]], zero: str | None = None, ratio: tuple[str, str] | None = None) -> Column:
    """struct<n, units, how> of one free-text quantity: its number and the factors it may be written in.

    A number with its own unit has that one candidate, a bare number every unit of the measure.
    ratio=(mass, volume) names the patterns of a quotient such as 200 mg / 10 ml or 12 mg por
    2 ml: concentration = mass / volume, so n is the quotient of the two. zero is the pattern of
    texts that state nothing is contained. Null where the text is null or states no amount.
    """
    unit = any_unit(units)
    tagged = rf"({NUMBER})\s*({unit})(?![a-zω])"
    shape = rf"({NUMBER})\s*(?:{ratio[0]})\s*(?:/|por|per)\s*({NUMBER})\s*(?:{ratio[1]})" if ratio else None
    every = F.array(*[F.lit(f) for f in sorted({f for _, f in units})])

    def result(how: str, n: Column, factors: Column) -> Column:
        return F.struct(n.cast("double").alias("n"), factors.alias("units"), F.lit(how).alias("how"))

    def bare(n: Column) -> Column:
        return F.when(n.isNotNull(), result("bare", n, every))

    def written(t: Column) -> Column:
        own = let(
            F.regexp_extract(t, tagged, 0),
            lambda m: let(
                F.struct(number(F.regexp_extract(m, tagged, 1)).alias("n"), factor(F.regexp_extract(m, tagged, 2), units).alias("f")),
                lambda o: F.when(o["n"].isNotNull() & o["f"].isNotNull(), result("written", o["n"], F.array(o["f"]))),
            ),
        )
        return F.when(t.rlike(tagged), own).otherwise(let(number(F.regexp_extract(t, rf"(?<![a-z0-9])({NUMBER})(?![a-z0-9])", 1)), bare))

    def quotient(t: Column) -> Column:
        if shape is None:
            return written(t)
        both = let(
            F.struct(number(F.regexp_extract(t, shape, 1)).alias("m"), number(F.regexp_extract(t, shape, 2)).alias("v")),
            lambda q: F.when(q["v"] > 0, result("quotient", q["m"] / q["v"], F.array(F.lit(1.0)))),
        )
        return F.when(t.rlike(shape), both).otherwise(written(t))

    def whole(t: Column) -> Column:
        if zero is None:
            return quotient(t)
        return F.when(t.rlike(zero) & ~t.rlike(r"\d"), result("none stated", F.lit(0.0), F.array(F.lit(1.0)))).otherwise(quotient(t))

    return F.when(value.isNotNull(), let(plain(value), whole))


def mentions(text: Column, units: Sequence[tuple[str, float]]) -> Column:
    """array<struct<n, f>> of the quantities of a measure written in a text."""
    mention = rf"(?<![\d.,/])((?:{NUMBER})\s*(?:{any_unit(units)}))(?![a-zω])"
    seen = F.transform(
        F.regexp_extract_all(F.coalesce(plain(text), F.lit("")), F.lit(mention), F.lit(1)),
        lambda s: F.struct(
            number(F.regexp_extract(s, rf"^({NUMBER})", 1)).alias("n"), factor(F.regexp_extract(s, rf"^(?:{NUMBER})\s*(.*)$", 1), units).alias("f")
        ),
    )
    return F.filter(seen, lambda o: (o["n"] > 0) & (o["f"] > 0))


def unit_solution(entries: Column, same: Sequence[tuple[str, str]] = ()) -> Column:
    """array<struct<field, amount, unit_factor, residual, unique, how>>: the units of one row's quantities, solved together.

    entries is array<struct<field, n, units, how, seen>>: the observed columns of a row with the
    candidate factors of each and, in seen, the amounts that another column of the row gives for
    the same quantity. Every combination of one candidate per entry gets the sum of the absolute
    log residuals of the identities among the columns:

    - the entry's amount equals one of those seen (the nearest counts),
    - the amounts of two fields named in `same` are equal.

    The least sum wins; combinations equal up to rounding are ordered by the number of unusual
    units (factor other than 1) and then by their factors, so an entry that no identity touches
    keeps the usual unit. An entry is `unique` if all combinations within TOLERANCE of the least
    agree on its unit. Amounts of zero take part in no identity.
    """
    none = F.array().cast("array<array<double>>")
    start = F.array(F.array().cast("array<double>"))
    combos = F.aggregate(entries, start, lambda acc, e: F.coalesce(F.flatten(F.transform(acc, lambda c: F.transform(e["units"], lambda f: F.concat(c, F.array(f))))), none))

    def log_amount(e: Column, f: Column) -> Column:
        return F.when(e["n"] > 0, F.ln(e["n"]) + F.ln(f))

    def of_seen(combo: Column) -> Column:
        terms = F.transform(
            F.zip_with(entries, combo, lambda e, f: F.struct(log_amount(e, f).alias("x"), e["seen"].alias("seen"))),
            lambda t: F.coalesce(F.array_min(F.transform(t["seen"], lambda a: F.abs(t["x"] - F.ln(a)))), F.lit(0.0)),
        )
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    def of_same(combo: Column) -> Column:
        logs = F.map_from_entries(F.zip_with(entries, combo, lambda e, f: F.struct(e["field"], log_amount(e, f))))
        total = F.lit(0.0)
        for left, right in same:
            total = total + F.coalesce(F.abs(F.element_at(logs, F.lit(left)) - F.element_at(logs, F.lit(right))), F.lit(0.0))
        return total

    scored = F.transform(
        combos,
        lambda c: F.struct(F.round(of_seen(c) + of_same(c), 9).alias("r"), F.size(F.filter(c, lambda f: f != 1.0)).alias("unusual"), c.alias("units")),
    )

    def solved(ranked: Column) -> Column:
        best = F.get(ranked, F.lit(0))
        near = F.filter(ranked, lambda c: c["r"] <= best["r"] + TOLERANCE)
        return F.transform(
            entries,
            lambda e, i: F.struct(
                e["field"].alias("field"),
                (e["n"] * F.get(best["units"], i)).alias("amount"),
                F.get(best["units"], i).alias("unit_factor"),
                best["r"].alias("residual"),
                (F.size(F.array_distinct(F.transform(near, lambda c: F.get(c["units"], i)))) == 1).alias("unique"),
                F.when(e["how"] != "bare", e["how"]).when(F.size(e["seen"]) > 0, F.lit("context")).otherwise(F.lit("default")).alias("how"),
            ),
        )

    return let(F.array_sort(scored), solved)


def pair_spec_amounts(specs: DataFrame) -> DataFrame:
    """pair_id, field, amount (thousandths of ml, mg/ml or ohm) and how each was resolved.

    The entries of a pair and the quantities of its title are the observed columns. A title
    quantity states the same as an entry where the number is written alike (that is what the test
    data say of bare numbers); OHM and RESISTENCIA state one resistance. The units of all entries
    of a pair are chosen together, by the least log residual of these identities.

    Null maps, null, blank and unmeasured values give no row; repeated pair_ids give a row for
    each occurrence of an entry.
    """
    value = lambda k: F.element_at("b_variants", F.lit(k))

    def entry(field: str) -> Column:
        units = MEASURES[field]
        got = observed(value(field), units, NO_NICOTINE, ("mg", "ml")) if field == "MG" else observed(value(field), units)

        def with_seen(o: Column) -> Column:
            alike = F.filter(mentions(F.col("b_title"), units), lambda m: F.abs(m["n"] - o["n"]) <= TOLERANCE * m["n"])
            seen = F.when((o["how"] == "bare") & (o["n"] > 0), F.transform(alike, lambda m: m["n"] * m["f"])).otherwise(F.array().cast("array<double>"))
            return F.when(o["n"].isNotNull(), F.struct(F.lit(field).alias("field"), o["n"].alias("n"), o["units"].alias("units"), o["how"].alias("how"), seen.alias("seen")))

        return let(got, with_seen)

    entries = F.filter(F.array(*[entry(k) for k in MEASURES]), lambda e: e.isNotNull())
    rows = specs.where(F.size("b_variants") > 0).select("pair_id", "b_title", "b_variants")
    solution = let(entries, lambda e: unit_solution(e, [("OHM", "RESISTENCIA")]))
    return rows.select("pair_id", F.inline(solution)).select(
        "pair_id", "field", F.round(F.col("amount") * 1000).cast("bigint").alias("amount"), "unit_factor", "residual", "unique", "how"
    )


def infer_column_units(
    df: DataFrame,
    group: str,
    candidates: Mapping[str, Mapping[str, float]],
    identities: Sequence[Mapping[str, float]],
    tie: float = 1e-6,
    max_combinations: int = 4096,
) -> DataFrame:
    """The unit of every column of every group, from identities that hold among the columns.

    candidates: column -> {unit: factor to the common unit}. identities: column -> exponent,
    read as sum(exponent * ln(column in common units)) = 0, so mass = density * volume is
    {"mass": 1, "density": -1, "volume": -1}. Every combination of one unit per column gets the
    mean |residual| over the group's rows; the least one wins, ties by unit names. Rows where a
    column of an identity is null or not positive do not count for it; a group without any
    countable row has residual null and unique false. `unique` says that no other combination
    comes within `tie`.

    Combinations differ in the sum of their log factors only, so one pass adds up the residuals
    for each distinct sum (their number is checked), map side, and the combinations are ranked
    on one row per group.
    """
    columns = list(candidates)
    combos = list(itertools.product(*[sorted(candidates[c].items()) for c in columns]))
    if len(combos) > max_combinations:
        raise ValueError(f"{len(combos)} combinations of units; the limit is {max_combinations}")
    import math

    shifts = [
        [sum(e * math.log(dict(zip(columns, combo))[c][1]) for c, e in identity.items() if c in columns) for identity in identities]
        for combo in combos
    ]
    base = []
    for identity in identities:
        ok = None
        total = F.lit(0.0)
        for c, e in identity.items():
            ok = (F.col(c) > 0) if ok is None else ok & (F.col(c) > 0)
            total = total + F.lit(float(e)) * F.ln(F.col(c).cast("double"))
        base.append(F.when(ok, total))
    # one sum per identity and distinct shift: rows are neither repeated nor shuffled
    distinct = [sorted({row[i] for row in shifts}) for i in range(len(identities))]
    sums = [F.sum(F.abs(F.col(f"_b{i}") + F.lit(x))).alias(f"_t{i}_{j}") for i, xs in enumerate(distinct) for j, x in enumerate(xs)]
    counts = [F.count(f"_b{i}").alias(f"_n{i}") for i in range(len(identities))]
    summed = df.select(F.col(group).alias("_g"), *[b.alias(f"_b{i}") for i, b in enumerate(base)]).groupBy("_g").agg(*sums, *counts)
    n = sum((F.col(f"_n{i}") for i in range(len(identities))), F.lit(0))

    def residual(row: Sequence[float]) -> Column:
        parts = [F.coalesce(F.col(f"_t{i}_{distinct[i].index(x)}"), F.lit(0.0)) for i, x in enumerate(row)]
        return F.when(n > 0, sum(parts, F.lit(0.0)) / n)

    scored = F.array(
        *[F.struct(residual(row).isNull().alias("none"), residual(row).alias("r"), F.lit(k).alias("combo"), F.array(*[F.lit(u) for u, _ in combo]).alias("u")) for k, (row, combo) in enumerate(zip(shifts, combos))]
    )
    ranked = summed.select("_g", F.slice(F.array_sort(scored), 1, 2).alias("_s"))
    best, second = F.get("_s", F.lit(0)), F.get("_s", F.lit(1))
    return ranked.select(
        F.col("_g").alias(group),
        *[F.get(best["u"], F.lit(i)).alias(f"{c}_unit") for i, c in enumerate(columns)],
        best["r"].alias("residual"),
        F.coalesce(best["r"].isNotNull() & (second["r"].isNull() | (second["r"] - best["r"] > tie)), F.lit(False)).alias("unique"),
    )
