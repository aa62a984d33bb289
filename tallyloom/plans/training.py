"""Queries of the general (core) data problems 1, 4 and 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import packed, snapshots, units
from tallyloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.catalog_changes(table(spark, d, "catalog_snapshot"), table(spark, d, "snapshot_delivery"), carry=()).select(
        "snapshot_no", "listing_id", "change_kind"
    )


def p1_url_report(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.url_report(table(spark, d, "catalog_snapshot"), table(spark, d, "snapshot_delivery"))


def p1_url_names(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.url_only_names(table(spark, d, "catalog_snapshot"), table(spark, d, "snapshot_delivery"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return units.pair_spec_amounts(table(spark, d, "pair_spec")).select("pair_id", "field", "amount")


def p4_resolution(spark: SparkSession, d: str) -> DataFrame:
    """How the units were resolved, per field."""
    return (
        units.pair_spec_amounts(table(spark, d, "pair_spec"))
        .groupBy("field", "how", "unique")
        .agg(F.count(F.lit(1)).alias("entries"))
    )


def p4_column_units(spark: SparkSession, d: str) -> DataFrame:
    """Units per return flag from price = rate * quantity, where the rate's unit is unknown."""
    rows = table(spark, d, "lineitem").select(
        "l_returnflag",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity") * 100).alias("rate"),
    )
    return infer(rows)


def infer(rows: DataFrame) -> DataFrame:
    return units.infer_column_units(
        rows,
        "l_returnflag",
        {"price": {"eur": 1.0, "keur": 1000.0}, "quantity": {"unit": 1.0}, "rate": {"eur": 1.0, "cent": 0.01, "keur": 1000.0}},
        [{"price": 1.0, "rate": -1.0, "quantity": -1.0}],
    ).select("l_returnflag", "price_unit", "quantity_unit", "rate_unit", "unique")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.split_packed(table(spark, d, "variant_match"), ["match_id"], {"a": "a_variant", "b": "b_variant"})


QUERIES = {
    "p1_found": p1_found,
    "p1_url_report": p1_url_report,
    "p1_url_names": p1_url_names,
    "p4_found": p4_found,
    "p4_resolution": p4_resolution,
    "p4_column_units": p4_column_units,
    "p6_found": p6_found,
}

_ONE = "row_number() over (partition by snapshot_no, distributor, listing_id order by captured_at desc nulls last) as n"
_CONTENT = (
    "(trim(regexp_replace(name, '\\s+', ' ', 'g')), coalesce(list_sort(map_entries(variants)), []), reference, category, cast(round(price_tax_excluded * 100) as bigint))"
)
_CHANGES = f"""
    seq as (select distributor, snapshot_no, row_number() over w as i, lead(snapshot_no) over w as next_no
            from (select distinct distributor, snapshot_no from snapshot_delivery) window w as (partition by distributor order by snapshot_no)),
    r as (select s.snapshot_no, s.distributor, listing_id, url, trim(regexp_replace(name, '\\s+', ' ', 'g')) as name, cast({_CONTENT} as varchar) as c, i, next_no
          from (select *, {_ONE} from catalog_snapshot) s join seq on seq.distributor = s.distributor and seq.snapshot_no = s.snapshot_no where n = 1),
    o as (select distributor, next_no as snap, listing_id, url, name, c from r where next_no is not null),
    k as (select distributor, snapshot_no as snap, listing_id, url, name, c from r where i > 1),
    f as (select coalesce(k.snap, o.snap) as snapshot_no, coalesce(k.distributor, o.distributor) as distributor, coalesce(k.listing_id, o.listing_id) as listing_id, o.url as old_url, k.url as new_url,
                 case when o.listing_id is null then 'added' when k.listing_id is null then 'removed' else 'changed' end as change_kind
          from k full join o on k.distributor = o.distributor and k.snap = o.snap and k.listing_id = o.listing_id
          where o.listing_id is null or k.listing_id is null or k.c <> o.c)"""
_NAMES = """
    names as (select snap, distributor, url, name, sum(x) as old_rows, sum(y) as new_rows from (select snap, distributor, url, name, 1 as x, 0 as y from o union all select snap, distributor, url, name, 0, 1 from k) group by 1, 2, 3, 4)"""
_COMBOS = "(values ('eur', 'eur', 1.0, 1.0), ('eur', 'cent', 1.0, 0.01), ('eur', 'keur', 1.0, 1000.0), ('keur', 'eur', 1000.0, 1.0), ('keur', 'cent', 1000.0, 0.01), ('keur', 'keur', 1000.0, 1000.0))"
_NUM = "\\d+\\s*/\\s*\\d+|\\d+r\\d+|\\d[\\d.,]*|[.,]\\d[\\d.,]*"
_ML = [("fl\\.?\\s*oz\\.?", 29.5735295625), ("microlit(?:ros?|ers?|res?)|[uμ]l", 0.001), ("mililitros?|millilit(?:res?|ers?)|ml", 1.0), ("centilitros?|centilit(?:res?|ers?)|cl", 10.0), ("decilitros?|decilit(?:res?|ers?)|dl", 100.0), ("c\\.\\s*c\\.|cc|cm3|cm³", 1.0), ("litros?|lit(?:res?|ers?)|ltrs?|lts?|l", 1000.0)]
_MG = [("%|por\\s+ciento|por\\s+cien|percent", 10.0), ("‰|por\\s+mil", 1.0), ("(?:mcg|[uμ]g)\\s*/\\s*ml", 0.001), ("mg\\s*/\\s*l", 0.001), ("mg\\s*/\\s*ml", 1.0), ("g\\s*/\\s*ml", 1000.0), ("g\\s*/\\s*l", 1.0), ("mg", 1.0)]
_OHM = [("mili?ohm(?:ios?|s)?|milliohms?|m\\s?ohm(?:ios?|s)?|mω", 0.001), ("k\\s?ohm(?:ios?|s)?|kω", 1000.0), ("ohm(?:ios?|s)?|ω", 1.0)]


def _plain_sql(c: str) -> str:
    return f"trim(regexp_replace(replace(replace(replace(lower(translate({c}, ' Ωµ', ' Ωμ')), '½', '1/2'), '¼', '1/4'), '¾', '3/4'), '\\s+', ' ', 'g'))"


def _number_sql(c: str) -> str:
    t = f"regexp_replace({c}, '[.,]+$', '')"
    grouped = t
    for _ in range(4):
        grouped = f"regexp_replace({grouped}, '[.,](\\d{{3}})([.,]|$)', '\\1\\2')"
    over = f"try_cast(regexp_extract({t}, '/\\s*(\\d+)$', 1) as double)"
    return (
        f"case when regexp_full_match({t}, '\\d+') then try_cast({t} as double) when contains({t}, '/') then case when {over} > 0 then try_cast(regexp_extract({t}, '^(\\d+)', 1) as double) / {over} end "
        f"when contains({t}, 'r') then try_cast(replace({t}, 'r', '.') as double) when regexp_matches({t}, '^0*[.,]') then try_cast(replace({t}, ',', '.') as double) else try_cast(replace({grouped}, ',', '.') as double) end"
    )


def _factor_sql(c: str, units) -> str:
    return "case " + " ".join(f"when regexp_full_match({c}, '{p}') then {f}" for p, f in units) + " end"


def _entry_sql(field: str, units) -> str:
    """Rows pair_id, field, n, f (null where bare), how, and the factors of title quantities with the same number."""
    u = "|".join(p for p, _ in units)
    tagged = f"({_NUM})\\s*({u})(?:[^a-zω]|$)"
    shape = f"({_NUM})\\s*mg\\s*(?:/|por|per)\\s*({_NUM})\\s*ml"
    bare = "(?:^|[^a-z0-9])(" + _NUM + ")(?:[^a-z0-9]|$)"
    none = "(?:^|[^a-z])(?:cero|zero|sin\\s+nic\\w*|libre\\s+de\\s+nic\\w*|nic\\w*[\\s-]*free|no\\s+nic\\w*|sem\\s+nic\\w*)(?:[^a-z]|$)"
    zero = f"regexp_matches(t, '{none}') and not regexp_matches(t, '\\d')" if field == "MG" else "false"
    over = f"regexp_matches(t, '{shape}')" if field == "MG" else "false"
    m = f"regexp_extract_all(replace(title, ' ', '  '), '(?:^|[^\\d.,/])((?:{_NUM})\\s*(?:{u}))(?:[^a-zω]|$)', 1)"
    return f"""(select pair_id, '{field}' as field, how, f, case how when 'none stated' then 0.0 when 'quotient' then q1 / nullif(q2, 0) when 'written' then case when f is not null then own end else loose end as n,
          list_distinct(list_transform(list_filter(list_transform({m}, lambda x: {{'n': {_number_sql(f"regexp_extract(x, '^({_NUM})', 1)")}, 'f': {_factor_sql(f"trim(regexp_extract(x, '^(?:{_NUM})\\s*(.*)$', 1))", units)}}}), lambda x: x.n > 0 and x.f > 0 and abs(x.n - loose) <= 1e-9 * x.n), lambda x: x.f)) as seen
        from (select pair_id, t, title, case when {zero} then 'none stated' when {over} then 'quotient' when regexp_matches(t, '{tagged}') then 'written' else 'bare' end as how,
                {_number_sql(f"regexp_extract(t, '{tagged}', 1)")} as own, {_factor_sql(f"regexp_extract(t, '{tagged}', 2)", units)} as f, {_number_sql(f"regexp_extract(t, '{shape}', 1)")} as q1, {_number_sql(f"regexp_extract(t, '{shape}', 2)")} as q2, {_number_sql(f"regexp_extract(t, '{bare}', 1)")} as loose
              from (select pair_id, {_plain_sql(f"b_variants['{field}']")} as t, coalesce({_plain_sql('b_title')}, '') as title from pair_spec where b_variants['{field}'] is not null)))"""


_AMOUNTS = f"""
    en as ({' union all '.join(_entry_sql(k, u) for k, u in (('ML', _ML), ('MG', _MG), ('OHM', _OHM), ('RESISTENCIA', _OHM)))}),
    am as (select pair_id, field, case when how <> 'bare' then how when n > 0 and len(seen) > 0 then 'context' else 'default' end as how, n,
                  case when how in ('none stated', 'quotient') then 1.0 when how = 'written' then f when n > 0 and len(seen) > 0 and not list_contains(seen, 1.0) then list_min(seen) else 1.0 end as factor,
                  how <> 'bare' or (n > 0 and len(seen) = 1) as "unique" from en where n is not null)"""
SQL = {
    "p4_found": f"with {_AMOUNTS} select pair_id, field, cast(round(n * factor * 1000) as bigint) as amount from am",
    "p4_resolution": f"with {_AMOUNTS} select field, how, \"unique\", count(*) as entries from am group by 1, 2, 3",
    "p1_found": f"with {_CHANGES} select snapshot_no, listing_id, change_kind from f",
    "p1_url_names": f"with {_CHANGES}, {_NAMES} select snap as snapshot_no, distributor, url, case when new_rows = 0 then 'old' else 'new' end as side, name, cast(old_rows + new_rows as bigint) as rows from names where name is not null and (old_rows = 0 or new_rows = 0)",
    "p1_url_report": f"""with {_CHANGES}, {_NAMES},
        u as (select snapshot_no, distributor, url, change_kind from (select *, old_url as url from f where change_kind <> 'added' union all
              select *, new_url from f where change_kind <> 'removed' and not (change_kind = 'changed' and old_url is not distinct from new_url))),
        a as (select snapshot_no, distributor, url, count(*) filter (change_kind = 'added') as added, count(*) filter (change_kind = 'removed') as removed, count(*) filter (change_kind = 'changed') as changed from u group by 1, 2, 3),
        n as (select snap, distributor, url, cast(sum(old_rows) as bigint) as old_rows, cast(sum(new_rows) as bigint) as new_rows, count(*) filter (new_rows = 0 and name is not null) as only_old_names, count(*) filter (old_rows = 0 and name is not null) as only_new_names from names group by 1, 2, 3)
        select a.*, old_rows, new_rows, only_old_names, only_new_names from a join n on a.snapshot_no = n.snap and a.distributor = n.distributor and a.url is not distinct from n.url""",
    "p4_column_units": f"""with c(price_unit, rate_unit, p, q) as {_COMBOS},
        r as (select l_returnflag, price_unit, rate_unit, avg(abs(ln(l_extendedprice * p) - ln(l_extendedprice / l_quantity * 100 * q) - ln(l_quantity))) as residual
              from lineitem, c where l_extendedprice > 0 and l_quantity > 0 group by 1, 2, 3),
        k as (select *, row_number() over w as n, lead(residual) over w - residual as gap from r window w as (partition by l_returnflag order by residual, price_unit, rate_unit))
        select l_returnflag, price_unit, 'unit' as quantity_unit, rate_unit, coalesce(gap > 1e-6, true) as "unique" from k where n = 1""",
}
