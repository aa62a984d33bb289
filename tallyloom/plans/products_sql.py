"""Common table expressions (DuckDB) of the captured rows, their variants and bases, typed out from the rules."""

from __future__ import annotations

from tallyloom.plans.sql import BLANK, sql_compact, sql_fold, sql_key, sql_numbered, sql_type

_NORMREF = "regexp_replace(upper({}), '[^A-Z0-9]+', '', 'g')"
_ALNUM = "regexp_replace({}, '[^a-z0-9]+', '', 'g')"
_PARTS = "list_filter(list_transform(coalesce(#, []), lambda x: regexp_replace(x, '^" + BLANK + "+|" + BLANK + "+$', '', 'g')), lambda x: x is not null and x <> '')"


def _parts(c: str) -> str:
    return _PARTS.replace("#", c)


_HEADINGS = (
    "'inicio','productos','producto','alquimia','aromas','aroma','liquidos','liquidos electronicos','sales','sales de nicotina','kits','kits pod system','pod system','pods','resistencias',"
    "'recambios','desechables','mods','mod electronico','atomizadores','accesorios'"
)
_CRUMB = f"list_filter({_parts('breadcrumb_path')}, lambda x: {sql_fold('x')} not in ({_HEADINGS}))[-1]"


def normref(c: str) -> str:
    return _NORMREF.format(c)


OWN = f"""
    nv as (select row_id, k, arg_max(v, i) as v, min(i) as first from (
             select row_id, {sql_key('e.key')} as k, regexp_replace(e.value, '^{BLANK}+|{BLANK}+$', '', 'g') as v, e.i from (
               select row_id, unnest(list_transform(map_entries(variants), lambda x, i: {{'key': x.key, 'value': x.value, 'i': i}})) as e from product where variants is not null))
           where v is not null and v <> '' group by 1, 2)"""

PROFILE = f"""
    p0 as (select *, list_transform(list_sort(list_transform({_parts('map_values(variants)')}, lambda v, i: {{'n': -length(v), 'i': i, 'v': v}})), lambda s: s.v) as vals from product),
    p1 as (select *, case when name is null then null else coalesce(nullif(trim(regexp_replace(list_reduce(list_prepend(regexp_replace(name, '^{BLANK}+|{BLANK}+$', '', 'g'), coalesce(vals, [])), lambda acc, v: regexp_replace(acc, '\\s+-\\s+' || regexp_escape(v) || '$', '', 'i')), '{BLANK}+', ' ', 'g')), ''), name) end as title from p0),
    p2 as (select *, {_parts("regexp_split_to_array(translate(title, '–—', '--'), '\\s+-\\s+|-\\s+')")} as pieces, {_CRUMB} as crumb from p1),
    p3 as (select *, list_max(list_filter(list_transform(pieces, lambda x, i: case when regexp_matches(x, '(?i)\\b(?:\\d+\\s*(?:mg|ml|mah|ohm|w)|\\d+\\s*/\\s*\\d+)\\b') then null else i end), lambda i: i is not null)) as tail_at from p2),
    p4 as (select * exclude (tail_at, vals, pieces), coalesce({_parts('brand_candidates')}[1], nullif(commercial_brand, ''), nullif(brand, ''), case when tail_at >= 2 then pieces[tail_at] end, crumb) as brand_found,
                  split_part(coalesce(url, ''), '#', 1) as base_url from p3),
    p5 as (select *, {_parts('coalesce(brand_candidates, []) || [commercial_brand, brand_found, crumb]')} as bs from p4),
    prof as (select *, coalesce(nullif({normref("coalesce(nullif(synthetic_reference, ''), reference, '')")}, ''), {normref('base_url')}) as base_key, coalesce(nullif(brand_found, ''), 'NO_BRAND') as brand_or_none, {sql_type()} as product_type,
                    list_filter(bs, lambda v, i: {_ALNUM.format(sql_fold('v'))} <> '' and list_position(list_transform(bs, lambda w: {_ALNUM.format(sql_fold('w'))}), {_ALNUM.format(sql_fold('v'))}) = i) as brands from p5)"""

REPS = f"""
    ranked as (select *, row_number() over (partition by distributor, brand_or_none, base_key, base_url order by length(title) nulls first, name nulls first, row_id) as rn from prof),
    agg as (select distributor, brand_or_none, base_key, base_url, count(*) as variant_count, min(price_tax_excluded) as min_price, max(price_tax_excluded) as max_price,
                   coalesce(string_agg(distinct nullif(source_file, ''), ' | ' order by nullif(source_file, '')), '') as source_files, coalesce(string_agg(distinct nullif(category, ''), ' | ' order by nullif(category, '')), '') as source_categories from prof group by all),
    rep as (select r.*, variant_count, min_price, max_price, source_files, source_categories,
                   coalesce(nullif(r.distributor, ''), 'SRC') || ':' || coalesce(nullif(r.base_key, ''), {normref('title')}, '') || ':' || right({normref('r.base_url')}, 80) as base_id
            from ranked r join agg a on r.distributor is not distinct from a.distributor and r.brand_or_none = a.brand_or_none and r.base_key = a.base_key and r.base_url = a.base_url where rn = 1)"""

SUMMARY = f"""
    sk as (select distributor, brand_or_none, base_key, base_url, k, list_sort(list(distinct v)) as vs, min({{'a': nv.row_id, 'b': nv.first}}) as f from nv join prof using (row_id) group by all),
    sm as (select distributor, brand_or_none, base_key, base_url, string_agg(k || ': ' || len(vs), '; ' order by f) as variant_summary, string_agg(k || ': ' || array_to_string(vs, ' | '), '; ' order by f) as variant_values from sk group by all),
    r2 as (select r.*, variant_summary, variant_values, array_to_string({_parts('breadcrumb_path')}, ' > ') as crumbs from rep r left join sm s on r.distributor is not distinct from s.distributor and r.brand_or_none = s.brand_or_none and r.base_key = s.base_key and r.base_url = s.base_url)"""

_N = "(\\d+(?:[.,]\\d+)?)"


def _ml_text(x: str) -> str:
    n = f"try_cast(replace({x}, ',', '.') as double)"
    return f"case when {n} = floor({n}) then cast(cast({n} as bigint) as varchar) || ' ml' when {n} is not null then cast({n} as varchar) || ' ml' end"


def _hit(pattern: str, group: int) -> str:
    return _ml_text(f"nullif(regexp_extract(source, '{pattern}', {group}), '')")


def _size(c: str) -> str:
    return f"try_cast(replace(nullif(regexp_extract({c}, '(?i){_N}\\s*ml', 1), ''), ',', '.') as double)"


_COMPACT = f"{_N}\\s*ml\\s*/\\s*{_N}\\s*(?:ml|\\b\\s*(?:longfill|shortfill|shake|\\(|$))"
_LABEL = f"{_N}\\s*ml\\s+en\\s+(?:bote|botella)\\s+de\\s+{_N}\\s*ml"
_WITH = f"(?:botella|bote)\\s+de\\s+{_N}\\s*ml\\s+con\\s+{_N}\\s*ml"
_LIQUIDS, _NICOTINE = "('aroma_concentrate', 'eliquid', 'nicotine_salt', 'base_booster')", "('eliquid', 'nicotine_salt', 'base_booster')"
_SOURCE = sql_fold("concat_ws(' ', nullif(variant_label, ''), nullif(capacidad, ''), nullif(name, ''), nullif(base_title, ''), nullif(url, ''), nullif(description, ''))")

VARIANTS = f"""
    dims as (select row_id, string_agg(k || ': ' || v, '; ' order by k) as variant_label, string_agg(k || '=' || {_ALNUM.format(sql_fold('v'))}, '|' order by k) as variant_signature,
                    {', '.join(f"max(v) filter (k = '{k}') as {k}" for k in ("color", "reference_color", "pod_type", "nicotina", "capacidad", "resistencia", "base_ratio", "sabor", "cafeina", "tamano", "contenido_ml", "contenido", "bote_ml", "capacidad_bote"))}
             from nv group by 1),
    v0 as (select p.row_id, p.name, p.url, p.base_url, p.distributor, p.description, p.reference, p.synthetic_reference, p.sku, p.derived, r.base_id, r.title as base_title, r.brand_found as base_brand, r.brands as base_brands, r.product_type as kind, coalesce(d.variant_label, '') as variant_label, coalesce(d.variant_signature, '') as variant_signature, d.* exclude (row_id, variant_label, variant_signature)
           from prof p join rep r on p.distributor is not distinct from r.distributor and p.brand_or_none = r.brand_or_none and p.base_key = r.base_key and p.base_url = r.base_url left join dims d on d.row_id = p.row_id),
    v1 as (select *, {_SOURCE} as source from v0),
    v2 as (select *, coalesce(nullif(contenido_ml, ''), nullif(contenido, ''), {_hit(_COMPACT, 1)}, {_hit(_LABEL, 1)}, {_hit(_WITH, 2)}, {_hit(f"(?:formato|contenido|aroma)\\s*:?\\s*{_N}\\s*ml", 1)}, {_hit(f"{_N}\\s*ml", 1)}) as c,
                  coalesce(nullif(bote_ml, ''), nullif(capacidad_bote, ''), {_hit(_COMPACT, 2)}, {_hit(_LABEL, 2)}, {_hit(_WITH, 1)}, {_hit(f"capacidad\\s+del\\s+bote\\s*:?\\s*{_N}\\s*ml", 1)}, {_hit(f"(?:botella|bote)\\s+de\\s+{_N}\\s*ml", 1)}) as b,
                  regexp_matches(source, '\\b(?:longfill|shortfill|shake\\s*(?:and|&)?\\s*vape)\\b') as longfill,
                  coalesce(nullif(nicotina, '') is not null and not regexp_matches(nicotina, '(?i)\\b0\\s*mg\\b|\\bsin\\s+nicotina\\b'), false) or (kind in {_NICOTINE} and (kind <> 'eliquid' or (not regexp_matches(source, '\\b(?:sin|without)\\s+nicotina\\b|\\b0\\s*mg\\b') and regexp_matches(source, '\\b(?:nicotine|sales|salts|\\d+(?:[.,]\\d+)?\\s*mg)\\b')))) as nic
           from v1),
    v3 as (select *, case when b is null and c is not null and not longfill and kind in {_NICOTINE} and (not nic or {_size('c')} is null or {_size('c')} <= 10) then c else b end as b2 from v2),
    vr as (select row_id, base_id || ':' || coalesce(nullif(variant_signature, ''), {normref("coalesce(nullif(sku, ''), nullif(url, ''), name)")}) as id, base_id, distributor, coalesce(url, '') as url, base_url, coalesce(name, '') as title, base_title, coalesce(base_brand, '') as brand,
                  array_to_string(base_brands, ' | ') as brand_candidates, kind as product_type, coalesce(reference, '') as reference, coalesce(synthetic_reference, '') as synthetic_reference, coalesce(sku, '') as sku, variant_signature, variant_label,
                  {', '.join(f"coalesce({k}, '') as {k}" for k in ("color", "reference_color", "pod_type", "nicotina", "capacidad", "resistencia", "base_ratio", "sabor", "cafeina", "tamano"))},
                  case when kind in {_LIQUIDS} then coalesce(c, '') else coalesce(nullif(contenido_ml, ''), nullif(contenido, ''), '') end as contenido_ml,
                  case when kind in {_LIQUIDS} then coalesce(case when nic and {_size('b2')} > 10 then case when {_size('c')} <= 10 then c end else b2 end, '') else coalesce(nullif(bote_ml, ''), nullif(capacidad_bote, ''), '') end as bote_ml,
                  coalesce(derived.matched_reference_color, '') as derived_reference_color from v3)"""


def american(c: str) -> str:
    from tallyloom.plans.sql import sql_plain

    return f"replace({sql_plain(f'coalesce({c}, {chr(39) * 2})')}, 'colour', 'color')"


def mended(c: str) -> str:
    return f"replace(replace(regexp_replace({american(c)}, '\\bartic\\b', 'arctic', 'g'), 'graffitti', 'graffiti'), 'grey', 'gray')"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({mended(c)}, '[^a-z0-9]+'), lambda w: w <> '' and w not in ('and', 'y', 'de', 'color', 'oxva', 'uwell', 'vaporesso', 'voopoo'))"


def build(c: str) -> str:
    return f"list_reverse(list_distinct(list_reverse(list_filter({words(c)}, lambda w: w in ('mesh', 'dual', 'corex', 'dtl', 'mtl', 'lush', 'top', 'fill')))))"


def build_text(c: str) -> str:
    """Build words in the order they first appear."""
    w = f"list_filter({words(c)}, lambda w: w in ('mesh', 'dual', 'corex', 'dtl', 'mtl', 'lush', 'top', 'fill'))"
    return f"array_to_string(list_filter({w}, lambda x, i: list_position({w}, x) = i), ' ')"


def _texts(*ks: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({k}, '')" for k in ks) + ")"


def _first_ml(*ks: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({k}, '(?i){_N}\\s*ml', 1), '')" for k in ks) + ")"


_WORDED = sql_fold(_texts("variant_label", "capacidad", "resistencia", "title", "base_title", "url"))
_OHM = f"list_transform(regexp_extract_all({_texts('variant_label', 'title', 'base_title', 'url')}, '(?i){_N}\\s*(?:ohm|Ω)', 1), lambda x: replace(x, ',', '.') || ' ohm')"
_BUILT = build_text(_texts("variant_label", "title", "base_title", "reference", "synthetic_reference", "url"))
FIELDS = f"""
    vf0 as (select * from vr qualify row_number() over (partition by id order by row_id) = 1),
    vf as (select id, base_id, title, url, variant_label, color, reference_color, derived_reference_color, coalesce(nullif(reference_color, ''), nullif(derived_reference_color, ''), color) as effective_color, nicotina,
                  coalesce(nullif(capacidad, ''), replace(case when product_type in ('pyrex', 'atomizer_tank', 'pod_replacement') then {_first_ml('variant_label', 'title', 'base_title', 'reference', 'synthetic_reference', 'sku', 'url')}
                    when product_type in ('eliquid', 'nicotine_salt', 'aroma_concentrate', 'base_booster', 'disposable') then {_first_ml('variant_label', 'title', 'base_title', 'url')} end, ',', '.') || ' ml', '') as capacidad,
                  contenido_ml, bote_ml,
                  case when resistencia <> '' then case when len({build('resistencia')}) > 0 or {_BUILT} = '' then resistencia else resistencia || ' ' || {_BUILT} end
                       when product_type in ('coil', 'pod_replacement') then trim(concat_ws(' ', array_to_string(list_filter({_OHM}, lambda x, i: list_position({_OHM}, x) = i), ' - '), {_BUILT})) else '' end as resistencia,
                  base_ratio, sabor, cafeina, tamano, coalesce(nullif(pod_type, ''), case when regexp_matches({_WORDED}, '\\bdtl\\b') then 'DTL' when regexp_matches({_WORDED}, '\\bmtl\\b') then 'MTL' end, '') as pod_type, product_type from vf0)"""

_WEIGHTS = [("nicotina", 2.0), ("capacidad", 1.5), ("contenido_ml", 2.0), ("bote_ml", 2.0), ("resistencia", 2.0), ("base_ratio", 1.5), ("sabor", 2.5), ("cafeina", 1.5), ("tamano", 1.0), ("pod_type", 4.0)]
_LIQUID_PAIR = f"(a.product_type in {_LIQUIDS} or b.product_type in {_LIQUIDS})"
_REFERENCE = " or ".join(f"{s}.{c} <> ''" for s in "ab" for c in ("reference_color", "derived_reference_color"))


def _keyed(c: str) -> str:
    return f"regexp_replace({mended(c)}, '[^a-z0-9]+', '', 'g')"


def _numbers(c: str, unit: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({c}, '(?i){_N}\\s*{unit}', 1), lambda x: cast(replace(x, ',', '.') as double)))"


#: Needs pairs(a_base, b_base) before it and the variants of FIELDS.
SCORES = f"""
    met as (select a_base, b_base, a.id as a_id, b.id as b_id, b.variant_label as b_label, a, b from pairs p join vf a on a.base_id = p.a_base join vf b on b.base_id = p.b_base),
    long as (select a_base, b_base, a_id, b_id, b_label, unnest([
        {{'f': 'color', 'w': case when a.effective_color <> '' or b.effective_color <> '' then 1.0 end, 'x': case when {_REFERENCE} then a.effective_color else a.color end, 'y': case when {_REFERENCE} then b.effective_color else b.color end}},
        {', '.join("{'f': '" + k + "', 'w': case when (a." + k + " <> '' or b." + k + " <> '')" + (f" and not {_LIQUID_PAIR}" if k == "capacidad" else f" and {_LIQUID_PAIR}" if k.endswith("_ml") else "") + f" then {w} end, 'x': a." + k + ", 'y': b." + k + "}" for k, w in _WEIGHTS)}]) as e from met),
    vals as (select distinct e.f as f, e.x as x, e.y as y from long where e.w is not null),
    keyed as (select f, x, y, {_keyed('x')} as kx, {_keyed('y')} as ky, {words('x')} as wx, {words('y')} as wy, {build('x')} as bx, {build('y')} as by_,
                     {_numbers('x', 'ml')} as mx, {_numbers('y', 'ml')} as my, {_numbers('x', '(?:ohm|Ω)')} as ox, {_numbers('y', '(?:ohm|Ω)')} as oy from vals),
    jac as (select *, case when len(list_distinct(wx || wy)) > 0 then len(list_filter(wx, lambda w: list_contains(wy, w)))::double / len(list_distinct(wx || wy)) else 0.0 end as j,
                   contains(kx, ky) or contains(ky, kx) as inside, len(list_filter(list_filter(wx, lambda w: not list_contains(wy, w)) || list_filter(wy, lambda w: not list_contains(wx, w)), lambda w: w not in ('dark', 'light', 'metal', 'metallic'))) = 0 as soft,
                   case when f = 'resistencia' then ox else mx end as nx, case when f = 'resistencia' then oy else my end as ny from keyed),
    sims as (select *, case when kx = '' and ky = '' then 1.0 when kx = '' or ky = '' then 0.35 when kx = ky then 1.0 when j >= 0.8 then 0.95 when j >= 0.66 then 0.88 when j >= 0.5 then 0.72 when inside and soft then 0.86 when inside then 0.45 else 0.0 end as base,
                    case when len(nx) = 0 or len(ny) = 0 then null when len(list_intersect(nx, ny)) = len(nx) and len(nx) = len(ny) then 1.0 when len(list_intersect(nx, ny)) > 0 then 0.72 else 0.0 end as num,
                    (list_contains(bx, 'corex') and list_contains(by_, 'dual')) or (list_contains(bx, 'dual') and list_contains(by_, 'corex')) or (len(bx) > 0 and len(by_) > 0 and len(list_intersect(bx, by_)) = 0) as opposed from jac),
    sim as (select f, x, y, cast(case when f in ('capacidad', 'contenido_ml', 'bote_ml') then case when (kx = '') <> (ky = '') then 0.35 else coalesce(num, base) end
                                 when f = 'resistencia' then coalesce(case when opposed then least(num, 0.72) else num end, base) else base end as double) as s, kx <> '' or ky <> '' as stated from sims),
    scored as (select a_base, b_base, a_id, b_id, b_label, coalesce(sum(e.w::double) filter (stated), 0) as total, sum(e.w::double * s) filter (stated) as score
               from long left join sim on e.f = sim.f and e.x = sim.x and e.y = sim.y and e.w is not null group by all),
    conf as (select *, case when total = 0 then 0.75 else floor(score / total * 100 + 0.5) / 100.0 end as confidence from scored),
    best as (select *, case when total = 0 then 'base_only' when confidence >= 0.95 then 'variant_match' when confidence >= 0.72 then 'possible_variant_match' else 'no_variant_match' end as d
             from conf qualify row_number() over (partition by a_base, b_base, a_id order by confidence desc, b_label, b_id) = 1),
    vm as (select a_base, b_base, a_id, case when confidence >= 0.72 then b_id end as b_id, case when confidence >= 0.72 then d else 'a_variant_without_b_variant' end as decision, case when confidence >= 0.72 then confidence else 0.0 end as confidence from best
           union all select a_base, b_base, null, null, 'missing_variants', 0.0 from pairs p where not exists (select 1 from vf where base_id = a_base) or not exists (select 1 from vf where base_id = b_base))"""


_PRIMARY = sql_numbered("concat_ws(' ', nullif(title, ''), nullif(array_to_string(brands, ' | '), ''), nullif(commercial_brand, ''), nullif(product_line, ''), nullif(crumbs, ''), nullif(reference, ''), nullif(synthetic_reference, ''), nullif(base_key, ''), nullif(base_url, ''), nullif(variant_values, ''))")
_RESPELL = "case w when 'bleu' then 'blue' when 'colour' then 'color' when 'cartridges' then 'cartridge' when 'berries' then 'berry' when 'grapes' then 'grape' when 'fruits' then 'fruit' when 'slices' then 'slice' when 'resistances' then 'resistencia' when 'tips' then 'tip' else w end"
_NO_MODEL = (
    "a al and aroma aromas bote by capacidad com cartucho cartridge coil coils con de del deposito dl dla eciglogistica el empty en es fill for fruit full fum glass html http https incluida incluido kit la las los "
    "longfill concentrado concentrate edition limited mesh meshed ml moon new no nuevo nueva ohm ohmios mao o4v apv pack packs para pc pcs pod pods pyrex recambio replacement repuesto resistencia resistencias serie "
    "series sin tank updated vaperalia vpm version vacio vacia bar with wonder y"
).split()
_CLEAN = "named"
for _p in (r"\b(\d+)[.,](\d+)\s*ml\b", r"\b\d+(?:[.,]\d+)?\s*ohm\b", r"\b\d+\s*(?:ml|mah|w|pcs|pc|pzs|unidades)\b", r"\bpack\s*(?:de\s*)?\d+\b"):
    _CLEAN = f"regexp_replace({_CLEAN}, '{_p}', ' ', 'g')"
_W = "list_sum(list_transform({}, lambda w: case when w in ('dtl', 'ez', 'mtl', 'rba', 'ss') then 1.45::double when regexp_matches(w, '[0-9]') then 1.4 when length(w) <= 2 then 0.75 else 1.0 end))"


def _w(lst: str) -> str:
    return f"coalesce({_W.replace('{}', lst)}, 0.0)"


def _first_seen(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def _differs(p: str) -> str:
    fa, fb = (f"list_filter({s}.tokens, lambda w: {p})" for s in "ab")
    return f"(len(list_filter({fa}, lambda w: not list_contains({fb}, w))) > 0 or len(list_filter({fb}, lambda w: not list_contains({fa}, w))) > 0)"


def _clash(x: str, y: str) -> str:
    return f"(len({x}) > 0 and len({y}) > 0 and len(list_intersect({x}, {y})) = 0)"


#: Base pairs with their whole score: needs r2 of SUMMARY; a side is a set of distributors.
HARDWARE = f"""
    h0 as (select base_id || '|' || coalesce(brand_found, '') as id, distributor, title, product_type as kind, {_PRIMARY} as prim, {sql_numbered("concat_ws(' ', title, nullif(trim(reference), ''), nullif(trim(synthetic_reference), ''), nullif(trim(base_url), ''))")} as named,
                  coalesce(nullif(reference, ''), nullif(synthetic_reference, ''), nullif(base_key, ''), '') as ref0, coalesce(nullif(trim(base_key), ''), nullif(trim(synthetic_reference), ''), nullif(trim(reference), '')) as key0,
                  coalesce(nullif(trim(reference), ''), nullif(trim(synthetic_reference), ''), nullif(trim(base_key), '')) as ref1,
                  list_filter(regexp_split_to_array({sql_numbered("concat_ws(' ', array_to_string(brands, ' | '), commercial_brand)")}, '[^a-z0-9]+'), lambda w: w <> '') as bw,
                  list_distinct(list_filter(list_transform(brands, lambda x: {sql_compact('x')}), lambda k: k <> '')) as keys from r2),
    h1 as (select *, regexp_matches({sql_numbered('ref0')}, '^r[-.\\s]') or regexp_matches(prim, '^\\s*resistencias?\\b') as starts, regexp_matches(prim, '\\bcoils?\\b') as coiled from h0),
    h2 as (select *, unnest(list_filter([case when starts or coiled or (kind = 'coil' and not (regexp_matches(prim, '\\bpod\\b') and regexp_matches(prim, '\\b(?:replacement|recambio|cartucho|cartridge)\\b'))) then 'coil' end,
                  case when kind = 'coil' or (kind = 'pod_replacement' and starts) or (kind = 'aroma_concentrate' and regexp_matches(prim, '\\b(?:nicokit|niko|nicotina|nicotine|base\\s*(?:pack|glicerina|pdo|propilenglicol)|glicerina|propilenglicol)\\b')) then null else kind end], lambda x: x is not null)) as block from h1),
    h3 as (select *, list_transform(list_filter(regexp_split_to_array({_CLEAN}, '[^a-z0-9]+'), lambda w: w <> ''), lambda w: {_RESPELL}) as ws from h2),
    h4 as (select *, list_filter(ws, lambda w: not list_contains(bw, w) and w not in ({', '.join(f"'{w}'" for w in _NO_MODEL)}) and not regexp_matches(w, '^p\\d+$|^\\d+b$|\\d+ml')
                  and not (regexp_full_match(w, '[0-9]+') and not (block in ('kit_device', 'mod_device', 'pod_replacement', 'atomizer_tank', 'pyrex') and length(w) = 1)) and not (length(w) = 1 and not regexp_matches(w, '[0-9]') and w not in ('g', 'j', 'm', 'n', 'q', 's', 't', 'x'))) as ts from h3),
    hf as (select id, distributor, title, block, keys, {_first_seen('ts')} as tokens, list_distinct(list_transform(regexp_extract_all(prim, '\\b(\\d+(?:[.,]\\d+)?)\\s*ml\\b', 1), lambda x: cast(replace(x, ',', '.') as double))) as caps,
                  list_distinct(list_transform(regexp_extract_all(prim, '\\bpack\\s*(?:de\\s*)?(\\d+)\\b', 1) || regexp_extract_all(prim, '\\b(\\d+)\\s*(?:pcs|pc|pzs|unidades)\\b', 1) || regexp_extract_all(prim, '(?:^|[\\s.-])p(\\d+)(?:$|[\\s.-])', 1), lambda x: cast(x as double))) as packs,
                  case when block = 'coil' then case when regexp_matches(prim, '\\b(?:adaptador|adapter)\\b') then 'adapter' when regexp_matches(prim, '\\brba\\b') then 'rba' else 'coil' end
                       when block = 'pod_replacement' then case when regexp_matches({sql_numbered('ref1')}, '^r[-.\\s]') or regexp_matches(prim, '^\\s*resistencias?\\b') then 'coil' when regexp_matches(prim, '\\b(?:adaptador|adapter)\\b') then 'adapter'
                         when regexp_matches(prim, '\\b(?:boquillas?|drip\\s*tip|filter\\s*tips?|filtro|algodon|pom)\\b') and not regexp_matches(prim, '\\b(?:pod|cartucho|cartridge)\\b') then 'tip' else 'pod' end else block end as subtype,
                  regexp_matches(prim, '\\b(?:salts?|nicotine\\s*salt|sales)\\b') as salt, nullif({sql_compact(sql_numbered('key0'))}, '') as key, nullif({sql_compact(sql_numbered('ref1'))}, '') as ref, block = 'aroma_concentrate' as aroma from h4),
    hp as (select distinct a, b from hf a join hf b on a.block = b.block and len(list_intersect(a.keys, b.keys)) > 0 where a.distributor in ('brumacat', 'calimadis', 'humedra') and b.distributor in ('vahoria', 'nubarolia')),
    hs as (select a.id as a_id, b.id as b_id, b.title as b_title, case
              when a.subtype <> b.subtype or {_clash('a.caps', 'b.caps')} or (a.aroma and a.salt <> b.salt) or {_clash('a.packs', 'b.packs')} or {_differs("regexp_full_match(w, 'v\\d+[a-z]?')")}
                or {_differs("w in ('koko', 'legend', 'lite', 'max', 'mini', 'nano', 'plus', 'primal', 'pro') or regexp_full_match(w, 's\\d+[a-z]?')")}
                or {' or '.join(_clash(f"list_filter(a.tokens, lambda w: w in ('{x}', '{y}'))", f"list_filter(b.tokens, lambda w: w in ('{x}', '{y}'))") for x, y in (('top', 'side'), ('dtl', 'mtl'), ('regular', 'pro')))} then 0.0
              when a.key = b.key then 1.0
              when len(list_filter(list_intersect(a.tokens, b.tokens), lambda w: length(w) >= 3 or regexp_matches(w, '[0-9]'))) = 0 or (a.aroma and {_differs('true')}) then 0.0
              else least(1.0, case when len(list_intersect(a.tokens, b.tokens)) >= 2 and {_w('list_intersect(a.tokens, b.tokens)')} / least({_w('a.tokens')}, {_w('b.tokens')}) >= 0.68 then greatest(raw, 0.72) else raw end
                   + case when len(list_intersect(a.caps, b.caps)) > 0 then 0.03 else 0.0 end + case when len(list_intersect(a.packs, b.packs)) > 0 then 0.02 else 0.0 end) end::double as score
           from (select a, b, 0.62 * {_w('list_intersect(a.tokens, b.tokens)')} / {_w('list_distinct(a.tokens || b.tokens)')} + 0.28 * greatest({_w('list_intersect(a.tokens, b.tokens)')} / {_w('a.tokens')}, {_w('list_intersect(a.tokens, b.tokens)')} / {_w('b.tokens')})
                   + case when contains(array_to_string(a.tokens, ''), array_to_string(b.tokens, '')) or contains(array_to_string(b.tokens, ''), array_to_string(a.tokens, '')) then 0.08 else 0.0 end
                   + case when contains(a.ref, b.ref) or contains(b.ref, a.ref) then 0.05 else 0.0 end as raw from hp)),
    hw as (select a_id, b_id, min(b_title) as b_title, round(max(score), 6) as score from hs group by 1, 2 having max(score) >= 0.7199995),
    ha as (select distinct id as a_id from hf where distributor in ('brumacat', 'calimadis', 'humedra'))"""

_INVERSE_STOP = (
    "a al and aroma aromas base bar bote by capacidad cartucho cartridge coil coils com con de del deposito eciglogistica edition el empty en es fill for full glass html http https incluida incluido juice kit la las "
    "limited liquid liquids longfill los mesh meshed ml new nic nicokit no nuevo nueva ohm ohmios pack packs para pc pcs pod pods pyrex recambio replacement repuesto resistencia resistencias salt salts serie series "
    "sin tank updated vaperalia version vpm vacio vacia with y black blue brown gold gray grey green orange pink purple rainbow red silver violet white yellow"
).split()
_INVERSE_TEXT = sql_numbered("concat_ws(' ', nullif(title, ''), nullif(array_to_string(brands, ' | '), ''), nullif(commercial_brand, ''), nullif(reference, ''), nullif(synthetic_reference, ''), nullif(base_key, ''), nullif(base_url, ''))")
_INVERSE_CLEAN = _CLEAN.replace("(named,", "(text,")
_GROUPED = "case when {0} in ('pod_replacement', 'coil', 'pyrex', 'atomizer_tank') then 'hardware_repuesto' when {0} in ('kit_device', 'mod_device') then 'hardware_dispositivo' when {0} in ('aroma_concentrate', 'eliquid', 'nicotine_salt', 'base_booster') then 'liquidos' else {0} end"
INVERSE = f"""
    i0 as (select base_id || '|' || coalesce(brand_found, '') as id, distributor, title, product_type as kind, {_GROUPED.format('product_type')} as grp, {_INVERSE_TEXT} as text, nullif({sql_compact('base_key')}, '') as key,
                  list_filter(regexp_split_to_array({sql_numbered("concat_ws(' ', array_to_string(brands, ' | '), commercial_brand)")}, '[^a-z0-9]+'), lambda w: w <> '') as bw, list_distinct(list_filter(list_transform(brands, lambda x: {sql_compact('x')}), lambda k: k <> '')) as keys from r2),
    i1 as (select *, list_transform(list_filter(regexp_split_to_array({_INVERSE_CLEAN}, '[^a-z0-9]+'), lambda w: w <> ''), lambda w: case w when 'bleu' then 'blue' when 'berries' then 'berry' when 'grapes' then 'grape' when 'fruits' then 'fruit' when 'slices' then 'slice' else w end) as ws from i0),
    i2 as (select *, list_filter(ws, lambda w: not list_contains(bw, w) and w not in ({', '.join(f"'{w}'" for w in _INVERSE_STOP)}) and not regexp_matches(w, '^p\\d+$|^\\d+b$|\\d+ml')
                  and not (regexp_full_match(w, '[0-9]+') and not (kind in ('kit_device', 'mod_device', 'pod_replacement', 'atomizer_tank', 'pyrex') and length(w) = 1)) and not (length(w) = 1 and not regexp_matches(w, '[0-9]') and w not in ('g', 'j', 'm', 'n', 'q', 's', 't', 'x'))) as ts from i1),
    ie as (select id, distributor, title, kind, grp, key, bw, keys, {_first_seen('ts')} as tokens, {_numbers('text', 'ml')} as ml, {_numbers('text', 'ohm')} as ohm, regexp_matches(title, '(?i)\\b(?:promo|promopack|2x1)\\b') as promo,
                  list_distinct(list_transform(regexp_extract_all(text, '\\bpack\\s*(?:de\\s*)?(\\d+)\\b', 1) || regexp_extract_all(text, '\\b(\\d+)\\s*(?:pcs|pc|pzs|unidades)\\b', 1) || regexp_extract_all(text, '(?:^|[\\s.-])p(\\d+)(?:$|[\\s.-])', 1), lambda x: cast(x as double))) as packs from i2),
    ip as (select a, b, list_filter(a.tokens, lambda w: not list_contains(b.bw, w)) as x, list_filter(b.tokens, lambda w: not list_contains(a.bw, w)) as y from ie a join ie b on len(list_intersect(a.keys, b.keys)) > 0 or (len(a.keys) = 0 and len(b.keys) = 0)
           where a.distributor in ('brumacat', 'calimadis', 'humedra') and b.distributor in ('vahoria', 'nubarolia')),
    iw as (select *, list_intersect(x, y) as c from ip),
    isc as (select a.id as a_id, b.id as b_id, b.title as b_title, case when a.promo <> b.promo or (a.grp <> b.grp and a.kind <> b.kind) then 0.0 when a.key = b.key then 1.0
              when {_clash('a.ml', 'b.ml')} or {_clash('a.ohm', 'b.ohm')} or {_clash('a.packs', 'b.packs')} then 0.0
              when len(list_filter(c, lambda w: length(w) >= 3 or regexp_matches(w, '[0-9]'))) = 0 or (a.grp = 'liquidos' and len(c) < 2) or ((a.kind = 'aroma_concentrate' or b.kind = 'aroma_concentrate') and (len(c) < len(list_distinct(x)) or len(c) < len(list_distinct(y)))) then 0.0
              else least(1.0, floor((0.62 * {_w('c')} / {_w('list_distinct(x || y)')} + 0.3 * greatest({_w('c')} / {_w('x')}, {_w('c')} / {_w('y')}) + case when a.kind = b.kind then 0.08 else 0.0 end
                + case when len(list_intersect(a.ml, b.ml)) > 0 then 0.03 else 0.0 end + case when len(list_intersect(a.ohm, b.ohm)) > 0 then 0.03 else 0.0 end + case when len(list_intersect(a.packs, b.packs)) > 0 then 0.02 else 0.0 end)::double * 100 + 0.5) / 100.0) end::double as score from iw),
    inv as (select * from isc where score >= 0.4)"""
