"""Building blocks of the reference SQL (DuckDB dialect)."""

from __future__ import annotations

from tallyloom.functions import similarity as S


BLANK = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def sql_fold(c: str) -> str:
    return f"regexp_replace(lower(strip_accents({c})), '^{BLANK}+|{BLANK}+$', '', 'g')"


def sql_plain(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({c})), '{BLANK}+', ' ', 'g'))"


def sql_numbered(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({sql_plain(c)}, '\biii\b', '3', 'g'), '\bii\b', '2', 'g'), '\biv\b', '4', 'g')"


def sql_compact(c: str) -> str:
    return f"regexp_replace({sql_plain(c)}, '[^a-z0-9]+', '', 'g')"


def sql_key(c: str) -> str:
    k = sql_fold(c)
    return (
        f"case when {k} in ('color', 'colour') then 'color' when {k} in ('reference color', 'reference colour', 'color referencia', 'colour reference', 'color de referencia') then 'reference_color' "
        f"when {k} in ('tipo de pod', 'tipo pod', 'pod type', 'type of pod') then 'pod_type' when {k} in ('ohm', 'ohmios', 'resistencia') then 'resistencia' "
        f"when {k} in ('capacidad', 'ml', 'tamano', 'size') then 'capacidad' when {k} in ('nicotina', 'mg', 'sales de nicotina') then 'nicotina' "
        f"when {k} in ('vgpg', 'pgvg', 'vg/pg', 'pg/vg', 'compuesto base') then 'base_ratio' when {k} in ('elige sabor', 'sabor', 'flavor', 'flavour') then 'sabor' "
        f"when {k} = 'cafeina' then 'cafeina' else coalesce(nullif({k}, ''), 'variante') end"
    )


def sql_numbers(c: str, unit: str) -> str:
    p = S.UNIT[unit].replace("'", "''")
    hits = f"list_transform(regexp_extract_all(lower({c}), '{p}', 1), lambda x: try_cast(replace(x, ',', '.') as double))"
    return f"coalesce(list_aggregate(list_transform(list_sort(list_distinct({hits})), lambda x: cast(cast(round(x * 1000) as bigint) as varchar)), 'string_agg', ' '), '')"


def sql_type() -> str:
    """The product type of a row of product, rule by rule."""
    t = sql_fold("concat_ws(' ', nullif(name, ''), nullif(category, ''), nullif(category_id, ''), nullif(reference, ''), nullif(synthetic_reference, ''))")
    v = sql_fold("array_to_string(list_transform(map_entries(variants), lambda e: e.key || ' ' || coalesce(e.value, '')), ' ')")
    prefix = f"regexp_extract({sql_fold('reference')}, '^([a-z])[\\s.-]', 1)"
    m = lambda p: f"regexp_matches({t}, '{p}')"
    return (
        f"case when {m(r'\bpouch(?:es)?\b')} then 'pouch' when {m(r'\bcbd\b')} then 'cbd' "
        f"when {m(r'\b(?:aromas?|concentrado|concentrate|longfill|shortfill|shake and vape|alquimia|diy)\b')} then 'aroma_concentrate' "
        f"when {m(r'\b(?:bases?|booster|nicokit)\b')} then 'base_booster' when {m(r'\b(?:sales|salts|nic salt|salt nic)\b')} then 'nicotine_salt' "
        f"when {m(r'\b(?:liquidos?|liquids?|e-liquid|eliquid)\b')} then 'eliquid' "
        f"when {m(r'\bpod\b')} and {m(r'\b(?:\d+\s*pcs?|\d+\s*unidades?|pack\s*\d+)\b')} and regexp_matches({v}, '\\b(?:ohm|ohmios|resistencia)\\b') then 'pod_replacement' "
        f"when {prefix} = 'k' then 'kit_device' when {m(r'\+\s*(?:itank|xtank|tank|atomizador|clearomizador|rta|rdta|rda)|\bcon\s+(?:itank|xtank|tank|atomizador|clearomizador)\b')} then 'kit_device' "
        f"when {m(r'\b(?:pyrex|glass|cristal)\b|deposito\s+de\s+pyrex')} then 'pyrex' when {m(r'\b(?:atomizador(?:es)?|tanks?|clearomizador|rta|rda|rdta)\b')} then 'atomizer_tank' "
        f"when {m(r'\b(?:coils?|resistencias?)\b')} then 'coil' when {m(r'\b(?:empty pod|replacement pod|pod replacement|cartridge|cartucho|pods? vacios?|pods? recambio|pack ?\d+|\d+\s*pcs?)\b')} then 'pod_replacement' "
        f"when {prefix} = 'm' then 'mod_device' when {m(r'\bmods?\b')} and not {m(r'\bkit\b')} then 'mod_device' "
        f"when {m(r'\b(?:kit|pod system|dispositivo|device|aio)\b')} then 'kit_device' when {m(r'\b(?:desechable|disposable)\b')} then 'disposable' "
        f"when {m(r'\b(?:bateria|battery|cargador|charger|pila)\b')} then 'battery_charger' when {m(r'\b(?:algodon|cotton|drip tip|boquilla|accesorio|adapter|adaptador)\b')} then 'accessory' else 'unknown' end"
    )


def sql_group(kind: str) -> str:
    return (
        f"case when {kind} in ('pod_replacement', 'coil', 'pyrex', 'atomizer_tank') then 'hardware_repuesto' when {kind} in ('kit_device', 'mod_device') then 'hardware_dispositivo' "
        f"when {kind} in ('aroma_concentrate', 'eliquid', 'nicotine_salt', 'base_booster') then 'liquidos' else {kind} end"
    )


def sql_category(*cols: str) -> str:
    t = f"lower(concat_ws(' ', {', '.join(cols)}))"
    return (
        f"case when regexp_matches({t}, 'desech|disposable') then 'DESECHABLES' when regexp_matches({t}, 'coil|resistencia') then 'RESISTENCIAS' when regexp_matches({t}, 'aroma|alquimia|concentrate') then 'ALQUIMIAS' "
        f"when regexp_matches({t}, 'nicotin[ea]|pouch|sales') then 'NICOTINA' when regexp_matches({t}, 'liquid|líquido') then 'LIQUIDOS' when regexp_matches({t}, 'kit_device|mod_device|pod_replacement|atomizer_tank|pyrex') then 'MAQUINAS' else 'OTROS' end"
    )


def sql_status() -> str:
    return (
        "case when b_variant_id is null then 'a_only' when a_variant_id is null then 'b_only' when variant_decision = 'match' and variant_confidence >= 0.95 then 'valid' "
        "when variant_decision in ('match', 'possible') and variant_confidence >= 0.85 then 'probable' when variant_confidence <= 0 then 'impossible' else 'discarded_low_confidence' end"
    )


def sql_weight(w: str) -> str:
    return f"(case when {w} in ({', '.join(repr(x) for x in S.SPECIAL)}) then 1.45 when regexp_matches({w}, '[0-9]') then 1.4 when length({w}) <= 2 then 0.75 else 1.0 end)::double"


COLOURS_SQL = "coalesce(lower(trim(variants['Colour'])), lower(trim(variants['Color'])), lower(trim(variants['COLOR'])), lower(trim(variants['color de referencia'])))"
