"""What a product listing says of its item: model, edition, pack, measures, colour, brand."""

from __future__ import annotations

import re

from tallyloom.llm.unify import consistent, folded

# Flavours and colours, Spanish to English, accents folded.
FLAVOURS = {
    "algodon de azucar": "cottoncandy", "cotton candy": "cottoncandy", "te verde": "greentea", "green tea": "greentea", "tabaco rubio": "blondtobacco",
    "blond tobacco": "blondtobacco", "pina": "pineapple", "sandia": "watermelon", "fresa": "strawberry", "frambuesa": "raspberry", "arandano": "blueberry",
    "cereza": "cherry", "melocoton": "peach", "platano": "banana", "limon": "lemon", "uva": "grape", "manzana": "apple", "melon": "melon", "coco": "coconut",
    "vainilla": "vanilla", "caramelo": "caramel", "galleta": "cookie", "natillas": "custard", "cafe": "coffee", "menta": "mint", "regaliz": "liquorice",
    "almendra": "almond", "avellana": "hazelnut", "canela": "cinnamon", "jengibre": "ginger", "granada": "pomegranate", "higo": "fig", "kiwi": "kiwi",
    "mango": "mango", "naranja": "orange", "pera": "pear", "mora": "blackberry", "hierbabuena": "spearmint", "chocolate": "chocolate", "tabaco": "tobacco", "nuez": "nut",
}
COLOURS = {
    "fibra de carbono": "carbon fiber", "carbon fiber": "carbon fiber", "fibra carbono": "carbon fiber", "negro mate": "matte black", "matte black": "matte black",
    "azul marino": "navy blue", "navy blue": "navy blue", "negro": "black", "black": "black", "blanco": "white", "white": "white", "rojo": "red", "red": "red",
    "azul": "blue", "blue": "blue", "verde": "green", "green": "green", "gris": "grey", "grey": "grey", "gray": "grey", "rosa": "pink", "pink": "pink",
    "morado": "purple", "purple": "purple", "plata": "silver", "silver": "silver", "dorado": "gold", "gold": "gold", "amarillo": "yellow", "yellow": "yellow",
    "naranja": "orange", "orange": "orange", "marron": "brown", "brown": "brown",
}
# Advertising, type and filler words of listings.
ADVERTS = [
    r"100\s*%\s*original", r"original", r"envio\s*24\s*h", r"envio gratis", r"recomendado", r"precio mayorista", r"ultimas unidades", r"novedad(?:es)?", r"new", r"hot price",
    r"best seller", r"top ventas", r"oferta", r"-\d+\s*%(?=\s|$)", r"nuevo", r"sale", r"outlet", r"super precio", r"promo(?:cion)?", r"limited", r"stock limitado", r"exclusivo",
]
TYPES = [
    r"sales? de nicotina", r"nicotine salts?", r"nic salts?", r"salts?", r"sales?", r"base neutra", r"base diy", r"base", r"booster", r"nicokit", r"aroma concentrate", r"aroma diy",
    r"aroma", r"concentrados?", r"concentrate", r"longfill", r"shortfill", r"e[\s-]?liquids?", r"e[\s-]?liquidos?", r"liquidos?", r"liquids?(?=\s|$)", r"pod kit", r"kit pod",
    r"starter kit", r"kit", r"dispositivo", r"device", r"replacement pods?", r"pod de recambio", r"pod recambio", r"replacement coils?", r"coils?", r"resistencias?", r"cartuchos?",
    r"cartridges?", r"pod desechable", r"vaper desechable", r"disposable vape", r"disposable pod", r"disposable", r"desechable", r"pods?",
]
EDITION_WORDS = ["zero", "pro", "max", "ice", "lite", "plus", "mini", "duo", "nano", "xl", "se"]
_SHADE = r"(gold|green|black|white|silver|red|blue|pink|purple|grey|platinum|dorada?|oro|verde|negra?|blanca?|plata|roja?|azul|rosa|limitada|limited|20\d\d)"
_OWN_EDITIONS = re.compile(
    rf"\b(?:edicion|edition|ed)\b[\s.:]*{_SHADE}\b|\b{_SHADE}\W{{1,3}}(?:edition|edicion)\b|\b(?:v|ver|version)\s*\.?\s*(\d)\b|\bs\s?(\d)\b"
)
_STATED_EDITION = re.compile(r"\b(?:edicion|edition|version|model|modelo)\s*:\s*([\w. ]+?)\s*(?:[.;,/<\n]|$)")
_N = r"(\d+(?:[.,]\d+)?|[.,]\d+)"
_VOLUME = re.compile(rf"(?<![\d.,/]){_N}\s*(ml|cc|c\.c\.|cl|dl|l|litros?)\b(?!\s*/)")
_STRENGTH = re.compile(rf"(?<![\d.,/-]){_N}\s*(mg\s*/\s*ml|mg|%|g/l)(?!\w)")
_OHMS = re.compile(rf"(?<![\d.,/]){_N}\s*(mohm|m\s?ω|miliohm\w*|ohm\w*|ω)")
_PACK = re.compile(r"\(?\bpack(?:\s+de)?\s+(\d+)\b\)?|\(?\b(\d+)\s*(?:uds?|unidades|pcs|piezas|pieces)\b\.?\)?|\bx\s?(\d+)\b|\b(\d+)\s?x\b(?!\d)")
_RATIO = re.compile(r"\b(\d{2})\s*/\s*(\d{2})\b")
_NOT_STRENGTH = re.compile(r"(?<!\S)-\d+\s*%|100\s*%\s*original")
_MODEL_IN_DESCRIPTION = re.compile(
    r"^(?:nuestro equipo ha elegido|ya disponible:?|descubre|ahora en stock,?|llega al catalogo|discover|introducing|te presentamos|presentamos|vuelve|llega|new in:?|now in stock,?|meet)\s+(.{3,60}?):"
)
_BRAND_IN_DESCRIPTION = re.compile(r"\b(?:marca|fabricante|brand)\s*:\s*([^.;<\n|]{2,40}?)\s*(?:[.;<\n|]|$)")
_TAG = re.compile(r"<[^<>]*>|&nbsp;")


def _number(text: str) -> float:
    return float(text.replace(",", "."))


def millilitres(text: str | None) -> float | None:
    m = _VOLUME.search(text) if text else None
    if not m:
        return None
    unit = m.group(2)
    return round(_number(m.group(1)) * {"cl": 10, "dl": 100, "ml": 1, "cc": 1, "c.c.": 1}.get(unit, 1000), 3)


def strength(text: str | None) -> float | None:
    """Milligrams per millilitre; 1 % is 10."""
    if not text:
        return None
    m = _STRENGTH.search(_NOT_STRENGTH.sub(" ", text))
    if not m:
        return 0.0 if re.search(r"\bsin nicotina\b|\bnicotine free\b", text) else None
    return round(_number(m.group(1)) * (10 if m.group(2) == "%" else 1), 3)


def ohms(text: str | None) -> float | None:
    m = _OHMS.search(text) if text else None
    if not m:
        return None
    return round(_number(m.group(1)) / (1000 if m.group(2).startswith("m") else 1), 4)


def pack_of(text: str | None) -> int | None:
    m = _PACK.search(text) if text else None
    return int(next(g for g in m.groups() if g)) if m else None


def colour_of(text: str | None) -> str | None:
    """The colour named last in the text."""
    if not text:
        return None
    found = [(m.start(), COLOURS[m.group(1)]) for m in _COLOUR.finditer(text)]
    return found[-1][1] if found else None


def _any(words) -> str:
    return "|".join(sorted((re.escape(w) for w in words), key=len, reverse=True))


_COLOUR = re.compile(rf"\b({_any(COLOURS)})\b")
_FLAVOUR = re.compile(rf"\b({_any(FLAVOURS)})\b")
_ADVERT = re.compile("|".join(rf"(?<!\w)(?:{a})(?!\w)" for a in ADVERTS))
_TYPE = re.compile("|".join(rf"(?<!\w)(?:{a})(?!\w)" for a in TYPES))
_EDITION_WORD = re.compile(rf"\b({'|'.join(EDITION_WORDS[:4])})\b")


def editions(text: str) -> tuple[list[str], str]:
    """Edition marks of a folded text, sorted, and the text without them."""
    marks: list[str] = []

    def take(m: re.Match) -> str:
        word, before, version, series = m.groups()
        if version:
            marks.append("v" + version)
        elif series:
            marks.append("s" + series)
        else:
            marks.append((word or before) + " edition")
        return " "

    rest = _OWN_EDITIONS.sub(take, text)
    rest = _EDITION_WORD.sub(lambda m: marks.append(m.group(1)) or " ", rest)
    return sorted(set(marks)), rest


def stated_edition(description: str) -> list[str]:
    out: list[str] = []
    for m in _STATED_EDITION.finditer(description):
        word = m.group(1).strip()
        got, rest = editions(word)
        out += got or ([f"{word} edition"] if re.fullmatch(r"[a-z]+|\d{4}", word) else [])
    return sorted(set(out))


def parse(name: str | None, description: str | None, variants: dict[str, str] | None, brands: frozenset[str] | set[str] = frozenset()) -> dict:
    """The attributes of one listing; missing ones are None (edition and model are never).

    The model is what is left of the name; without a name what the description says, and where
    nothing is left, all words of the name but the advertising.

    brands: the brand words of the listing, folded; they are no part of the model.
    """
    n = folded(name or "").replace("™", " ").replace("®", " ")
    d = _TAG.sub("\n", folded(description or "")).strip()
    v = {folded(k).strip(): folded(x) for k, x in (variants or {}).items() if k and x}

    def of(keys: str, read) -> object:
        for k, x in v.items():
            if re.fullmatch(keys, k) and (got := read(x)) is not None:
                return got
        return None

    clean = _ADVERT.sub(" ", n)
    flat = _FLAVOUR.sub(lambda m: " " + FLAVOURS[m.group(1)] + " ", clean)
    marks, rest = editions(flat)
    if not marks:
        marks = stated_edition(d)
    stated = lambda words: next(iter(re.findall(rf"\b(?:{words})\s*:?\s*([^.;/\n<]{{1,12}}(?:[.,]\d[^.;/\n<]{{0,10}})?)", d)), None)
    volume = of(r"ml|capacidad|tamano|size|contenido", millilitres)
    volume = volume if volume is not None else millilitres(clean)
    volume = volume if volume is not None else millilitres(stated("contenido|capacidad|content|volume"))
    mg = of(r"mg|nicotina|nicotine|sales de nicotina", strength)
    mg = mg if mg is not None else strength(n)
    mg = mg if mg is not None else strength(stated("nicotina|nicotine"))
    ohm = of(r"ohm|ohmios|resistencia|resistance", ohms)
    ohm = ohm if ohm is not None else ohms(clean)
    ohm = ohm if ohm is not None else ohms(stated("resistencia|resistance"))
    pack = pack_of(clean)
    pack = pack if pack is not None else pack_of(d)
    colour = of(r"colou?r|color de referencia|acabado", lambda x: COLOURS.get(x.strip()))
    stripped = _PACK.sub(" ", _OHMS.sub(" ", _STRENGTH.sub(" ", _VOLUME.sub(" ", rest))))
    colour = colour if colour is not None else colour_of(stripped)
    colour = colour if colour is not None else COLOURS.get((stated("acabado|finish|color|colour") or "").strip())
    stripped = _COLOUR.sub(" ", _TYPE.sub(" ", _RATIO.sub(" ", stripped)))
    tokens = [w for w in re.findall(r"[a-z0-9]+", stripped) if w not in _SMALL and not w.isdigit()]
    head = _MODEL_IN_DESCRIPTION.match(d)
    said = re.findall(r"[a-z0-9]+", editions(_FLAVOUR.sub(lambda m: FLAVOURS[m.group(1)], head.group(1)))[1]) if head else []
    model = [w for w in tokens if w not in brands]
    foreign = {folded(w) for w in re.findall(r"[^\W\d_]+", consistent(name or "")) if not w.isascii()}
    if sum(w not in foreign for w in model) >= 2:
        model = [w for w in model if w not in foreign]  # words of other languages meant as such decorate a name
    if said and (set(said) <= set(tokens) or not n.strip()):
        model = said
    if not model:
        model = tokens or re.findall(r"[a-z0-9]+", clean)
    named = _BRAND_IN_DESCRIPTION.search(d)
    return {
        "model": " ".join(sorted(set(model))), "edition": " ".join(marks), "volume": volume, "strength": mg, "ohm": ohm, "pack": pack, "colour": colour,
        "named_brand": named.group(1).strip() if named else None,
    }


_SMALL = set("de by the y and con para of a x el la n no edition edicion ed".split())
