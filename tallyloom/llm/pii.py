"""Personal information in free text: found exactly, replaced by typed placeholders.

Validated numbers become format-preserving pseudonyms: a keyed Feistel network permutes the
digits within their format, so equal values stay linked across documents and nothing else
about them survives.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import re
import secrets
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Common given names (Spanish, Portuguese, English), written as usual.
GIVEN_NAMES = """
Adrián Agustín Aitor Ainara Ainhoa Alba Alberto Alejandra Alejandro Alexandra Alfonso Alice Alicia Álvaro Amaia Amelia Ana Andrea Andrés
Andrew Ángel Ángela Antonia Antonio António Arturo Beatriz Begoña Belén Benjamin Bernardo Blanca Brenda Bruno Carla Carlos Carmen Carolina
Catalina Catarina Catherine Cecilia César Charlotte Claire Clara Claudia Concepción Cristina Daniel Daniela David Diana Diego Diogo Dolores
Duarte Duncan Eduardo Elena Elisa Emilio Emma Enrique Esteban Esther Eva Fátima Federico Felipe Fernanda Fernando Filipa Francisca Francisco
Gabriel Gabriela Gael Gemma George Gerardo Gloria Gonçalo Gonzalo Grant Guillermo Gustavo Hannah Harry Héctor Helena Henrique Hugo Ignacio
Iker Inés Inês Irene Isabel Ismael Iván Jaime James Javier Jesús João Joaquim Joaquín Jorge José Josefa Juan Julia Julián Julio Laura Leah
Leire Leonor Lorena Lourdes Lucas Lucía Luis Luisa Luís Manuel Manuela Marcos Margarita María Maria Mariana Marina Mario Marta Martín Mary-Ann
Mateo Matilde Miguel Miles Miriam Mónica Natalia Nerea Nicolás Noelia Nuno Nuria Olga Óscar Owen Pablo Patricia Paula Paulo Pedro Phoebe Pilar
Rafael Ramón Raquel Raúl Ricardo Roberto Rocío Rodrigo Rosa Rubén Rui Rupert Samuel Sandra Santiago Sara Sergio Silvia Sofía Sonia Susana
Teresa Tessa Tiago Tomás Unai Vicente Víctor Xabier Yolanda
""".split()
# Words that end a name written in small letters, and greetings before a name.
NOT_SURNAME = set(
    """
    a al ante con contra de del desde e el en entre era es escribe escribo está fue ha han hasta he la las le lo los más me mi muy ni no nos o
    para pero por que queda quedó quien recoge recogerá recogió se según ser si sin sobre son su sus también te tiene un una uno y ya abre
    contesta avisa llama llamó dice dijo firma firmó vino viene como cuando donde hoy ayer mañana gracias
    ao aos as com da das do dos em foi já levantou na nas não nem nos os ou pela pelo pois quando são sem seu sua um uma faz fez fiz assina
    and answered are as at by for from had has have he her his i in is it left never not number of on or our placed said she signed that the
    their to was we were will with wrote phoned called collected received sent
    """.split()
)
GREETINGS = set("atentamente bom boa caro cara cumprimentos dear estimada estimado gracias hello hi hola obrigada obrigado olá querida querido regards saludos sinceramente thanks tarde tardes".split())
ROLES_OF_NON_PERSONS = set("tía tio tío tia uncle aunt avó avô abuela abuelo capitán capitão captain doctor doctora doutor granny grandpa maestro santa san santo são st".split())

_U = "A-ZÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÑÇŠ"
_L = "a-záàâãäéèêëíìîïóòôõöúùûüñçš"
_SP = "[  ]"

# --- email -----------------------------------------------------------------------------
_DOT = rf"(?:\.|\(\.\)|\[\.\]|{_SP}?[(\[](?:dot|punto|ponto)[)\]]{_SP}?|{_SP}(?:dot|punto|ponto){_SP})"
_WORD_DOT = rf"(?:\(\.\)|\[\.\]|{_SP}?[(\[](?:dot|punto|ponto)[)\]]{_SP}?|{_SP}(?:dot|punto|ponto){_SP})"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_TLD = r"[A-Za-z]{2,}(?![A-Za-z0-9-])"
_AT = rf"(?:{_SP}?[(\[{{](?:at|arroba|@|a)[)\]}}]{_SP}?|{_SP}arroba{_SP}|{_SP}?[@＠]{_SP}?)"
EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*(?:{_AT}(?:{_LABEL}{_DOT})+{_TLD}|{_SP}at{_SP}(?:{_LABEL}{_WORD_DOT})+{_TLD})",
    re.IGNORECASE,
)
_EMAIL_HINT = re.compile(r"@|＠|arroba|[(\[{]a(?:t)?[)\]}]| at [\w-]+(?: dot | punto | ponto |\(\.\)|\[\.\])", re.IGNORECASE)

# --- phone -----------------------------------------------------------------------------
_NATIONAL = r"(?:{first}\d{{8}}|{first}\d{{2}}([ .\-]?)\d{{3}}\{g}\d{{3}}|{first}\d{{2}}([ .\-])\d{{2}}\{h}\d{{2}}\{h}\d{{2}}|{first}\d([ .\-])\d{{3}}\{i}\d{{2}}\{i}\d{{2}})"
PHONE = re.compile(
    r"(?<![\w@#+/.(-])(?<![\w.-][-/.])(?:"
    + r"(?:\(\+?34\)|\+34|0034|\(0034\))[ .\-]?" + _NATIONAL.format(first="[5-9]", g=1, h=2, i=3)
    + r"|(?:\(\+?351\)|\+351|00351|\(00351\))[ .\-]?" + _NATIONAL.format(first="[2-9]", g=4, h=5, i=6)
    + r"|(?:\+44|0044|\(\+44\))[ .\-]?(?:\(0\)[ .\-]?)?\d{4}[ .\-]?\d{6}"
    + r"|(?:\+44|0044|\(\+44\))[ .\-]?(?:\(0\)[ .\-]?)?\d{2,3}[ .\-]\d{3,4}[ .\-]\d{4}"
    + r"|07\d{3}[ .\-]?\d{6}"
    + r"|(?:\+1[ .\-]|1-)?(?:\(\d{3}\)[ .\-]?|(?<=\+1[ .\-])\d{3}[ .\-])\d{3}[ .\-]\d{4}"
    + r"|" + _NATIONAL.format(first="[6-9]", g=7, h=8, i=9)
    + r"|\+(?!34|351|44|1[ .\-])\d{1,3}[ .\-]?\d{2,4}(?:[ .\-]?\d{2,4}){2,4}"
    + r")(?![\w@]|[-/]\d|\.\d)"
)

# --- identity numbers --------------------------------------------------------------------
_CONTROL = "TRWAGMYFPDXBNJZSQVHLCKE"
DNI = re.compile(r"(?<![\w.\-/])(\d{8}|\d{2}\.\d{3}\.\d{3})[ -]?([A-Za-z])(?![\w])")
NIE = re.compile(r"(?<![\w.\-/])([XYZxyz])[ -]?(\d{7}|\d\.\d{3}\.\d{3})[ -]?([A-Za-z])(?!\w)")
NINO = re.compile(r"(?<![\w.\-/])([A-Za-z]{2}) ?(\d{2}) ?(\d{2}) ?(\d{2}) ?([A-Da-d])(?!\w)")
SOCIAL = re.compile(r"(?<![\w.\-/])(\d{2})([ /-])(\d{7,8})\2(\d{2})(?![\w]|[-/.]\d)")
DATE = re.compile(r"(?<![\w.\-/])(\d{1,2})([/.-])(\d{1,2})\2(\d{4})(?![\w]|[-/.]\d)")
PASSPORT = re.compile(r"(?<![\w.\-/])([A-Z]{2,3})[ -]?(\d{6})(?![\w]|[-/.]\d)")

# --- addresses ---------------------------------------------------------------------------
_STREET_WORD = (
    r"(?:c/|calle|avda\.?|avenida|av\.|plaza|pza\.?|pl\.|paseo|pº|camino|ronda|traves[ií]a|carretera|ctra\.?|glorieta|rambla|callej[oó]n|cuesta"
    r"|rua|r\.|travessa|largo|praça|estrada|alameda|beco)"
)
_NAME_WORD = rf"(?:(?:de|del|da|do|das|dos|la|las|los|el|os|as|y|e|i)(?={_SP})|[{_U}][{_L}{_U}'’.-]*)"
_NUMBER = rf"(?:,?{_SP}?(?:n[úu]m\.?|n\.?{_SP}?[º°o]\.?|n[º°]\.?|número){_SP}?|,{_SP}?|{_SP})(?:\d{{1,4}}(?:{_SP}bis\b|[A-Za-z]\b)?|s/n\b)(?!\d)"
_SEP = rf"(?:,{_SP}?|{_SP}[-–]{_SP})"
_UNIT = (
    rf"(?:{_SEP}(?:esc\.?{_SP}?\w{{1,2}}|(?:planta|piso|puerta|pta\.?|portal|bloque|blq\.?|local|bajos?|[áa]tico|entresuelo|entlo\.?|r/c|cave)(?:{_SP}?(?:\d{{1,3}}|[A-Z]|dcha\.?|izda\.?|izq\.?|dto\.?|esq\.?)(?!\w))?"
    rf"|\d{{1,2}}{_SP}?\.?[º°ª](?:{_SP}?(?:[A-Z](?!\w)|dcha\.?|izda\.?|izq\.?|dto\.?|esq\.?|frente))?))"
)
_TOWN = rf"[{_U}][{_L}{_U}'’-]+(?:{_SP}(?:de|del|da|do|la|el|los|las){_SP}[{_U}][{_L}{_U}'’-]+|{_SP}[{_U}][{_L}{_U}'’-]+(?={_SP}?(?:[.,;:)|\]\n]|$|por\b|[{_L}])))?"
ADDRESS = re.compile(
    rf"(?<![\w/.@-])(?i:{_STREET_WORD}){_SP}?{_NAME_WORD}(?:{_SP}{_NAME_WORD}){{0,6}}{_NUMBER}(?i:{_UNIT}){{0,3}}(?:{_SEP}(?:\d{{5}}(?!\d)|\d{{4}}-\d{{3}}(?!\d))(?:{_SP}{_TOWN})?)?"
)
_ENGLISH_STREET = r"(?:Street|St|Lane|Ln|Avenue|Ave|Road|Rd|Close|Drive|Dr|Court|Ct|Way|Terrace|Mews|Hill|Square|Place|Crescent|Gardens|Grove|Row|Walk|Park)"
_EN_WORD = rf"[{_U}][{_L}{_U}'’-]*\.?"
ADDRESS_EN = re.compile(
    rf"(?<![\w/.@#-])(?:(?:Flat|Apartment|Apt\.?|Unit|Suite){_SP}\d{{1,4}}[A-Za-z]?,?{_SP})?\d{{1,4}}[A-Za-z]?{_SP}(?:{_EN_WORD}{_SP}){{1,4}}{_ENGLISH_STREET}\b"
    rf"(?:,{_SP}[{_U}][{_L}{_U}'’-]+(?:{_SP}[{_U}][{_L}'’-]{{2,}})?(?:,?{_SP}[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{_SP}\d[A-Z]{{2}}\b)?)?(?:,?{_SP}[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{_SP}\d[A-Z]{{2}}\b)?"
)

# --- persons -----------------------------------------------------------------------------
_GIVEN = {n.lower() for n in GIVEN_NAMES}


def _trie(words: set[str]) -> str:
    """A pattern of exactly these words that shares their beginnings, longest match first."""
    heads: dict[str, set[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], set()).add(w[1:])
    if not heads:
        return ""
    parts = [re.escape(h) + _trie(rest) for h, rest in sorted(heads.items())]
    body = parts[0] if len(parts) == 1 and "" not in words else "(?:" + "|".join(parts) + ")"
    return body + ("?" if "" in words else "")


_GIVEN_ALT = _trie(_GIVEN)
GIVEN = re.compile(rf"(?<![\w@.+'’-])(?:{_GIVEN_ALT})(?:{_SP}(?:{_GIVEN_ALT}))?(?![\w@+])(?!-\w+[@(\[]|[.+_]\w)", re.IGNORECASE)
_TITLE = rf"[{_U}][{_L}'’]{{2,}}(?:-[{_U}][{_L}'’]{{2,}})?"
_UPPER = rf"[{_U}'’]{{3,}}(?:-[{_U}'’]{{3,}})?"
_LOWER = rf"[{_L}'’]{{3,}}(?:-[{_L}'’]{{3,}})?"
_WORD_OF = {"T": _TITLE, "U": _UPPER, "l": _LOWER}
_LINK_OF = {"T": r"(?:de|del|de la|y|e|i|da|do|dos)", "U": r"(?:DE|DEL|DE LA|Y|E|I|DA|DO|DOS|de|y|e)", "l": r"(?:de|del|de la|y|e|i|da|do|dos)"}
_FOLLOW = {k: re.compile(rf"{_SP}({w})(?:{_SP}({_LINK_OF[k]}){_SP}({w})|{_SP}({w}))?(?![\w@])") for k, w in _WORD_OF.items()}
_BEFORE = {k: re.compile(rf"(?:({w}){_SP}(?:({_LINK_OF[k]}){_SP})?)?({w}),{_SP}$") for k, w in _WORD_OF.items()}
INITIAL = re.compile(rf"(?<![\w.@'’-])(?<!\d{_SP})(?<![º°ª]{_SP})[{_U}]\.{_SP}?(?:({_TITLE}(?:{_SP}(?:de|del|y|e|da|do){_SP}{_TITLE}|{_SP}{_TITLE})?)|({_UPPER}(?:{_SP}(?:DE|Y|E){_SP}{_UPPER}|{_SP}{_UPPER})?)|([{_L}'’]{{5,}}-[{_L}'’]{{5,}}))(?![\w@])")
# Words that say that a person's name follows; after the first kind a colon or comma
# must stand, after the second a point or colon may, after the third only a blank.
_CUES = (
    r"contacto|contact|contato|dest(?:inatario)?|att|attn|firmado|signed|assinado|titular|cliente|customer|factura|fatura|billing|saludos?|regards|cumprimentos|obrigad[oa]|atentamente|sincerely|sinceramente|thanks|gracias|comercial",
    r"dest|att|attn|sr|sra|srta|sres|mr|mrs|ms|dña|rep",
    r"a nombre de|em nome de|on behalf of|in the name of|me llamo|chamo-me|my name is|soy|sou|recogerá|recogió|levantou|atendió|atendeu|según|don|doña|dona|señora?|senhora?",
)
CONTEXT = re.compile(
    rf"(?i:(?<![\w@])(?:(?:{_CUES[0]}){_SP}?[:,]|(?:{_CUES[1]})[.:]{{0,2}}|(?:{_CUES[2]})))[ \u00a0\n]{{1,2}}"
    rf"((?:{_TITLE}(?:{_SP}(?:{_LINK_OF['T']}){_SP}{_TITLE}|{_SP}{_TITLE}){{1,2}})|(?:{_UPPER}(?:{_SP}{_UPPER}){{1,2}}))(?![\w@])"
)
# Capitalised words after such a cue that name a group, a thing or a place.
_NOT_GIVEN = set("equipo team equipa servicio serviço service departamento department atención atendimento tienda loja shop store calle avenida rua plaza el la los las o os as the your su tu".split())
_PREV_WORD = re.compile(rf"([\w'’]+)\.?{_SP}*$")


def _case(s: str) -> str | None:
    letters = [c for c in s if c.isalpha()]
    if not letters:
        return None
    if all(c.isupper() for c in letters):
        return "U"
    if all(c.islower() for c in letters):
        return "l"
    return "T" if letters[0].isupper() else None


def _surname(word: str | None, case: str) -> bool:
    if not word:
        return False
    low = word.lower()
    return low not in NOT_SURNAME and low not in GREETINGS and not (case == "l" and low in _GIVEN and "-" not in low)


def valid_dni(digits: str, letter: str) -> bool:
    return _CONTROL[int(digits) % 23] == letter.upper()


def valid_social(province: str, number: str, control: str) -> bool:
    """The control digits of a Spanish social-security number."""
    n = int(number)
    whole = n + int(province) * 10_000_000 if n < 10_000_000 else int(province + number)
    return 1 <= int(province) <= 66 and whole % 97 == int(control)


def valid_date(day: str, month: str, year: str) -> dt.date | None:
    try:
        return dt.date(int(year), int(month), int(day))
    except ValueError:
        return None


def _overlaps(spans: list[tuple[int, int, str]], a: int, b: int) -> bool:
    return any(x < b and a < y for x, y, _ in spans)


def find(text: str | None, dates: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every finding, in order and without overlaps; calendar dates only if asked for."""
    if not text:
        return []
    spans: list[tuple[int, int, str]] = []

    def add(a: int, b: int, kind: str) -> None:
        if not _overlaps(spans, a, b):
            spans.append((a, b, kind))

    if _EMAIL_HINT.search(text):
        for m in EMAIL.finditer(text):
            add(m.start(), m.end(), "email")
    for m in ADDRESS.finditer(text):
        add(m.start(), m.end(), "address")
    for m in ADDRESS_EN.finditer(text):
        add(m.start(), m.end(), "address")
    for m in DNI.finditer(text):
        if valid_dni(m.group(1).replace(".", ""), m.group(2)):
            add(m.start(), m.end(), "id_number")
    for m in NIE.finditer(text):
        if valid_dni(str("XYZ".index(m.group(1).upper())) + m.group(2).replace(".", ""), m.group(3)):
            add(m.start(), m.end(), "id_number")
    for m in NINO.finditer(text):
        add(m.start(), m.end(), "id_number")
    for m in SOCIAL.finditer(text):
        if valid_social(m.group(1), m.group(3), m.group(4)):
            add(m.start(), m.end(), "id_number")
    for m in PASSPORT.finditer(text):
        add(m.start(), m.end(), "id_number")
    if dates:
        for m in DATE.finditer(text):
            if valid_date(m.group(1), m.group(3), m.group(4)):
                add(m.start(), m.end(), "date")
    for m in PHONE.finditer(text):
        add(m.start(), m.end(), "phone")
    _persons(text, add)
    spans.sort()
    return spans


def _persons(text: str, add) -> None:
    taken = 0
    for m in GIVEN.finditer(text):
        if m.start() < taken:
            continue
        case = _case(m.group(0))
        if case is None:
            continue
        prev = _PREV_WORD.search(text, _back(text, m.start(), 2), m.start())
        if prev and prev.group(1).lower() in ROLES_OF_NON_PERSONS:
            continue
        after = _FOLLOW[case].match(text, m.end())
        if after and _surname(after.group(1), case):
            end = after.end(1)
            if after.group(3) and _surname(after.group(3), case):
                end = after.end(3)
            elif after.group(4) and _surname(after.group(4), case):
                end = after.end(4)
            add(m.start(), end, "person")
            taken = end
            continue
        offset = _back(text, m.start(), 6)
        before = _BEFORE[case].search(text[offset : m.start()])
        if before and _surname(before.group(3), case):
            start = offset + before.start(3)
            if before.group(1) and _surname(before.group(1), case) and _starts_name(before.group(1), case):
                start = offset + before.start(1)
            elif before.group(2):
                continue
            add(start, m.end(), "person")
            taken = m.end()
    for m in INITIAL.finditer(text):
        word = (m.group(1) or m.group(2) or m.group(3)).split()[0]
        case = "U" if m.group(2) else "T" if m.group(1) else "l"
        if _surname(word, case) and len(word) > 3:
            add(m.start(), m.end(), "person")
    for m in CONTEXT.finditer(text):
        words = m.group(1).lower().split()
        if words[0] not in _NOT_GIVEN and not any(w in NOT_SURNAME and len(w) > 3 for w in words):
            add(m.start(1), m.end(1), "person")


def _back(text: str, end: int, blanks: int) -> int:
    """Where the text before `end` begins that holds so many blanks."""
    for _ in range(blanks):
        end = max(text.rfind(c, 0, max(0, end - 1)) for c in " \u00a0\n") + 1
        if end <= 0:
            return 0
        end -= 1
    return max(0, end)


# Capitalised words that introduce a name but are no part of it.
_INTRODUCE = set("según contacto firmado dest att attn billing preguntad recogerá passaporte gracias thanks ask warranty contactar dni nie pasaporte avisad escribid llamad".split())


def _starts_name(word: str, case: str) -> bool:
    return word.lower() not in _INTRODUCE and word.lower() not in _GIVEN


# --- pseudonyms --------------------------------------------------------------------------
def feistel(digits: str, key: bytes, tweak: str, rounds: int = 8) -> str:
    """A permutation of the digit strings of one length, keyed and bound to the tweak.

    An alternating Feistel network over the two halves with HMAC-SHA256 rounds. One digit is
    permuted by a keyed shift. Empty strings stay.
    """
    n = len(digits)
    if n == 0:
        return digits
    if n == 1:
        return str((int(digits) + _round(key, tweak, 0, n, "") % 10) % 10)
    u = n // 2
    a, b = digits[:u], digits[u:]
    for i in range(rounds):
        m = len(a)
        c = (int(a) + _round(key, tweak, i, n, b)) % 10**m
        a, b = b, str(c).zfill(m)
    return a + b


def unfeistel(digits: str, key: bytes, tweak: str, rounds: int = 8) -> str:
    """The inverse of feistel with the same key, tweak and rounds."""
    n = len(digits)
    if n == 0:
        return digits
    if n == 1:
        return str((int(digits) - _round(key, tweak, 0, n, "") % 10) % 10)
    u = n // 2
    first = u if rounds % 2 == 0 else n - u
    a, b = digits[:first], digits[first:]
    for i in reversed(range(rounds)):
        m = len(b)
        c = (int(b) - _round(key, tweak, i, n, a)) % 10**m
        a, b = str(c).zfill(m), a
    return a + b


def _round(key: bytes, tweak: str, i: int, n: int, half: str) -> int:
    return int.from_bytes(hmac.new(key, f"{tweak}|{n}|{i}|{half}".encode(), hashlib.sha256).digest()[:16], "big")


def pseudonym_date(day_number: int, key: bytes, span: int = 36_525) -> int:
    """A day of the same span of days, by cycle walking over the digits of the day number."""
    width = len(str(span - 1))
    x = day_number % span
    while True:
        x = int(feistel(str(x).zfill(width), key, "date"))
        if x < span:
            return x


def _in_format(found: str, digits: str) -> str:
    """The found text with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in found)


def pseudonym(found: str, kind: str, key: bytes) -> str:
    """The pseudonym of one finding: same value, same pseudonym, whatever its notation.

    Phones keep their written format and country prefix, identity numbers their format with the
    control letter or digits recomputed where there are any, dates their format and century; other
    kinds get a short keyed tag.
    """
    if kind == "phone":
        digits = re.sub(r"\D", "", found)
        if digits.startswith("00"):
            digits = digits[2:]
        head = ""
        for prefix in ("351", "34", "44", "1"):
            if digits.startswith(prefix) and len(digits) - len(prefix) >= 9:
                head = prefix
                break
        if head == "44" and "(0)" in found:
            digits = head + digits[3:]
        national = digits[len(head) :].lstrip("0") or digits
        swapped = feistel(national, key, "phone")
        total = sum(c.isdigit() for c in found)
        own = re.sub(r"\D", "", found)
        return _in_format(found, own[: total - len(national)] + swapped)
    if kind == "date":
        day, mark, month, year = DATE.match(found).groups()
        first = dt.date(int(year) // 100 * 100, 1, 1)
        moved = first + dt.timedelta(days=pseudonym_date((dt.date(int(year), int(month), int(day)) - first).days, key))
        return f"{moved.day:0{len(day)}d}{mark}{moved.month:0{len(month)}d}{mark}{moved.year}"
    if kind == "id_number":
        digits = re.sub(r"\D", "", found)
        letters = re.sub(r"[^A-Za-z]", "", found).upper()
        if social := SOCIAL.fullmatch(found):
            province, mark, number, _ = social.groups()
            moved = feistel(number, key, "social")
            whole = int(moved) + int(province) * 10_000_000 if int(moved) < 10_000_000 else int(province + moved)
            return f"{province}{mark}{moved}{mark}{whole % 97:02d}"
        swapped = feistel(digits, key, "id" + (letters[:-1] if len(digits) in (7, 8) else letters))
        out = _in_format(found, swapped)
        if len(digits) in (7, 8) and len(letters) in (1, 2):
            number = (str("XYZ".index(letters[0])) if len(digits) == 7 and letters[0] in "XYZ" else "") + swapped
            control = _CONTROL[int(number) % 23]
            i = max(k for k, c in enumerate(out) if c.isalpha())
            out = out[:i] + (control if out[i].isupper() else control.lower()) + out[i + 1 :]
        return out
    plain = re.sub(r"\s+", " ", found).strip().lower()
    return hmac.new(key, f"{kind}|{plain}".encode(), hashlib.sha256).hexdigest()[:8]


def redact(text: str | None, key: bytes, dates: bool = False) -> str | None:
    """The text with every finding replaced by `[KIND pseudonym]`, otherwise unchanged."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, kind in find(text, dates):
        out += [text[at:a], f"[{kind.upper()} {pseudonym(text[a:b], kind, key)}]"]
        at = b
    out.append(text[at:])
    return "".join(out)


# --- operators ---------------------------------------------------------------------------
def pseudonym_key(spark) -> bytes:
    """The secret in the session setting spark.tallyloom.pseudonymKey; without it one made for this call only."""
    own = spark.conf.get("spark.tallyloom.pseudonymKey", None)
    return own.encode() if own else secrets.token_bytes(32)


def personal_data(documents: DataFrame, key: bytes, dates: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, kind, found_text, pseudonym: distinct findings of every document, exactly as written, and what replaces them.

    Equal values have one pseudonym in all documents, whatever their notation. Null and empty
    texts give no row. Texts are read whole, one document at a time, so a very long one needs
    memory for itself only; documents never meet, and nothing but the findings is shuffled (to
    make them distinct where an id is repeated).
    """
    schema = f"`{id_col}` bigint, kind string, found_text string, pseudonym string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["_id"], pdf["_text"]):
                rows += {(i, kind, t[a:b], pseudonym(t[a:b], kind, key)) for a, b, kind in find(t, dates)}
            out = pd.DataFrame(rows, columns=[id_col, "kind", "found_text", "pseudonym"], dtype="object")
            yield out.astype({id_col: "int64"})

    picked = documents.selectExpr(f"cast(`{id_col}` as bigint) as _id", f"`{text_col}` as _text").where("_text is not null and _id is not null")
    return picked.mapInPandas(run, schema).distinct()


def redacted(documents: DataFrame, key: bytes, dates: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the text with typed placeholders; null texts stay null, repeated rows stay."""
    schema = f"`{id_col}` bigint, `{text_col}` string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf["_id"], text_col: [redact(t, key, dates) for t in pdf["_text"]]})

    return documents.selectExpr(f"cast(`{id_col}` as bigint) as _id", f"`{text_col}` as _text").mapInPandas(run, schema)
