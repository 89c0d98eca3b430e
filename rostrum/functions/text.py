"""Text, URL and number expressions. Column in, Column out; all of them stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Letters and marks that become more than one ASCII character, or none by accent rule.
EXPANSIONS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th",
    "…": "...", "—": "--", "«": "<<", "»": ">>", "©": "(c)", "®": "(r)",
}
SINGLES = {
    "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "ı": "i",
    "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t", "\xa0": " ", "‘": "'", "’": "'", "“": '"', "”": '"',
    "‚": ",", "„": '"', "–": "-", "¡": "!", "¿": "?",
}


def strip(c: Column) -> Column:
    """Python's ``strip()``; Spark's ``trim`` would remove spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_ascii(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\r"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Letters of other scripts, by the romanizations of ALA-LC (Cyrillic, Hebrew, Arabic without marks),
# ISO 843 (Greek) and Hepburn (kana), in ASCII.
_CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяіїєґёўјљњћђџ", (
    "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia i i ie g e u j lj nj c dj dz").split()))
_GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t y f ch ps o".split()))
_HEBREW = dict(zip("אבגדהוזחטיכךלמםנןסעפףצץקרשת", "' b g d h v z h t y k k l m m n n s ' p p ts ts k r sh t".split()))
_ARABIC = dict(zip("ابتثجحخدذرزسشصضطظعغفقكلمنهويىةءپچژگ", (
    "a b t th j h kh d dh r z s sh s d t z ' gh f q k l m n h w y a h ' p ch zh g").split()))
_KANA = {"": "あいうえお", "k": "かきくけこ", "g": "がぎぐげご", "s": "さしすせそ", "z": "ざじずぜぞ", "t": "たちつてと", "d": "だぢづでど",
         "n": "なにぬねの", "h": "はひふへほ", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ", "m": "まみむめも", "r": "らりるれろ"}
_KANA_OTHERS = {"し": "shi", "ち": "chi", "つ": "tsu", "ふ": "fu", "じ": "ji", "ぢ": "ji", "づ": "zu", "や": "ya", "ゆ": "yu", "よ": "yo", "わ": "wa",
                "を": "o", "ん": "n", "ゔ": "vu", "ゃ": "+ya", "ゅ": "+yu", "ょ": "+yo", "っ": "+", "ー": ""}
# Hangul's initial, middle and final letters, by the Revised Romanization.
_HANGUL = ("g kk n d tt r m b pp s ss - j jj ch k t p h".split(),
           "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(),
           "- k k k n n n t l k m l l l p l m p p t t ng t t k t p t".split())
#: Stands before what a small kana sign gives until its neighbours are known; of no script.
_SMALL = "\ue000"
_OTHER_SCRIPTS = r"[\u0370-\u052F\u0590-\u06FF\u1F00-\u1FFF\u3041-\u30FC\uAC00-\uD7A3]"


def _letters() -> dict[str, str]:
    """Every letter of the scripts above with its ASCII form: upper case, kana of both kinds, digits and marks too."""
    table = {**_CYRILLIC, **_GREEK, **_HEBREW, **_ARABIC}
    table.update({a.upper(): x.capitalize() for a, x in {**_CYRILLIC, **_GREEK}.items() if a != "ς"})
    kana = {sign: row + vowel for row, signs in _KANA.items() for sign, vowel in zip(signs, "aiueo")} | _KANA_OTHERS
    kana = {sign: x.replace("+", _SMALL) for sign, x in kana.items()}
    table.update(kana)
    table.update({chr(ord(sign) + 0x60): x for sign, x in kana.items() if sign != "ー"})
    table.update({chr(0x660 + n): str(n) for n in range(10)})
    table.update({chr(code): "" for code in (*range(0x591, 0x5C8), *range(0x64B, 0x653), 0x640) if unicodedata.category(chr(code)) in ("Mn", "Lm")})
    return table


def _accent_table() -> tuple[str, str]:
    """Accented letters to their base letter, by canonical decomposition; marks to nothing."""
    source, target = [], []
    letters = _letters()
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x370, 0x530), *range(0x620, 0x6D4), *range(0x1F00, 0x2000)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and chr(code) not in letters and (base.isascii() or base in letters):
            source.append(chr(code))
            target.append(base)
    source.extend(SINGLES)
    target.extend(SINGLES.values())
    source.extend(chr(code) for code in range(0x300, 0x370))
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def _romanized(c: Column) -> Column:
    """Letters by table, Hangul syllables by their place in the code, kana's small signs by their neighbours."""
    quoted = lambda x: "'" + x.replace("'", "\\'") + "'"
    table = "map(" + ", ".join(f"{quoted(a)}, {quoted(x)}" for a, x in _letters().items()) + ")"
    first, middle, last = ("array(" + ", ".join(quoted(x.replace("-", "")) for x in part) + ")" for part in _HANGUL)
    n = "(ascii(ch) - 44032)"
    syllable = f"concat(get({first}, {n} DIV 588), get({middle}, ({n} % 588) DIV 28), get({last}, {n} % 28))"
    one = f"CASE WHEN ascii(ch) BETWEEN 44032 AND 55203 THEN {syllable} ELSE coalesce(try_element_at({table}, ch), ch) END"
    text = F.array_join(F.call_function("transform", F.split(c, ""), F.expr(f"ch -> {one}")), "")
    text = F.regexp_replace(F.regexp_replace(text, f"(sh|ch|j)i{_SMALL}y", "$1"), f"i{_SMALL}y", "y")
    text = F.regexp_replace(F.regexp_replace(text, f"{_SMALL}(?=ch)", "t"), f"{_SMALL}([a-z])", "$1$1")
    return F.replace(text, F.lit(_SMALL), F.lit(""))


def transliterate(c: Column) -> Column:
    """Latin, Cyrillic, Greek, Hebrew, Arabic, kana and Hangul to ASCII. Other scripts, such as Chinese
    characters and those of India and South-East Asia, are left alone."""
    out = F.translate(c, _ACCENTED, _PLAIN)
    for letter, ascii_form in EXPANSIONS.items():
        out = F.replace(out, F.lit(letter), F.lit(ascii_form))
    # pure-ASCII values (one byte per character) need no table walk, others only that of their scripts
    return F.when(F.octet_length(c) == F.char_length(c), c) \
        .when(c.rlike(_OTHER_SCRIPTS), _romanized(out)).otherwise(out)


def drop_commas(c: Column) -> Column:
    return F.translate(c, ",", "")


def clean_bill(c: Column) -> Column:
    """``h.r. 12`` -> ``HR12``."""
    return F.upper(F.translate(c, " .", ""))


def congress_number(d: Column) -> Column:
    return F.floor((F.year(d) - F.lit(1789)) / F.lit(2)).cast("int") + F.lit(1)


def session_number(d: Column) -> Column:
    return F.when(F.year(d) % 2 == 0, F.lit(2)).otherwise(F.lit(1))


def char_positions(c: Column, char: str) -> Column:
    """All 0-based positions of one character; one pass over the text."""
    marked = F.transform(F.split(c, ""), lambda x, i: F.when(x == F.lit(char), i))
    return F.filter(marked, lambda p: p.isNotNull())


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def _collapse_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; only paths that hold one pay for the array work."""
    parts = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when(part == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.array_append(acc, part)),
    )
    folded = F.array_join(parts, "/")
    folded = F.when(path.rlike(r"(^|/)\.{1,2}$") & ~folded.endswith("/"),
                    F.concat(folded, F.lit("/"))).otherwise(folded)
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), folded).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Join a link to the URL of the page that holds it."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    no_fragment = F.substring_index(base, "#", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    link_tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.isNull() | (href == ""), base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, _collapse_dots(link_path), link_tail))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .otherwise(F.concat(origin, _collapse_dots(F.concat(folder, link_path)), link_tail))
    )
