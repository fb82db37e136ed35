"""ASCII spellings of letters, digits and punctuation of other scripts.

The table is made by rule: a character with a compatibility decomposition is spelt
like what it is made of; letters of the scripts of India are spelt by their Unicode
names (DEVANAGARI LETTER KA is k, DEVANAGARI VOWEL SIGN AA is aa); the rest are the
fixed values below. A character without an entry is dropped.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters whose spelling no decomposition gives.
SPELLINGS = {
    # Latin-1 signs
    "\xa0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "«": "<<", "¬": "!", "®": "(r)", "¯": "-",
    "°": "deg", "±": "+-", "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "¿": "?", "×": "x", "÷": "/",
    # Latin letters
    "Æ": "AE", "æ": "ae", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Þ": "Th", "þ": "th", "ß": "ss", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "k",
    "Ł": "L", "ł": "l", "Ŋ": "NG", "ŋ": "ng", "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "ſ": "s", "ƒ": "f", "ẞ": "Ss",
    # Greek
    "Α": "A", "Β": "B", "Γ": "G", "Δ": "D", "Ε": "E", "Ζ": "Z", "Η": "E", "Θ": "Th", "Ι": "I", "Κ": "K", "Λ": "L", "Μ": "M", "Ν": "N", "Ξ": "Ks", "Ο": "O",
    "Π": "P", "Ρ": "R", "Σ": "S", "Τ": "T", "Υ": "U", "Φ": "Ph", "Χ": "Kh", "Ψ": "Ps", "Ω": "O", "ς": "s",
    # Cyrillic
    "А": "A", "Б": "B", "В": "V", "Г": "G", "Д": "D", "Е": "E", "Ж": "Zh", "З": "Z", "И": "I", "Й": "I", "К": "K", "Л": "L", "М": "M", "Н": "N", "О": "O",
    "П": "P", "Р": "R", "С": "S", "Т": "T", "У": "U", "Ф": "F", "Х": "Kh", "Ц": "Ts", "Ч": "Ch", "Ш": "Sh", "Щ": "Shch", "Ъ": '"', "Ы": "Y", "Ь": "'", "Э": "E",
    "Ю": "Iu", "Я": "Ia", "Ё": "Io", "Ђ": "Dj", "Є": "Ie", "Ѕ": "Dz", "І": "I", "Ї": "Yi", "Ј": "J", "Љ": "Lj", "Њ": "Nj", "Ћ": "Tsh", "Џ": "Dzh",
    # punctuation
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‖": "||", "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"',
    "†": "+", "‡": "++", "•": "*", "‰": "%0", "′": "'", "‹": "<", "›": ">", "⁄": "/", "€": "EU", "₹": "Rs", "№": "No", "™": "tm",
    "\u2028": "\n", "\u2029": "\n\n", "।": " / ", "॥": " // ", "ॐ": "AUM",
    # letters of India whose names say something else
    "ळ": "l", "ऍ": "eN", "ऑ": "oN", "ॅ": "eN", "ॉ": "oN",
}

#: First and last code points that the table covers.
RANGES = ((0x80, 0x24F), (0x370, 0x52F), (0x900, 0xD7F), (0x1E00, 0x1EFF), (0x2000, 0x20BF), (0x2100, 0x214F), (0xFF00, 0xFF5E))

SCRIPTS = "DEVANAGARI|BENGALI|GURMUKHI|GUJARATI|ORIYA|TAMIL|TELUGU|KANNADA|MALAYALAM"
NAME = re.compile(rf"(?:{SCRIPTS}) (LETTER|VOWEL SIGN|SIGN) (?:SHORT |CANDRA |VOCALIC |ARCHAIC )?(\w+)$")
VOWELS = set("A AA I II U UU R RR L LL E EE AI O OO AU".split())


def _by_name(c: str) -> str:
    """The spelling that the name of a letter of India gives; '' if it gives none."""
    m = NAME.match(unicodedata.name(c, ""))
    if not m:
        return ""
    kind, name = m.groups()
    if kind == "SIGN":  # nasal and breathing signs; the sign that removes a vowel has no sound
        return {"ANUSVARA": "N", "CANDRABINDU": "N", "BINDI": "N", "TIPPI": "N", "VISARGA": "H"}.get(name, "")
    vowel = kind == "VOWEL SIGN" or name in VOWELS
    return (name if vowel else name.removesuffix("A")).lower()


def spelling(c: str) -> str:
    """ASCII for one character."""
    if c.isascii():
        return c
    for x in (c, c.upper()):
        if x in SPELLINGS:
            return SPELLINGS[x] if x == c else SPELLINGS[x].lower()
    if unicodedata.decimal(c, None) is not None:
        return str(unicodedata.decimal(c))
    if unicodedata.category(c) == "Zs":
        return " "
    parts = unicodedata.normalize("NFKD", c)
    return "".join(map(spelling, parts)) if parts != c else _by_name(c)


TABLE = {chr(i): spelling(chr(i)) for a, b in RANGES for i in range(a, b + 1)}
#: What translate can do: a character for a character, or for none.
SINGLE = {c: s for c, s in TABLE.items() if len(s) == 1}
OTHER = r"[^\x00-\x7F]"


def ascii_text(c: Column) -> Column:
    """The text in ASCII. Texts that are ASCII already cost one look."""
    once = F.translate(c, "".join(SINGLE), "".join(SINGLE.values()))
    return F.when(~c.rlike(OTHER), c).otherwise(F.transform(F.array(once), lambda s: F.when(~s.rlike(OTHER), s).otherwise(_spelt(s)))[0])


def _spelt(s: Column) -> Column:
    """Character by character, each looked up by its place in the table."""
    spellings = F.split(F.lit("\x1f".join(TABLE.values())), "\x1f")

    def one(c: Column) -> Column:
        code, at, first = F.ascii(c), F.lit(0), 1
        for a, b in RANGES:
            at = F.when(code.between(a, b), code - (a - first)).otherwise(at)
            first += b - a + 1
        return F.when(code < 128, c).when(at > 0, F.element_at(spellings, at)).otherwise("")

    # characters beyond the table's planes go first: split would halve them
    return F.array_join(F.transform(F.split(F.regexp_replace(s, r"[\x{10000}-\x{10FFFF}]", ""), ""), one), "")
