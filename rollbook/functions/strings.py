"""Text functions with the missing-value rules of the reporting scripts."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# Letters and signs that do not decompose into a base letter and an accent.
ASCII_REPLACEMENTS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH",
    "ĳ": "ij", "Ĳ": "IJ", "…": "...", "«": "<<", "»": ">>", "©": "(C)", "®": "(R)",
}
ASCII_LETTERS = {
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ħ": "h",
    "Ħ": "H", "ı": "i", "ŧ": "t", "Ŧ": "T", "ŋ": "n", "Ŋ": "N", "ĸ": "q", "ſ": "s",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": '"',
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-",
    "×": "*", "÷": "/", " ": " ",
}


@cache
def _accent_map() -> tuple[str, str]:
    """Every Latin letter with accents, and the plain letter it decomposes to."""
    source, target = list(ASCII_LETTERS), list(ASCII_LETTERS.values())
    for start, end in ((0x00C0, 0x024F), (0x1E00, 0x1EFF)):
        for point in range(start, end + 1):
            letter = chr(point)
            base = unicodedata.normalize("NFD", letter)[0]
            if base != letter and base.isascii() and letter not in ASCII_LETTERS:
                source.append(letter)
                target.append(base)
    return "".join(source), "".join(target)


def to_ascii(c: Column) -> Column:
    """Latin letters to ASCII: accents dropped, ß to ss, æ to ae and so on. Text that is ASCII
    already is left alone, and each step runs only on text that has something for it."""
    source, target = _accent_map()
    out = F.when(c.rlike(r"\p{Mn}"), F.regexp_replace(c, r"(?<=[A-Za-z])\p{Mn}+", "")).otherwise(c)
    out = F.translate(out, source, target)
    spelled = out
    for sign, plain in ASCII_REPLACEMENTS.items():
        spelled = F.replace(spelled, F.lit(sign), F.lit(plain))
    out = F.when(out.rlike("[" + "".join(ASCII_REPLACEMENTS) + "]"), spelled).otherwise(out)
    return F.when(c.rlike(r"[^\x00-\x7F]"), out).otherwise(c)


# The characters that count as white space.
WHITE_SPACE = (" \t\n\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")


def trim_all(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def extract(c: Column, pattern: str) -> Column:
    """First match of the pattern, NULL without one."""
    return F.regexp_substr(c, F.lit(pattern))


def replace_first(c: Column, pattern: str, replacement: str) -> Column:
    """Replace the first match only. The replacement is plain text."""
    plain = replacement.replace("\\", "\\\\").replace("$", "\\$")
    # the non-greedy head stops at the first match; an anchored pattern keeps its anchor
    if pattern.startswith("^"):
        return F.regexp_replace(c, pattern, plain)
    return F.regexp_replace(c, f"(?s)^(.*?)(?:{pattern})", "$1" + plain)


def replace_all(c: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(c, pattern, replacement)


def remove_prefix(c: Column, pattern: str) -> Column:
    """Remove the pattern where the text starts with it."""
    return F.regexp_replace(c, "^(?:" + pattern + ")", "")


def text_or_na(c: Column) -> Column:
    """The text, or the two letters NA where it is missing."""
    return F.coalesce(c.cast("string"), F.lit("NA"))


def paste(*parts: Column, sep: str = " ") -> Column:
    """Join texts; a missing part shows as NA instead of making the whole NULL."""
    return F.concat_ws(sep, *[text_or_na(p) for p in parts])


def first_line(c: Column) -> Column:
    return F.split(c, "\n").getItem(0)


def clean_entity_name(c: Column, prefix: str, aliases: dict[str, str] | None = None) -> Column:
    """Lower case, institution prefix ("abc - ") removed, trimmed, then whole-name aliases."""
    out = trim_all(remove_prefix(F.lower(c), prefix.lower() + r"\s*-\s*"))
    for old, new in (aliases or {}).items():
        out = F.when(out == old, F.lit(new)).otherwise(out)
    return out


def parse_number(c: Column) -> Column:
    """First number in the text, "," read as grouping mark; NULL without one."""
    digits = F.regexp_substr(c, F.lit(r"-?[0-9][0-9,]*([.][0-9]+)?"))
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def parse_european_number(c: Column) -> Column:
    """"1.234,5" to 1234.5; NULL where that is no number."""
    plain = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("double")


def format_european_number(c: Column) -> Column:
    """1234.5 to "1234,5", also large numbers in full."""
    full = F.regexp_replace(c.try_cast("decimal(38,6)").cast("string"), r"\.?0+$", "")
    text = F.when(F.abs(c) >= 1e7, F.coalesce(full, c.cast("string"))).otherwise(c.cast("string"))
    return F.replace(text, F.lit("."), F.lit(","))
