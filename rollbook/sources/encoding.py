"""Texts whose encoding is not the same in every value.

Exports are put together from systems of different encodings: one line is UTF-8, the next Latin-1, a third is UTF-8 that was
read as Latin-1 and written again. UTF-8 can be told with near certainty, as other encodings' accented letters are no valid sequences of it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: Windows' Latin-1 has letters and signs at 27 of the places 80 to 9F (hexadecimal), in this order
WINDOWS_SIGNS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
WINDOWS_PLACES = [*range(0x80, 0x81), *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F]


def repair_encoding(text: Column) -> Column:
    """A text that was UTF-8 and was read as Latin-1 ("CafÃ©") becomes what it was ("Café"): its characters are put back to
    bytes, and if all of them are bytes and these are valid UTF-8, that is the text. Any other text stays as it is; a missing one stays missing."""
    signs = F.translate(text, WINDOWS_SIGNS, "".join(map(chr, WINDOWS_PLACES)))
    bytes_only = ~signs.rlike(r"[^\x{00}-\x{FF}]") & signs.rlike(r"[\x{C2}-\x{F4}][\x{80}-\x{BF}]")
    back = F.encode(F.when(bytes_only, signs), "ISO-8859-1")
    return F.coalesce(F.when(bytes_only, F.try_validate_utf8(back.cast("string"))), text)


def windows_signs(text: Column) -> Column:
    """Signs of Windows' Latin-1 in a text that was read as plain Latin-1, which has control characters in their places."""
    return F.translate(text, "".join(map(chr, WINDOWS_PLACES)), WINDOWS_SIGNS)


def decoded(lines, encoding: str = "utf-8", repair: bool = False):
    """An Arrow array of bytes as text. With `repair`, lines that are no valid UTF-8 are Windows' Latin-1, or else Latin-1."""
    import pyarrow as pa

    if repair or encoding.lower().replace("-", "") == "utf8":
        try:
            return lines.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            pass
    decode = _either if repair else lambda line: line.decode(encoding, "replace")
    return pa.array([decode(line) for line in lines.to_pylist()], pa.string())


def _either(line: bytes) -> str:
    for encoding in ("utf-8", "cp1252"):
        try:
            return line.decode(encoding)
        except UnicodeDecodeError:
            continue
    return line.decode("latin-1")
