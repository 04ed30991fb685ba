"""Text cleaning as Column expressions.

All patterns are character classes and short looks around them, so that a cleaning
projection stays inside generated code. Where a class has many ranges, one test
settles the common characters first. Tokens are
runs of non-blank characters; ``squash`` brings a text into the form the other
functions expect (single blanks, none at the ends).
"""

from __future__ import annotations

import re
import string
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters, other than the blank, that count as white space between tokens.
ODD_BLANK = (
    r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANK = f" {ODD_BLANK}"
# Fixed value: characters of a word.
WORD = r"\p{L}\p{N}_"
# Fixed value: blocks that hold pictographs, and the marks that join or tint them.
PICTOGRAPH = (
    r"\x{a9}\x{ae}\x{203c}\x{2049}\x{2122}\x{2139}\x{2190}-\x{21ff}\x{2300}-\x{23ff}"
    r"\x{25a0}-\x{27bf}\x{2b00}-\x{2bff}\x{3030}\x{303d}\x{3297}\x{3299}\x{1f000}-\x{1faff}"
)
REGIONAL = r"\x{1f1e6}-\x{1f1ff}"
KEYCAP = "0123456789#*"
PICTOGRAPH_MARK = r"\x{fe0f}\x{1f3fb}-\x{1f3ff}"

USER_TOKEN = "user"


def _spans() -> list[tuple[int, int]]:
    """First and last code point of each range of ``PICTOGRAPH``, ascending."""
    found = re.findall(r"\\x\{(\w+)\}(?:-\\x\{(\w+)\})?", PICTOGRAPH)
    return [(int(a, 16), int(b or a, 16)) for a, b in found]


def _no_pictograph() -> str:
    """Class of all characters outside ``PICTOGRAPH``.

    Its first range, which holds most characters of most texts, is tried before the nested others.
    """
    ends = [-1, *[b for _, b in _spans()]]
    starts = [*[a for a, _ in _spans()], sys.maxunicode + 1]
    first, *others = [f"\\x{{{a + 1:x}}}-\\x{{{b - 1:x}}}" for a, b in zip(ends, starts) if a + 1 < b]
    return f"[{first}[{''.join(others)}]]"


NO_PICTOGRAPH = _no_pictograph()


def squash(text: Column) -> Column:
    """Collapse every run of white space to one blank and trim the ends.

    The pattern passes over single blanks, which are most of the runs, and looks
    at no other class where a visible ASCII character is the next or follows a blank.
    """
    return F.trim(F.regexp_replace(text, f"(?![!-~]| [!-~])(?:[{ODD_BLANK}][{BLANK}]*| [{BLANK}]+)", " "))


def single_blanks(text: Column) -> Column:
    """``squash`` for a text whose only white space is the blank."""
    return F.trim(F.when(text.contains("  "), F.regexp_replace(text, "  +", " ")).otherwise(text))


def tokens(text: Column) -> Column:
    """Tokens of a squashed text; the empty text has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def without_urls(text: Column) -> Column:
    """Drop tokens that start with ``http`` (case-sensitive)."""
    return F.trim(F.regexp_replace(text, "(?:^| )http[^ ]*", ""))


def hashtags(text: Column) -> Column:
    """Tokens that start with ``#``, in order, with duplicates."""
    return F.regexp_extract_all(text, F.lit("#(?<![^ ]#)[^ ]*"), 0)


def without_hashtags(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "(?:^| )#[^ ]*", ""))


def user_names(text: Column) -> Column:
    """Tokens that start with ``@``, in order, with duplicates."""
    return F.regexp_extract_all(text, F.lit("@(?<![^ ]@)[^ ]*"), 0)


def without_urls_and_hashtags(text: Column) -> Column:
    """Both removals in one pass; a token is a link or a tag, never both."""
    return F.trim(F.regexp_replace(F.concat(F.lit(" "), text), " (?:http|#)[^ ]*", ""))


def with_user_token(text: Column) -> Column:
    """Replace every token that starts with ``@`` by one neutral token."""
    return F.regexp_replace(text, "@(?<![^ ]@)[^ ]*", USER_TOKEN)


def symbol_count(text: Column, symbol: str) -> Column:
    """How often a one-character symbol occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(symbol), F.lit("")))


def without_symbols(text: Column, symbols: list[str]) -> Column:
    for symbol in symbols:
        text = F.replace(text, F.lit(symbol), F.lit(""))
    return text


def capital_share(text: Column) -> Column:
    """Share of capitals among the ASCII letters, 0 for a text without letters."""
    size = F.length(text)
    capitals = size - F.length(F.translate(text, string.ascii_uppercase, ""))
    letters = size - F.length(F.translate(text, string.ascii_letters, ""))
    return F.coalesce(F.try_divide(capitals, letters), F.lit(0.0))


def words(text: Column) -> Column:
    """Maximal runs of word characters."""
    return F.regexp_extract_all(text, F.lit(f"[{WORD}]+"), 0)


def word_tokens(text: Column) -> Column:
    """Word runs plus every other visible character as a token of its own."""
    return F.regexp_extract_all(text, F.lit(f"[{WORD}]+|(?! )[^{WORD}{BLANK}]"), 0)


def _pictographs() -> list[int]:
    """Code points of ``PICTOGRAPH``."""
    return [code for a, b in _spans() for code in range(a, b + 1)]


def default_emoji_names() -> dict[str, str]:
    """Names of all pictographs, skin tones, flags (by their letters) and keycaps, derived from the Unicode character names."""
    names = {}
    for code in _pictographs():
        if name := unicodedata.name(chr(code), ""):
            names[chr(code)] = name.lower().replace(" ", "_")
    tones = ("light", "medium_light", "medium", "medium_dark", "dark")
    names |= {chr(0x1F3FB + k): f"{tone}_skin_tone" for k, tone in enumerate(tones)}
    letter = {x: chr(0x1F1E6 + k) for k, x in enumerate(string.ascii_lowercase)}
    names |= {letter[a] + letter[b]: f"flag_{a}{b}" for a in letter for b in letter}
    for char in KEYCAP:
        name = "keycap_" + unicodedata.name(char).lower().replace(" ", "_").replace("digit_", "")
        names |= {f"{char}\ufe0f\u20e3": name, f"{char}\u20e3": name}
    return names


def emoji_named(text: Column, names: dict[str, str] | None = None) -> Column:
    """Write emoji as their names; afterwards every ``:`` and ``_`` is a blank.

    ``names`` maps an emoji (one character, a flag, a keycap or a joined sequence) to its name. A
    sequence without an entry of its own is named character by character, and a
    pictograph without a name is kept. Only texts with a character beyond ASCII pay for the lookup.
    """
    table = default_emoji_names() if names is None else names
    encoded = "\x1e".join(f"{char}\x1f{name}" for char, name in table.items())
    lookup = F.str_to_map(F.lit(encoded), F.lit("\x1e"), F.lit("\x1f"))
    unit = f"[{PICTOGRAPH}][{PICTOGRAPH_MARK}]*"
    sequence = f"[{REGIONAL}]{{2}}|{unit}(?:\\x{{200d}}{unit})*"
    capped = text
    for char, name in table.items():
        if char.endswith("\u20e3"):
            capped = F.replace(capped, F.lit(char), F.lit(f":{name}:"))
    text = F.when(text.contains("\u20e3"), capped).otherwise(text)
    pieces = F.regexp_extract_all(text, F.lit(f"{NO_PICTOGRAPH}+|{sequence}"), 0)

    def marked(name: Column) -> Column:
        return F.concat(F.lit(":"), name, F.lit(":"))

    def one(char: Column) -> Column:
        return F.coalesce(marked(F.try_element_at(lookup, char)), char)

    def piece(part: Column) -> Column:
        by_char = F.array_join(
            F.transform(F.split(F.regexp_replace(part, r"[\x{fe0f}\x{200d}]", ""), ""), one), ""
        )
        named = F.coalesce(marked(F.try_element_at(lookup, part)), by_char)
        return F.when(part.rlike(f"^[{PICTOGRAPH}]"), named).otherwise(part)

    ascii_only = F.octet_length(text) == F.length(text)
    replaced = F.when(ascii_only, text).otherwise(F.array_join(F.transform(pieces, piece), ""))
    return F.replace(F.replace(replaced, F.lit(":"), F.lit(" ")), F.lit("_"), F.lit(" "))
