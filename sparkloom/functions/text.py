"""Text expressions with the semantics of Python strings, JVM-side."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip and \s take as white space.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The same characters one by one, for functions that take no patterns.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
CJK = r"\u4e00-\u9fff"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def collapse(c: Column) -> Column:
    """Stripped, each run of white space as one space."""
    return F.regexp_replace(strip(c), f"{WS}+", " ")


def safe_name(c: Column, most: int | None = None) -> Column:
    """A name fit for a file: path separators and blanks as underscores."""
    out = F.translate(c, "/\\ ", "___")
    return out if most is None else F.substring(out, 1, most)


def chars(c: Column) -> Column:
    """Array of characters, one for each code point."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))


def grams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the text in lower case without white space; a shorter text is its own only gram."""
    t = F.regexp_replace(F.lower(c), f"{WS}+", "")
    return F.when(F.length(t) < n, F.array(t)).otherwise(F.array_distinct(F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))))


def ratio_of(c: Column, character_class: str) -> Column:
    """Share of the characters of a class; the class goes between brackets."""
    return F.length(F.regexp_replace(c, f"[^{character_class}]", "")) / F.length(c)


def has_any(c: Column, characters: str) -> Column:
    """Whether the text holds one of the characters; a search for each, as one for a class of them takes a pattern at every place."""
    return functools.reduce(lambda a, b: a | b, [F.contains(c, F.lit(x)) for x in dict.fromkeys(characters)])


def char_ratio_over(c: Column, share: float) -> Column:
    """Share of the most frequent character, if it is over `share`; of some character otherwise.

    In sorted order a character of more than that share is a run that holds one of the places 0, k, 2k and
    so on, k being that share of the length; so only the runs at these places are measured.
    """
    step = F.greatest(F.floor(F.length(c) * F.lit(float(share))), F.lit(1)).cast("int")
    first = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  binds x to a name, so that f doesn't make it again at each use
    run = lambda x, y: F.coalesce(F.size(x["s"]) + 2 - F.array_position(x["s"], y) - F.array_position(x["r"], y), F.lit(0))
    # below 1 / share a place is k characters on at least, so there are few; short texts have k = 1 and fewer
    places = range(int(2 / share) + 2)
    longest = lambda x: F.greatest(F.lit(0), *[run(x, F.get(x["s"], j * x["k"])) for j in places])
    return first(F.sort_array(chars(c)), lambda s: first(F.struct(s.alias("s"), F.reverse(s).alias("r"), step.alias("k")), longest)) / F.length(c)


def seeded(seed: int, *key: Column) -> Column:
    """A pseudo-random order that every engine with md5 agrees on."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *[k.cast("string") for k in key])).cast("binary"))
