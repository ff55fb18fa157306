"""Numbers, ranks and dictionary words in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numerals of tiers, and how texts foretell a place.
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10}
PROJECTED = r"(?i)projected[^.]{0,60}?\b(?:no\.?|number|#)\s?([0-9]{1,2})\b"
TOP = r"(?i)\btop[- ]([0-9]{1,2})\b (?:pick|prospect)"


def tier_number(text: Column) -> Column:
    """The first arabic number of a text, else its first roman numeral up to ten as a word of its own."""
    arabic = F.regexp_extract(text, r"([0-9]+)", 1)
    roman = F.regexp_extract(F.upper(text), r"\b(VIII|VII|VI|IV|IX|III|II|I|V|X)\b", 1)
    numeral = F.try_element_at(F.create_map(*[F.lit(x) for pair in ROMAN.items() for x in pair]), roman)
    return F.coalesce(arabic.try_cast("double"), numeral.cast("double"))


def smallest_pick(text: Column) -> Column:
    """The least place that a text foretells: a number within sixty characters after "projected", or "top n" before pick or prospect."""
    told, top = (F.regexp_extract_all(text, F.lit(x), F.lit(1)) for x in (PROJECTED, TOP))
    return F.array_min(F.transform(F.concat(told, top), lambda x: x.try_cast("int")))


def infobox(text: Column, field: str) -> Column:
    """The value of a field of an infobox, a line ``| field = value``; null without one."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?im)^[ \t]*\|[ \t]*{field}[ \t]*=[ \t]*([^\n|]*)", 1)), F.lit(""))


def dictionary_hits(words: Column, dictionary: list[str], suffix: str | None = None, stops: list[str] = ()) -> Column:
    """How many of an array of words are in a dictionary, or, with a suffix, end so without being stop words: the regular forms that a list doesn't name."""
    known = F.array(*[F.lit(x) for x in dictionary])
    regular = (lambda w: w.endswith(suffix) & (F.char_length(w) > len(suffix) + 2) & ~w.isin(*stops)) if suffix else (lambda w: F.lit(False))
    return F.size(F.filter(words, lambda w: F.array_contains(known, w) | regular(w))).cast("long")
