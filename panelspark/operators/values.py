"""Cleaning of values: tolerant casts, guarded ratios, null-safe clips, ordered rules, provenance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """Text to double; what isn't a finite number is missing."""
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def count(c: Column) -> Column:
    """A count: finite, integral and not negative, else missing."""
    x = number(c.cast("string"))
    return F.when((x >= 0) & (x == F.floor(x)), x.cast("long"))


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, else missing."""
    return F.when(b > 0, a / F.nullif(b, F.lit(0).cast("double")))


def clip(x: Column, lo: float, hi: float) -> Column:
    """Missing stays missing; greatest() alone would turn it into the bound."""
    return F.when(x < lo, lo).when(x > hi, hi).otherwise(x)


def in_range(x: Column, lo: float, hi: float) -> Column:
    return F.when(x.between(lo, hi), x)


def first_rule(text: Column, rules: list[tuple[str, str]], other: str) -> Column:
    """The label of the first pattern that matches, in the order given."""
    out = None
    for pattern, label in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(other)


def with_source(*options: tuple[Column, int]) -> tuple[Column, Column]:
    """(first value that isn't missing, code of where it came from)."""
    source = None
    for value, code in options:
        source = F.when(value.isNotNull(), code) if source is None else source.when(value.isNotNull(), code)
    return F.coalesce(*[v for v, _ in options]), source


def feet_inches(text: Column) -> Column:
    """``6-8``, ``6'8"`` to inches; zero is missing."""
    ft = F.regexp_extract(text, r"^\s*(\d+)\s*['\-]\s*(\d+(?:\.\d+)?)", 1).try_cast("double")
    inch = F.regexp_extract(text, r"^\s*(\d+)\s*['\-]\s*(\d+(?:\.\d+)?)", 2).try_cast("double")
    return F.nullif(ft * 12 + inch, F.lit(0.0))


def made_attempted(text: Column) -> tuple[Column, Column]:
    """``12-25`` to (12, 25)."""
    pattern = r"^\s*(\d+)\s*-\s*(\d+)\s*$"
    return F.regexp_extract(text, pattern, 1).try_cast("int"), F.regexp_extract(text, pattern, 2).try_cast("int")


def season_end(text: Column) -> Column:
    """``2018-19``, ``2018/2019``, ``2018–19`` or a lone year to the ending year, with century roll."""
    first = F.regexp_extract(text, r"((?:19|20)\d\d)", 1).try_cast("int")
    tail = F.regexp_extract(text, r"(?:19|20)\d\d\s*[-/–]\s*(\d{2,4})", 1)
    two = F.floor(first / 100).cast("int") * 100 + F.substring(tail, -2, 2).try_cast("int")
    two = F.when(two < first, two + 100).otherwise(two)
    return F.when(tail != "", F.coalesce(F.when(F.length(tail) == 4, tail.try_cast("int")), two)).otherwise(first)


def fold_of(key: Column, folds: int = 3) -> Column:
    """A stable fold of a key: the digit sum of its SHA-256, as 16 = 1 modulo 3."""
    digits = F.transform(F.split(F.sha2(key, 256), ""), lambda d: F.conv(d, 16, 10).cast("int"))
    return F.aggregate(F.filter(digits, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % folds


#: Acklam's coefficients of the inverse normal distribution function.
A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)


def inverse_normal_sql(p: str) -> str:
    """The inverse normal as one SQL expression of ``p`` in (0, 1), for either engine."""
    poly = lambda cs, x: cs[0].__repr__() if len(cs) == 1 else f"({poly(cs[:-1], x)}) * {x} + {cs[-1]!r}"
    q, r = f"({p} - 0.5e0)", f"(({p} - 0.5e0) * ({p} - 0.5e0))"
    low, high = f"sqrt(-2e0 * ln({p}))", f"sqrt(-2e0 * ln(1e0 - {p}))"
    e = lambda s: s.replace("(-", "(-")
    mid = f"(({poly(A, r)}) * {q} / (({poly(B, r)}) * {r} + 1e0))"
    tail = lambda x: f"(({poly(C, x)}) / (({poly(D, x)}) * {x} + 1e0))"
    return e(f"CASE WHEN {p} < 0.02425e0 THEN {tail(low)} WHEN {p} <= 0.97575e0 THEN {mid} ELSE -{tail(high)} END")


#: The months, in order, by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def prose_date(text: Column) -> Column:
    """The first date of a text: month day year, day month year, month year (its first day) or a lone year (1 January), tried in this order; impossible days are missing."""
    month, year = rf"\b((?:{'|'.join(MONTHS)})[a-z]*)\.?", r"((?:19|20)\d\d)\b"
    forms = [(rf"{month}\s+(\d{{1,2}}),?\s+{year}", 3, 1, 2), (rf"\b(\d{{1,2}})\s+{month},?\s+{year}", 3, 2, 1), (rf"{month},?\s+{year}", 2, 1, None), (rf"\b{year}", 1, None, None)]
    low, out = F.lower(text), None
    for pattern, y, m, d in forms:
        part = lambda i, p=pattern: F.regexp_extract(low, p, i)
        number = F.lit("1") if m is None else F.array_position(F.array(*map(F.lit, MONTHS)), F.left(part(m), F.lit(3))).cast("string")
        day = F.lit("1") if d is None else part(d)
        at = F.concat_ws("-", part(y), F.lpad(number, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
        hit = low.rlike(pattern)
        out = F.when(hit, at) if out is None else out.when(hit, at)
    return out


def relative_date(text: Column, anchor: Column) -> Column:
    """``same day``, ``next day``, ``N days later``, ``N weeks later`` from an anchor date; anything else is missing."""
    low = F.lower(text)
    n = lambda unit: F.regexp_extract(low, rf"\b(\d{{1,4}}) {unit}s? later\b", 1).try_cast("int")
    return F.when(low.rlike(r"\bsame day\b"), anchor).when(low.rlike(r"\b(next|following) day\b"), F.date_add(anchor, 1)).when(n("day").isNotNull(), F.date_add(anchor, n("day"))).when(n("week").isNotNull(), F.date_add(anchor, n("week") * 7))


def repair_encoding(text: Column, rounds: int = 3) -> Column:
    """UTF-8 that was read as Latin-1, undone while that gives valid UTF-8, at most ``rounds`` times."""
    for _ in range(rounds):
        raw = F.when(text.rlike(r"[\x80-\xff]") & text.rlike(r"^[\x00-\xff]*$"), F.encode(text, "ISO-8859-1").cast("string"))
        text = F.when(F.is_valid_utf8(raw), raw).otherwise(text)
    return text


def hits(text: Column, term: str, negations: tuple[str, ...], window: int = 20) -> tuple[Column, Column]:
    """(hits of a word between spaces, those of them with a negation in the ``window`` characters before, back to the last hit at most); a missing text has none."""
    pieces = F.split(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), f" {term} ", -1)
    before = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    negated = F.filter(before, lambda p: F.concat(F.lit(" "), F.right(p, F.lit(window)), F.lit(" ")).rlike(f" ({'|'.join(negations)}) "))
    return (F.size(pieces) - 1).cast("long"), F.size(negated).cast("long")


def deletions(text: Column) -> Column:
    """The distinct texts left after deleting none, one or two characters: texts within two edits share one."""
    without = lambda t, i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t)))
    each = lambda t: F.when(F.char_length(t) > 0, F.transform(F.sequence(F.lit(1), F.char_length(t)), lambda i: without(t, i))).otherwise(F.array().cast("array<string>"))
    one = F.array_distinct(each(text))
    return F.array_distinct(F.concat(F.array(text), one, F.flatten(F.transform(one, each))))
