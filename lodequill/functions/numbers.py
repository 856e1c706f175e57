"""Numerals and written numbers in Turkish and English."""

from __future__ import annotations

import re
from functools import lru_cache

# Number words.
TR_UNITS = "- bir iki üç dört beş altı yedi sekiz dokuz".split()
TR_TENS = "- on yirmi otuz kırk elli altmış yetmiş seksen doksan".split()
EN_SMALL = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
EN_TENS = "- - twenty thirty forty fifty sixty seventy eighty ninety".split()
TR_ORDINAL_ENDS = {
    "bir": "birinci",
    "iki": "ikinci",
    "üç": "üçüncü",
    "dört": "dördüncü",
    "beş": "beşinci",
    "altı": "altıncı",
    "yedi": "yedinci",
    "sekiz": "sekizinci",
    "dokuz": "dokuzuncu",
    "on": "onuncu",
    "yirmi": "yirminci",
    "otuz": "otuzuncu",
    "kırk": "kırkıncı",
    "elli": "ellinci",
    "altmış": "altmışıncı",
    "yetmiş": "yetmişinci",
    "seksen": "sekseninci",
    "doksan": "doksanıncı",
    "yüz": "yüzüncü",
    "bin": "bininci",
}
EN_ORDINAL_ENDS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
ROMAN = (("M", 1000), ("CM", 900), ("D", 500), ("CD", 400), ("C", 100), ("XC", 90), ("L", 50), ("XL", 40), ("X", 10), ("IX", 9), ("V", 5), ("IV", 4), ("I", 1))


def to_roman(n: int) -> str:
    out = ""
    for sign, value in ROMAN:
        out += sign * (n // value)
        n %= value
    return out


def roman_value(text: str) -> int | None:
    """The value of a canonical numeral up to 4999 in any case, else None."""
    up, total, rest = text.upper(), 0, text.upper()
    for sign, value in ROMAN:
        while rest.startswith(sign):
            total, rest = total + value, rest[len(sign) :]
    if rest or not 0 < total < 5000:
        return None
    # canonical forms, and those with D or L, V before a run of the next sign
    return total if to_roman(total) == up else None


def cardinal(n: int, language: str) -> str | None:
    if not 1 <= n <= 9999:
        return None
    if language == "tr":
        parts = []
        for size, word in ((1000, "bin"), (100, "yüz")):
            k, n = divmod(n, size)
            if k:
                parts.append(word if k == 1 else f"{TR_UNITS[k]} {word}")
        parts += [TR_TENS[n // 10]] * (n >= 10) + [TR_UNITS[n % 10]] * (n % 10 > 0)
        return " ".join(parts)
    parts = []
    for size, word in ((1000, "thousand"), (100, "hundred")):
        k, n = divmod(n, size)
        if k:
            parts.append(f"{EN_SMALL[k]} {word}")
    if n >= 20:
        parts.append(EN_TENS[n // 10])
        n %= 10
    if n:
        parts.append(EN_SMALL[n])
    return " ".join(parts)


def ordinal(n: int, language: str) -> str | None:
    words = cardinal(n, language)
    if words is None:
        return None
    head, _, last = words.rpartition(" ")
    if language == "tr":
        last = TR_ORDINAL_ENDS[last]
    elif last in EN_ORDINAL_ENDS:
        last = EN_ORDINAL_ENDS[last]
    else:
        last = last[:-1] + "ieth" if last.endswith("y") else last + "th"
    return f"{head} {last}".strip()


@lru_cache(maxsize=8)
def written(language: str, most: int = 999) -> tuple[re.Pattern, dict[str, int]]:
    """One pattern for all written ordinals up to `most`, longest first."""
    values = {ordinal(n, language): n for n in range(1, most + 1)}
    longest = sorted(values, key=len, reverse=True)
    return re.compile(r"\b(?:" + "|".join(map(re.escape, longest)) + r")\b", re.I), values


def digits_from_written(text: str, language: str) -> str:
    pattern, values = written(language)
    lower = {k.lower(): v for k, v in values.items()}
    return pattern.sub(lambda m: f"{lower[m[0].lower()]}." if m[0].lower() in lower else m[0], text)


def written_from_digits(text: str, language: str) -> str:
    return re.sub(r"\b(\d{1,4})(?:\s*\.)?(?=\s+[^\W\d_])", lambda m: ordinal(int(m[1]), language) or m[0], text)


def digits_from_roman(text: str, boundary: str = r"\b") -> str:
    return re.sub(rf"{boundary}[IVXLCDM]+{boundary}", lambda m: str(roman_value(m[0]) or m[0]), text, flags=re.I)
