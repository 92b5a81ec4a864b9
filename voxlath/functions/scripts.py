"""Romanised Nepali to Devanagari by fixed rules, and back to a rough Latin spelling."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What each romanisation stands for.
HALANT, NUKTA, DIGITS = "्", "़", "०१२३४५६७८९"
CONSONANTS = {
    "k": "क", "q": "क", "kh": "ख", "g": "ग", "gh": "घ", "NG": "ङ", "c": "च", "ch": "च", "chh": "छ", "Ch": "छ", "j": "ज", "z": "ज", "jh": "झ", "NY": "ञ",
    "T": "ट", "Th": "ठ", "D": "ड", "Dh": "ढ", "N": "ण", ".D": "ड़", ".Dh": "ढ़", "t": "त", "th": "थ", "d": "द", "dh": "ध", "n": "न",
    "p": "प", "ph": "फ", "f": "फ", "b": "ब", "bh": "भ", "m": "म", "y": "य", "r": "र", "l": "ल", "w": "व", "v": "व",
    "sh": "श", "Sh": "ष", "S": "ष", "s": "स", "h": "ह", "x": "क्ष", "ksh": "क्ष", "kSh": "क्ष", "gy": "ज्ञ", "gny": "ज्ञ", "jny": "ज्ञ",
}
#: A vowel by itself, and after a consonant.
VOWELS = {
    "a": ("अ", ""), "aa": ("आ", "ा"), "A": ("आ", "ा"), "i": ("इ", "ि"), "ii": ("ई", "ी"), "ee": ("ई", "ी"), "I": ("ई", "ी"), "u": ("उ", "ु"), "uu": ("ऊ", "ू"), "oo": ("ऊ", "ू"), "U": ("ऊ", "ू"),
    "R": ("ऋ", "ृ"), "e": ("ए", "े"), "ai": ("ऐ", "ै"), "ei": ("ऐ", "ै"), "o": ("ओ", "ो"), "au": ("औ", "ौ"), "ou": ("औ", "ौ"),
}
MODIFIERS = {"M": "ं", "~": "ँ", "H": "ः"}
#: Rough Latin letters of Devanagari consonants, vowel signs, vowels and other signs.
LATIN = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "ng", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "n", "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n",
    "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n", "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "ळ": "l", "व": "w", "श": "sh", "ष": "sh", "स": "s", "ह": "h",
}
SIGNS = {"ा": "aa", "ि": "i", "ी": "ii", "ु": "u", "ू": "uu", "ृ": "ri", "े": "e", "ै": "ai", "ो": "o", "ौ": "au", "ॅ": "e", "ॉ": "o"}
ALONE = {"अ": "a", "आ": "aa", "इ": "i", "ई": "ii", "उ": "u", "ऊ": "uu", "ऋ": "ri", "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au", "ं": "n", "ँ": "n", "ः": "h"}


def _longest(keys) -> str:
    return "|".join(re.escape(k) for k in sorted(keys, key=len, reverse=True))


_KEYS = [*CONSONANTS, *VOWELS, *MODIFIERS]
# Keys in their own case come first; then lower-case keys in any case.
_TOKEN = re.compile(f"({_longest(_KEYS)})|((?i:{_longest(k for k in _KEYS if k == k.lower())}))|(.)", re.DOTALL | re.ASCII)
_STOP = re.compile(r"(?<![0-9.])\.(?![0-9.])")
_BRACED = re.compile(r"\{([^{}]*)\}")
_SYLLABLE = re.compile(f"(?:(ज(?:{NUKTA}(?=.))?{HALANT}ञ)|([{''.join(LATIN)}])(?:{NUKTA}(?=.))?)([{''.join(SIGNS)}]|{HALANT})?|(.)", re.DOTALL)


def _plain(text: str, digits: bool, danda: bool) -> str:
    out, open_ = "", False  # open: the last letter is a consonant that still has its own vowel
    for own, folded, other in _TOKEN.findall(text):
        key = own or folded.lower()
        if key in CONSONANTS:
            out += HALANT * open_ + CONSONANTS[key]
        elif key in VOWELS:
            out += VOWELS[key][open_]
        elif key:
            out += MODIFIERS[key]
        elif other == "_":  # parts letters that would be read as one key
            continue
        else:
            out += HALANT * open_ if other == "\\" else "।" if other == "|" else other
        open_ = key in CONSONANTS
    out = out.replace("।।", "॥")
    out = _STOP.sub("।", out) if danda else out
    return out.translate({48 + i: d for i, d in enumerate(DIGITS)}) if digits else out


def devanagari_of(text: str, digits: bool = True, danda: bool = True) -> str:
    """Text in Devanagari; what stands in {braces} is copied."""
    parts = _BRACED.split(text)
    return "".join(p if i % 2 else _plain(p, digits, danda) for i, p in enumerate(parts))


def latin_of(word: str) -> str:
    """A rough Latin spelling, good for lookup keys."""

    def syllable(m: re.Match) -> str:
        special, consonant, sign, other = m.groups()
        if other is not None:
            return ALONE.get(other, "")
        return ("gy" if special else LATIN[consonant]) + ("a" if sign is None else SIGNS.get(sign, ""))

    return _SYLLABLE.sub(syllable, word)


def devanagari(text: Column, digits: bool = True, danda: bool = True) -> Column:
    @F.pandas_udf(T.StringType())
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else devanagari_of(t, digits, danda))

    return run(text)


@F.pandas_udf(T.StringType())
def latin(word: pd.Series) -> pd.Series:
    return word.map(lambda t: None if t is None else latin_of(t))


def typed_latin(word: Column) -> Column:
    """A typed word's case signs in the spelling that `latin` gives, so that keys of both agree."""
    signs = F.replace(F.replace(F.replace(word, F.lit("R"), F.lit("ri")), F.lit("M"), F.lit("n")), F.lit("H"), F.lit("h"))
    return F.translate(signs, "~_\\", "")
