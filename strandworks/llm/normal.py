"""Text that looks the same, in one form: compatibility normalisation in composed form, mapped whitespace, no
default-ignorable characters, full case folding, and look-alike letters as Latin letters.

Python strings are handled per distinct value of an Arrow batch; ASCII values take a short way.
"""

from __future__ import annotations

import re
import string
import sys
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code points that Unicode calls default-ignorable.
IGNORABLE = (
    r"\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0"
    r"\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
)
# Letters and hyphens that look like a Latin letter or an ASCII hyphen, and that letter.
LOOKALIKES = {
    "АВЕЅІЈКМНОРСТУХԌаеѕіјорсухһԁԛԝ": "ABESIJKMHOPCTYXGaesijopcyxhdqw",  # Cyrillic
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρϲϳ": "ABEZHIKMNOPTYXovpcj",  # Greek
    "օɡ": "og",  # Armenian, phonetic
    "\u2010\u2011": "--",
}
_IGNORABLE = re.compile(f"[{IGNORABLE}]")
_SPACE = re.compile(r"[\s\u0085\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_MARKS = re.compile(r"[\u0300-\u036f]")
_NOT_WORD = re.compile(r"[\W_]+")
# shows nothing either: control characters that are no whitespace
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]")


class Lookalikes:
    """Letters and the letter that stands for all that look like it: `as_is` keeps letter case; `folded` has one letter for both cases.

    Of a letter whose two cases look like different Latin letters, the folded form takes what its small letter looks like.
    """

    def __init__(self, pairs: dict[str, str]):
        self.as_is = {ord(c): x for c, x in pairs.items()}
        self.folded: dict[int, str] = {}
        # capitals first, so that small letters prevail
        for c, x in sorted(pairs.items(), key=lambda p: (p[0] == p[0].casefold(), p[0])):
            if len(c.casefold()) == 1 and x.isascii():
                self.folded[ord(c.casefold())] = x.casefold()
        for c, x in pairs.items():
            if not x.isascii() and c == c.casefold() and x == x.casefold():
                self.folded.setdefault(ord(c), self.folded.get(ord(x), x))
        self.seen = frozenset(map(chr, self.as_is.keys() | self.folded.keys()))


BASIC = Lookalikes({a: b for these, those in LOOKALIKES.items() for a, b in zip(these, those, strict=True)})


@lru_cache(maxsize=1)
def unicode_lookalikes(spark: SparkSession) -> Lookalikes:
    """BASIC, and all letters, of whatever script, as Unicode's table of confusables takes them for each other.

    Letters that the table gives one skeleton become one letter: the ASCII letter of that skeleton, else the first of
    them, common Greek and Cyrillic ones before rare ones.
    The letter case stays apart where both cases of a letter have one skeleton. The table is generous within a script
    without letter case (three common Thai letters have one skeleton), so letters of which such a script has several with
    one skeleton are not mapped; neither is the dotless i, an everyday letter beside i, nor ASCII letters, digits and marks.
    The table is the one of the ICU library that Spark brings along. The driver asks it once for the letters' skeletons.
    """
    letters = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if c != "ı" and unicodedata.category(c)[0] == "L" and unicodedata.is_normalized("NFKD", c) and not _IGNORABLE.match(c)]
    ascii_ = [*string.ascii_letters]
    icu = spark._jvm.com.ibm.icu.text.SpoofChecker
    checker = icu.Builder().setChecks(icu.CONFUSABLE).build()
    skeletons = checker.getSkeleton("\n".join(ascii_ + letters)).split("\n")
    like: dict[str, list[str]] = {}
    for x, skeleton in zip(ascii_, skeletons):
        like.setdefault(skeleton, []).append(x)
    # of letters without case: the script, told by the name's first word, and the skeleton
    caseless = {c: (unicodedata.name(c, "").split(" ")[0], skeleton) for c, skeleton in zip(letters, skeletons[len(ascii_) :]) if not (c.isupper() or c.islower())}
    several = {x for x, n in Counter(caseless.values()).items() if n > 1}
    found = {}
    others: dict[tuple[str, bool], list[str]] = {}
    for c, skeleton in zip(letters, skeletons[len(ascii_) :]):
        if caseless.get(c) in several:
            continue
        if skeleton in like:
            found[c] = min(like[skeleton], key=lambda x: (x.islower() != c.islower(), x))
        elif skeleton[:1].isalnum():
            others.setdefault((skeleton, (skeleton[0] if c in caseless else c).isupper()), []).append(c)
    basic = {chr(c): x for c, x in BASIC.as_is.items()}
    for same in others.values():
        x = min((basic[c] for c in same if c in basic), default=min(same, key=lambda c: (not "Α" <= c <= "џ", c)))
        found |= {c: x for c in same if c != x}
    return Lookalikes(found | basic)


def _plain(text: str) -> str:
    return _IGNORABLE.sub("", unicodedata.normalize("NFKC", _IGNORABLE.sub("", text)))


def _as_latin(text: str, like: Lookalikes, table: dict[int, str]) -> str:
    # look-alikes are mapped without their accents, then composed again
    apart = unicodedata.normalize("NFD", text)
    return unicodedata.normalize("NFC", apart.translate(table)) if not like.seen.isdisjoint(apart) else unicodedata.normalize("NFC", text)


def look(text: str, like: Lookalikes = BASIC) -> str:
    """The form in which texts that look the same are equal; letter case, accents, digits and punctuation stay."""
    if not text.isascii():
        text = _as_latin(_plain(text), like, like.as_is)
    return _SPACE.sub(" ", text).strip()


def canonical(text: str, like: Lookalikes = BASIC) -> str:
    """The form for comparison, the same for a text in capitals and in small letters: folded, look-alikes mapped, folded again."""
    if text.isascii():
        return _SPACE.sub(" ", text).strip().lower()
    text = _plain(text).casefold()
    return _SPACE.sub(" ", _as_latin(unicodedata.normalize("NFKC", text), like, like.folded).casefold()).strip()


def without_accents(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFD", text)))


def words(text: str) -> str:
    """canonical(text) as words joined by single spaces."""
    # combining marks of Indic scripts are no word characters to the pattern, yet belong to their word
    text = canonical(text)
    if text.isascii():
        return _NOT_WORD.sub(" ", text).strip()
    return " ".join("".join(c if c.isalnum() or unicodedata.category(c)[0] == "M" else " " for c in text).split())


def per_distinct(series: pd.Series, f) -> pd.Series:
    """f of each value, called once per distinct value; null stays null."""
    # no factorize: it takes texts for equal that differ behind a NUL
    done: dict[str, object] = {v: f(v) for v in dict.fromkeys(series) if not pd.isna(v)}
    return pd.Series([done.get(v) for v in series], dtype=object)


FORMS = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("look", T.StringType())])


def text_forms(column: Column, like: Lookalikes = BASIC) -> Column:
    """struct(canonical, look) of a text: the form in which it compares equal whatever its letter case, and the form that keeps it.

    Both come from one pass, once per distinct value of a batch. null stays null; control characters count as nothing;
    blank text and text of ignorable characters alone become the empty string.
    """

    @F.pandas_udf(FORMS)
    def mapped(series: pd.Series) -> pd.DataFrame:
        shown = per_distinct(series, lambda x: _CONTROL.sub("", x))
        return pd.DataFrame({"canonical": per_distinct(shown, lambda x: canonical(x, like)), "look": per_distinct(shown, lambda x: look(x, like))})

    return mapped(column)
