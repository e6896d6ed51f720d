"""Text functions as Column expressions. Stored text is never lower-cased or translated; matching works on a copy."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Words that carry no content, by which short utterances are judged.
STOPWORDS = (
    "a an the is was are were be been am i me my it its this that of to in on for and or but so very too "
    "hai ka ki ke ko se me mein"
).split()
#: Latin-script Hindi function words that mark mixed-language text.
HINDI_LATIN = (
    "hai nahi nahin kya mera meri aur bhi koi kar kiya diya liya gaya raha rahi hua hui abhi bahut bohot accha acha "
    "theek thik paisa paise wapas dubara matlab lekin phir jab tab yeh woh apna sirf"
).split()
#: A word's character and any other, white space, and a word's edge, in all scripts: Java's ``\\w`` and ``\\b`` know ASCII only.
LETTER, OTHER = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
GAP = r"[\s\x0B\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BEFORE, AFTER = f"(?<!{LETTER})", f"(?!{LETTER})"
#: Whole texts that praise or blame without content, or only report that an app fails.
GENERIC = (
    rf"(?i)^{OTHER}*(nice|good|best|super|awesome|excellent|bad|worst|ok|okay|fine|great|nyc|mast|badhiya|accha|acha|thik|theek|useless|osm|wow|thanks?|thank you)"
    rf"{OTHER}*(app|application|service|shopping|experience)?{OTHER}*$"
)
CRASH = rf"(?i)^{OTHER}*(app{GAP}+)?(is{GAP}+)?(crash{LETTER}*|not{GAP}+work{LETTER}*|hang{LETTER}*|slow|lag{LETTER}*|login{GAP}+(issue|problem)|not{GAP}+open{LETTER}*){OTHER}*$"
URL = r"(?i)https?://|www\."
#: What an unfinished text still holds.
PLACEHOLDERS = (
    ("«[^»]*»", "guillemet placeholder"),
    (rf"(?i){BEFORE}TODO{AFTER}", "TODO marker"),
    (rf"{BEFORE}XXX{AFTER}", "XXX marker"),
    (rf"(?i){BEFORE}TBD{AFTER}", "TBD marker"),
    (rf"(?i){BEFORE}FIXME{AFTER}", "FIXME marker"),
    (r"(?<![\p{L}\p{N}_?])\?{2,}(?![\p{L}\p{N}_?])", "bare question-mark placeholder"),
    (rf"(?i){BEFORE}placeholder{AFTER}", "the word placeholder"),
    (rf"(?i){BEFORE}lorem ipsum{AFTER}", "lorem ipsum"),
)
#: All white space of Unicode.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    """Without white space of any kind at either end; only the ends are looked at."""
    return F.btrim(text, F.lit(WHITE))


@F.pandas_udf(StringType())
def _nfc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield part.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Unicode NFC. Text below U+0300 is composed already and stays in the JVM."""
    return F.when(text.rlike(r"[^\x00-\x{2FF}]"), _nfc(F.when(text.rlike(r"[^\x00-\x{2FF}]"), text))).otherwise(text)


def strip_invisible(text: Column) -> Column:
    return F.regexp_replace(text, r"[​-‍⁠﻿\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def cap_runs(text: Column, least: int = 4, to: int = 3) -> Column:
    """Runs of ``least`` or more equal characters become ``to`` of them."""
    return F.regexp_replace(text, rf"(.)\1{{{least - 1},}}", "$1" * to)


def collapse_space(text: Column) -> Column:
    # a single space is left where it is
    return trimmed(F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}|\t", " "), r"\n{3,}", "\n\n"))


def normalise(text: Column, compose: bool = True) -> Column:
    return collapse_space(cap_runs(strip_invisible(nfc(text) if compose else text)))


def text_hash(text: Column) -> Column:
    """SHA-1 of a copy without case, punctuation and runs of space."""
    bare = F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.sha1(trimmed(F.regexp_replace(bare, r"(?U)\s{2,}|[^\S ]", " ")))


def detect_language(text: Column, words: Sequence[str] = HINDI_LATIN) -> Column:
    """en, hi, hinglish or other, by script and word list."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
    hits = F.size(F.filter(tokens, lambda t: t.isin(*words)))
    return (
        F.when(trimmed(text) == "", "other")
        .when(text.rlike(r"[ऀ-ॿ]"), "hi")
        .when(F.size(tokens) == 0, "other")
        .when((hits >= 2) | ((hits == 1) & (F.size(tokens) <= 8)), "hinglish")
        .otherwise("en")
    )


def emphasis_flags(raw: Column) -> dict[str, Column]:
    return {
        "has_caps_emphasis": raw.rlike(r"(?U)\b[A-Z]{4,}\b"),
        "has_repeated_chars": raw.rlike(r"(.)\1{2,}"),
        "has_exclamation_run": raw.rlike(r"!{2,}"),
    }


def word_count(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def content_tokens(text: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_']+"), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*stopwords))


def has_words(text: Column, n: int) -> Column:
    """Whether a text has n words or more; the rest of it is not looked at."""
    return text.rlike(rf"(?U)^\s*+(?:\S++\s++){{{n - 1}}}\S")


#: Characters in which most texts show as many content words as any rule asks for.
GLANCE = 1000


def has_content_tokens(text: Column, n: int) -> Column:
    """Whether a text has n content words or more. A long text is searched whole only if its beginning, whose last word may
    be cut, does not have n already."""
    start = F.size(content_tokens(F.substring(text, 1, GLANCE))) > n
    return ((F.length(text) > GLANCE) & start) | (F.size(content_tokens(text)) >= n)


def lexicon_hits(text: Column, lexicon: dict[str, Sequence[str]]) -> Column:
    """For each group of a small lexicon its phrases that a lower-case copy of the text holds: ``map<string,array<string>>``.

    For a lexicon that is a table, of any size, see ``operators.lexicon``."""

    def held(low: Column) -> Column:
        return F.create_map(*(x for group, phrases in lexicon.items() for x in (F.lit(group), F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(low, p)))))

    return F.transform(F.array(F.lower(text)), held)[0]  # a lambda's variable is computed once


def placeholder_kinds(line: Column) -> Column:
    return F.array_compact(F.array(*(F.when(line.rlike(p), F.lit(kind)) for p, kind in PLACEHOLDERS)))


def compose_text(title: Column, body: Column) -> Column:
    """``title. body`` without markup and character references; dots and spaces at the ends go."""

    def plain(text: Column) -> Column:
        out = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", "")
        for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            out = F.replace(out, F.lit(name), F.lit(char))
        return F.nullif(F.trim(out), F.lit(""))

    return F.regexp_replace(F.concat_ws(". ", plain(title), plain(body)), r"^[. ]+|[. ]+\z", "")


def to_int(text: Column) -> Column:
    """The number that a text of digits only says; else null."""
    return F.when(text.rlike(r"^\d+$"), text.try_cast("int"))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in columns))


def content_id(*parts: Column, prefix: str = "", length: int = 20) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, length))


def estimate_tokens(text: Column, ratio: float = 0.0) -> Column:
    """A length-based guess of tokens, with room for the answer as a part of it."""
    asked = F.floor(F.length(text) / 3.2) + 32
    return F.floor(asked * (1 + ratio)).cast("long")


def is_regex(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True
