"""Column expressions over review text. All of them stay inside the JVM."""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tellmark import lexicon as L

# Same meaning as the classes in the lexicon, arranged so that printable ASCII, nearly all
# of the input, is decided by one range test instead of the whole class.
NOT_ASCII_INK = "(?![!-~])"
TOKEN = f"[!-~]++{L.NON_WS}*+|{L.NON_WS}++"
BLANKS = f"{NOT_ASCII_INK}{L.WS}+"
BLANK_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if re.fullmatch(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{m[1]:0>4}", L.WS), c))
SHOUTED = (
    f"(?<![!-~])(?![a-z\\s])(?<!{L.NON_WS})"
    f"[^{L.WS[1:-1]}\\p{{IsLowercase}}\\p{{Lt}}]{{2,}}(?!{L.NON_WS})"
)


def present(text: Column) -> Column:
    """Missing text counts as empty text wherever features are computed."""
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Without blanks at both ends; only these are looked at."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def strip_quoted(text: Column) -> Column:
    """Strip blanks, then double quotes, then blanks again."""
    return strip(F.regexp_replace(strip(text), '^"+|"+\\z', ""))


def words(text: Column) -> Column:
    """Lower-cased ASCII words; any other letter breaks a word."""
    return F.regexp_extract_all(F.lower(text), F.lit(L.LOWER_WORD), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of blank-separated tokens: one more than the blank runs between them."""
    edges = F.substring(text, 1, 1).rlike(L.WS).cast("int") + F.substring(text, -1, 1).rlike(L.WS).cast("int")
    return F.when(F.length(text) == 0, 0).otherwise(F.regexp_count(text, F.lit(BLANKS)) + 1 - edges)


def line_tokens(text: Column) -> Column:
    """Tokens of each line that has any. A line feed is a blank, so they add up to those of the text."""
    return F.filter(F.transform(F.split(text, "\n"), lambda p: token_count(p).cast("bigint")), lambda c: c > 0)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def sentences(text: Column) -> Column:
    """Split at a blank run after . ! or ?, and drop blank pieces."""
    parts = F.split(text, f"{NOT_ASCII_INK}(?<={L.SENTENCE_END}){L.WS}+")
    return F.filter(parts, lambda s: s.rlike(f"[!-~]|{L.NON_WS}"))


def count_literal(text: Column, literal: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))


def count_chars(text: Column, chars: str) -> Column:
    escaped = "".join("\\" + c for c in chars)
    return F.regexp_count(text, F.lit(f"[{escaped}]"))


def count_in(words_: Column, lexicon: list[str]) -> Column:
    return F.size(F.filter(words_, lambda w: w.isin(*lexicon)))


def shouted_tokens(text: Column) -> Column:
    """Tokens of two or more characters holding an upper-case and no other cased letter."""
    found = F.regexp_extract_all(text, F.lit(SHOUTED), F.lit(0))
    return F.size(F.filter(found, lambda w: w.rlike(r"\p{IsUppercase}")))


def beyond_ascii(text: Column) -> Column:
    """The characters outside ASCII, in order; usually very few."""
    return F.regexp_replace(text, r"[\x00-\x7f]++", "")


def digits(text: Column, exotic: Column) -> Column:
    """Digit characters; `exotic` is `beyond_ascii(text)`."""
    return F.regexp_count(text, F.lit("[0-9]")) + F.regexp_count(exotic, F.lit(L.DIGIT))


def matches(text: Column, pattern: str) -> Column:
    """Whether a phrase pattern occurs; texts without its longest fixed part skip the regex.

    `(?d)` lets `.` cross every line mark but \\n, `(?U)` keeps \\b Unicode-aware.
    """
    fixed = re.split(r"\\b|\([^)]*\)\??|\[[^\]]*\]|\.\*|.\?", pattern)
    return text.contains(max(fixed, key=len)) & text.rlike(f"(?dU){pattern}")


def sum_of(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)


def sum_of_squares(counts: Column) -> Column:
    return F.aggregate(
        counts, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint") * x.cast("bigint")
    )


def population_std(n: Column, total: Column, squares: Column) -> Column:
    """Population deviation from exact integer sums, so no engine-specific rounding enters."""
    n = n.cast("bigint")
    return F.sqrt((n * squares - total * total).cast("double")) / n


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double")


def text_key(text: Column) -> Column:
    """Content key; two different texts never share it in practice."""
    return F.sha2(text, 256)
