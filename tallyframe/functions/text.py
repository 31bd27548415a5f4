"""Text normalisation for comparison, as a registry of Column functions. Values that aren't strings pass unchanged."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as Python's str methods see it: Unicode white space and four separators.
_SPACE = "(?U)[\\s\\x1c-\\x1f]+"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used: optimisers don't inline an array's element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def each(array: Column, use: Callable[[Column, Column], Column], n: int = 4) -> Column:
    """use of every element and its place. Up to n of them are laid out, so that it stays in generated code, which a lambda never does."""
    n = min(n, 8)
    laid = F.slice(F.array(*[use(F.get(array, F.lit(i)), F.lit(i)) for i in range(n)]), 1, F.size(array))
    return F.when(F.size(array) <= n, laid).otherwise(F.transform(array, lambda x, i: use(x, i)))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row, where they stand: filters on them stay above, for an optimiser that moves
    a filter below a projection computes all that it reads a second time, and what that reads a third."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(made)))


def tidy(text: Column) -> Column:
    """Whether text is of printable ASCII with single spaces within: what transforms of white space leave as it is."""
    return ~(text.startswith(" ") | text.endswith(" ") | text.contains("  ") | text.rlike("[^ -~]"))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$", "")


def collapse_whitespace(text: Column) -> Column:
    return strip(F.regexp_replace(text, _SPACE, " "))


def remove_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE, "")


def normalize_dashes(text: Column) -> Column:
    return F.translate(text, "‐‑‒–—−", "------")


def canonical_number(text: Column) -> Column:
    """Numeric-looking text without separators, sign +, leading and trailing zeros; anything else unchanged.

    Numbers of more than 28 significant digits keep all of them.
    """
    compact = strip(F.replace(text, F.lit(","), F.lit("")))
    number = compact.rlike("^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)$")
    sign = F.when(compact.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(compact, "^[+-]", "")
    whole = F.regexp_replace(F.substring_index(digits, ".", 1), "^0+", "")
    part = F.when(digits.contains("."), F.regexp_replace(F.substring_index(digits, ".", -1), "0+$", "")).otherwise("")
    out = F.concat(F.when(whole == "", "0").otherwise(whole), F.when(part != "", F.concat(F.lit("."), part)).otherwise(""))
    return F.when(number, F.when(out == "0", "0").otherwise(F.concat(sign, out))).otherwise(text)


def _python(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """An Arrow-batched call for text with characters beyond ASCII; other text never leaves the JVM's side of a CASE."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else function(x))

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")


def nfkc(text: Column) -> Column:
    import unicodedata

    ascii_only = text.rlike("^[\\x00-\\x7f]*$")
    other = _python(lambda x: unicodedata.normalize("NFKC", x))(F.when(~ascii_only, text))
    return F.when(ascii_only, text).otherwise(other)


def casefold(text: Column) -> Column:
    ascii_only = text.rlike("^[\\x00-\\x7f]*$")
    return F.when(ascii_only, F.lower(text)).otherwise(_python(str.casefold)(F.when(~ascii_only, text)))


TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "nfkc": nfkc,
    "strip": strip,
    "collapse_whitespace": collapse_whitespace,
    "whitespace": collapse_whitespace,
    "remove_whitespace": remove_whitespace,
    "casefold": casefold,
    "lower": F.lower,
    "upper": F.upper,
    "uppercase_latin": F.upper,
    "normalize_dashes": normalize_dashes,
    "canonical_number": canonical_number,
}

#: Transforms that change no tidy text. Compatibility folding doesn't either, but calls Python, which no lambda may.
KEEP_TIDY = (strip, collapse_whitespace, normalize_dashes)


def natural_key(text: Column) -> Column:
    """Digit runs as numbers, before and between lower-cased text: an array that sorts as people would.

    A number is its digits without leading zeros, the longer one being the larger, so that none is too long.
    """

    def part(p: Column) -> Column:
        digits, number = F.regexp_replace(p, "^0+(?=[0-9])", ""), p.rlike("^[0-9]")
        return F.struct(
            F.when(number, 0).otherwise(1).alias("kind"), F.when(number, F.length(digits)).alias("size"), F.when(number, digits).otherwise(F.lower(p)).alias("word")
        )

    return F.transform(F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), part)
