"""Text expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Runs of letters, digits and underscores, in Java as in RE2.
WORD_RUN = r"[\p{L}\p{N}_]+"
BLANKS = r"(?U)^\s+|\s+$"

# cp1252's characters beyond Latin-1, and the bytes that stand for them.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = "80 82 83 84 85 86 87 88 89 8A 8B 8C 8E 91 92 93 94 95 96 97 98 99 9A 9B 9C 9E 9F"
MOJIBAKE_MARKS = ("Ã", "â€", "Å", "Â")
# End of the fixed values.


def strip(c: Column) -> Column:
    """Without white space at both ends, in Unicode's sense."""
    return F.regexp_replace(c, BLANKS, "")


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as cp1252, read again; null becomes the empty text.

    Only texts with one of the marks change. In those, characters that
    cp1252 lacks and bytes that aren't UTF-8 are dropped.
    """
    text = F.coalesce(c, F.lit(""))
    latin = F.translate(F.regexp_replace(text, f"[^\\u0000-\\u007F\\u00A0-\\u00FF{CP1252}]", ""), CP1252, "".join(chr(int(x, 16)) for x in CP1252_BYTES.split()))
    again = F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))
    return F.when(text.rlike("|".join(MOJIBAKE_MARKS)), F.replace(again, F.lit("�"), F.lit(""))).otherwise(text)


def clean_headline(c: Column) -> Column:
    """Repaired, with U+FFFD as a space, stripped."""
    return strip(F.replace(repair_mojibake(c), F.lit("�"), F.lit(" ")))


def word_tokens(c: Column) -> Column:
    """Lower-cased words of two or more ASCII letters, where a word ends at no letter, digit or underscore."""
    alone = r"(?<![\p{L}\p{N}_])[a-z]{2,}+(?![\p{L}\p{N}_])"
    return F.regexp_extract_all(F.lower(c), F.lit(alone), F.lit(0))


def letter_runs(c: Column) -> Column:
    """Lower-cased runs of two or more ASCII letters, wherever they stand."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z]{2,}"), F.lit(0))


def canonical(t: Column, variants: dict[str, str]) -> Column:
    """The base form of a token: by the table, else ...ies to ...y beyond 5 letters, else without a final single s beyond 4."""
    plain = (
        F.when((F.length(t) > 5) & t.endswith("ies"), F.concat(F.left(t, F.length(t) - 3), F.lit("y")))
        .when((F.length(t) > 4) & t.endswith("s") & ~t.endswith("ss"), F.left(t, F.length(t) - 1))
        .otherwise(t)
    )
    if not variants:
        return plain
    table = F.create_map(*[F.lit(x) for kv in sorted(variants.items()) for x in kv])
    return F.coalesce(F.element_at(table, t), plain)


def without(tokens: Column, stop: tuple[str, ...] | list[str]) -> Column:
    """The tokens that aren't listed; a list of some length is looked up as a hash set."""
    return F.filter(tokens, lambda t: ~t.isin(sorted(stop))) if stop else tokens


def keyword_terms(c: Column, stop: tuple[str, ...], variants: dict[str, str]) -> Column:
    """Distinct base forms of letter runs; stop words and terms under three letters go before and after."""
    long = lambda a: F.filter(without(a, stop), lambda t: F.length(t) >= 3)
    return F.array_distinct(long(F.transform(long(letter_runs(c)), lambda t: canonical(t, variants))))


def ngrams(tokens: Column) -> Column:
    """Single tokens, then pairs of neighbours. ``tokens`` is read several times, so it should be a column, not an expression."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.concat(tokens, F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)))


def stems(term: Column) -> Column:
    """The first four letters of each word of a term."""
    return F.transform(F.split(term, " "), lambda w: F.left(w, F.lit(4)))


def slug(c: Column) -> Column:
    """Lower case; runs of all else than a-z and 0-9 become one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
