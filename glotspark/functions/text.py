"""Column expressions for cleaning and cutting text; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

LINE_TERMINATORS = "\n\r\u0085\u2028\u2029"


def clean(text: Column, emoji: str = "range") -> Column:
    """Remove entities, retweet marks, e-mails, mentions, links, hashtags and emoji in one pass.

    Every branch needs one of ``& @ # ://`` or a character of the emoji class, and three of the
    seven need ``@``. Texts without them skip the alternation, or its costly ``@`` branches; the
    result is the same as running the whole pattern on every text.
    """
    if emoji not in ("range", "supplementary"):
        raise ValueError("emoji must be 'range' or 'supplementary'")
    emoji_class = P.EMOJI if emoji == "range" else P.EMOJI_SUPPLEMENTARY
    without_at = "|".join((P.ENTITY, P.LINK, P.HASHTAG, emoji_class))
    whole = P.SAFE_CLEAN_PATTERN.replace(P.EMOJI, emoji_class)
    return (
        F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, whole, ""))
        .when(
            F.contains(text, F.lit("&"))
            | F.contains(text, F.lit("#"))
            | F.contains(text, F.lit("://"))
            | text.rlike(emoji_class),
            F.regexp_replace(text, without_at, ""),
        )
        .otherwise(text)
    )


def normalized(text: Column) -> Column:
    """Lower-case text without line terminators: the character stream that grams are cut from."""
    stream = F.lower(text)
    for mark in LINE_TERMINATORS:  # a search for bytes each, far cheaper than a look-up per character
        stream = F.replace(stream, F.lit(mark))
    return stream


def char_tokens(text: Column) -> Column:
    """One lower-case token per code point, line terminators dropped."""
    return F.regexp_extract_all(normalized(text), F.lit("."), 0)


def char_ngrams(text: Column, n: int, spaced: bool = True) -> Column:
    """All overlapping character n-grams, empty for texts shorter than ``n``.

    The match takes one code point and looks ahead over the whole gram, so the regex stays linear
    and never cuts a surrogate pair. ``spaced`` joins the characters with a space, which is what
    the ML ``NGram`` stage yields.
    """
    stream = normalized(text)
    if not spaced:
        return F.regexp_extract_all(stream, F.lit("(?=(" + "." * n + "))."), 1)
    # An empty pattern splits into code points, and is cheaper than a regex that adds the spaces.
    pairs = F.concat(F.array_join(F.split(stream, ""), " "), F.lit(" "))
    return F.regexp_extract_all(pairs, F.lit("(?=(" + " ".join("." * n) + ")). "), 1)


def spaced(gram: Column) -> Column:
    """The characters of a gram joined by a space."""
    return F.regexp_replace(gram, "(.)(?=.)", "$1 ")


def windows(text: Column, n: int) -> Column:
    """At every position the next ``n`` characters, or fewer at the end of the text.

    The prefixes of the windows are all the grams of length 1 to ``n``, so jobs that count several
    gram lengths explode one row per character and derive the short grams after aggregation.
    """
    return F.regexp_extract_all(normalized(text), F.lit("(?=(.{1,%d}))." % n), 1)
