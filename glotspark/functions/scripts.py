"""Scripts whose characters language profiles fold to one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranges of code points, and the character that stands for all of them in profiles.
REPRESENTATIVES = {
    "぀-ゟ": "あ",  # Hiragana
    "゠-ヿ": "ア",  # Katakana
    "㄀-ㄯㆠ-ㆿ": "ㄅ",  # Bopomofo
    "가-힣": "가",  # Hangul syllables
    "Ạ-ỿ": "ể",  # Vietnamese letters
    "ی": "ي",  # Farsi yeh, Arabic yeh
}


def folded(text: Column) -> Column:
    """Every character of a folded script replaced by its representative; one for one, so that the
    grams of a folded text are the folded grams of the text. Other texts are left as they are."""
    found = text.rlike(f"[{''.join(REPRESENTATIVES)}]")
    replaced = reduce(
        lambda part, each: F.regexp_replace(part, f"[{each[0]}]", each[1]),
        REPRESENTATIVES.items(),
        text,
    )
    return F.when(found, replaced).otherwise(text)
