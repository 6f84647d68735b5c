from .patterns import BRANCHES, CLEAN_PATTERN
from .scripts import folded
from .text import char_ngrams, char_tokens, clean, normalized, spaced, windows

__all__ = [
    "BRANCHES",
    "CLEAN_PATTERN",
    "char_ngrams",
    "char_tokens",
    "clean",
    "folded",
    "normalized",
    "spaced",
    "windows",
]
