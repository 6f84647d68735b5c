"""The regular expressions of the text cleaner (java.util.regex syntax)."""

# The cleaning patterns. Their order decides which branch wins
# when two could match at the same place.
ENTITY = r"(&\w+;)"
RETWEET = r"(^RT @\w+: )"
EMAIL = (
    r"(?:[a-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[a-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
    r'|"(?:[\x01-\x08\x0b\x0c\x0e-\x1f\x21\x23-\x5b\x5d-\x7f]|\\[\x01-\x09\x0b\x0c\x0e-\x7f])*")'
    r"@(?:(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
    r"|\[(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?|[a-z0-9-]*[a-z0-9]:"
    r"(?:[\x01-\x08\x0b\x0c\x0e-\x1f\x21-\x5a\x53-\x7f]|\\[\x01-\x09\x0b\x0c\x0e-\x7f])+)\])"
)
MENTION = r"(@\w+)"
LINK = r"((https?|ftp):\/\/[^\s/$.?#].[^\s]*)"
HASHTAG = r"(#\w+)"
EMOJI = r"([\u203C-\uDFFF])"

# Opt-in instead of EMOJI: keeps East Asian text, removes present-day emoji.
EMOJI_SUPPLEMENTARY = r"([\x{1F000}-\x{1FAFF}\u2600-\u27BF])"

BRANCHES = {
    "entity": ENTITY,
    "retweet": RETWEET,
    "email": EMAIL,
    "mention": MENTION,
    "link": LINK,
    "hashtag": HASHTAG,
    "emoji": EMOJI,
}
CLEAN_PATTERN = "|".join(BRANCHES.values())

# ---- The e-mail branch for long texts ------------------------------------------------------
#
# EMAIL as it stands recurses once per character or dot inside java.util.regex and rescans a run
# of word characters from each of its positions: one text with a long run ends the executor with
# a stack overflow, or keeps it busy for hours. SAFE_EMAIL finds the same matches:
#
# * possessive loops, where giving a repetition back can never help: the next thing wanted is not
#   in the class that was repeated;
# * "label (.label)+" for "(label.)+ label";
# * inside [...], a loop over pieces that end in "]", for a loop that is cut back to the last "]";
# * a start in the middle of a dotted run is skipped, unless the last match ended there: had it
#   been the start of an address, so would the run's first character have been.
_LOCAL = r"[a-z0-9!#$%&'*+/=?^_`{|}~-]"
_LABEL = r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
_IN_BRACKETS = r"(?:[\x01-\x08\x0b\x0c\x0e-\x1f\x21-\x5c\x5e-\x7f]|(?<=\\)[\x09\x20])"
SAFE_EMAIL = (
    rf"(?:(?:\G|(?<=\G\.)|(?<!{_LOCAL})(?<!{_LOCAL}\.)){_LOCAL}++(?:\.{_LOCAL}++)*+"
    r'|"(?:[\x01-\x08\x0b\x0c\x0e-\x1f\x21\x23-\x5b\x5d-\x7f]|\\[\x01-\x09\x0b\x0c\x0e-\x7f])*+")'
    rf"@(?:{_LABEL}(?:\.{_LABEL})++"
    r"|\[(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}"
    r"(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\]|[a-z0-9-]*[a-z0-9]:"
    rf"[\x01-\x08\x0b\x0c\x0e-\x1f\x21-\x7f](?:{_IN_BRACKETS}*+\])++))"
)
SAFE_CLEAN_PATTERN = CLEAN_PATTERN.replace(EMAIL, SAFE_EMAIL)
