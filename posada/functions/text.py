"""Text cleaning."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Body of a character class for every white-space character, to be used under the (?U) flag; the
# four separators x1c-x1f are white space for the data but not for the regex engine.
SPACE_CLASS = r"\s\x1c-\x1f"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# A run of breaks and white space. A single blank between words needs no change and does not start a
# run, which spares most replacements. Possessive, so that a run of any length takes no recursion.
_BREAK = f"<br[{SPACE_CLASS}]*/?>"
_BREAK_OR_SPACE = (f"(?U)(?:[{SPACE_CLASS}&&[^ ]]| (?=[{SPACE_CLASS}<])|{_BREAK})"
                   f"(?:{_BREAK}|[{SPACE_CLASS}]++)*+")
# A word starts after every character that has no case, so the parts of a text are the runs of characters
# with case and every other character on its own.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_PARTS = f"[{_CASED}]+|[^{_CASED}]"


def clean_text(text: Column) -> Column:
    """Line-break tags and white-space runs become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(text, _BREAK_OR_SPACE, " "))


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(SPACES))


def title_case(text: Column) -> Column:
    """Capital after every character without case: "o'neil santa-fe" -> "O'Neil Santa-Fe"."""
    # Unlike split, this pattern is compiled once and not for every row.
    parts = F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0))
    return F.array_join(F.transform(parts, _capitalised), "")


def _capitalised(part: Column) -> Column:
    """initcap of one part. Signs before the letters stay as they are, and runs of ASCII letters need no word rules."""
    ascii_ = F.octet_length(part) == F.length(part)
    plain = F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substring(part, 2, 2 ** 31 - 1)))
    return F.when(part < "A", part).when(ascii_, plain).otherwise(F.initcap(part))


def replace_word(text: Column, word: str, replacement: str) -> Column:
    # Most texts do not hold the word at all, which takes no pattern to see.
    return F.when(F.contains(text, F.lit(word)), F.regexp_replace(text, rf"(?U)\b{word}\b", replacement)).otherwise(text)


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(text, F.lit(default))


def truncate(text: Column, max_chars: int) -> Column:
    return F.substring(text, 1, max_chars)


def holds(text: Column, fragment: str) -> Column:
    """True where text contains fragment; null text is False."""
    return F.coalesce(F.contains(text, F.lit(fragment)), F.lit(False))
