"""Words of URLs and HTML bodies, as JVM-side column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a word, a script region and a tag.
WORD = r"([A-Za-z0-9]+)"
SCRIPT_REGION = r"<script(?:\s[^<>]*)?>(?:.*?</script(?:\s[^<>]*)?>|.*$)"
TAG_PART = r"<[^<>]*>?"

# One pass over the page: script regions and tags match without filling the group, words fill it.
# A tag part stops before the next '<', so a stray '<' cannot hide the start of a script region.
# Java's (?i) folds ASCII only, so the Kelvin sign is no letter here.
_MARKUP_OR_WORD = rf"(?is){SCRIPT_REGION}|{TAG_PART}|{WORD}"


def words(text: Column | str) -> Column:
    """Lower-case ASCII words of plain text, in order.

    Lower-casing follows extraction: some non-ASCII letters have an ASCII lower case.
    """
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(1)), F.lower)


def html_words(html: Column | str) -> Column:
    """Lower-case ASCII words outside tags and scripts, in order."""
    found = F.regexp_extract_all(html, F.lit(_MARKUP_OR_WORD), F.lit(1))
    return F.array_remove(F.transform(found, F.lower), "")


def until_nul(text: Column | str) -> Column:
    """The text up to its first NUL character."""
    return F.substring_index(text, "\0", 1)
