"""Publication identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The canonical form and the accepted resolver prefix. The dot in
# the prefix is a pattern dot on purpose, so any character may stand there.
DOI_PREFIX = "https://doi.org/"
DOI_RESOLVER = r"(?i)^https?://doi.org/"
DOI_START = "10."

# The characters that count as white space at the ends of a text.
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(text: Column) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.btrim(text, F.lit(SPACE))


def format_doi(raw: Column) -> Column:
    """Canonical lower-case DOI address, or NULL when ``raw`` holds no DOI."""
    name = F.regexp_replace(strip_space(raw.cast("string")), DOI_RESOLVER, "")
    return F.when(
        name.startswith(DOI_START) & name.contains("/"),
        F.concat(F.lit(DOI_PREFIX), F.lower(name)),
    )
