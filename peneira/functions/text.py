"""Text functions beyond those of ``pyspark.sql.functions``.

``upper``, ``lower``, ``trim``, ``regexp_replace``, ``translate``, ``concat``,
``substring``, ``when`` and the like are used as Spark gives them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letter each one becomes.
ACCENTED = "áàãâéèêíìóòõôúùûç"
PLAIN = "aaaaeeeiioooouuuc"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without_accents(text: Column, cased: Column) -> Column:
    # Text with as many bytes as characters has no accents and is passed on as
    # it is, which is much faster than looking up each of its characters.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, cased).otherwise(F.translate(cased, ACCENTED, PLAIN))


def strip_accents(c: Column | str) -> Column:
    """Replace lower-case accented letters; capitals are left as they are."""
    return _without_accents(_column(c), _column(c))


def standardise(c: Column | str) -> Column:
    """Lower case, no accents, no blanks at the ends.

    Lower case comes first, or capital accented letters would keep their accent.
    """
    text = _column(c)
    return F.trim(_without_accents(text, F.lower(text)))


def split_on(c: Column | str, separator: str) -> Column:
    """Split at a literal separator, keeping empty parts."""
    return F.split(_column(c), re.escape(separator))
