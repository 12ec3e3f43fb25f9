"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which the next letter starts a word.
WORD_DELIMITERS = " \t\n\r[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"


def initcap_delimited(c: Column, delimiters: str = WORD_DELIMITERS) -> Column:
    """INITCAP that also starts a word after punctuation (``mary-jane`` -> ``Mary-Jane``)."""
    after_delimiter = "(?<=[" + "".join(re.escape(d) for d in delimiters) + "])"
    return F.array_join(F.transform(F.split(c, after_delimiter), F.initcap), "")
