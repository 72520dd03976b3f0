"""Word count."""

from __future__ import annotations

from pyspark.sql import DataFrame

from streamlytics.functions.text import tokenize
from streamlytics.operators.aggregate import word_count


def count_words(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Batch word count. Empty words inside a line count; those at its end do not."""
    return word_count(tokenize(lines, sep))


def count_words_stream(lines: DataFrame, sep: str = ",", normalise: bool = True) -> DataFrame:
    """Stream word count (write in ``update`` mode). Empty words are filtered."""
    return word_count(tokenize(lines, sep, normalise=normalise, drop_empty=True))
