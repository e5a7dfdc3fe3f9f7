"""Character n-grams inside word boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import words


def char_ngrams(text: Column, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """All n-grams of each token, padded with one space on both sides; repeats stay.

    A padded token shorter than n gives itself, as one n-gram.
    """

    def sized(padded: Column, length: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substring(padded, i, F.lit(n)))

    def of(token: Column) -> Column:
        padded, length = F.concat(F.lit(" "), token, F.lit(" ")), F.length(token) + 2
        return F.concat(*(sized(padded, length, n) for n in sizes))

    return F.flatten(F.transform(words(text), of))
