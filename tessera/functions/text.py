"""Normalisation of names and addresses as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that are replaced as whole tokens, and words that addresses drop afterwards.
NAME_WORDS = {
    "assoc": "associates", "bros": "brothers", "co": "company", "corp": "corporation", "enterpr": "enterprises", "enterprise": "enterprises",
    "entpr": "enterprises", "grp": "group", "inc": "incorporated", "indus": "industry", "industries": "industry", "intl": "international",
    "llc": "limited liability company", "llp": "limited liability partnership", "ltd": "limited", "mfg": "manufacturing", "mgmt": "management",
    "mgr": "manager", "national": "national", "pvt": "private", "sa": "societe anonyme", "sarl": "societe a responsabilite limitee",
    "sas": "societe par actions simplifiee", "sci": "societe civile immobiliere", "serv": "services", "sol": "solutions", "soln": "solutions",
    "svc": "service", "svcs": "services", "tech": "technology", "technologies": "technology",
}
ADDRESS_WORDS = {
    "appt": "apartment", "apt": "apartment", "av": "avenue", "ave": "avenue", "blvd": "boulevard", "cir": "circle", "ct": "court", "dr": "drive",
    "e": "east", "expy": "expressway", "fl": "floor", "flr": "floor", "fwy": "freeway", "hwy": "highway", "ln": "lane", "n": "north",
    "ne": "northeast", "no": "number", "nw": "northwest", "ph": "penthouse", "pkwy": "parkway", "pky": "parkway", "pl": "place", "rd": "road",
    "s": "south", "se": "southeast", "sq": "square", "st": "street", "ste": "suite", "str": "street", "sw": "southwest", "ter": "terrace",
    "terr": "terrace", "trce": "trace", "w": "west", "xing": "crossing",
}
ADDRESS_DROPPED = (
    "above", "and", "at", "behind", "below", "beside", "bldg", "block", "building", "by", "colony", "complex", "flat", "floor", "house", "in",
    "near", "next", "of", "on", "opp", "opposite", "plot", "room", "sector", "shop", "the", "to", "unit",
)
# ASCII white space as Python's text methods have it.
SPACE = r"[\s\x0b\x1c-\x1f]+"
_BREAKS = {i: " " for i in range(128) if not (chr(i).isalnum() or chr(i).isspace() or chr(i) == "_")}


def ascii_form(text: str | None) -> str | None:
    return text if text is None or text.isascii() else unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def normal_form(text: str, table: dict[str, str], dropped: frozenset[str] = frozenset()) -> str:
    """Tokens of the folded text, replaced and dropped: lower case, all but letters, digits, ``_`` and white space are breaks."""
    # Every replacement of a table with dropped words is one word, so dropping needs no second split.
    found = (table.get(t, t) for t in ascii_form(text).lower().translate(_BREAKS).split())
    return " ".join(t for t in found if t not in dropped)


def _normalized(text: Column | str, table: dict[str, str], dropped: frozenset[str] = frozenset()) -> Column:
    # Folding has no operator in Spark, so a text goes to Python; it is normalised there, once in a batch.
    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        texts = texts.fillna("")
        return texts.map({t: normal_form(t, table, dropped) for t in texts.unique()})

    return run(F.col(text) if isinstance(text, str) else text)


def normalize_name(text: Column | str) -> Column:
    """Normalised name, of compatibility decomposition in ASCII (``é`` is ``e``); null and empty give an empty text."""
    return _normalized(text, NAME_WORDS)


def normalize_address(text: Column | str) -> Column:
    """Normalised address, folded like a name; null and empty give an empty text."""
    return _normalized(text, ADDRESS_WORDS, frozenset(ADDRESS_DROPPED))


def words(text: Column) -> Column:
    """White-space tokens, without empty ones."""
    return F.filter(F.split(text, SPACE), lambda t: t != "")


def long_tokens(normalized: Column) -> Column:
    """Tokens of more than one character."""
    return F.filter(words(normalized), lambda t: F.length(t) > 1)


def token_set(text: Column) -> Column:
    return F.array_distinct(words(text))


def number_set(text: Column) -> Column:
    """Distinct tokens of digits only, at word boundaries (``5b`` is none)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b\d+\b"), F.lit(0)))


def country_key(country: Column) -> Column:
    """Key of retrieval: lower case, not trimmed; a missing country is a group of its own."""
    return F.lower(F.coalesce(country, F.lit("")))


def combined_text(name: Column, address: Column) -> Column:
    return F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(address, F.lit("")))


def with_normalized(records: DataFrame, again: bool = False) -> DataFrame:
    """Adds ``norm_name`` and ``norm_address`` where they are not there yet (or ``again``)."""
    wanted = {"norm_name": ("business_name", normalize_name), "norm_address": ("business_address", normalize_address)}
    return records.withColumns({new: make(F.col(old)) for new, (old, make) in wanted.items() if again or new not in records.columns})
