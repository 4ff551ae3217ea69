"""Identifiers, postcodes and name keys."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_folding() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by Unicode decomposition."""
    accented, base = [], []
    for point in range(0xC0, 0x250):
        parts = unicodedata.normalize("NFKD", chr(point))
        letters = [p for p in parts if not unicodedata.combining(p)]
        if len(parts) > 1 and len(letters) == 1:
            accented.append(chr(point))
            base.append(letters[0])
    return "".join(accented), "".join(base)


_ACCENTED, _BASE = _latin_folding()
_COMBINING = "[\\u0300-\\u036f]"


def accent_key(c: Column) -> Column:
    """Comparison key: no accents, lower case, no outer blanks."""
    folded = F.translate(F.lower(F.trim(c)), _ACCENTED, _BASE)
    return F.regexp_replace(folded, _COMBINING, "")


# Neighbourhood names that differ between the census table and the map.
NEIGHBOURHOOD_ALIASES = {
    "Coronel Aparício Borges": "Aparício Borges",
    "Mont'Serrat": "Montserrat",
    "Passo da Areia": "Passo D'Areia",
}


def alias_name(c: Column, aliases: dict[str, str] = NEIGHBOURHOOD_ALIASES) -> Column:
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.trim(c)], F.trim(c))


def postcode_prefix(c: Column) -> Column:
    """First five digits, or '' when there are fewer (missing text included)."""
    digits = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5)).otherwise("")


def truncate_code(c: Column) -> Column:
    """Seven-digit municipality code without its check digit."""
    return F.substring(c.cast("string"), 1, 6)


def composite_key(facility: Column, yyyymm: Column) -> Column:
    period = yyyymm.cast("string")
    return F.concat(
        facility.cast("string"),
        F.lit("|"),
        F.substring(period, 1, 4),
        F.lit("-"),
        F.substring(period, 5, 2),
    )


def pseudonym(c: Column, salt: str | None = None) -> Column:
    """SHA-256 hex of an identifier. A 13-digit number can be enumerated, so a
    secret salt should be given wherever the output leaves the trusted zone."""
    text = c.cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer values stay whole."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def id_or_fallback(c: Column, fallback: Column) -> Column:
    return F.when(c.rlike("^0+$"), fallback).otherwise(c)


def null_coordinates(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(0, 0) and half-missing pairs both mean unknown."""
    known = lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))
    return F.when(known, lat), F.when(known, lon)
