"""Cleaning of scraped text."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portal names by the key found in a feed's file name.
ORIGINS = {
    "chaves": "Chaves na Mão",
    "vivareal": "Viva Real",
    "zap": "ZAP Imóveis",
}
UNKNOWN_ORIGIN = "Origem Desconhecida"

# White space as scraped pages have it, the no-break space included.
BLANKS = " \t\n\r\x0b\x0c\u00a0"

# The standard's named characters, for those written with a semicolon and those without, and a
# pattern of the longest of the latter that a text begins with.
ENTITIES = json.dumps(html5)
_BARE = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True))


def _drop(text: Column, *parts: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def price_digits(text: Column) -> Column:
    """Remove the currency mark and the thousands points; blanks stay."""
    return _drop(text, "R$", ".")


def clean_price(text: Column) -> Column:
    """Price text as the feeds carry it; empty becomes NULL."""
    return strip_blanks(price_digits(F.nullif(text, F.lit(""))))


def before_comma(text: Column) -> Column:
    """Text before the first comma; empty stays empty."""
    return F.substring_index(text, ",", 1)


def clean_location(text: Column, trim: bool = False) -> Column:
    """Neighbourhood out of 'neighbourhood, city'; empty becomes NULL unless trimmed."""
    if trim:
        return before_comma(strip_blanks(text))
    return before_comma(F.nullif(text, F.lit("")))


def first_token(text: Column) -> Column:
    """Text before the first blank ('70 m²' to '70')."""
    return F.substring_index(text, " ", 1)


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` mentions it."""
    # The end of a fold over nothing: unlike an array's entry, what `use` gives is not copied.
    return F.aggregate(F.array(), value, lambda kept, _: kept, use)


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Text with its character references, named and numeric, replaced by the characters.

    A name without a semicolon counts as far as it is one of the standard's, so `&copyright` is
    ©right; in an attribute only if neither a letter, a digit nor an equals sign follows.
    """
    names = F.from_json(F.lit(ENTITIES), "map<string,string>")
    bare = rf"^(?:{_BARE}){'(?![A-Za-z0-9=])' if attribute else ''}"

    def numeric(reference: Column) -> Column:
        # Without its leading zeros a code has 7 decimal or 6 hexadecimal digits at most.
        hexadecimal = F.regexp_extract(reference, "^#[xX]0*([0-9A-Fa-f]{0,6});?$", 1)
        decimal = F.regexp_extract(reference, "^#0*([0-9]{0,7});?$", 1)
        code = F.when(decimal != "", decimal).otherwise(F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10)).cast("int")
        sound = lambda n: (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        character = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return bind(code, lambda n: F.when(sound(n), character(n)).otherwise("\ufffd"))

    def decoded(piece: Column) -> Column:
        number = F.regexp_extract(piece, "^#(?:[0-9]++|[xX][0-9A-Fa-f]++);?", 0)
        whole = F.regexp_extract(piece, "^[A-Za-z][A-Za-z0-9]*+;", 0)
        name = F.when(F.try_element_at(names, whole).isNotNull(), whole).otherwise(F.regexp_extract(piece, bare, 0))

        def replaced(reference: Column) -> Column:
            found = F.when(reference.startswith("#"), numeric(reference)).when(reference != "", F.try_element_at(names, reference))
            rest = F.substring(piece, F.length(reference) + 1, F.length(piece))
            return F.coalesce(F.concat(found, rest), F.concat(F.lit("&"), piece))

        return bind(F.when(piece.startswith("#"), number).otherwise(name), replaced)

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, 2, F.size(pieces)), decoded)
        return F.concat(F.get(pieces, 0), F.array_join(tail, ""))

    return F.when(text.contains("&"), bind(F.split(text, "&"), joined)).otherwise(text)


def origin_of(
    file_name: Column,
    mapping: Mapping[str, str] = ORIGINS,
    default: str = UNKNOWN_ORIGIN,
) -> Column:
    """Portal by file name: the first key contained in the lower-cased name wins."""
    lowered = F.lower(file_name)
    found = [F.when(lowered.contains(key), F.lit(name)) for key, name in mapping.items()]
    return F.coalesce(*found, F.lit(default))
