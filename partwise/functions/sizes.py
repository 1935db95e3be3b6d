"""Sizes as text ("5M", "1.5 Gi") to bytes and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit names of each symbol set in ascending order, each 1024 times the last.
SYMBOL_SETS = {
    "customary": ["", "K", "M", "G", "T", "P", "E", "Z", "Y"],
    "customary_ext": ["byte", "kilo", "mega", "giga", "tera", "peta", "exa", "zetta", "iotta"],
    "iec": ["Bi", "Ki", "Mi", "Gi", "Ti", "Pi", "Ei", "Zi", "Yi"],
    "iec_ext": ["byte", "kibi", "mebi", "gibi", "tebi", "pebi", "exbi", "zebi", "yobi"],
}
ALIASES = {"k": "K"}

_LONG_LIMIT = 2.0**63


def unit_factors() -> dict[str, float]:
    factors = {
        name: 1024.0**power
        for names in SYMBOL_SETS.values()
        for power, name in enumerate(names)
    }
    factors.update({alias: factors[name] for alias, name in ALIASES.items()})
    return factors


def size_text_to_bytes(text: Column) -> Column:
    """Bytes as BIGINT, fractions cut off; NULL where the text is no size or passes 2^63 - 1."""
    number = F.regexp_extract(text, r"^([0-9.]*)", 1).try_cast("double")
    unit = F.regexp_replace(F.regexp_replace(text, r"^[0-9.]*\s*", ""), r"\s+$", "")
    table = F.create_map(*[F.lit(x) for pair in unit_factors().items() for x in pair])
    value = number * F.try_element_at(table, unit)
    return F.when(value < F.lit(_LONG_LIMIT), F.floor(value).cast("bigint"))


def bytes_to_text(
    size: Column, decimals: int = 1, symbols: str = "customary", suffix: str = ""
) -> Column:
    """Size in the largest unit that is not above it; NULL for a negative size."""
    names = SYMBOL_SETS[symbols]

    def label(value: Column, name: str) -> Column:
        # bround first: Java's formatter rounds halves up, the expected text has them to even.
        return F.format_string(f"%.{decimals}f {name}{suffix}", F.bround(value, decimals))

    text = F.when(size < 0, F.lit(None).cast("string"))
    for power in range(6, 0, -1):  # a BIGINT ends below 8 * 1024^6
        text = text.when(size >= 1024**power, label(size.cast("double") / 1024.0**power, names[power]))
    return text.otherwise(label(size.cast("double"), names[0]))
