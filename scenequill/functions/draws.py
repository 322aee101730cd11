"""Draws that are fixed by their key: the same rows always get the same choice, in any engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(c: Column | str) -> Column:
    return (F.lit(c) if isinstance(c, str) else c).cast("string")


def draw(n: int | Column, *key: Column | str) -> Column:
    """A whole number in [0, n), from the first 60 bits of the key's md5."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *[_text(k) for k in key])), 1, 15), 16, 10).cast("long")
    return F.pmod(bits, n if isinstance(n, Column) else F.lit(n).cast("long")).cast("long")


def order_of(*key: Column | str) -> Column:
    """By which to sort for a shuffle that is fixed by the key."""
    return F.md5(F.concat_ws(":", *[_text(k) for k in key]))


def pick(choices: Column | list[str], *key: Column | str) -> Column:
    """One element of an array."""
    array = F.array(*[F.lit(c) for c in choices]) if isinstance(choices, list) else choices
    return F.element_at(array, (draw(F.size(array).cast("long"), *key) + 1).cast("int"))


def sample(choices: Column, k: int, *key: Column | str) -> Column:
    """``k`` different elements of an array, in drawn order."""
    keyed = F.transform(choices, lambda c: F.struct(order_of(*key, c).alias("o"), c.alias("c")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda x: x["c"])


def choices(array: Column, k: int, *key: Column | str) -> Column:
    """``k`` elements of an array, each drawn anew."""
    return F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: pick(array, *key, i))


def sql_draw(n: int, *key: str) -> str:
    """The same as an SQL expression."""
    return f"(CAST('0x' || substr(md5(concat_ws(':', {', '.join(key)})), 1, 15) AS BIGINT) % {n})"


def half_up(c: Column, places: int = 0) -> Column:
    """Rounded by plain arithmetic of doubles, so that every engine gives the same; ties go up."""
    scale = float(10**places)
    return F.floor(c * scale + 0.5) / scale


def sql_half_up(c: str, places: int = 0) -> str:
    return f"(floor(({c}) * {float(10**places)!r}::DOUBLE + 0.5) / {float(10**places)!r}::DOUBLE)"
