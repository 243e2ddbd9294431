"""Text helpers: id lists, flows, percentages, composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_ids(ids: Column, sep: str = ",") -> Column:
    """Split a separated id list the way ``String.split`` does.

    Trailing empty pieces are dropped, leading and inner ones kept:
    ``"1,,2,,"`` -> ``["1", "", "2"]``; ``""`` -> ``[""]`` (no separator
    found, the text itself); separators only (``",,"``) -> ``[]``.
    A null list stays null, so ``explode`` emits nothing for it.
    """
    trimmed = F.regexp_replace(ids, f"(?:{_re(sep)})+$", "")
    return (F.when(ids == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, _re(sep))))


def _re(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)


def java_split(text: str | None, sep: str = ",") -> list[str]:
    """Driver-side twin of :func:`split_ids` for short parameter lists."""
    if text is None:
        return []
    if text == "":
        return [""]
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def target_flows(pages: list[str]) -> list[str]:
    """Consecutive pairs of the target page list as ``a->b``."""
    return [f"{a}->{b}" for a, b in zip(pages[:-1], pages[1:])]


def flow(from_page: Column, to_page: Column) -> Column:
    """``a->b`` from two page ids."""
    return F.concat_ws("->", from_page.cast("string"), to_page.cast("string"))


def ratio(count: Column, total: Column) -> Column:
    """Double division."""
    return count.cast("double") / total.cast("double")


def percent(x: Column, leading_zero: bool = True) -> Column:
    """``0.1234`` -> ``12.34%`` with two decimals, half-even rounding.

    ``leading_zero=False`` is the ``.00%`` pattern (``0.005`` -> ``.50%``),
    ``True`` the ``0.00%`` one (``0.50%``).
    """
    pattern = "0.00%" if leading_zero else ".00%"
    # the SQL function takes a DecimalFormat pattern; the Python wrapper only an int
    return F.call_function("format_number", x, F.lit(pattern))


def join_text(parts: Column, sep: str = ", ") -> Column:
    """C11: array of text joined with ``sep``."""
    return F.array_join(parts, sep)


def id_text(x: Column) -> Column:
    """Numeric id to text."""
    return x.cast("string")


def composite_key(*parts: Column, sep: str = ":") -> Column:
    """Text key such as ``area:city:ads:day``; only built at a keyed sink."""
    return F.concat_ws(sep, *[p.cast("string") for p in parts])
