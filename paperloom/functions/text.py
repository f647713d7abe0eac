"""Column helpers for text, attributes and ordered concatenation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five predefined XML entities plus the no-break space.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def collapse_ws(c: Column) -> Column:
    """Every run of whitespace becomes one space."""
    return F.regexp_replace(c, r"\s+", " ")


def tidy(c: Column) -> Column:
    """Collapse whitespace and trim both ends."""
    return F.trim(collapse_ws(c))


def soften_ws(c: Column) -> Column:
    """Whitespace other than tab and newline becomes a space; then one pass of
    double space to single (three spaces leave two)."""
    return F.regexp_replace(F.regexp_replace(c, r"[^\S\n\t]", " "), "  ", " ")


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def number(c: Column, kind: str = "int") -> Column:
    """Text as a number, NULL when it is none. Empty text, the common case of
    what a pattern did not find, is set aside first: a cast that fails costs
    far more than one that succeeds."""
    return F.nullif(c, F.lit("")).try_cast(kind)


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def unescape(c: Column) -> Column:
    """Replace entity references by the characters they stand for, each once:
    what a reference yields is not read again. ``c`` is used once, so it may be
    a costly expression. Only texts with numeric references are taken apart."""

    def piece(x: Column) -> Column:
        dec = F.regexp_extract(x, r"^&#(\d{1,7});", 1)
        hexa = F.regexp_extract(x, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.coalesce(number(dec, "long"), number(F.conv(blank_to_null(hexa), 16, 10), "long"))
        valid = code.between(1, 1114111) & ~code.between(55296, 57343)
        rest = F.regexp_replace(x, r"^&[^;]*;", "")
        out = F.when(valid, F.concat(_code_point(code), rest))
        for name, char in ENTITIES:
            out = out.when(x.startswith(name), F.concat(F.lit(char), rest))
        return F.when(x.startswith("&"), out.otherwise(x)).otherwise(x)

    def whole(x: Column) -> Column:
        named = x
        # No replacement can be part of a reference but "&", which comes last.
        for name, char in ENTITIES:
            named = F.replace(named, F.lit(name), F.lit(char))
        return F.when(x.contains("&#"), F.array_join(F.transform(F.split(x, "(?=&)"), piece), "")).otherwise(named)

    return F.get(F.transform(F.array(c), whole), F.lit(0))


def escape(c: Column) -> Column:
    """Escape the characters that may not stand in element text."""
    out = c
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def attr(token: Column, name: str) -> Column:
    """Value of an attribute of a tag token, NULL when absent or empty."""
    value = F.regexp_extract(token, rf"\s{name}\s*=\s*([\"'])([\s\S]*?)\1", 2)
    value = F.nullif(value, F.lit(""))
    return F.when(token.contains("&"), unescape(value)).otherwise(value)


def ordered_list(order: Column, value: Column) -> Column:
    """Aggregate: non-NULL values as an array in the given order."""
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("k"), value.alias("v")))))
    return pairs["v"]


def ordered_items(order: Column, value: Column) -> Column:
    """Aggregate: like ``ordered_list`` for values that cannot be compared,
    such as structs with maps; only the order decides."""
    pairs = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("k"), value.alias("v"))))
    by_key = lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)
    return F.transform(F.array_sort(pairs, by_key), lambda x: x["v"])


def ordered_concat(order: Column, value: Column, sep: str = "") -> Column:
    """Aggregate: string values joined in the given order."""
    return F.array_join(ordered_list(order, value), sep)


def first_by(value: Column, order: Column, when: Column | None = None) -> Column:
    """Aggregate: value of the row that comes first, among those that qualify."""
    key = order if when is None else F.when(when, order)
    return F.min_by(value, key)


def last_by(value: Column, order: Column, when: Column | None = None) -> Column:
    key = order if when is None else F.when(when, order)
    return F.max_by(value, key)
