"""Column expressions on text, dates and nested values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters with marks and their plain forms (fixed values).
MARKED, PLAIN = "áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc"


def normal_name(name: Column) -> Column:
    """Lower case, marks dropped, anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.translate(F.lower(name), MARKED, PLAIN), "[^a-z0-9]+", " "))


def escape_html(text: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def local_number(value: Column, digits: int = 1, signed: bool = False) -> Column:
    """Decimal comma, dots between thousands, a dash for nothing; the sign written out if asked for."""
    shown = F.translate(F.format_number(value, digits), ",.", ".,")
    if signed:
        shown = F.concat(F.when(value > 0, "+").otherwise(""), shown)
    return F.coalesce(shown, F.lit("—"))


def first_sentence(text: Column) -> Column:
    return F.regexp_extract(text, r"^[^.!?]*[.!?]?", 0)


def settings(text: Column) -> Column:
    """map of KEY = value lines."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.contains("="))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), F.trim(F.split_part(x, F.lit("="), F.lit(2))).alias("v")))
    return F.map_from_entries(pairs)


def local_time(ts: Column, hours: int = -5) -> Column:
    return ts + F.expr(f"INTERVAL {hours} HOURS")


def minutes_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts) + F.second(ts) / 60.0


def month_before(day: Column, months: int = 1) -> Column:
    return F.add_months(F.trunc(day, "month"), -months)


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def day_365(day: Column) -> Column:
    """Day of the year from 1 to 365: the 29th of February counts as the 28th, later days move up."""
    leap = F.dayofmonth(F.last_day(F.make_date(F.year(day), F.lit(2), F.lit(1)))) == 29
    return F.dayofyear(day) - F.when(leap & (F.dayofyear(day) > 59), 1).otherwise(0)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs as columns a_b; arrays and maps stay whole; of equal names the first stays."""
    found: dict[str, Column] = {}

    def walk(schema: T.StructType, path: tuple[str, ...]) -> None:
        for f in schema.fields:
            at = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, at)
            else:
                found.setdefault(sep.join(at), F.col(".".join(f"`{p}`" for p in at)))

    walk(df.schema, ())
    return df.select(*[c.alias(n) for n, c in found.items()])


def round_all(values: Column, digits: int) -> Column:
    """Rounds an array's numbers; NaN becomes null."""
    return F.transform(values, lambda v: F.when(~F.isnan(v), F.round(v, digits)))


#: Month names by which dates in texts are found, and what they are shortened to (fixed values).
MONTHS = {
    "enero": "ene", "febrero": "feb", "marzo": "mar", "abril": "abr", "mayo": "may", "junio": "jun",
    "julio": "jul", "agosto": "ago", "septiembre": "sep", "octubre": "oct", "noviembre": "nov", "diciembre": "dic",
}


def short_date(text: Column) -> Column:
    """day-mon-year of the first date written out (5 de marzo de 2024); null without one."""
    low = F.lower(text)
    part = lambda k: F.regexp_extract(low, r"(\d{1,2}) de ([a-z]+) de (\d{4})", k)
    table = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.try_element_at(table, part(2))
    return F.when(month.isNotNull(), F.concat_ws("-", part(1), month, part(3)))


def by_unit(value: Column, unit: Column) -> Column:
    """A figure's text as its unit asks for: no decimals for people and hectares, two for degrees, one for percent."""
    digits = F.when(unit.rlike("(?i)^(hab|people|ha)"), 0).when(unit.rlike("°|deg"), 2).otherwise(1)
    shown = F.when(digits == 0, F.format_number(value, 0)).when(digits == 2, F.format_number(value, 2)).otherwise(F.format_number(value, 1))
    return F.concat_ws(" ", shown, unit)


def first_key(values: Column, names: Sequence[str]) -> Column:
    """The first key of a map that has a value."""
    return F.coalesce(*[F.try_element_at(values, F.lit(n)) for n in names])


def access_class(tags: Column, excluded: Sequence[str], restricted: Sequence[str], inside: Column) -> Column:
    """none for excluded kinds; private by tag, or where half of it or more lies inside an institution; restricted kinds;
    public by tag, and where nothing is said."""
    kind, access = F.try_element_at(tags, F.lit("kind")), F.try_element_at(tags, F.lit("access"))
    return (
        F.when(kind.isin(*excluded), "none")
        .when(access.isin("private", "no") | (inside >= 0.5), "private")
        .when(kind.isin(*restricted), "restricted")
        .when(access.isNotNull(), "public")
        .otherwise("undeclared")
    )


def without_empty(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drops columns that have no value in any row; one aggregate tells which."""
    rest = [c for c in df.columns if c not in keys]
    seen = df.agg(*[F.count(c).alias(c) for c in rest]).first()
    return df.select(*keys, *[c for c in rest if seen[c]])
