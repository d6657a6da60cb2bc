"""Cleaning and typing of dirty text cells as Column expressions.

Nothing here can fail a row: every parser yields a struct with the value and an error text, and only
``try_*`` casts are used. All of it stays JVM-side. ``type_columns`` stages the work in three projections
(trim, recognise, convert): an intermediate that is read several times is then computed once, because
Catalyst does not inline a non-trivial expression into a projection that uses it more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters stripped from both ends, and the words that mean "no value".
BLANKS = " \t\n\r\x0b\x0c\xa0"
MISSING_WORDS = ("", "nan", "none", "null", "nat")

_PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_SPACE_GROUPS = r"^[+-]?\d{1,3}( \d{3})+([.,]\d+)?$"
_DOT_GROUPS_COMMA_DECIMAL = r"^[+-]?\d{1,3}(\.\d{3})+,\d+$"
_COMMA_GROUPS = r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)$|^[+-]?\d{1,3}(,\d{3}){2,}$"
_DOT_GROUPS = r"^[+-]?\d{1,3}(\.\d{3}){2,}$"
_LONE_COMMA_GROUP = r"^[+-]?\d{1,3},\d{3}$"
_COMMA_DECIMAL = r"^[+-]?(\d+,\d*|,\d+)([eE][+-]?\d+)?$"
_WHOLE_NUMBER = r"^[+-]?\d*(\.0*)?$"
_TIME = r"([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
_ISO = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}(T" + _TIME + r"(\.\d{1,6})?| " + _TIME + r")?$"
_SLASH = r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$"

DAY_FIRST = "%d/%m/%Y"
MONTH_FIRST = "%m/%d/%Y"


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(BLANKS))


def is_missing(c: Column) -> Column:
    """True for NULL and for the words that stand for it."""
    return c.isNull() | F.lower(strip(c)).isin(*MISSING_WORDS)


def is_missing_cell(c: Column) -> Column:
    """The same for cells that may be long: these are not put into lower case to find out."""
    return c.isNull() | ((F.length(strip(c)) <= max(map(len, MISSING_WORDS))) & is_missing(c))


def clean_text(c: Column) -> Column:
    return F.when(~is_missing(c), strip(c))


def lower_text(c: Column) -> Column:
    return F.lower(clean_text(c))


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def number_text(c: Column) -> Column:
    """Trimmed cell without a currency affix."""
    t = F.replace(strip(c), F.lit("\xa0"), F.lit(" "))
    has_affix = t.contains("EUR") | t.contains("€")
    return F.when(has_affix, strip(F.regexp_replace(t, r"^(EUR|€)\s*|\s*(EUR|€)$", ""))).otherwise(t)


def recognise_number(t: Column) -> Column:
    """``struct<text, error>`` of a trimmed cell: canonical decimal text, or why it is not one number.

    Group marks count only in full groups of three; a lone ``1,234`` could mean two numbers and is
    rejected. Clean numbers leave at the first test.
    """
    comma_to_dot = F.translate(t, ", ", ".")
    text = (
        F.when(t.rlike(_PLAIN_NUMBER), t)
        .when(t.rlike(_SPACE_GROUPS), comma_to_dot)
        .when(t.rlike(_DOT_GROUPS_COMMA_DECIMAL), F.translate(t, ",.", "."))
        .when(t.rlike(_COMMA_GROUPS), F.translate(t, ",", ""))
        .when(t.rlike(_DOT_GROUPS), F.translate(t, ".", ""))
        .when(t.rlike(_COMMA_DECIMAL) & ~t.rlike(_LONE_COMMA_GROUP), comma_to_dot)
    )
    error = (
        F.when(is_missing(t) | t.rlike(_PLAIN_NUMBER), F.lit(None).cast("string"))
        .when(t.rlike("^[^,]*[.][^,]*[.]|,.*,|[.].*,|,.*[.]| ") & text.isNull(),
              F.lit("digits are not grouped by thousands"))
        .when(t.rlike(_LONE_COMMA_GROUP), F.lit("separator may be decimal or grouping"))
        .when(text.isNull(), F.lit("no number of finite size"))
    )
    return F.struct(F.when(~is_missing(t), text).alias("text"), error.alias("error"))


def float_value(n: Column) -> Column:
    """``struct<value double, error>``; infinities are errors."""
    raw = n["text"].try_cast("double")
    finite = F.coalesce(F.abs(raw) < F.lit(float("inf")), F.lit(False))
    return F.struct(
        F.when(finite, raw).alias("value"),
        F.coalesce(n["error"], F.when(n["text"].isNotNull() & ~finite,
                                      F.lit("number too large"))).alias("error"),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it reads several times. A lambda binds it once and is not inlined into the generated
    code, which suits rare cases."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scientific_digits(text: Column) -> Column:
    """Digits of a whole number in exponent notation, decided on what is written, so that nothing is rounded: NULL if
    it is not whole, and "" if it has more digits than a long."""
    part = lambda i: F.regexp_extract(text, r"^([+-]?)(\d*)\.?(\d*)[eE]([+-]?\d+)$", i)
    parts = F.struct(part(1).alias("sign"), F.concat(part(2), part(3)).alias("digits"),
                     (part(4).try_cast("int") - F.length(part(3))).alias("power"))

    def digits(p: Column) -> Column:
        kept = F.regexp_replace(p["digits"], "0+$", "")
        power = p["power"] + F.length(p["digits"]) - F.length(kept)
        return F.when(kept == "", F.lit("0")).when(power.between(0, 19), F.concat(p["sign"], kept, F.repeat(F.lit("0"), power))).when(
            power > 19, F.lit(""))

    return let(parts, digits)


def int_value(n: Column) -> Column:
    """``struct<value bigint, error>`` without a detour through double."""
    text = n["text"]
    plain = F.when(text.rlike("[eE]"), scientific_digits(text)).when(text.rlike(_WHOLE_NUMBER), F.regexp_replace(text, r"\.0*$", ""))
    value = plain.try_cast("bigint")
    error = F.when(text.isNotNull() & value.isNull(), F.when(
        text.rlike(_WHOLE_NUMBER) | text.rlike("[eE]") & scientific_digits(text).isNotNull(),
        F.lit("whole number beyond 64 bits")).otherwise(F.lit("no whole number")))
    return F.struct(value.alias("value"), F.coalesce(n["error"], error).alias("error"))


def recognise_date(t: Column) -> Column:
    """Calendar readings of a trimmed cell. A slash date keeps day-first and month-first."""
    slash = t.rlike(_SLASH)
    first, second, year = F.substring_index(t, "/", 1), F.substring_index(F.substring_index(t, "/", 2), "/", -1), F.substring_index(t, "/", -1)
    iso = F.substring_index(F.substring_index(t, "T", 1), " ", 1).try_cast("date")
    return F.struct(
        F.when(~slash & t.rlike(_ISO), iso).alias("iso"),
        F.when(slash, _date(year, second, first)).alias("day_first"),
        F.when(slash, _date(year, first, second)).alias("month_first"),
        F.when(~is_missing(t), F.when(slash, F.lit("no such day in slash notation"))
               .otherwise(F.lit("date in no known notation"))).alias("error"),
    )


def date_value(d: Column) -> Column:
    """``struct<value, fmt, readings, error>``: ``value`` prefers day-first; ``readings`` holds two
    dates only when both exist and differ."""
    value = F.coalesce(d["iso"], d["day_first"], d["month_first"])
    return F.struct(
        value.alias("value"),
        F.when(d["iso"].isNotNull(), F.lit("iso"))
        .when(d["day_first"].isNotNull(), F.lit(DAY_FIRST))
        .when(d["month_first"].isNotNull(), F.lit(MONTH_FIRST)).alias("fmt"),
        F.when(value.isNotNull(), F.array_distinct(F.array_compact(
            F.array(d["iso"], d["day_first"], d["month_first"])))).alias("readings"),
        F.when(value.isNull(), d["error"]).alias("error"),
    )


def typed_date(c: Column, kind: str) -> Column:
    """The same struct for a column that already is a date or timestamp."""
    value = F.to_date(c)
    return F.struct(
        value.alias("value"),
        F.when(value.isNotNull(), F.lit(kind)).alias("fmt"),
        F.when(value.isNotNull(), F.array(value)).alias("readings"),
        F.lit(None).cast("string").alias("error"),
    )


def identifier_value(t: Column) -> Column:
    """``struct<value bigint, text>``: integer reading if there is one, and the trimmed text. Whole numbers in exponent
    notation, as doubles of ten million and more are printed, count as what they stand for."""
    exponent = F.when(t.rlike(r"^[+-]?\d+(\.\d*)?[eE][+-]?\d+$"), F.nullif(scientific_digits(t), F.lit("")))
    text = F.coalesce(exponent, F.regexp_replace(t, r"\.0$", ""))
    return F.struct(
        F.when(~is_missing(t) & text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")).alias("value"),
        F.when(~is_missing(t), text).otherwise(F.lit("")).alias("text"),
    )


def enum_value(t: Column, known: tuple[str, ...]) -> Column:
    """Lower-case member of a closed vocabulary, or ``unknown``."""
    return F.when(F.lower(t).isin(*known), F.lower(t)).otherwise(F.lit("unknown"))


_RECOGNISE = {"float": recognise_number, "int": recognise_number, "date": recognise_date}
_CONVERT = {"float": float_value, "int": int_value, "date": date_value, "id": identifier_value}


def type_columns(df: DataFrame, spec: dict[str, tuple[str, Column]], keep: list[str]) -> DataFrame:
    """Type many cells at once. ``spec`` maps an output name to ``(kind, source column)`` with kind one of
    float, int, date, id, text (trimmed text, NULL when missing). Struct outputs as described above."""
    kept = [F.col(f"`{k}`") for k in keep]
    trimmed = df.select(*kept, *[
        (number_text(c) if kind in ("float", "int") else strip(c)).alias(f"_t_{name}")
        for name, (kind, c) in spec.items()
    ])
    seen = trimmed.select(*kept, *[
        (_RECOGNISE[kind](F.col(f"_t_{name}")) if kind in _RECOGNISE else F.col(f"_t_{name}"))
        .alias(f"_n_{name}")
        for name, (kind, _) in spec.items()
    ])
    return seen.select(*kept, *[
        (_CONVERT[kind](F.col(f"_n_{name}")) if kind in _CONVERT
         else F.when(~is_missing(F.col(f"_n_{name}")), F.col(f"_n_{name}"))).alias(name)
        for name, (kind, _) in spec.items()
    ])
