"""Column functions: values in, one value out, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Party sub-type ids.
SUB_TYPES = {"1": "Vessel", "2": "Aircraft", "3": "Entity", "4": "Individual"}
IN_SCOPE = ("Individual", "Entity")
UNKNOWN = "Unknown"


def not_blank(value: Column) -> Column:
    """The value, or null where it is empty or white space only; not trimmed otherwise."""
    return F.when(F.trim(value) != "", value)


def classify(sub_type: Column) -> Column:
    """Vessel, Aircraft, Entity, Individual, or Unrecognized for null, blank and other ids; exact match."""
    out = F.lit("Unrecognized")
    for code, name in SUB_TYPES.items():
        out = F.when(sub_type == code, name).otherwise(out)
    return out


def shown(value: Column) -> Column:
    """How a diagnostic shows a value: <missing>, <empty> or the value in quotes."""
    return F.when(value.isNull(), "<missing>").when(F.trim(value) == "", "<empty>").otherwise(F.concat(F.lit("'"), value, F.lit("'")))


def assemble_name(parts: Column) -> Column:
    """Name parts, trimmed, without blank ones, joined by a space."""
    return F.array_join(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), " ")


def first_of(values: Column) -> Column:
    """The first element that is not null."""
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(1))


def last_of(values: Column) -> Column:
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(-1))


def whole_number(text: Column) -> Column:
    """A trimmed whole number, else null."""
    return F.trim(text).try_cast("int")


def date_parts(year: Column, month: Column, day: Column) -> Column:
    return F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"), day.cast("int").alias("day"))


def partial_date(start: Column, end: Column) -> Column:
    """One date value of two ends (structs year, month, day), as struct(year, month, day, period).

    An end without a year counts as missing. Equal ends give that date, different ones a period, one alone
    itself, none null.
    """
    known = lambda d: F.when(d.year.isNotNull(), d)
    a, b = known(start), known(end)
    single = F.coalesce(a, b)
    period = F.struct(a.alias("from"), b.alias("to"))
    none = F.lit(None).cast("int")
    kind = "struct<from:struct<year:int,month:int,day:int>,to:struct<year:int,month:int,day:int>>"
    one = F.struct(single.year.alias("year"), single.month.alias("month"), single.day.alias("day"), F.lit(None).cast(kind).alias("period"))
    two = F.struct(none.alias("year"), none.alias("month"), none.alias("day"), period.cast(kind).alias("period"))
    return F.when(a.isNotNull() & b.isNotNull() & ~a.eqNullSafe(b), two).when(single.isNotNull(), one)


def clamped_date(year: Column, month: Column, day: Column, strict: bool = False) -> Column:
    """A date of parts: month into 1..12, day into 1..28, both 1 if missing; strict keeps real days and gives null for impossible ones."""
    if strict:
        written = F.format_string("%04d-%02d-%02d", year, F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
        return F.when(year.isNotNull(), F.try_to_date(written, "yyyy-MM-dd"))
    clamp = lambda c, top: F.coalesce(F.least(F.greatest(c, F.lit(1)), F.lit(top)), F.lit(1))
    return F.when(year.isNotNull(), F.make_date(year, clamp(month, 12), clamp(day, 28)))


def http_date(text: Column) -> Column:
    """The instant of an RFC 1123 date, as `Sun, 06 Nov 1994 08:49:37 GMT`; null for others."""
    return F.try_to_timestamp(F.regexp_extract(text, r"^[A-Za-z]{3}, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} GMT)$", 1), F.lit("dd MMM yyyy HH:mm:ss z"))


def publish_date(year: Column, month: Column, day: Column, last_modified: Column, today: Column) -> Column:
    """The date of issue if its year is known, else the day of Last-Modified, else today; all in UTC."""
    return F.coalesce(clamped_date(year, month, day), F.to_date(http_date(last_modified)), today.cast("date"))


def record_count(text: Column) -> Column:
    """A trimmed whole number of at least 0, else null."""
    n = F.trim(text).try_cast("int")
    return F.when(n >= 0, n)


def normalise_digest(text: Column) -> Column:
    """A SHA-256 digest in lower-case hex, from hex or base64 with or without a sha-256 prefix; null for anything else."""
    bare = F.regexp_replace(F.trim(text), r"(?i)^sha-?256[\s:=]*", "")
    bare = F.regexp_replace(bare, r"^[\s:\"]+|[\s:\"]+$", "")
    base64 = F.when(bare.rlike(r"^[A-Za-z0-9+/]{43}=$"), bare)
    return F.when(bare.rlike(r"^[0-9A-Fa-f]{64}$"), F.lower(bare)).otherwise(F.lower(F.hex(F.unbase64(base64))))


def complete_download(status: Column, redirects: Column, declared: Column, received: Column, most: int = 5) -> Column:
    """Status 2xx, at most so many redirects (null: unknown), and the declared length if there is one."""
    return (status.between(200, 299)) & (F.coalesce(redirects, F.lit(0)) <= most) & (declared.isNull() | (declared == received)) & received.isNotNull()


def name_matches(primary_lower: Column, alias_search: Column, needle: Column) -> Column:
    """Case-insensitive contains on the primary name or any alias; no character is special."""
    return F.contains(primary_lower, F.lower(needle)) | F.coalesce(F.contains(alias_search, F.lower(needle)), F.lit(False))


def alias_search(names: Column) -> Column:
    """Lower-cased aliases, one a line, so that no match crosses from one into the next."""
    return F.lower(F.array_join(names, "\n"))
