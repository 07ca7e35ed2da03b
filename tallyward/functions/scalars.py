"""Column functions of public-record data: money, dates, names, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column | str) -> Column:
    """Decimal(14,2), null where the text is no number."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("decimal(14,2)")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def month_day_year(c: Column) -> Column:
    """MMDDYYYY as a date, null for anything else."""
    return F.when(c.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(c, F.lit("MMddyyyy"))))


def iso_day(c: Column) -> Column:
    """The date in the first ten characters, null for anything else."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def ratio(num: Column, den: Column, digits: int = 4) -> Column:
    """num / den as a rounded double; null where den is null or 0."""
    return F.round(F.when(den != 0, num.cast("double") / den.cast("double")), digits)


def at_least_zero(c: Column) -> Column:
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))


def display_name(c: Column) -> Column:
    """`LAST, FIRST MIDDLE MR` as `First Middle Last`; a first letter is upper case, the rest of a word lower."""
    titles = r"(?i)\b(MR|MRS|MS|DR|HON|REV)\b\.?"
    first, last = F.trim(F.regexp_replace(F.split_part(c, F.lit(","), F.lit(2)), titles, "")), F.trim(F.split_part(c, F.lit(","), F.lit(1)))
    name = F.trim(F.regexp_replace(F.concat_ws(" ", first, last), r"\s+", " "))
    return F.array_join(
        F.transform(F.split(name, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), " "
    )


#: Vote words and what they mean; anything else is unknown (null).
POSITIONS = {"yea": "yea", "aye": "yea", "yes": "yea", "nay": "nay", "no": "nay", "present": "present", "not voting": "not_voting"}


def vote_position(c: Column) -> Column:
    word = F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
    pairs = [x for k, v in POSITIONS.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), word)


def bill_key(c: Column) -> Column:
    """`H.R. 8595`, `HR 8595` as HR-8595; null where no letters with a number behind them stand."""
    flat = F.upper(F.regexp_replace(c, r"[\s.]", ""))
    return F.when(flat.rlike(r"^[A-Z]+\d+$"), F.concat_ws("-", F.regexp_extract(flat, r"^([A-Z]+)", 1), F.regexp_extract(flat, r"(\d+)$", 1)))


#: Kinds of bills that have a path of their own.
BILL_PATHS = ("HR", "S", "HRES", "SRES", "HJRES", "SJRES", "HCONRES", "SCONRES")


def split_bill_key(key: Column) -> Column:
    """struct(path, number) of a key like HR-8595; null where the kind is unknown or what follows the first hyphen is no number."""
    kind, number = F.upper(F.substring_index(key, "-", 1)), F.regexp_extract(key, r"^[^-]*-(\d+)$", 1)
    return F.when(kind.isin(*BILL_PATHS) & (number != ""), F.struct(F.lower(kind).alias("path"), number.cast("long").alias("number")))


def seat_district(office: Column, district: Column, seats: Column) -> Column:
    """Two-digit House district, 00 for an at-large seat, null for other offices and numbers outside 1..seats."""
    n = district.try_cast("int")
    return F.when(office == "H", F.when(seats == 1, F.lit("00")).when(n.between(1, seats), F.lpad(n.cast("string"), 2, "0")))
