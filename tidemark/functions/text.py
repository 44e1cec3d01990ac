"""Text and number expressions over published labels and cells: built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters of the sources and the letters that stand for them.
ACCENTED, PLAIN = "áéíóúüñàèìòùâêîôûäëïöç", "aeiouunaeiouaeiouaeioc"
# Month words by number, in the two languages of the sources.
MONTHS = [
    ("ene", 1), ("jan", 1), ("feb", 2), ("mar", 3), ("abr", 4), ("apr", 4), ("may", 5), ("jun", 6), ("jul", 7),
    ("ago", 8), ("aug", 8), ("sep", 9), ("set", 9), ("oct", 10), ("nov", 11), ("dic", 12), ("dec", 12),
]
QUARTERS = [("i", 1), ("ii", 2), ("iii", 3), ("iv", 4), ("t1", 1), ("t2", 2), ("t3", 3), ("t4", 4)]


def normalized(label: Column) -> Column:
    """Trimmed, single blanks, lower case, without accents."""
    return F.translate(F.lower(F.trim(F.regexp_replace(label, r"\s+", " "))), ACCENTED, PLAIN)


def slug(label: Column) -> Column:
    """An identifier from a label."""
    return F.regexp_replace(F.regexp_replace(normalized(label), "[^a-z0-9]+", "_"), "^_|_$", "")


def blank(cell: Column) -> Column:
    """G03."""
    return cell.isNull() | (F.trim(cell) == "")


def malformed_number(token: Column) -> Column:
    """Neither blank nor a decimal-comma number with optional grouping dots."""
    return ~blank(token) & ~F.trim(token).rlike(r"^-?([0-9]+|[0-9]{1,3}(\.[0-9]{3})+)(,[0-9]+)?$")


def decimal_comma(token: Column) -> Column:
    """The number, or null where the token is blank or malformed."""
    plain = F.replace(F.replace(F.trim(token), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(~blank(token) & ~malformed_number(token), plain.try_cast("double"))


def _lookup(token: Column, words) -> Column:
    flat = [F.lit(x) for pair in words for x in pair]
    return F.try_element_at(F.create_map(*flat), token)


def month_number(word: Column) -> Column:
    """1..12 by the first three letters of a month's name."""
    return _lookup(F.substring(normalized(word), 1, 3), MONTHS)


def quarter_number(token: Column) -> Column:
    """1..4 from roman numerals, T1..T4 or '1er trim'."""
    t = F.regexp_replace(normalized(token), r"[\s.]", "")
    ordinal = F.regexp_extract(t, "^([1-4])(er|do|ro|to|°|º)?trim", 1)
    return F.coalesce(_lookup(t, QUARTERS), F.nullif(ordinal, F.lit("")).try_cast("int"))


def year_label(cell: Column) -> Column:
    """A four-digit year that may carry a footnote mark."""
    return F.regexp_extract(F.trim(cell), r"^((?:19|20)[0-9]{2})\s*(?:\(?\*+\)?|[0-9]?/|p)?$", 1).try_cast("int")


def without_footnote(label: Column) -> Column:
    """The label without trailing marks such as (*), */ or 1/."""
    return F.trim(F.regexp_replace(label, r"\s*(\((\*+|[0-9]+)\)|\*+/?|\b[0-9]/)\s*$", ""))


def expanded_year(two_digits: Column) -> Column:
    """The century turns at 40."""
    return two_digits + F.when(two_digits < 40, 2000).otherwise(1900)


def footnote_only(label: Column) -> Column:
    """A cell that holds a footnote mark and nothing else."""
    return ~blank(label) & blank(without_footnote(label))


def axis_date(label: Column) -> Column:
    """The day that an axis label names as yyyy-mm, mmm-yy or d-mmm-yy; months stand for their last day."""
    t = normalized(label)
    iso_year, iso_month = (F.regexp_extract(t, "^((?:19|20)[0-9]{2})-(0[1-9]|1[0-2])$", g).try_cast("int") for g in (1, 2))
    day, word, two = (F.regexp_extract(t, "^(?:([0-9]{1,2})-)?([a-z]{3,})-([0-9]{2})$", g) for g in (1, 2, 3))
    first = F.make_date(expanded_year(two.try_cast("int")), month_number(word), F.lit(1))
    named = F.when(day == "", F.last_day(first)).when(day.try_cast("int").between(1, F.day(F.last_day(first))), F.date_add(first, day.try_cast("int") - 1))
    return F.coalesce(F.last_day(F.make_date(iso_year, iso_month, F.lit(1))), named)


def month_interval(label: Column) -> tuple[Column, Column]:
    """First and last month number of 'ene/jun'; null where a word is no month or the end comes first."""
    first, last = (month_number(F.split_part(label, F.lit("/"), F.lit(k))) for k in (1, 2))
    both = (F.size(F.split(label, "/")) == 2) & (first <= last)
    return F.when(both, first), F.when(both, last)


def path(*labels: Column) -> Column:
    """The labels that aren't blank, each once, in order."""
    return F.array_join(F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull() & (F.trim(x) != ""))), " — ")


def hashed_id(prefix: str, *parts: Column) -> Column:
    """A prefix and 24 hex digits of the parts' sha-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24))


def column_number(letters: Column) -> Column:
    """A=1, Z=26, AA=27."""
    return F.aggregate(F.split(F.upper(letters), ""), F.lit(0), lambda n, c: F.when(c == "", n).otherwise(n * 26 + F.ascii(c) - 64))


def a1(reference: Column) -> tuple[Column, Column]:
    """Row and column of an A1 reference."""
    return F.regexp_extract(reference, "([0-9]+)$", 1).try_cast("long"), column_number(F.regexp_extract(reference, "^([A-Za-z]+)", 1)).cast("long")


def first_match(text: Column, rules) -> Column:
    """The value of the first expression that the text matches."""
    out = F.lit(None).cast("string")
    for pattern, value in reversed(list(rules)):
        out = F.when(text.rlike(pattern), value).otherwise(out)
    return out


def only_match(text: Column, rules, otherwise: str = "not_reviewed") -> Column:
    """The value of the one expression that matches; several or none leave it open."""
    rules = list(rules)
    hits = F.lit(0)
    for pattern, _ in rules:
        hits = hits + F.when(text.rlike(pattern), 1).otherwise(0)
    return F.when(hits == 1, first_match(text, rules)).otherwise(otherwise)
