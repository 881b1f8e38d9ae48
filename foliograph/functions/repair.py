"""Scalar repairs of scanned text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def case_number(c: Column) -> Column:
    return F.replace(c, F.lit("G.R. No,"), F.lit("G.R. No."))


def division(c: Column) -> Column:
    """Canonical division name from a misread one; others stay."""
    fixed = F.regexp_replace(F.upper(c), r"DIVIS\w+N", "DIVISION")
    return (
        F.when(fixed.contains("EN BANC"), "EN BANC").when(fixed.contains("FIRST"), "FIRST DIVISION").when(fixed.contains("SECOND"), "SECOND DIVISION").when(fixed.contains("THIRD"), "THIRD DIVISION").otherwise(c)
    )


def end_mark(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "SOORDERED", "SO ORDERED"), ",$", ".")


def date_text(c: Column) -> Column:
    """A full stop after the day becomes a comma; of four misread forms of 1986 the first one found is mended."""
    month = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
    t = F.regexp_replace(c, rf"(?i)({month}\s+\d{{1,2}})\.(\s+\d{{4}})", "$1,$2")
    case = F
    for wrong in ("[986", "(986", "[9B6", "(9B6"):  # fixed values
        case = case.when(F.contains(t, F.lit(wrong)), F.replace(t, F.lit(wrong), F.lit("1986")))
    return case.otherwise(t)


#: How scans misspell "concur".
CONCUR = ["coneur", "concue", "concuf", "soncur", "concor", "coricur", "conour", "concut", "conrur", "concui"]


def concur(c: Column) -> Column:
    """White space collapsed and broken or misread forms of 'concur' made whole."""
    t = F.trim(F.regexp_replace(c, r"\s+", " "))
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)\bcon-\s*cur", "concur"), r"(?i)\bcon\s+cur", "concur")
    return F.regexp_replace(F.regexp_replace(t, "(?i)_concur", " concur"), rf"(?i)\b(?:{'|'.join(CONCUR)})\b", "concur")


def ponente(c: Column) -> Column:
    """PER CURIAM in one spelling, without punctuation after it; other names stay."""
    return F.when(c.rlike(r"(?i)^\s*PER\s+CURIAM\s*[,:;.]*\s*$"), "PER CURIAM").otherwise(c)


def by_label(label: Column, text: Column) -> Column:
    """The repair that the label calls for."""
    return (
        F.when(label == "case_number", case_number(text)).when(label == "date", date_text(text)).when(label == "division", division(text))
        .when(label == "ponente", ponente(text)).when(label == "end_decision", end_mark(text)).otherwise(text)
    )


def flexible_date(c: Column) -> Column:
    """The first of several formats that reads the text, ordinals stripped; null if none does."""
    t = F.trim(F.regexp_replace(c, r"(?<=\d)(?:st|nd|rd|th)\b", ""))
    formats = ["MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "d MMMM yyyy", "yyyy-MM-dd", "MM/dd/yyyy", "MMMM yyyy"]
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for f in formats])


def clamped_date(c: Column) -> Column:
    """Month, day and year with the day clamped to 28, 30 or 31; years 1800 to 2100, days 1 to 31; else null."""
    month = F.array_position(F.array(*[F.lit(m[:3].lower()) for m in MONTHS]), F.lower(F.substring(F.regexp_extract(c, r"([A-Za-z]{3,9})\.? +(\d{1,2}),? +(\d{4})", 1), 1, 3))).cast("int")
    day, year = (F.regexp_extract(c, r"([A-Za-z]{3,9})\.? +(\d{1,2}),? +(\d{4})", k).try_cast("int") for k in (2, 3))
    most = F.when(month == 2, 28).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.when((month > 0) & day.between(1, 31) & year.between(1800, 2100), F.make_date(year, month, F.least(day, most)))


def title_case(c: Column) -> Column:
    """Capitals at the start of words and after hyphens."""
    return F.array_join(F.transform(F.split(F.lower(c), "-"), F.initcap), "-")
