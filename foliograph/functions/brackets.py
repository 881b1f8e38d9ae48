"""Case numbers and dates in a bracket such as "[G.R. No. 5. May 3, 1999]"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How months begin.
MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"


def _found(at: Column) -> Column:
    """Positions from 0; null where there is none."""
    return F.when(at > 0, at - 1)


def bracket_number(line: Column, date: Column) -> Column:
    """What stands between the opening signs and the date; without the date, before the first month, else to the end."""
    opening = F.length(F.regexp_extract(line, r"^[\[({1I]*", 0))
    end = F.coalesce(_found(F.position(date, line)), _found(F.regexp_instr(line, F.lit(rf"(?i)[.\s,]+{MONTH}"))), F.length(line) - 1)
    return F.regexp_replace(F.trim(F.substring(line, opening + 1, F.greatest(end - opening, F.lit(0)))), r"[., ]+$", "")


def bracket_date(line: Column, date: Column) -> Column:
    """(col from 0, text) of the date: as given, else what looks like one, else 20 characters before the closing sign."""
    like = rf"(?i){MONTH}[a-z]*\.?\s+\d{{1,2}},?\s+\d{{4}}"
    closing = F.length(F.regexp_extract(line, r"^(.*)[\])}]", 1))
    end = F.when(closing > 0, closing).otherwise(F.length(line))
    rough = F.greatest(end - 20, F.lit(0))
    given, looks = _found(F.position(date, line)), _found(F.regexp_instr(line, F.lit(like)))
    text = F.when(given.isNotNull(), date).when(looks.isNotNull(), F.regexp_extract(line, like, 0)).otherwise(F.trim(F.substring(line, rough + 1, end - rough)))
    return F.struct(F.coalesce(given, looks, rough).alias("col"), text.alias("text"))
