"""Fields of case rows as column expressions: eras, dates, names, divisions, sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Volume ranges of the pattern eras and of the validation reports, anchors of years, label sets.
ERAS = [("era1", 121, 260), ("era2", 261, 500), ("era3", 501, 700), ("era4", 701, 900), ("era5", 901, 999)]
VALIDATION_ERAS = [("ERA-1 (121-260)", 121, 260), ("ERA-2 (261-500)", 261, 500), ("ERA-3 (501-660)", 501, 660), ("ERA-4 (661-850)", 661, 850), ("ERA-5 (851-999)", 851, 999)]
ANCHORS = [(226, 1986), (500, 2005), (700, 2014), (961, 2024)]
NO_NAMES = ["LLM_TEST_MARKER", "Per curiam", "PER CURIAM", ""]
WHOLE_NAMES = {"Jose Abad Santos": "Abad Santos", "Vicente Abad Santos": "Abad Santos", "Priscilla Baltazar-Padilla": "Baltazar-Padilla"}
CONTENT = ["case_number", "counsel", "date", "division", "doc_type", "end_syllabus", "parties", "ponente", "start_syllabus", "votes"]
REDO = {
    "required_labels_present": ["case_number", "date", "division", "doc_type", "votes"], "parties_length": ["parties"], "votes_length": ["votes"],
    "ponente_known": ["ponente"], "ordering_correct": CONTENT, "no_overlaps": CONTENT, "date_valid": ["date"],
}
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def _ranged(volume: Column, ranges: list[tuple], otherwise: Column) -> Column:
    case = F
    for value, first, last in ranges:
        case = case.when(volume.between(first, last), F.lit(value))
    return case.otherwise(otherwise)


def era(volume: Column) -> Column:
    """Name of the pattern era; era1 where none fits."""
    return _ranged(volume, ERAS, F.lit("era1"))


def validation_era(volume: Column) -> Column:
    return _ranged(volume, VALIDATION_ERAS, F.concat(F.lit("Other ("), volume.cast("string"), F.lit(")")))


def era_order(volume: Column) -> Column:
    """Eras outward from the volume's own, right before left: the order in which patterns are tried."""
    own = _ranged(volume, [(k, a, b) for k, (_, a, b) in enumerate(ERAS)], F.lit(0))
    ranked = F.array(*[F.struct(F.abs(F.lit(k) - own).alias("far"), (F.lit(k) < own).alias("left"), F.lit(name).alias("era")) for k, (name, _, _) in enumerate(ERAS)])
    return F.transform(F.array_sort(ranked), lambda x: x["era"])


def date_of_volume(volume: Column) -> Column:
    """The middle of the year that lies between the anchors' years as the volume lies between their volumes."""
    case = F
    for (v0, y0), (v1, y1) in zip(ANCHORS, ANCHORS[1:]):
        case = case.when(volume <= v1, F.lit(y0) + (volume - v0) / F.lit(v1 - v0) * F.lit(y1 - y0))
    return F.make_date(case.otherwise(F.lit(ANCHORS[-1][1])).cast("int"), F.lit(6), F.lit(15))


def date_prefix(text: Column) -> Column:
    """struct(date, prefix): what stands before the first month name, or before a numeric date that leads the text."""
    t = F.trim(text)
    numeric = t.rlike(r"^(?:\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{1,2}-\d{1,2})")
    at = F.length(F.regexp_extract(t, rf"(?is)^(.*?)\b(?:{MONTHS})\b", 1))
    at = F.when(numeric | ~t.rlike(rf"(?i)\b(?:{MONTHS})\b"), F.lit(0)).otherwise(at)
    return F.struct(F.trim(F.substring(t, at + 1, F.length(t))).alias("date"), F.trim(F.substring(t, F.lit(1), at)).alias("prefix"))


def term_days(text: Column) -> Column:
    """'18 years 302 days' in days; what is missing counts as none."""
    part = lambda unit: F.coalesce(F.regexp_extract(text, rf"(\d+)\s+{unit}", 1).try_cast("long"), F.lit(0))
    return part("year") * 365 + part("day")


def date_validity(text: Column) -> Column:
    """1 for a text that begins as a date, 0.5 if it does without its brackets, else 0."""
    begins = r"(?i)^(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4}"
    t = F.trim(text)
    return F.when(t.rlike(begins), 1.0).when(F.regexp_replace(t, r"[\[\](){}]", "").rlike(begins), 0.5).otherwise(0.0)


def visible_midpoint(start: Column, end: Column, lo: Column, hi: Column) -> Column:
    """The middle of a term inside a range; its start if it lies outside."""
    a, b = F.greatest(start, lo), F.least(end, hi)
    return F.when(b < a, start).otherwise(F.date_add(a, F.floor(F.datediff(b, a) / 2).cast("int")))


def in_term(start: Column, end: Column, lo: Column, hi: Column, grace: int = 365) -> Column:
    """Whether a term meets [lo, hi] with ``grace`` days on both sides; an unknown side never excludes."""
    return F.coalesce(start <= F.date_add(hi, grace), F.lit(True)) & F.coalesce(end >= F.date_sub(lo, grace), F.lit(True))


def division_name(raw: Column) -> Column:
    """Canonical name of a division as it is spelled in case tables."""
    t = F.upper(F.trim(raw))
    return (
        F.when(t.contains("BANC"), "EN BANC").when(t.rlike("FIRS|1ST"), "FIRST DIVISION").when(t.rlike("SECON|2ND"), "SECOND DIVISION")
        .when(t.rlike("THIR|3RD"), "THIRD DIVISION").when(t.contains("SPECIAL"), "SPECIAL DIVISION").otherwise(t)
    )


def names_in(joined: Column) -> Column:
    """Names of a list joined by semicolons, without those that are none."""
    return F.filter(F.transform(F.split(F.coalesce(joined, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: ~x.isin(*NO_NAMES))


def case_number_key(number: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(number), r"\s+", " "))


def volume_number(name: Column) -> Column:
    """The first run of digits in a volume's name."""
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("int")


def display_name(name: Column) -> Column:
    """Surname of a full name, with its suffixes after a comma; some surnames have two words."""
    t = F.trim(name)
    body = F.regexp_replace(t, r"(?i)(?:\s+(?:jr|sr|iii|ii|iv)\.?)+$", "")
    suffixes = F.filter(F.split(F.trim(F.substring(t, F.length(body) + 1, F.length(t))), r"\s+"), lambda x: x != "")
    surname = F.element_at(F.split(body, r"\s+"), -1)
    with_suffix = F.when(F.size(suffixes) > 0, F.concat(surname, F.lit(", "), F.array_join(F.transform(suffixes, lambda x: F.concat(F.initcap(F.rtrim(x, F.lit("."))), F.lit("."))), " "))).otherwise(surname)
    case = F
    for full, short in WHOLE_NAMES.items():
        case = case.when(name == full, F.lit(short))
    return case.otherwise(with_suffix)


def surname_key(name: Column) -> Column:
    """Last word of a name in capitals, without suffixes, commas and full stops: what two spellings are matched by."""
    words = F.filter(F.split(F.regexp_replace(F.upper(name), "[,.]", ""), r"\s+"), lambda x: ~x.isin("", "JR", "SR", "II", "III", "IV"))
    return F.when(F.size(words) > 0, F.element_at(words, -1))


def log_metrics(log: Column) -> Column:
    """struct of the numbers that a run's summary names; null where it doesn't."""
    said = {
        "total_cases": r"Total cases:\s*(\d+)", "high_confidence": r"High confidence:\s*(\d+)", "low_confidence": r"Low confidence:\s*(\d+)", "ocr_corrections": r"OCR corrections:\s*(\d+)",
        "llm_calls": r"LLM calls:\s*(\d+)", "llm_cost": r"LLM cost:\s*\$([\d.]+)", "volumes_processed": r"Volumes processed:\s*(\d+)",
    }
    return F.struct(*[F.regexp_extract(log, pattern, 1).try_cast("double").alias(name) for name, pattern in said.items()])


def natural_order(text: Column) -> list[Column]:
    """Sort keys that compare letters without case and runs of digits as numbers (up to two of each)."""
    letters, digits = F.split(F.lower(text), r"\d+"), F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
    return [x for k in (0, 1) for x in (F.get(letters, k), F.get(digits, k).try_cast("long"))] + [text]


def labels_to_redo(checks: Column) -> Column:
    """Sorted labels to extract again: those of the checks (map of name to score) that are below one half."""
    failed = F.map_keys(F.map_filter(checks, lambda _, score: score < 0.5))
    of = F.create_map(*[x for name, labels in REDO.items() for x in (F.lit(name), F.array(*map(F.lit, labels)))])
    return F.sort_array(F.array_distinct(F.flatten(F.transform(failed, lambda name: F.coalesce(F.element_at(of, name), F.array().cast("array<string>"))))))
