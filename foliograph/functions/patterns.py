"""What lines of decisions look like: fixed values, in the dialect of the JVM. Eras differ where their tuning says so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliograph.functions.fields import ERAS, era_order

NAME = r"[A-ZÀ-ɏ][A-ZÀ-ɏ\s,.'\-]+?"
TITLE = r"(?:Actg\.\s*|Acting\s+)?(?:C[\s./)]*J[\s./)]*|J[\s./)]*)"
#: The title of an author, with suffixes that scanning mangled.
MANGLED = r"(?:Actg\.\s*|Acting\s+)?(?:C[\s./)]*J[\s./)]*|J[\s./)]*|[CVJ/À-ɏ][A-Za-zÀ-ɏ./)]*)"
#: What stands around division headers.
AROUND = "\"'`~*_-‐‑‒–—―‘’‚‛“”„‟«»‹›•·.,:;!?()[]{}|/\\ \t"
#: How a case number begins in a bracket, and the months.
PREFIX = r"(?:(?:G\.\s*R|A\.\s*M|A\.\s*C|B\.\s*M)\.\s*No|OCA\s*IPI\s*No|Adm\.\s*(?:Matter|Case)\s*No)[.\s,]*s?[.\s,]*"
MONTHS = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4}"
#: A bracket with number and date: with its closing sign, and without one but with the name of a month.
BRACKETS = [
    rf"(?i)^[\s*•·]*[\[({{1I]*{PREFIX}\s*([\w\-/&\s.]+?)[.\s,:]+(.+)[\])}}].*$",
    rf"(?i)^[\s*•·]*[\[({{1]?{PREFIX}\s*([\w\-/&\s.]+?)[.\s,:]+({MONTHS})",
]
ROLE = r"(?:respondents?|petitioners?|plaintiffs?|defendants?|appellants?|appellees?|accused-appellants?|intervenors?|oppositors?)"

#: Kinds of lines and their patterns. Lines of parties, votes and footnotes are told apart further by our
#: own "versus_inside", "role_twice", "vote" and "no_vote".
LINES = {
    "page": r"^--- Page \d+ ---$",
    "volume": r"^(?:VOL[.,]\s*\d+.*\d+|\d+\s+PHILIPPINE REPORTS)\s*$",
    "division": r"(?i)^(?:EN\s*BAN\s*C|(?:[A-Z]{4,10}\s+)?[A-Z]{4,7}\s+DIVIS[A-Z]+N)\s*$",
    "bracket": "|".join(BRACKETS),
    "syllabus": r"(?i)^SY[IL]?LABUS\s*$",
    "counsel": r"(?i)^APPEARANCES?\s+OF\s+COUNSEL\s*$",
    "doc_type": r"^(?:DECISION|RESOLUTION|D\s+E\s+C\s+I\s+S\s+I\s+O\s+N|R\s+E\s+S\s+O\s+L\s+U\s+T\s+I\s+O\s+N)\s*$",
    "ponente": rf"^\s*\W*{NAME},?\s*{MANGLED}:\s*[./)!*“”‘’Â\"':]*\s*$",
    "per_curiam": r"(?i)^PER\s+CURIAM\s*[,:;]*\s*$",
    "so_ordered": r"(?i)^\s*[“”‘’\"']*\s*(?:IT\s+IS\s+)?SO\s*ORDERED\s*[.,;:!]*\s*[“”‘’\"']*\s*\d{0,3}\s*$",
    "wherefore": r"(?i)^\s*WHEREFORE\b",
    "opinion": rf"(?i)^\s*\W*{NAME},\s*{TITLE},?\s*(?:concurring|dissenting|separate)\b",
    "versus": r"(?i)^\s*vs\.?\s",
    "versus_inside": r"(?i)\svs?\.\s",
    "role_end": rf"(?i){ROLE}\s*[.,;]*\s*$",
    "role_twice": rf"(?i){ROLE}.*\bvs?\..*{ROLE}\s*[.,;]*\s*$",
    "for_party": r"(?i)for\s+(?:the\s+)?(?:petitioner|respondent|plaintiff|defendant|appellant|appellee|accused|complainant|private|intervenor|oppositor)",
    "vote": r"(?i)concur|dissent|separate opinion|JJ\.|J\.,|C\.J\.|Chairman|Presiding|\(on (?:official )?leave\)|no part|on (?:official )?leave",
    "no_vote": r"^(?:\d+\.\s+[A-Z]|(?:Art|Sec)\.\s|See\s|Cf\.\s|Annex\b)",
    "footnote": r"^(?:\d+\s+|\*|\")",
}


#: The patterns that an era has of its own, in place of those of ``LINES``.
OF_ERA = {
    "era2": {
        "opinion": r"(?i)^([A-Z][A-Z\s,.'\-]+?),\s*(?:C\.?\s*J\.?\s*|J\.?\s*),?\s*(?:concurring|dissenting|separate)\b.*[:;]\s*$",
        "role_end": r"(?i)(?:respond.n.s?|p.titioners?|plaintiffs?|defendants?|appellants?|appellees?|accused-appellants?|intervenors?|oppositors?)\s*[.,;]*\s*$",
    },
}


def pattern(kind: str, era: str) -> str:
    return OF_ERA.get(era, {}).get(kind, LINES[kind])


def fitted(kind: str, line: Column, volume: Column) -> Column:
    """The first era, outward from the volume's own, whose pattern of this kind fits the line; null if none does.

    Each pattern runs once a line, however many eras share it.
    """
    eras = [name for name, _, _ in ERAS]
    groups: dict[str, list[str]] = {}
    for name in eras:
        groups.setdefault(pattern(kind, name), []).append(name)
    if len(groups) == 1:
        return F.when(line.rlike(pattern(kind, eras[0])), F.get(era_order(volume), 0))
    fits = F.flatten(F.array(*[F.when(line.rlike(p), F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>")) for p, names in groups.items()]))
    return F.get(F.filter(era_order(volume), lambda e: F.array_contains(fits, e)), 0)


def of_own_era(kind: str, line: Column, era: Column) -> Column:
    """Whether the pattern of the line's own era fits."""
    test = line.rlike(LINES[kind])
    for name, own in OF_ERA.items():
        if kind in own:
            test = F.when(era == name, line.rlike(own[kind])).otherwise(test)
    return test


def normal_division(line: Column) -> Column:
    """A division header without what scanning put around it."""
    return F.btrim(line, F.lit(AROUND))


def flags(line: Column, era: Column | None = None) -> dict[str, Column]:
    """A flag for each kind of line, by the patterns of the line's era where that is given, and whether it is blank."""
    return {f"is_{kind}": line.rlike(p) if era is None else of_own_era(kind, line, era) for kind, p in LINES.items()} | {"is_blank": F.trim(line) == ""}
