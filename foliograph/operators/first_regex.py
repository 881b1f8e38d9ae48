"""Fields of a case's text by regular expressions with positions, and its parts between section headers.

Both read whole case texts with column expressions only; a user's own patterns can stand in for any of the defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
#: Patterns of fields; of the first all matches count, of the others the first one.
FIELDS = {
    "case_number": r"G\.R\.\s*No\.\s*\d+(?:-\d+)?",
    "date": rf"\b{MONTH}\s+\d{{1,2}},\s+\d{{4}}\b",
    "division": r"\b(?:FIRST|SECOND|THIRD|EN BANC)\s+DIVISION\b",
    "ponente": r"\bJ\.\s+[A-Z\s.]+\b",
    "decision": r"\bDECISION\b",
    "resolution": r"\bRESOLUTION\b",
}
#: Prefixes of case numbers, brackets and headers of the older family, lines by line feeds only.
PREFIX = (
    r"(?:G[.\s]*R[.\s]*\s*(?:Nos?\.?|No\.?)|A[.\s]*C[.\s]*\s*(?:Nos?\.?|No\.?)|A[.\s]*M[.\s]*\s*(?:Nos?\.?|No\.?)|B[.\s]*M[.\s]*\s*(?:Nos?\.?|No\.?)"
    r"|UDK[\s\-]*(?:Nos?\.?|No\.?)|OCA[\s\-]*(?:IPI[\s\-]*)?(?:Nos?\.?|No\.?)|(?:Nos?\.?|No\.?))"
)
OLDER = {
    "bracket": rf"(?id)[\[({{]\s*{PREFIX}\s*(?:[L1Il][\-~])?\s*[\d\-~]+(?:\s*-\s*\d+)?(?:\s*(?:,|and|&)\s*{PREFIX}?\s*(?:[L1Il][\-~])?\s*[\d\-~]+)*\s*[.,;\s]\s*[A-Z][a-z]+\s+\d{{1,2}}\s*,?\s*\d{{4}}\s*\.?\s*[\])}}]",
    "syllabus": r"(?imd)^\s*S\s*Y\s*L\s*L\s*A\s*B\s*U\s*S\s*$|^\s*SYLLABUS\s*$",
    "counsel": r"(?imd)^\s*(?:APPEARANCES?\s+OF\s+COUNSEL|COUNSEL)\s*$",
    "decision": r"(?imd)^\s*D\s*E\s*C\s*I\s*S\s*I\s*O\s*N\s*$|^\s*DECISION\s*$",
    "resolution": r"(?imd)^\s*R\s*E\s*S\s*O\s*L\s*U\s*T\s*I\s*O\s*N\s*$|^\s*RESOLUTION(?!.*NO\.)\s*$",
    "so_ordered": r"(?id)SO\s+ORDERED\s*\.",
    "opinion": r"(?imd)^\s*(CONCURRING(?:\s+AND\s+DISSENTING)?\s+OPINION|DISSENTING\s+OPINION|SEPARATE\s+OPINION|CONCURRING\s+OPINION)\s*$",
    "ponente": r"(?md)^\s*([A-Z][A-Z\-\s']+?)\s*[,.;]\s*(?:[A-Z.]+\s*,\s*)?(C\.?\s*J\.?|JJ?\.?)\s*[:.?]",
}
#: Characters that a part may have, and those in which an author is looked for behind a header.
PARTIES, OPEN_PARTIES, SYLLABUS, OPEN_SYLLABUS, COUNSEL, BEHIND = 2000, 1500, 3000, 5000, 2000, 500
WHITE = " \t\n\r\f\v"


def first(text: Column, pattern: str) -> Column:
    """(s, e, text) of the first match, offsets from 0; null if there is none."""
    found = F.regexp_extract(text, pattern, 0)
    at = F.regexp_instr(text, F.lit(pattern)) - 1
    return F.when(at >= 0, F.struct(at.cast("long").alias("s"), (at + F.length(found)).cast("long").alias("e"), found.alias("text")))


def every(text: Column, pattern: str) -> Column:
    """(s, e, text) of all matches in order: what stands between them gives their places."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    size = lambda parts, n: F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0).cast("long"), lambda t, x: t + F.length(x))
    return F.transform(found, lambda x, i: F.struct((size(between, i + 1) + size(found, i)).alias("s"), (size(between, i + 1) + size(found, i + 1)).alias("e"), x.alias("text")))


def fields(cases: DataFrame, key: str, text: str = "text", patterns: dict[str, str] | None = None) -> DataFrame:
    """(key, label, group, text, start_char, end_char) of each case's fields; ``patterns`` replaces some of ``FIELDS``.

    Case numbers are grouped by their order if there are several. The document's type has no place: 0, 0. Null texts
    have no fields.
    """
    p, t = FIELDS | (patterns or {}), F.col(text)
    row = lambda label, group, x: F.struct(F.lit(label).alias("label"), group.cast("int").alias("group"), x["text"].alias("text"), x["s"].alias("start_char"), x["e"].alias("end_char"))
    numbers = F.transform(every(t, p["case_number"]), lambda x, i: row("case_number", i, x))
    single = [F.when(first(t, p[c]).isNotNull(), row(c, F.lit(None), first(t, p[c]))) for c in ("date", "division", "ponente")]
    kind = F.when(t.rlike(p["decision"]), "DECISION").when(t.rlike(p["resolution"]), "RESOLUTION")
    none = F.struct(kind.alias("text"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("e"))
    single.append(F.when(kind.isNotNull(), row("doc_type", F.lit(None), none)))
    return cases.where(t.isNotNull()).select(key, F.inline(F.concat(numbers, F.array_compact(F.array(*single)))))


def _cut(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def subfields(cases: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per case with its parts: parties_raw, syllabus_raw, counsel_raw, author, type, flags and opinions.

    Parties stand between the last bracket and the first kind of header that is there (syllabus, counsel, decision,
    resolution, in this order); syllabus and counsel go to a later header. A null text counts as empty.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    at = {c: first(t, OLDER[c]) for c in ("syllabus", "counsel", "decision", "resolution")}
    df = cases.select(key, t.alias("t"), *[x.alias(c) for c, x in at.items()], F.try_element_at(every(t, OLDER["bracket"]), F.lit(-1))["e"].alias("bracket"), every(t, OLDER["opinion"]).alias("heads"))
    t = F.col("t")
    size = F.length("t").cast("long")

    def part(start: Column, headers: list[str], open_: int, most: int) -> Column:
        """From ``start`` to the first kind of header behind it that is there, else so many characters."""
        rest = _cut(t, start, size)
        end = F.coalesce(*[first(rest, OLDER[h])["s"] for h in headers], F.lit(open_))
        return F.substring(F.btrim(_cut(rest, F.lit(0), end), F.lit(WHITE)), 1, most)

    ends = F.coalesce("syllabus.s", "counsel.s", "decision.s", "resolution.s", F.col("bracket") + OPEN_PARTIES)
    parties = F.when(F.col("bracket").isNotNull(), F.substring(F.btrim(_cut(t, F.col("bracket"), ends), F.lit(WHITE)), 1, PARTIES)).otherwise("")
    body = F.coalesce("decision.e", "resolution.e")
    behind = _cut(t, body, body + BEHIND)
    author = lambda c, k: F.coalesce(F.btrim(F.regexp_extract(c, OLDER["ponente"], k), F.lit(WHITE)), F.lit(""))
    title = F.when(author(behind, 2) == "", "").when(F.upper(author(behind, 2)).contains("C"), "C.J.").otherwise("J.")
    opinions = F.transform("heads", lambda x: F.struct(F.upper(F.btrim(F.regexp_extract(x["text"], OLDER["opinion"], 1), F.lit(WHITE))).alias("type"), author(_cut(t, x["e"], x["e"] + BEHIND), 1).alias("author")))
    there = {f"has_{c}": F.col(c).isNotNull() for c in ("syllabus", "counsel", "decision", "resolution")}
    return df.select(
        key, parties.alias("parties_raw"), *[c.alias(n) for n, c in there.items()], t.rlike(OLDER["so_ordered"]).alias("has_so_ordered"),
        F.when(F.col("syllabus").isNotNull(), part(F.col("syllabus.e"), ["counsel", "decision", "resolution"], OPEN_SYLLABUS, SYLLABUS)).otherwise("").alias("syllabus_raw"),
        F.when(F.col("counsel").isNotNull(), part(F.col("counsel.e"), ["decision", "resolution"], COUNSEL, COUNSEL)).otherwise("").alias("counsel_raw"),
        F.when(F.col("decision").isNotNull(), "DECISION").when(F.col("resolution").isNotNull(), "RESOLUTION").otherwise("").alias("doc_type"),
        author(behind, 1).alias("ponente_name"), F.coalesce(title, F.lit("")).alias("ponente_title"), opinions.alias("opinions"),
    )
