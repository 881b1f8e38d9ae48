"""Fields and parts of case texts against the same rules in plain Python."""

import random
import re

from foliograph.operators import first_regex


def python(pattern):
    flags, rest = (m[1], pattern[m.end() :]) if (m := re.match(r"\(\?([imd]+)\)", pattern)) else ("", pattern)
    return re.compile(rest, (re.I if "i" in flags else 0) | (re.M if "m" in flags else 0))


P = {k: python(v) for k, v in first_regex.FIELDS.items()}
OLD = {k: python(v) for k, v in first_regex.OLDER.items()}
PIECES = ["G.R. No. 123", "G.R. No. 4-5", "[G.R. No. 73155. May 2, 1990]", "(A.M. No. P-85, L-77, June 30, 1986}", "EN BANC DIVISION", "FIRST DIVISION", "May 3, 1999", "June 30, 2001", "J. CRUZ", "DECISION", "D E C I S I O N", "RESOLUTION", "SYLLABUS", "APPEARANCES OF COUNSEL", "COUNSEL", "CRUZ, J.:", "DE LA PEÑA, C.J.:", "YAP, C.J.:", "SO ORDERED.", "DISSENTING OPINION", "CONCURRING AND DISSENTING OPINION", "Jose Cruz, petitioner, vs. State, respondent.", "a line of text that goes on", "", "x" * 300]


def texts():
    draw = random.Random(21)
    return [(k, "\n".join(draw.choice(PIECES) for _ in range(draw.randint(0, 25)))) for k in range(250)] + [(900, None), (901, "")]


def plain_fields(t):
    if t is None:
        return []
    numbers = list(P["case_number"].finditer(t))
    out = [("case_number", i, m[0], m.start(), m.end()) for i, m in enumerate(numbers)]
    out += [(c, None, m[0], m.start(), m.end()) for c in ("date", "division", "ponente") if (m := P[c].search(t))]
    kind = "DECISION" if P["decision"].search(t) else "RESOLUTION" if P["resolution"].search(t) else None
    return sorted(out + [("doc_type", None, kind, 0, 0)] * bool(kind), key=str)


def test_fields(spark):
    rows = texts()
    got = first_regex.fields(spark.createDataFrame(rows, "k int, text string"), "k").collect()
    for k, t in rows:
        assert sorted((tuple(r)[1:] for r in got if r.k == k), key=str) == plain_fields(t), t
    own = first_regex.fields(spark.createDataFrame([(1, "No 7, No 8")], "k int, text string"), "k", patterns={"case_number": r"No \d"}).collect()
    assert [(r.text, r.start_char) for r in own] == [("No 7", 0), ("No 8", 6)]


def plain_parts(t):
    t = t or ""
    first = {c: OLD[c].search(t) for c in ("syllabus", "counsel", "decision", "resolution")}
    brackets = list(OLD["bracket"].finditer(t))
    end = next((first[c].start() for c in first if first[c]), None)
    b = brackets[-1].end() if brackets else None
    parties = "" if b is None else t[b : end if end is not None else b + 1500].strip()[:2000] if end is None or end > b else ""

    def part(m, headers, open_, most):
        if not m:
            return ""
        rest = t[m.end() :]
        stop = next((x.start() for h in headers if (x := OLD[h].search(rest))), open_)
        return rest[:stop].strip()[:most]

    body = first["decision"] or first["resolution"]
    author = OLD["ponente"].search(t[body.end() : body.end() + 500]) if body else None
    opinions = []
    for m in OLD["opinion"].finditer(t):
        a = OLD["ponente"].search(t[m.end() : m.end() + 500])
        opinions.append((m[1].strip().upper(), a[1].strip() if a else ""))
    return (
        parties, *(bool(first[c]) for c in first), bool(OLD["so_ordered"].search(t)), part(first["syllabus"], ["counsel", "decision", "resolution"], 5000, 3000), part(first["counsel"], ["decision", "resolution"], 2000, 2000),
        "DECISION" if first["decision"] else "RESOLUTION" if first["resolution"] else "", author[1].strip() if author else "", ("C.J." if "C" in author[2].upper() else "J.") if author else "", opinions,
    )


def test_parts(spark):
    rows = texts()
    got = {r.k: r for r in first_regex.subfields(spark.createDataFrame(rows, "k int, text string"), "k").collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        r = got[k]
        have = (r.parties_raw, r.has_syllabus, r.has_counsel, r.has_decision, r.has_resolution, r.has_so_ordered, r.syllabus_raw, r.counsel_raw, r.doc_type, r.ponente_name, r.ponente_title, [tuple(x) for x in r.opinions])
        assert have == plain_parts(t), t
