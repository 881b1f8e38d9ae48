"""Boundaries from a cut scan against the plain one, pattern families by era."""

import random

import pytest
from pyspark.sql import functions as F

from foliograph.functions import patterns
from foliograph.operators import boundaries, case_scan

WORDS = {"division": "EN BANC", "bracket": "[G.R. No. 7. May 3, 1999]", "blank": "", "text": "some text"}


def plain(rows):
    """[(volume, start, brackets)] by reading each volume's lines in order."""
    out = []
    for v in dict.fromkeys(r[0] for r in rows):
        own = sorted(r[1:] for r in rows if r[0] == v)
        start, held, waited, i = None, [], 0, 0
        while i < len(own):
            no, kind, text = own[i]
            if start is None:
                if kind == "division":
                    start, held, waited = no, [], 0
            elif not held:
                if kind == "bracket":
                    held, waited = [text], 0
                elif waited >= 10:
                    start = None
                else:
                    waited += 1
            elif kind == "blank":
                waited += 1
            elif kind == "bracket" and waited < 10:
                held, waited = [*held, text], waited + 1
            elif waited >= 10:
                out.append((v, start, held))
                start = None
                continue
            else:
                waited += 1
            i += 1
    return sorted(out)


@pytest.mark.parametrize("seed,weights", [(1, (1, 1, 2, 6)), (2, (3, 2, 1, 1)), (3, (1, 1, 12, 1)), (4, (1, 3, 0, 3)), (5, (1, 1, 1, 40))])
def test_cut_scan_is_the_plain_scan(spark, seed, weights):
    draw = random.Random(seed)
    rows = []
    for v in ("a", "b", "c", "d"):
        for no in range(1, draw.choice([1, 5, 60, 400])):
            kind = draw.choices(list(WORDS), weights)[0]
            rows.append((v, no, kind, f"[{v} {no}]" if kind == "bracket" else "x"))
    df = spark.createDataFrame(rows, "volume string, line_no int, kind string, line string")
    want = plain(rows)
    for pieces in (1, 3, 40):
        got = case_scan.boundaries(df, pieces=pieces).collect()
        assert sorted((r.volume, r.start_line, r.brackets) for r in got) == want
    for v in "abcd":
        own = sorted((r.start_line, r.end_line) for r in got if r.volume == v)
        assert [e for _, e in own] == [*[s - 1 for s, _ in own[1:]], max([r[1] for r in rows if r[0] == v], default=0)][: len(own)]


def test_nothing_to_scan(spark):
    assert case_scan.boundaries(spark.createDataFrame([], "volume int, line_no int, kind string, line string")).count() == 0


BRACKETS = [
    ("[G.R. No. 73155. May 2, 1990]", "73155", "May 2, 1990"), ("(A.M. No. P-85-1. June 30, 1986}", "P-85-1", "June 30, 1986"), ("{Adm. Matter Nos. 12-13:: May 30, 1986]_", "12-13", "May 30, 1986"),
    ("1G.R. Nos, 5-7. Dec. 1, 2001", "5-7", "Dec. 1, 2001"), ("• [OCA IPI No. 9-8. July 4, 2010)", "9-8", "July 4, 2010"),
]


def test_brackets(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in BRACKETS], "line string").withColumn("volume", F.lit(300))
    number, date = case_scan.bracket_parts(F.col("line"))
    got = {r.line: (r.kind, r.n, r.d) for r in case_scan.classified(df).select("line", "kind", number.alias("n"), date.alias("d")).collect()}
    assert got == {t: ("bracket", n, d) for t, n, d in BRACKETS}
    kinds = ["_EN BANC.", "“FIRST DIVISLON”", "--- Page 4 ---", "VOL. 226, MAY 2", "THIRD DIVISON", "In the matter of G.R. No. 7", " \t"]
    rows = case_scan.classified(spark.createDataFrame([(k, t) for k, t in enumerate(kinds)], "k int, line string").withColumn("volume", F.lit(1))).orderBy("k").collect()
    assert [r.kind for r in rows] == ["division", "division", "blank", "blank", "division", "text", "blank"]


def test_families_go_outward_from_the_own_era(spark):
    lines = [(200, "the pétitioner."), (300, "the respondeni,"), (600, "the respondent."), (950, "DOE, J., concurring in part"), (300, "DOE, J., concurring in part"), (300, "DOE, J., dissenting:"), (300, "nothing")]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(lines)], "k int, volume int, line string")
    got = df.select("k", *(patterns.fitted(kind, F.col("line"), F.col("volume")).alias(kind) for kind in ("role_end", "opinion"))).orderBy("k").collect()
    assert [r.role_end for r in got] == ["era2", "era2", "era3", None, None, None, None]
    assert [r.opinion for r in got] == [None, None, None, "era5", "era3", "era2", None]
    own = df.select("k", patterns.of_own_era("opinion", F.col("line"), F.when(F.col("volume") == 300, "era2").otherwise("era1")).alias("x")).orderBy("k").collect()
    assert [r.x for r in own] == [False, False, False, True, False, True, False]


def plain_endings(lines, cases):
    out = {}
    for (start, end), following in zip(cases, [*cases[1:], None]):
        moved, order = None, False
        for no in range(following[0], min(following[1], following[0] + 40) + 1) if following else ():
            text = lines.get(no, "")
            if text in ("SYLLABUS", "APPEARANCES OF COUNSEL", "DECISION"):
                break
            if text == "SO ORDERED.":
                order, moved = True, no
            elif text.startswith("WHEREFORE") or order and ("concur" in text or text.startswith("* ")):
                moved = no
        out[start] = moved or end
    return out


def test_displaced_endings(spark):
    draw = random.Random(9)
    words = ["SYLLABUS", "APPEARANCES OF COUNSEL", "DECISION", "SO ORDERED.", "WHEREFORE, it is denied", "Cruz, JJ., concur.", "* designated", "text", "", "text", "text", "text"]
    rows, cases, want = [], [], set()
    for v in ("a", "b"):
        lines = {no: draw.choice(words) for no in range(1, 1500)}
        starts = sorted(draw.sample(range(1, 1500), 60))
        own = list(zip(starts, [*[s - 1 for s in starts[1:]], 1499]))
        rows += [(v, no, text, False) for no, text in lines.items()]
        cases += [(v, *x) for x in own]
        want |= {(v, s, e) for s, e in plain_endings(lines, own).items()}
    df = spark.createDataFrame(rows, "volume string, line_no int, line string, is_noise boolean")
    got = boundaries.displaced_endings(df, spark.createDataFrame(cases, "volume string, start_line int, end_line int"), "volume")
    assert {tuple(r) for r in got.collect()} == want
