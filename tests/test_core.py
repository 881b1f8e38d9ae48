"""Operators, sources and sinks outside llm; the registered SQL twins run on the smallest tables."""

import datetime as dt
import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from foliograph.functions import repair
from foliograph.operators import case_scan, lines, records, records_text
from foliograph.operators.windows import Sliding, bounds, windows
from foliograph.plans import casefile, evidence, registry  # noqa: F401
from foliograph.sources import readers, writers
from foliograph.streaming import ingest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows, columns):
    def value(v):
        if isinstance(v, dt.datetime):
            return v.date().isoformat()
        if isinstance(v, float):
            return f"{v:.6g}"
        return str(int(v)) if isinstance(v, bool) else f"{float(v):.6g}" if isinstance(v, int) or type(v).__name__ == "Decimal" else str(v)

    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(value(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_twin(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), names)


def test_null_language_is_a_group(spark, tmp_path):
    texts = [(k, "x" * (4000 if k < 30 else 90000), None if k % 2 == 0 else "en") for k in range(31)]
    rows = spark.createDataFrame([(k, t, lang, len(t)) for k, t, lang in texts], "doc_id long, text string, lang string, n_chars long")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name, n in (("flt14_overflow", 31), ("agg11_length_outliers", 1)):
        got = registry.QUERIES[name](spark, str(tmp_path))
        want = c.execute(registry.ORACLES[name])
        assert plain(got.collect(), got.columns) == plain(rows := want.fetchall(), [d[0] for d in want.description]) and len(rows) == n


def test_entry(spark):
    assert driver.entry(spark).count() > 0 and set(driver.oracle_sql()) <= set(driver.queries())


def one(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "function,text,want",
    [
        (repair.case_number, "G.R. No, 73155", "G.R. No. 73155"), (repair.division, "FIRST DIVISLON", "FIRST DIVISION"), (repair.division, "SECOND DIVISIION", "SECOND DIVISION"),
        (repair.division, "EN BANC", "EN BANC"), (repair.end_mark, "SOORDERED.", "SO ORDERED."), (repair.end_mark, "SO ORDERED,", "SO ORDERED."), (repair.date_text, "May 30. 1986", "May 30, 1986"),
        (repair.date_text, "[986", "1986"), (repair.date_text, "[976", "[976"), (repair.ponente, "PER CURIAM,", "PER CURIAM"), (repair.concur, "JJ., con cur", "JJ., concur"), (repair.flexible_date, "May 2nd, 1986", dt.date(1986, 5, 2)), (repair.flexible_date, "incumbent", None), (repair.clamped_date, "Feb. 30, 1999", dt.date(1999, 2, 28)),
        (repair.concur, "they   con- cur", "they concur"), (repair.title_case, "MELENCIO-HERRERA", "Melencio-Herrera"),
    ],
)
def test_repairs(spark, function, text, want):
    assert one(spark, function, text) == want


def test_window_arithmetic(spark):
    assert Sliding.of(3, 6) == Sliding(1095, 182) and Sliding.of(1, 12) == Sliding(365, 365)
    days = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2000, 3, 1),)], "date date")
    assert windows(bounds(days), Sliding(365, 10)).count() == 0


def test_line_model(spark):
    rows = lines.lines(spark.createDataFrame([("v", "a\r\nbb\rc\n"), ("e", ""), ("n", None)], "k string, text string"), "k").collect()
    assert [(r.line_no, r.start_char, r.line) for r in rows if r.k == "v"] == [(1, 0, "a"), (2, 2, "bb"), (3, 5, "c")]
    assert [r.line for r in rows if r.k in "en"] == ["", ""]


def volume(text):
    return [("v", i + 1, x) for i, x in enumerate(text.split("\n"))]


def test_boundaries(spark):
    body = "\n".join(f"text {k}" for k in range(12))
    text = f"FIRST DIVISION\n\n[G.R. No. 1. May 2, 1990]\n[G.R. No. 2. May 2, 1990]\n{body}\nEN BANC\n" + "x\n" * 12 + f"SECOND DIVISION\n(G.R. No, 3. May 3, 1990)\n{body}\nTHIRD DIVISION\n[G.R. No. 4. May 4, 1990]"
    got = case_scan.boundaries(case_scan.classified(spark.createDataFrame(volume(text), "volume string, line_no int, line string"))).orderBy("start_line").collect()
    assert [len(r.brackets) for r in got] == [2, 1]  # a header without a bracket and a case open at the end are no cases
    assert got[0].start_line == 1 and got[0].end_line == got[1].start_line - 1


@pytest.mark.parametrize("said,kind", [("concur", "concurring"), ("dissents", "dissenting"), ("took no part", "no_part"), ("on leave", "on_leave"), ("on official business", "on_leave"), ("see separate opinion", "other"), ("see dissenting opinion", "dissenting"), ("joins the dissent", "other"), ("inhibited himself", "no_part")])
def test_vote_categories(spark, said, kind):
    assert one(spark, records_text.vote_category, f"Cruz, J., {said}") == kind


@pytest.mark.parametrize(
    "said,want",
    [
        ("Cruz, J., concurs and Reyes, J., dissents.", {("concurring", "Cruz"), ("dissenting", "Reyes")}),
        ("Teehankee, C.J., Yap and J. B. L. Reyes, JJ., concur. Cruz, J., took no part.", {("concurring", "Teehankee"), ("concurring", "Yap"), ("concurring", "J. B. L. Reyes"), ("no_part", "Cruz")}),
        ("Narvasa (Chairman), Gutierrez, Jr., and Paras, JJ., con- cur.", {("concurring", "Narvasa"), ("concurring", "Gutierrez, Jr."), ("concurring", "Paras")}),
        ("Feria, J., on official leave. Yap, J., joins the opinion of Cruz.", {("on_leave", "Feria"), ("other", "Yap"), ("other", "Cruz")}),
        ("", set()), (None, set()),
    ],
)
def test_votes_by_verb(spark, said, want):
    rows = spark.createDataFrame([(1, said)], "k int, raw string")
    assert {(r.category, r.name) for r in records_text.votes_in(rows, "k", "raw").collect()} == want


def test_joined_dissents(spark):
    rows = spark.createDataFrame([(1, "Yap and Cruz, JJ., join the dissenting opinion of Justice Reyes. Paras, J., concurs in Sarmiento's dissent.")], "k int, raw string")
    got = {(r.joiner, r.target) for r in records_text.joined_dissents(rows, "k", "raw").collect()}
    assert {("Yap", "Reyes"), ("Cruz", "Reyes")} <= got and ("Paras", "Sarmiento") in got


def test_fuzzy_by_brute_force(spark):
    from difflib import SequenceMatcher
    import random

    draw = random.Random(6)
    names = sorted({"".join(draw.choice("ABCDE") for _ in range(draw.randint(2, 9))) for _ in range(60)})
    tokens = sorted({"".join(draw.choice("ABCDE") for _ in range(draw.randint(2, 9))) for _ in range(120)} - set(names))
    want = {}
    for t in tokens:
        score, name = max(((SequenceMatcher(None, n, t).ratio(), n) for n in names), key=lambda x: (x[0], [-ord(c) for c in x[1]], -len(x[1])))
        if score >= 0.75:
            want[t] = score
    got = records_text.best_match(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()
    assert {r.token: r.score for r in got} == want


def test_fuzzy(spark):
    names = spark.createDataFrame([("Aquino",), ("Melencio-Herrera",)], "name string")
    tokens = spark.createDataFrame([("AQUINO",), ("Aqvino",), ("Zzz",)], "token string")
    assert {r.token: r.name for r in records_text.best_match(tokens, names).collect()} == {"AQUINO": "Aquino", "Aqvino": "Aquino"}


def test_greedy_spans(spark):
    t = spark.createDataFrame([(1, 0, 10), (1, 8, 20)], "c int, s long, e long")
    g = spark.createDataFrame([(1, 0, 11), (1, 8, 19), (1, 100, 110)], "c int, s long, e long")
    assert sorted((r.s, r.s2) for r in records_text.greedy_spans(t, g, ["c"]).collect()) == [(0, 0), (8, 8)]


def test_merge_prefers_earlier_llm(spark):
    schema = "label string, `group` int, method string, value int"
    previous = spark.createDataFrame([("date", None, "regex", 1, 0), ("parties", None, "llm", 2, 1), ("votes", 1, "regex", 3, 2), ("votes", 1, "regex", 4, 3)], f"{schema}, ord int")
    current = spark.createDataFrame([("date", None, "regex", 10), ("parties", None, "regex", 20)], schema)
    assert {(r.label, r.value) for r in records.merge_keyed(previous, current, ["label", "group"]).collect()} == {("date", 10), ("parties", 2), ("votes", 3)}


def test_dimensions_and_reports(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"description": "d", "justices": ["Cruz", "Yap"]}))
    assert [r.name for r in readers.registry(spark, f"{tmp_path}/r.json").orderBy("ord").collect()] == ["Cruz", "Yap"]
    writers.registry_json(spark.createDataFrame([("yap",), ("Cruz",), ("Yap",)], "name string"), f"{tmp_path}/r2", "d")
    assert [r.name for r in readers.registry(spark, f"{tmp_path}/r2").orderBy("ord").collect()] == ["Cruz", "Yap"]
    (tmp_path / "t.csv").write_text('No.,Name,Birth Year,Death Year,Position,Succeeded,Tenure Start,Tenure End,Tenure Length,Appointed By\n1,A B,1,2,CJ,x,June 15 1901,Incumbent,18 years 302 days,P\n')
    r = readers.terms(spark, f"{tmp_path}/t.csv").first()
    assert (r.start, r.end, r.days, r.appointed_by) == (dt.date(1901, 6, 15), None, 18 * 365 + 302, "P")
    (tmp_path / "pdf").mkdir()
    for name in ("Volume_7.pdf", "Volume_7_searchable.pdf", "Volume_9.pdf"):
        (tmp_path / "pdf" / name).write_bytes(b"x")
    assert [r.name for r in readers.scans(spark, f"{tmp_path}/pdf", 1, 8).collect()] == ["Volume_7.pdf"]
    rows = spark.createDataFrame([(8, "G.R. 1", ["A", "B"]), (7, " ", []), (7, "G.R. 2", [])], "volume int, case_number string, concurring array<string>")
    rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in writers.CASE_COLUMNS if c not in rows.columns])
    writers.case_csv(rows, f"{tmp_path}/cases")
    back = readers.case_csv(spark, f"{tmp_path}/cases").orderBy("volume").collect()
    assert [(r.volume, r.case_number, r.concurring) for r in back] == [("7", "G.R. 2", []), ("8", "G.R. 1", ["A", "B"])]
    text = spark.createDataFrame([("v", k, f"line {k}") for k in range(1, 30)], "volume string, line_no int, line string")
    span = spark.createDataFrame([("v", "c1", "date", 10, 11)], "volume string, case_id string, label string, start_line int, end_line int")
    writers.excerpts_markdown(span, text, f"{tmp_path}/md", 2)
    got = [r.value for r in spark.read.text(f"{tmp_path}/md", wholetext=False).collect()]
    assert "## c1: date" in got and "> line 8" in got and "> line 13" in got and "> line 14" not in got


def test_files(spark, tmp_path):
    for name in ("Volume_7.txt", "vol7.txt", "Volume 8.txt"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("one\ntwo\n")
    assert sorted(r.volume_name for r in readers.volumes(spark, f"{tmp_path}/in").collect()) == ["Volume 8", "Volume_7"]
    query = ingest.ingest_lines(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check")
    query.awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6
    case = {"case_id": "c1", "annotations": [{"label": "date", "text": "x", "start_char": 1, "end_char": 2}], "status": "s", "notes": "confidence: 0.950"}
    (tmp_path / "p.json").write_text(json.dumps({"format_version": 2, "volumes": [{"volume_name": "V", "cases": [case]}]}))
    (tmp_path / "m.json").write_text(json.dumps({"format_version": 2, "volumes": {"V": {"volume": "V", "cases": [case]}}}))
    for mapped, name in ((False, "p"), (True, "m")):
        r = readers.predictions(spark, f"{tmp_path}/{name}.json", mapped).withColumn("confidence", readers.confidence_in(F.col("notes")))
        assert r.first().confidence == 0.95 and r.first().spans[0].label == "date"
    writers.prediction_json(r, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").first().total_cases == 1
    (tmp_path / "c.csv").write_text("﻿volume,case_number,division,date,ponente,votes_raw,concurring\n7,G.R. 1,EN BANC,,X,\"a\nb\",A; B\n", encoding="utf-8")
    assert readers.case_csv(spark, f"{tmp_path}/c.csv").first().concurring == ["A", "B"]


def test_llm_is_apart():
    """Nothing outside llm imports it, but for the driver's entry."""
    from pathlib import Path

    root = Path(driver.__file__).parent / "foliograph"
    outside = [p for p in root.rglob("*.py") if "llm" not in p.parts]
    assert outside and not any(re.search(r"foliograph\.llm|corpus_pipeline", p.read_text()) for p in outside)
