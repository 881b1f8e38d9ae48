"""Boundaries of cases as a scan over all volumes' lines that is cut anywhere and joined again.

Lines are dealt by range of volume and number, so a piece is a share of all lines and a volume of any length is spread.
A piece doesn't know in which state it begins: it reads its lines from the idle state, and from each other state only
until that run meets the first one, a few lines on. The driver joins the pieces' transitions in order (one row for each
piece and state), and only what was found from the state that a piece truly began in counts.

The rules: a division header waits for a bracket in the next ``BRACKET_WITHIN`` lines. Brackets in the ``MORE_WITHIN`` lines
after that join the case; the first line of text behind those settles it, and is read again as a possible header. What
is still open at a volume's end is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions.patterns import BRACKETS, LINES, fitted, normal_division
from foliograph.operators.steps import tabled

BRACKET_WITHIN, MORE_WITHIN = 11, 10
#: States: idle, waiting for a bracket since so many lines, open since so many lines after its first bracket.
IDLE = (0, 0)
STATES = [IDLE, *((1, n) for n in range(BRACKET_WITHIN)), *((2, n) for n in range(MORE_WITHIN + 1))]
SCHEMA = "piece long, volume {kind}, entry int, exit int, start long, line_no long, bracket string, settled boolean, at long, goes_on int"


def classified(lines: DataFrame, line: str = "line", volume: str = "volume") -> DataFrame:
    """``kind`` of each line (division, bracket, blank, text; page marks and running titles count as blank) and family.

    The family is the first era, in the order for the volume, whose pattern fits a division or bracket.
    """
    c = F.col(line)
    number = F.regexp_extract(F.col(volume).cast("string"), r"\d+", 0).try_cast("int")  # volumes may have names
    division, bracket = fitted("division", normal_division(c), number), fitted("bracket", c, number)
    noise = c.rlike(r"^\s*$") | c.rlike(LINES["page"]) | c.rlike(LINES["volume"])
    kind = F.when(noise, "blank").when(division.isNotNull(), "division").when(bracket.isNotNull(), "bracket").otherwise("text")
    return lines.withColumns({"kind": kind, "family": F.when(~noise, F.coalesce(division, bracket))})


def bracket_parts(bracket: Column) -> tuple[Column, Column]:
    """(number, date) of a bracket, by the first of the patterns that fits."""
    pick = lambda k: F.coalesce(*[F.when(bracket.rlike(p), F.trim(F.regexp_extract(bracket, p, k))) for p in BRACKETS])
    return pick(1), pick(2)


def step(state: tuple[int, int], kind: str) -> tuple[tuple[int, int], str]:
    """The state after a line and what the line did: "start", "join" or "settle" (and then perhaps starts), or nothing."""
    mode, waited = state
    if mode == 2:
        if kind == "bracket" and waited < MORE_WITHIN:
            return (2, waited + 1), "join"
        if kind == "blank" or waited < MORE_WITHIN:
            return (2, min(waited + 1, MORE_WITHIN)), ""
        return ((1, 0), "settle start") if kind == "division" else (IDLE, "settle")
    if mode == 1:
        if kind == "bracket":
            return (2, 0), "join"
        return ((1, waited + 1), "") if waited + 1 < BRACKET_WITHIN else (IDLE, "")
    return ((1, 0), "start") if kind == "division" else (IDLE, "")


class _Piece:
    """The runs through one piece's lines of one volume; ``first`` if the volume may have begun before the piece."""

    def __init__(self, volume, first: bool):
        self.volume = volume
        #: entry state -> (state now, line that its case began at, or None if that was before the piece)
        self.runs = {s: (s, None) for s in (STATES if first else [IDLE])}
        self.met: dict[tuple[int, int], tuple[tuple[int, int], int]] = {}  # runs that go on as another one after a line
        self.events: list[tuple] = []

    def read(self, no: int, kind: str, text: str | None) -> None:
        if kind == "text" and len(self.runs) == 1 and self.runs.get(IDLE, ("",))[0] == IDLE:
            return
        now: dict[tuple, tuple[int, int]] = {}
        for entry, (state, start) in list(self.runs.items()):
            state, did = step(state, kind)
            if did.startswith("settle"):
                self.events.append((entry, None, start, None, None, True, no, None))
            if did.endswith("start"):
                start = no
            elif did == "join":
                self.events.append((entry, None, start, no, text, False, no, None))
            elif state == IDLE:
                start = None
            self.runs[entry] = (state, start)
            # a run that is idle, or whose case began in this piece, goes on like any other in its place
            if state == IDLE or start is not None:
                if (state, start) in now:
                    self.met[entry] = now[state, start], no
                    del self.runs[entry]
                else:
                    now[state, start] = entry

    def exits(self) -> Iterator[tuple]:
        """A row for each entry state: its exit, or the run that it goes on as and since when."""
        for entry, (state, start) in self.runs.items():
            yield entry, STATES.index(state), start, None, None, None, None, None
        for entry, (other, at) in self.met.items():
            yield entry, -1, None, None, None, None, at, STATES.index(other)


def boundaries(lines: DataFrame, volume: str = "volume", pieces: int | None = None) -> DataFrame:
    """(volume, start_line, end_line, brackets) of the cases of each volume, from lines (volume, line_no, kind, line).

    ``pieces`` is the number of ranges that lines are dealt to, by default that of shuffle partitions.
    """
    spark = lines.sparkSession
    kind = lines.schema[volume].dataType.simpleString()
    sent = lines.select(volume, F.col("line_no").cast("long").alias("line_no"), "kind", F.when(F.col("kind") == "bracket", F.col("line")).alias("bracket"))
    dealt = sent.repartitionByRange(pieces or int(spark.conf.get("spark.sql.shuffle.partitions")), volume, "line_no").sortWithinPartitions(volume, "line_no")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, now, own = TaskContext.get().partitionId(), None, None
        names = ["piece", volume, "entry", "exit", "start", "line_no", "bracket", "settled", "at", "goes_on"]
        types = [pa.int64(), None, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int32()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*((number, v, STATES.index(entry), *rest) for v, entry, *rest in rows))) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t or own) for c, t in zip(columns, types)], names)

        for b in batches:
            out, own = [], b.column(0).type
            for v, no, k, text in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or v != now.volume:
                    if now is not None:
                        out += [(now.volume, *x) for x in (*now.events, *now.exits())]
                    now = _Piece(v, first=now is None)
                now.read(no, k, text)
            if now is not None:
                out += [(now.volume, *x) for x in now.events]
                now.events = []
            yield batch(out)
        if now is not None:
            yield batch([(now.volume, *x) for x in now.exits()])

    found = tabled(dealt.mapInArrow(scan, SCHEMA.replace("volume ", f"`{volume}` ").format(kind=kind)))
    # the volumes that a piece begins or ends with can reach into another piece; all others are whole
    ends = found.where("exit IS NOT NULL").groupBy("piece").agg(F.min(volume).alias("lo"), F.max(volume).alias("hi"))
    border = F.col(volume).eqNullSafe(F.col("lo")) | F.col(volume).eqNullSafe(F.col("hi"))
    after: dict[tuple, dict[int, tuple]] = {}
    for r in found.where("exit IS NOT NULL").join(F.broadcast(ends), "piece").where(border).select("piece", volume, "entry", "exit", "start", "at", "goes_on").collect():
        after.setdefault((r["piece"], r[volume] is not None, r[volume]), {})[r["entry"]] = r
    entered, state, start, before = [], 0, None, ()
    for piece, known, v in sorted(after):
        runs = after[piece, known, v]
        if (known, v) != before:
            state, start = 0, None
        run, since = runs[state], None
        entered.append((piece, v, state, start, since))
        while run["goes_on"] is not None:
            since = run["at"]
            run = runs[run["goes_on"]]
            entered.append((piece, v, run["entry"], start, since))
        start = (run["start"] if run["start"] is not None else start) if run["exit"] else None
        state, before = run["exit"], (known, v)
    taken = spark.createDataFrame(entered, f"piece long, `{volume}` {kind}, entry int, carried long, since long")
    events = found.where("exit IS NULL")
    inner = events.join(F.broadcast(taken.select("piece", volume).distinct()), ["piece", volume], "left_anti").withColumn("carried", F.lit(None).cast("long"))
    outer = events.join(F.broadcast(taken), ["piece", volume, "entry"]).where("since IS NULL OR at > since").drop("since")
    events = inner.unionByName(outer).select(volume, F.coalesce("start", "carried").alias("start"), "line_no", "bracket", "settled")
    listed = F.transform(F.sort_array(F.collect_list(F.when(F.col("line_no").isNotNull(), F.struct("line_no", "bracket")))), lambda x: x["bracket"])
    cases = events.groupBy(volume, F.col("start").alias("start_line")).agg(listed.alias("brackets"), F.max("settled").alias("settled")).where("settled")
    return _with_ends(cases, lines, volume)


def _with_ends(cases: DataFrame, lines: DataFrame, volume: str) -> DataFrame:
    """Cases end before the next one of their volume, the last with its volume; a volume's cases are far fewer than its lines."""
    from pyspark.sql import Window

    last = lines.groupBy(volume).agg(F.max("line_no").cast("long").alias("last"))
    following = F.lead("start_line").over(Window.partitionBy(volume).orderBy("start_line"))
    ended = cases.withColumn("next", following - 1).join(last, volume)
    return ended.select(volume, F.col("start_line").cast("int").alias("start_line"), F.coalesce("next", "last").cast("int").alias("end_line"), "brackets")
