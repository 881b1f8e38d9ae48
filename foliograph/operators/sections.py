"""Sections of a case: parties, syllabus, counsel, author, decision, votes, opinions.

What each line looks like is found by column expressions. A case becomes one row with the flags of its lines as bits, in
order, and a function reads such rows in batches. A case is a few thousand lines at most, so rows don't grow with the
collection.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.functions.fields import era
from foliograph.functions.patterns import flags

# Lines of votes by era and other limits, in lines that are not blank.
VOTE_LINES, VOTE_LINES_ERA2 = 15, 30
AUTHOR_WITHIN, COUNSEL_WITHIN, CLOSING_WITHIN, NEAR = 5, 30, 20, 3
SCHEMA = "label string, start_line int, end_line int"


class _Case:
    """The lines of one case, by place; each method finds the places of one section."""

    def __init__(self, no: list[int], size: list[int], bits: list[int], kinds: list[str]):
        self.no, self.size = no, size
        self.is_ = {kind: [b >> k & 1 for b in bits] for k, kind in enumerate(kinds)}
        self.n = len(no)

    def first(self, kind: str, since: int = 0, until: int | None = None) -> int | None:
        return next((i for i in range(since, self.n if until is None else until) if self.is_[kind][i]), None)

    def solid(self, since: int, until: int) -> list[int]:
        return [i for i in range(since, until) if not self.is_["blank"][i]]

    def parties(self) -> tuple[int, int] | None:
        """From the first line after the brackets to the second party's role, or to what surely isn't parties."""
        brackets = [i for i in range(self.n) if self.is_["bracket"][i]]
        rest = self.solid(brackets[-1] + 1, self.n) if brackets else []
        roles, versus, last = 0, False, None
        for i in rest:
            if any(self.is_[k][i] for k in ("syllabus", "doc_type", "counsel")) or roles and versus and self.is_["footnote"][i]:
                break
            last = i
            versus |= self.is_["versus"][i] or self.is_["versus_inside"][i]
            roles += self.is_["role_end"][i]
            if self.is_["role_twice"][i] or roles >= 2 or versus and self.is_["role_end"][i]:
                break
        return None if last is None else (rest[0], last)

    def counsel(self) -> tuple[int, int] | None:
        """After the header: to the document's type, two blank lines after a party was named, or the limit."""
        head = self.first("counsel")
        if head is None:
            return None
        named, last, seen = False, None, 0
        for i in range(head + 1, self.n):
            if any(self.is_[k][i] for k in ("doc_type", "syllabus", "ponente", "per_curiam")) or seen >= COUNSEL_WITHIN:
                break
            if self.is_["blank"][i]:
                if named and i + 1 < self.n and self.is_["blank"][i + 1]:
                    break
                continue
            if named and self.size[i] > 200 and not self.is_["for_party"][i]:
                break
            named |= self.is_["for_party"][i]
            last, seen = i, seen + 1
        return None if last is None else (self.solid(head + 1, last + 1)[0], last)

    def author(self, doc_type: int) -> int | None:
        near = self.solid(doc_type + 1, self.n)[:AUTHOR_WITHIN]
        return next((i for i in near if self.is_["ponente"][i] or self.is_["per_curiam"][i]), None)

    def closing(self, since: int, until: int) -> int | None:
        """The last line of the decision: the last order; else votes shortly after a closing; else the last line."""
        orders = [i for i in range(since, until) if self.is_["so_ordered"][i]]
        if orders:
            return orders[-1]
        closings = [i for i in range(since, until) if self.is_["wherefore"][i]]
        for i in reversed(closings):
            vote = next((j for j in range(i + 1, min(until, i + 1 + CLOSING_WITHIN)) if self.is_["vote"][j]), None)
            if vote is not None:
                return self.solid(i, vote)[-1]
        rest = self.solid(since, until)
        return rest[-1] if rest else None

    def votes(self, since: int, until: int, most: int) -> tuple[int, int] | None:
        """Lines on votes after the decision; two blank lines, a footnote or other matter end them."""
        found: list[int] = []
        for i in range(since, until):
            if self.is_["blank"][i]:
                if found and i + 1 < until and self.is_["blank"][i + 1]:
                    break
                continue
            if self.is_["no_vote"][i] or self.is_["footnote"][i] or len(found) >= most:
                break
            found.append(i)
        while found and not self.is_["vote"][found[-1]] and self.size[found[-1]] >= 50:
            found.pop()  # what trails behind the votes is a short rest of them, or none
        return (found[0], found[-1]) if any(self.is_["vote"][i] for i in found) else None

    def opinions(self, since: int) -> list[tuple[int, int]]:
        """Separate opinions: a header and its attribution right after it are one start; each ends before the next."""
        starts: list[int] = []
        for i in range(since, self.n):
            if self.is_["opinion"][i] and (not starts or len(self.solid(starts[-1], i)) > NEAR):
                starts.append(i)
        return [(s, self.solid(s, e)[-1]) for s, e in zip(starts, [*starts[1:], self.n])]

    def sections(self, era2: bool) -> list[tuple[str, int, int]]:
        out: list[tuple[str, int, int]] = []

        def put(label: str, place: tuple[int, int] | int | None) -> None:
            if place is not None:
                a, b = place if isinstance(place, tuple) else (place, place)
                out.append((label, self.no[a], self.no[b]))

        put("division", self.first("division"))
        for i in range(self.n):
            if self.is_["bracket"][i]:
                put("case_number", i)
        put("parties", self.parties())
        syllabus, kind = self.first("syllabus"), self.first("doc_type")
        if syllabus is not None:
            stop = min(x for x in (self.first("counsel", syllabus), kind if kind is not None and kind > syllabus else None, self.n) if x is not None)
            lines = self.solid(syllabus + 1, stop)
            put("syllabus", (lines[0], lines[-1]) if lines else None)
        put("counsel", self.counsel())
        put("doc_type", kind)
        if kind is None:
            return out
        author = self.author(kind)
        put("ponente", author)
        body = self.solid((author if author is not None else kind) + 1, self.n)
        if not body:
            return out
        opinions = self.opinions(body[0])
        end = self.closing(body[0], opinions[0][0] if opinions else self.n)
        put("decision", (body[0], end) if end is not None else None)
        if end is not None:
            put("votes", self.votes(end + 1, opinions[0][0] if opinions else self.n, VOTE_LINES_ERA2 if era2 else VOTE_LINES))
        for place in opinions:
            put("opinion", place)
        return out


def sections(lines: DataFrame, volume: str = "volume", case: str = "case_id") -> DataFrame:
    """(volume, case, label, start_line, end_line) of each case's sections, from its lines (line_no, line).

    Page marks and running titles are left out first. A case without lines has no sections.
    """
    found = flags(F.col("line"), era(F.col(volume)))
    left_out = [found.pop(f"is_{kind}") for kind in ("page", "volume")]
    kinds = [name.removeprefix("is_") for name in found]
    bits = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(found.values())), F.lit(0)).cast("long")
    marked = lines.where(~left_out[0] & ~left_out[1]).select(volume, case, F.struct(F.col("line_no").cast("long").alias("no"), F.coalesce(F.length("line"), F.lit(0)).alias("size"), bits.alias("bits")).alias("x"))
    whole = marked.groupBy(volume, case).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    whole = whole.select(volume, case, (era(F.col(volume)) == "era2").alias("second"), *[F.col(f"xs.{c}").alias(c) for c in ("no", "size", "bits")])
    names = ["label", "start_line", "end_line"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = [], []
            for i, (second, no, size, bits) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(2, 6)))):
                own = _Case(no, size, bits, kinds).sections(bool(second))
                rows += own
                places += [i] * len(own)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (pa.string(), pa.int32(), pa.int32()))]
            keys = [batch.column(k).take(pa.array(places, pa.int64())) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*keys, *columns], [volume, case, *names])

    keys = ", ".join(f"`{c}` {lines.schema[c].dataType.simpleString()}" for c in (volume, case))
    return whole.mapInArrow(read, f"{keys}, {SCHEMA}")
