r"""Judging URLs by rules, each indexed by its rarest literal token.

A rule is a pattern over host + path and a verdict. ``*`` stands for anything, ``^`` for a separator or the end, a leading
``||`` for the start of the host or of one of its labels, ``|`` at either side for the start or the end; everything else is
literal. A rule that names a host and the beginning of a path is the pattern ``||host/path``.

The literal tokens of a rule are the runs of letters and digits that the pattern closes on both sides, so a URL that fits
has each of them as a token of its own. Of these the one that the fewest URLs hold (counted by Spark over the whole table)
is the rule's entry in the index; rules without one stand under the empty token, which every URL has. The tokens of a URL
fetch its candidate rules and only those run their regular expressions.

The index is sent to the tasks in slices of at most ``SLICE_BYTES``; a longer list of rules is judged slice by slice, with
the best rule so far carried along, so no list is too long.

Which rule wins: of those with a place (host and path), the longest; without one, of the patterns the one with the highest
priority, then an allowing one before a blocking one, then the longest, then the first in order of text. No rule: allow.

Cases: a null URL or one without ``://`` has an empty host and path, which no rule fits: allow. Repeated rows give repeated
results; columns that aren't asked for, whatever their names, are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import table

#: A token of a rule or URL, in lower case.
TOKEN = r"[a-z0-9]+"
#: Bytes of patterns that are sent to the tasks at once.
SLICE_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``place`` is the host and path of a rule that names them, else None."""

    pattern: str
    verdict: str
    place: str | None = None
    priority: int = 0

    @property
    def rank(self) -> tuple:
        """Compares by which rule wins."""
        return (self.place is not None, self.priority, len(self.place or ""), self.verdict == "allow", len(self.pattern), self.pattern)


def placed(verdict: str, place: str) -> Rule:
    """The rule for ``host/path``: the host, its subdomains, and paths that begin with that path."""
    return Rule(f"||{place}", verdict, place)


#: The five rules of the registered query.
PLACES = [placed("allow", "com/"), placed("block", "example.com/en/"), placed("allow", "www.example.com/en/"), placed("block", "net/es/"), placed("block", "net/fr/")]

#: What the registered query does with URLs that none of them fits: hosts and paths of adverts, tracking, adult and
#: gambling sites and of pages that are not articles. An allowing pattern is an exception to the blocking ones.
PATTERNS = [Rule(p, "block") for p in (
    "||ad.", "||ads.", "||ads-", "||adserver.", "||adservice.", "||banner.", "||banners.", "||doubleclick.", "-ads.", "||track.", "||tracker.", "||tracking.", "-track.", "-tracker.", "||click.", "||pixel.", "||telemetry.",
    "||adult.", "||adult-", "-adult.", "||porn*.", "||sex-", "||sex.", "||xxx.", "||xxx-", "-xxx.", ".xxx/", ".xxx|", "||escort*.", "||casino*.", "-casino.", "||poker.", "||poker-", "||betting.", "||betting-", "||malware.", "||phishing.", "||warez.", "||torrent*.",
    "/wp-login.php|", "/wp-admin/", "/cgi-bin/", "/login^", "/signup^", "/checkout^", "/cart^",
)] + [Rule(p, "allow", priority=1) for p in ("||ads-txt.", "/login-help/", "/poker-rules/")]


def closed_tokens(pattern: str) -> list[str]:
    """Literal tokens that stand by themselves in every URL which fits; ASCII letters in lower case."""
    head = pattern.startswith("|")
    body, tail = pattern.lstrip("|"), pattern.endswith("|") and len(pattern.strip("|")) > 0
    body = body.removesuffix("|") if tail else body
    found = []
    for m in re.finditer(r"[A-Za-z0-9]+", body):
        before = body[m.start() - 1] if m.start() else ("|" if head else "*")
        after = body[m.end()] if m.end() < len(body) else ("|" if tail else "*")
        if "*" not in (before, after):
            found.append(m[0].translate(str.maketrans(UPPER, LOWER)))
    return found


def expression(pattern: str) -> str:
    """Regular expression of a pattern, over host + path; also right in RE2 and Java."""
    body, start, end = pattern, "", ""
    if body.startswith("||"):
        body, start = body[2:], r"^(?:[^/]*\.)?"
    elif body.startswith("|"):
        body, start = body[1:], "^"
    if body.endswith("|"):
        body, end = body[:-1], r"\z"
    parts = {"*": r"[\s\S]*", "^": r"(?:[^A-Za-z0-9_.%-]|\z)"}
    return start + "".join(parts.get(x) or (x if re.match(r"[A-Za-z0-9/_]", x) else f"[{x}]" if x not in "\\^]" else "\\" + x) for x in body) + end


def place_of(url: str) -> dict[str, F.Column]:
    """Columns host and path of the column ``url``."""
    after = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host, path = (F.regexp_extract(after, x, 1) for x in (r"^([^/?#]*)", r"^[^/?#]*([^?#]*)"))
    return {"host": F.translate(host, UPPER, LOWER), "path": path}


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """How many of the rows (host, path) hold each of the given tokens."""
    wanted = urls.sparkSession.createDataFrame([(t,) for t in tokens], "token string")
    held = F.array_distinct(F.regexp_extract_all(F.translate(F.concat("host", "path"), UPPER, LOWER), F.lit(TOKEN), F.lit(0)))
    found = urls.select(F.explode(held).alias("token")).join(F.broadcast(wanted), "token", "left_semi")
    return dict(found.groupBy("token").count().collect())  # a row for each token of a rule at most


def indexed(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """token -> rules that are found by it: each rule by its rarest, the smallest of several; without one by ''."""
    index = defaultdict(list)
    for rule in rules:
        index[min(closed_tokens(rule.pattern), key=lambda t: (counts.get(t, 0), t), default="")].append(rule)
    return dict(index)


def slices(rules: Sequence[Rule]) -> Iterator[list[Rule]]:
    now, size = [], 0
    for rule in rules:
        now.append(rule)
        size += len(rule.pattern.encode()) + 64
        if size >= SLICE_BYTES:
            yield now
            now, size = [], 0
    if now:
        yield now


def _best(df: DataFrame, rules: list[Rule], counts: dict[str, int]) -> DataFrame:
    """``df`` with pattern_, the pattern of the best rule so far, and what is compared of it."""
    index = indexed(rules, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, lower = re.compile(TOKEN), str.maketrans(UPPER, LOWER)
        ready = {t: sorted(((r.rank, re.compile(expression(r.pattern).replace(r"\z", r"\Z")), r) for r in rs), key=lambda x: x[0], reverse=True) for t, rs in index.items()}
        for batch in batches:
            last = [batch.schema.get_field_index(c) for c in ("host", "path", "best_")]
            out = []
            for host, path, best in zip(*(batch.column(i).to_pylist() for i in last)):
                subject = host + path
                rank = Rule(*best.values()).rank if best else None
                for t in {"", *token.findall(subject.translate(lower))} & ready.keys():
                    for own, fits, rule in ready[t]:
                        if rank is not None and own <= rank:
                            break
                        if fits.search(subject):
                            rank, best = own, {"pattern": rule.pattern, "verdict": rule.verdict, "place": rule.place, "priority": rule.priority}
                            break
                out.append(best)
            columns = batch.columns
            columns[last[2]] = pa.array(out, batch.schema.field(last[2]).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(run, df.schema)


def judge(df: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, pattern, verdict) of every row: rule is the host and path of the rule that decides, if it has any."""
    slim = df.select(F.col(key).alias("key_"), F.col(url).cast("string").alias("url_"))
    rows = slim.select("key_", *(c.alias(n) for n, c in place_of("url_").items()), F.lit(None).cast("struct<pattern: string, verdict: string, place: string, priority: int>").alias("best_"))
    tokens = sorted({t for r in rules for t in closed_tokens(r.pattern)})
    counts = token_counts(rows, tokens) if tokens else {}
    for part in slices(rules):
        rows = _best(rows, part, counts)
    return rows.select(F.col("key_").alias(key), "host", "path", F.col("best_.place").alias("rule"), F.col("best_.pattern").alias("pattern"), F.coalesce("best_.verdict", F.lit("allow")).alias("verdict"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), PLACES + PATTERNS).drop("pattern")


def _sql() -> str:
    rows = ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" if x is not None else "NULL" for x in (r.place, r.pattern, r.verdict, expression(r.pattern))) + f", {r.priority})" for r in PLACES + PATTERNS)
    return f"""
    WITH rules(place, pattern, verdict, expression, priority) AS (VALUES {rows}),
    cut AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    urls AS (SELECT DISTINCT host, path FROM parts),
    fits AS (
        SELECT host, path, place, verdict, row_number() OVER (PARTITION BY host, path ORDER BY place IS NOT NULL DESC, priority DESC, coalesce(length(place), 0) DESC, verdict = 'allow' DESC, length(pattern) DESC, pattern DESC) AS k
        FROM urls, rules
        WHERE CASE WHEN place IS NOT NULL THEN (host = split_part(place, '/', 1) OR ends_with(host, '.' || split_part(place, '/', 1))) AND starts_with(path, substr(place, strpos(place, '/'))) ELSE regexp_matches(host || path, expression) END
    )
    SELECT p.page_id, p.host, p.path, f.place AS rule, coalesce(f.verdict, 'allow') AS verdict
    FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path AND f.k = 1
    """


SQL = _sql()
