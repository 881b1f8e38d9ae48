"""Personal data and secrets replaced by surrogates of the same kind.

Each entity found gets a keyed replacement that keeps its kind and format: digits stay digits, letters keep their
case and script, separators stay where they are, numbers with a check digit keep it valid or invalid, first names
keep their gender, initials stay initials, country codes stay. The replacement is a keyed permutation of all values of that format, so the same value is replaced
alike everywhere (coreference) and different values differently. Names are replaced word by word, and a surname that a
document holds in a name is replaced wherever else it stands in that document, so a surname alone follows the full name.
What follows a first name is a surname only if the document doesn't speak against it: it isn't a word of ``PLAIN``, isn't
written small in the document, doesn't stand after an article there. Otherwise it stays, wherever it stands; after a title
it is replaced there alone. Names without a title are found by the first names of ``FIRST`` only. A run of digits is a
card number only if its check digit is right. IPv6 addresses of under four digits (loopback and
the like) are nobody's and stay.

Collision checks run over the corpus's different values: a surrogate that is itself a value of the corpus, or that two
values share, is drawn again for the later of them. Where a format has so few values that ``DRAWS`` draws don't help,
its values keep their first draw, which is a permutation and so keeps them apart; surnames get longer with each draw
instead. So this ends. The few values that were drawn again go to the tasks as a broadcast of ``EXCEPTIONS`` at most;
beyond that they are joined to their documents by key.

Values are compared, and counted as one, in a normal form: digits of a number, lower case of an address. A null text
stays null, an empty one empty; repeated rows are replaced alike; all other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm._common import durable, table

#: A placeholder for tests; ``spark.foliograph.surrogateKey`` or an argument gives the secret. Who has it can undo the surrogates.
KEY = b"surrogate-key"
#: Draws before a value goes back to its first one; values drawn again that are broadcast at most (about 100 bytes each).
DRAWS, EXCEPTIONS = 6, 200_000

GROUP = "[0-9A-Fa-f]{1,4}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: First names by script and gender, from common names that are no common words.
FIRST = {
    ("latin", "m"): "James John Robert Michael William David Richard Joseph Thomas Charles Pierre Jacques Philippe Nicolas Hans Klaus Jürgen Wolfgang Stefan Carlos Javier Miguel Antonio Francisco Peter Martin Daniel Georg José Pedro Luis Juan Alejandro Laurent Thierry Olivier".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Margaret Sophie Isabelle Nathalie Brigitte Ursula Sabine Heike Petra Claudia Carmen Lucía Dolores Francisca Teresa Maria María Anna Ana Laura Julia Ángela Camille Élise Monika Karin Angela".split(),
    ("cyrillic", "m"): "Иван Сергей Андрей Дмитрий Алексей Николай Михаил Владимир".split(),
    ("cyrillic", "f"): "Ольга Елена Наталья Татьяна Ирина Светлана Екатерина Людмила".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fo ga go ha he ho ka ke ko la le lo ma me mo na ne no pa pe po ra".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за зе зо ка ке ко ла ле ло ма ме мо на не но па пе по ра".split(),
}
TITLES = r"Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra"
UPPER, LOWER = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
#: Smith, McDonald, O'Brien, Smith-Jones.
_PART = rf"(?:[{UPPER}]['’])?(?:[{UPPER}][{LOWER}]+)+"
#: Le Guin, van der Berg, de la Cruz; small ones that also mean "from" are no part of a name.
PARTICLE = r"(?:(?:[Vv]an|[Vv]on|Le|La|De|Du|Des|Di|Da|Del|Della|El|Al|Bin|Ibn|Ter|Ten|bin|ibn|dos|das|del|ter|ten)|(?:[Vv]an|[Vv]on)\ de[nr]|[Dd]e\ l(?:a|os|as))"
SURNAME = rf"(?:{PARTICLE}\ )?{_PART}(?:-{_PART})?"
PARTICLES = set("van von le la de du des di da del della el al bin ibn ter ten dos das den der los las".split())
#: Words after which no surname stands, and words that may begin a sentence or clause after a first name.
ARTICLES = set("the a an der die das den dem des ein eine einen einem einer eines le la les un une des el los las unos unas lo il i gli".split())
PLAIN = ARTICLES | set(
    "and or but if when while as after before because so then there here this that these those he she it we you they his her its our their who which what where how why not no yes is was are were has had have will would can could may "
    "today yesterday tomorrow now later soon however meanwhile also only even still in on at by for from with to of "
    "und oder aber wenn als nachdem bevor weil so dann dort hier dieser diese dieses jener er sie es wir ihr ihre sein seine wer was wo wie warum nicht kein keine ja nein ist war sind waren hat hatte wird kann heute gestern morgen jetzt später bald doch auch nur noch im in am an bei für von mit zu aus nach über "
    "et ou mais si quand lorsque comme après avant parce alors ici ce cette ces il elle nous vous ils elles son sa ses qui que quoi où comment pourquoi pas non oui est était sont aujourd hier demain maintenant puis aussi dans sur par pour avec chez "
    "y o pero cuando mientras como después antes porque entonces aquí este esta estos él ella nosotros ellos su sus quien que donde cómo no sí es era son hoy ayer mañana ahora luego también en por para con desde".split()
)
#: Country codes of one and two digits; all others have three.
SHORT_CODES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
INITIAL = rf"(?:[{UPPER}]\.|[B-HJ-Z])"
GIVEN = "|".join(sorted((n for names in FIRST.values() for n in names), key=len, reverse=True))

#: Kinds in order of precedence where they start at the same place.
ENTITY = re.compile(
    rf"""
      (?P<email>(?<![\w.+%-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)
    | (?P<ip>(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d))
    | (?P<ipv6>(?<![\w:])(?:(?:{GROUP}:){{7}}{GROUP}|(?:{GROUP}:){{1,6}}(?::{GROUP}){{1,6}}|(?:{GROUP}:){{1,7}}:|::(?:{GROUP}:){{0,6}}{GROUP})(?![\w:]))
    | (?P<iban>\b[A-Z]{{2}}\d{{2}}(?:\ ?[A-Z0-9]{{4}}){{3,7}}(?:\ ?[A-Z0-9]{{1,3}})?\b)
    | (?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
    | (?P<card>(?<![\d.])\d(?:[\ -]?\d){{12,18}}(?!\d))
    | (?P<phone>(?<![\w.+])(?:\+\d{{1,3}}[\ .-]?\(?\d{{2,4}}\)?(?:[\ .-]?\d{{2,4}}){{2,4}}|\(\d{{3}}\)\ ?\d{{3}}[\ .-]\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}
        |(?:1\ )?[2-9]\d{{2}}\ [2-9]\d{{2}}\ \d{{4}}(?!\ ?\d)|(?=(?:\ ?\d){{9,12}}(?!\ ?\d))0\d{{1,4}}(?:\ \d{{2,4}}){{2,4}})(?!\w))
    | (?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b)
    | \b(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*["']?(?P<secret>[A-Za-z0-9+/_.~-]{{6,}})
    | \b(?:{TITLES})\.?\ (?P<titled>(?:{INITIAL}\ )*{SURNAME}(?:(?:\ {INITIAL})*\ {SURNAME})?)
    | \b(?P<name>(?:{GIVEN})(?:\ {INITIAL})*\ {SURNAME})
    """,
    re.X,
)
#: What a text must hold for ``ENTITY`` to find anything.
HINT = re.compile(rf"[@\d]|::|(?i:passw|pwd|secret|token|key)|\b(?:{TITLES}|{GIVEN})\b")
DIGITS, SMALL, LARGE, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def permute(value: int, size: int, tweak: str, key: bytes) -> int:
    """Keyed permutation of range(size): a Feistel network over enough bits, walked until it lands inside."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for turn in range(8):
            word = hashlib.shake_256(b"%s|%s|%d|%d|%s" % (key, tweak.encode(), size.bit_length(), turn, right.to_bytes(width, "big"))).digest(width)
            left, right = right, left ^ (int.from_bytes(word, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def alike(text: str, tweak: str, key: bytes, hexadecimal: bool = False) -> str:
    """Another text of the same format: each digit, small and capital letter changes within its kind."""
    if hexadecimal:
        kinds = [HEX if c in HEX else "" for c in text]
    else:
        kinds = [DIGITS if c in DIGITS else SMALL if c in SMALL else LARGE if c in LARGE else "" for c in text]
    value, size = 0, 1
    for c, k in zip(text, kinds):
        if k:
            value, size = value * len(k) + k.index(c), size * len(k)
    value = permute(value, size, tweak + re.sub(r"[A-Za-z0-9]", "x", text), key)
    out = []
    for c, k in zip(reversed(text), reversed(kinds)):
        if k:
            value, at = divmod(value, len(k))
            c = k[at]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """Check digit that makes ``digits`` followed by it valid."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def normal(kind: str, found: str) -> str:
    """The value that stands for all spellings of an entity."""
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", found)
    if kind == "phone":
        digits = re.sub(r"\D", "", found)
        code = next((digits[:k] for k in (1, 2) if digits[:k] in SHORT_CODES), digits[:3]) if found[0] == "+" else ""
        # numbers of the North American plan are the same with and without their code
        return f"+{code} {digits[len(code):]}" if code and (code != "1" or len(digits) != 11) else digits[-10:]
    if kind == "email":
        return found.lower()
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(found))
    return found.replace(" ", "") if kind == "iban" else found


def _iban_check(body: str) -> str:
    """Check digits of country + body, given as body followed by the country."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body) + '00') % 97:02d}"


def surrogate(kind: str, value: str, attempt: int, key: bytes = KEY) -> str:
    """Replacement of a normal value; ``attempt`` draws another one."""
    tweak = f"{kind}{attempt}"
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels, _, top = domain.rpartition(".")
        got = alike(f"{local}@{labels}", tweak + top, key)
        return f"{got}.{top}"
    if kind == "ip":
        n = int.from_bytes(bytes(map(int, value.split("."))), "big")
        for first, bits in ((10 << 24, 24), (172 << 24 | 16 << 16, 20), (192 << 24 | 168 << 16, 16), (127 << 24, 24)):
            if n >> bits == first >> bits:
                return ".".join(map(str, (first | permute(n & (1 << bits) - 1, 1 << bits, f"{tweak}{first}", key)).to_bytes(4, "big")))
        while True:  # stay among public addresses
            n = permute(n, 1 << 32, tweak, key)
            if 0 < n >> 24 < 224 and not any(n >> b == f >> b for f, b in ((10 << 24, 24), (172 << 24 | 16 << 16, 20), (192 << 24 | 168 << 16, 16), (127 << 24, 24))):
                return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "card":
        head, check = value[:-1], int(value[-1])
        got = value[0] + alike(head[1:], tweak + value[0], key)
        return got + str((luhn(got) + check - luhn(head)) % 10)
    if kind == "phone" and value[0] == "+":
        code, _, rest = value.partition(" ")
        return f"{code} {rest[:1]}{alike(rest[1:], tweak + code + rest[:1], key)}"
    if kind == "phone":
        got = value
        while True:
            got = "0" + alike(got[1:], tweak, key) if value[0] == "0" else alike(got, tweak, key)
            if len(got) < 10 or got[0] not in "01" and got[3] not in "01" or value[0] in "01" or value[3] in "01":
                return got
    if kind == "key":
        return value[:4] + "".join(_spell(permute(int(value[4:], 36), 36**16, tweak, key), 16))
    if kind == "iban":
        got = alike(value[4:], tweak + value[:2], key)
        return value[:2] + _iban_check(got + value[:2]) + got
    if kind == "ipv6":
        got = value
        while True:
            got = alike(got, tweak, key, True)
            if str(ipaddress.IPv6Address(got)) == got:
                return got
    if kind == "secret":
        return alike(value, tweak, key, all(c in HEX for c in value))
    if kind == "given_initial":
        letters = next(x for x in INITIALS if value in x)
        return letters[permute(letters.index(value), len(letters), tweak + letters[0], key)]
    if kind.startswith("given"):
        names = FIRST[script(value), kind[-1]]
        return names[permute(names.index(value), len(names), tweak, key)]
    if kind == "surname":
        parts = SYLLABLES[script(value)]
        number = int.from_bytes(hashlib.shake_256(b"%s|%s|%s" % (key, tweak.encode(), value.encode())).digest(40), "big")
        got = ""
        for _ in range(5 + attempt):  # longer with each draw, so that there are always enough
            number, k = divmod(number, len(parts))
            got += parts[k]
        return got.capitalize()
    return alike(value, tweak, key)


def _spell(n: int, size: int) -> list[str]:
    out = []
    for _ in range(size):
        n, d = divmod(n, 36)
        out.append((DIGITS + LARGE)[d])
    return out[::-1]


#: Every letter that can be an initial is in one of these.
INITIALS = [LARGE, "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7), "".join(chr(c) for c in range(0x410, 0x430)) + "Ё"]
GENDER = {n: g for (_, g), names in FIRST.items() for n in names}


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, normal value) of each entity, in text order and without overlap; names word by word."""
    if not HINT.search(text):
        return
    found = list(_matched(text))
    surnames = {value for _, _, kind, value in found if kind in ("surname", "titled")}
    if not surnames:
        yield from found
        return
    surnames -= _refuted(text, surnames, {start for start, _, kind, _ in found if kind in ("surname", "titled")})
    # a word that is no surname stays, but for where a title says that it is one
    found = [(s, e, "surname" if kind == "titled" else kind, value) for s, e, kind, value in found if kind != "surname" or value in surnames]
    bare = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(surnames, key=len, reverse=True)))})(?!\w)") if surnames else None
    at = 0
    for one in [*found, (len(text), len(text), "", "")]:
        for m in bare.finditer(text, at, one[0]) if bare else ():  # a boundary is looked for in the text as a whole
            if m.end() < one[0] or not text[m.end() : m.end() + 1].isalnum():
                yield m.start(), m.end(), "surname", m[0]
        if one[2]:
            yield one
        at = one[1]


def _refuted(text: str, words: set[str], named: set[int]) -> set[str]:
    """Those of ``words`` that the text uses as common words; ``named`` are the places where they stand in a name."""
    small = {w.lower(): w for w in words}
    out, before = {w for w in words if w.lower() in PLAIN}, ""
    for m in re.finditer(r"\w+", text):
        word = m[0]
        if word in small:
            out.add(small[word])
        elif before in ARTICLES and word in words and m.start() not in named:
            out.add(word)
        before = word.lower()
    return out


def _matched(text: str) -> Iterator[tuple[int, int, str, str]]:
    """What ``ENTITY`` finds and its checks leave."""
    for m in ENTITY.finditer(text):
        kind = m.lastgroup
        start, end = m.span(kind)
        if kind in ("titled", "name"):
            for w in re.finditer(r"[^\s.-]+", m[kind]):
                word = w[0]
                if word.lower() not in PARTICLES:
                    yield start + w.start(), start + w.end(), f"given_{GENDER[word]}" if word in GENDER else "given_initial" if len(word) == 1 else "titled" if kind == "titled" else "surname", word
        elif kind == "card":
            value = normal(kind, m[kind])
            if luhn(value[:-1]) == int(value[-1]):
                yield start, end, kind, value
        elif kind == "iban":
            value = normal(kind, m[kind])
            if 15 <= len(value) <= 34 and value[2:4] == _iban_check(value[4:] + value[:2]):
                yield start, end, kind, value
        elif kind == "ipv6":
            try:
                value = normal(kind, m[kind])
            except ValueError:
                continue
            if sum(c in HEX for c in value) >= 4:
                yield start, end, kind, value
        else:
            yield start, end, kind, normal(kind, m[kind])


def dressed(kind: str, found: str, new: str) -> str:
    """The new value in the spelling of the one found: its separators and capitals."""
    if kind in ("card", "ssn", "phone", "iban"):
        new = new.partition(" ")[2] if new[0] == "+" else new  # the country code stays
        at = len(new)
        out = list(found)
        for k in range(len(found) - 1, -1, -1):
            if found[k].isalnum() and at:
                at -= 1
                out[k] = new[at]
        return "".join(out)
    if kind == "email" and not found.islower():
        return new.upper() if found.isupper() else "".join(n.upper() if f.isupper() else n for f, n in zip(found, new))
    if kind == "ipv6":
        if "::" not in found:
            groups = ipaddress.IPv6Address(new).exploded.split(":")
            new = ":".join(groups if re.search(r"\b0\w", found) else (g.lstrip("0") or "0" for g in groups))
        return new.upper() if found.isupper() else new
    return new


@lru_cache(200_000)
def _first_draw(kind: str, value: str, key: bytes) -> str:
    return surrogate(kind, value, 0, key)


def replaced(text: str | None, key: bytes, again: dict[tuple[str, str], int]) -> tuple[str | None, int]:
    """(text with surrogates, number of entities); ``again``: attempts of the values that were drawn again."""
    if not text:
        return text, 0
    out, at, n = [], 0, 0
    for start, end, kind, value in entities(text):
        attempt = again.get((kind, value), 0)
        new = surrogate(kind, value, attempt, key) if attempt else _first_draw(kind, value, key)
        out += [text[at:start], dressed(kind, text[start:end], new)]
        at, n = end, n + 1
    out.append(text[at:])
    return "".join(out), n


#: Rows of which a task holds the texts and their surrogates at once.
ROWS = 500


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, so that a worker never holds thousands of texts twice."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def redrawn(docs: DataFrame, text: str, key: bytes) -> DataFrame:
    """(kind, value, attempt) of the corpus's values whose first surrogate collides."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            got = {(kind, value) for t in batch.column(0).to_pylist() if t for _, _, kind, value in entities(t)}
            kinds, values = ([g[k] for g in got] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([surrogate(k, v, a, key) for k, v, a in zip(kinds, values, attempts)], pa.string())], ["kind", "value", "attempt", "new"])

    kinds = "kind string, value string, attempt int, new string"
    values = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(find, "kind string, value string").distinct()
    now = durable(values.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(draw, kinds).withColumn("firm", F.lit(False)))
    own = now.select("kind", F.col("value").alias("new"))
    finite = F.col("kind").startswith("given")  # first names permute among themselves
    while True:
        open_ = now.where(~finite)
        shared = open_.groupBy("kind", "new").agg(F.count("*").alias("n"), F.min(F.struct(~F.col("firm"), "value"))["value"].alias("first")).where("n > 1")
        taken = open_.where("NOT firm").join(own, ["kind", "new"], "left_semi").select("kind", "value")
        bad = durable(taken.union(open_.join(shared, ["kind", "new"]).where("value <> first AND NOT firm").select("kind", "value")).distinct())
        if bad.isEmpty():
            return now.where("attempt > 0").select("kind", "value", "attempt")
        more = (F.col("attempt") < DRAWS) | (F.col("kind") == "surname")
        new = now.join(bad, ["kind", "value"], "left_semi").select("kind", "value", F.when(more, F.col("attempt") + 1).otherwise(0).cast("int").alias("attempt"), (~more).alias("firm"))
        drawn = new.drop("firm").mapInArrow(draw, kinds).join(new.select("kind", "value", "firm"), ["kind", "value"])
        now = durable(now.join(bad, ["kind", "value"], "left_anti").select("kind", "value", "attempt", "new", "firm").union(drawn.select("kind", "value", "attempt", "new", "firm")))


def with_surrogates(docs: DataFrame, key_column: str = "doc_id", text: str = "text", key: bytes = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; ``count`` names a column to add for their number."""
    columns = docs.columns
    number, again = (_free(columns, c) for c in ("n", "again"))
    exceptions = redrawn(docs, text, key)
    few = exceptions.limit(EXCEPTIONS + 1).collect()  # bounded
    shared = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in few} if len(few) <= EXCEPTIONS else None)
    joined = docs if len(few) <= EXCEPTIONS else _with_exceptions(docs, key_column, text, exceptions, again)
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = batch.column(at).to_pylist()
            if shared.value is not None:
                got = [replaced(t, key, shared.value) for t in texts]
            else:
                got = [replaced(t, key, {(x["kind"], x["value"]): x["attempt"] for x in a or ()}) for t, a in zip(texts, batch.column(len(columns)).to_pylist())]
            out = list(batch.columns[: len(columns)])
            out[at] = pa.array([g[0] for g in got], pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array([g[1] for g in got], pa.int64())], [*columns, number])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    done = joined.mapInArrow(run, f"{kinds}, `{number}` bigint")
    return done.withColumnRenamed(number, count) if count else done.select(*[F.col(f"`{c}`") for c in columns])


def _free(columns: list[str], name: str) -> str:
    """A name for a working column that none of ``columns`` has."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def _with_exceptions(docs: DataFrame, key_column: str, text: str, exceptions: DataFrame, again: str) -> DataFrame:
    """``docs`` with ``again``: for each row's key, the values in such rows that were drawn again."""
    key = _free([*docs.columns, again], "key")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(i, kind, value) for i, t in zip(batch.column(0), batch.column(1).to_pylist()) if t for kind, value in {x[2:] for x in entities(t)}]
            yield pa.RecordBatch.from_arrays([pa.array([g[0].as_py() for g in got], batch.column(0).type), *[pa.array([g[k] for g in got], pa.string()) for k in (1, 2)]], ["_key", "kind", "value"])

    kind = docs.schema[key_column].dataType.simpleString()
    where = docs.select(F.col(key_column).alias("_key"), F.col(text).cast("string").alias("t")).mapInArrow(find, f"_key {kind}, kind string, value string")
    each = where.join(exceptions, ["kind", "value"]).groupBy(F.col("_key").alias(key)).agg(F.collect_set(F.struct("kind", "value", "attempt")).alias(again))
    return docs.join(each, docs[key_column].eqNullSafe(each[key]), "left").drop(key)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_surrogates(docs, key=spark.conf.get("spark.foliograph.surrogateKey", KEY.decode()).encode(), count="n_replaced")
