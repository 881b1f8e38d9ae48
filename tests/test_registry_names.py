"""Names against a registry and registry names against persons, by the sequential rules."""

import random
import re
from collections import Counter
from difflib import SequenceMatcher

from foliograph.operators import records_text, registry_names

REGISTRY = ["TEEHANKEE", "ABAD SANTOS", "ABAD", "MELENCIO-HERRERA", "GUTIERREZ, JR.", "DAVIDE, JR.", "REYES", "REYES, JR.", "CARPIO MORALES", "CARPIO", "PLANA", "ALAMPAY", "FERNAN", "LOPEZ"]
ALIASES = [("SANTIAGO", "PLANA")]


class Plain:
    def __init__(self, registry):
        self.names, self.exact, last = [x.upper() for x in registry], {}, Counter()
        for n in self.names:
            self.exact[n] = n
            self.exact[re.sub(registry_names.SUFFIX, "", n).strip()] = n
            if len(n.split()) > 1 and len(w := n.split()[-1].rstrip(".,")) > 2:
                last[w] += 1
        for n in self.names:
            w = n.split()[-1].rstrip(".,")
            if len(n.split()) > 1 and last[w] == 1 and w not in self.exact:
                self.exact[w] = n

    def match(self, token):
        up = token.strip().upper()
        if len(up) < 2:
            return None, 0.0
        for key in (dict(ALIASES).get(up), up, up + ", JR.", up + ", SR."):
            if key in self.exact:
                return self.exact[key], 1.0
        best, name = 0.0, None
        for n in self.names:
            for form in (n, re.sub(registry_names.SUFFIX, "", n).strip()):
                if (r := SequenceMatcher(None, form, up).ratio()) > best:
                    best, name = r, n
        return (name, best) if best >= registry_names.LEAST else (None, 0.0)

    def pick(self, tokens):
        out, lost, i = [], [], 0
        while i < len(tokens):
            pair, score2 = self.match(f"{tokens[i]} {tokens[i + 1]}") if i + 1 < len(tokens) else (None, 0.0)
            name, score = self.match(tokens[i])
            if pair and score2 >= score:
                out.append(pair)
                i += 2
                continue
            parts = [self.match(w)[0] for w in (x.strip(" .,;:-*'\"") for x in tokens[i].split()) if len(w) > 1 and w not in records_text.NO_VOTERS] if not name and len(tokens[i].split()) > 1 else []
            if name:
                out.append(name)
            elif any(parts):
                out += [p for p in parts if p]
            elif re.search("[A-Z]", tokens[i]) and len(tokens[i]) > 2 and tokens[i].upper() not in {x.upper() for x in records_text.NO_VOTERS}:
                lost.append(tokens[i])
            i += 1
        return out, lost


def test_names_are_picked_as_by_the_sequential_rule(spark):
    draw, plain, rows = random.Random(11), Plain(REGISTRY), []
    words = ["Teehankee", "Teehankce", "Abad", "Santos", "Abad Santos", "Herrera", "Melencio-Herrera", "Gutierrez", "Gutierrez, Jr.", "Davide", "Reyes", "Reyes, Jr.", "Carpio", "Morales", "Plana Alampay", "Fernan Acting", "Santiago", "Zzyzx", "of the", "Lope", "Lopez", "X", "Planas", "Alampay Fernan Qwx"]
    for k in range(120):
        rows.append((k, [draw.choice(words) for _ in range(draw.randint(0, 6))]))
    registry = spark.createDataFrame(list(enumerate(REGISTRY)), "ord int, name string")
    aliases = spark.createDataFrame(ALIASES, "alias string, name string")
    found = registry_names.picked(spark.createDataFrame(rows, "k int, tokens array<string>"), ["k"], registry, aliases).collect()
    for k, tokens in rows:
        own = sorted((r.pos, r.name) for r in found if r.k == k and not r.unmatched)
        assert ([n for _, n in own], [r.name for r in sorted(found, key=lambda r: r.pos) if r.k == k and r.unmatched]) == plain.pick(tokens), tokens


def test_name_blocks(spark):
    raw = ["Teehankee (Chairman), Melencio-Herrera, Plana, and Gutierrez, Jr., JJ., concur.", "Abad Santos, J., took no part. Reyes, J., dissents.", "Fernan Alampay, JJ., concur; Nobody, J., on leave.", None]
    registry = spark.createDataFrame(list(enumerate(REGISTRY)), "ord int, name string")
    found = registry_names.named_votes(spark.createDataFrame(list(enumerate(raw)), "k int, raw string"), "k", "raw", registry).collect()
    got = {k: {(r.category, r.name) for r in found if r.k == k} for k in range(4)}
    assert got[0] == {("concurring", n) for n in ("TEEHANKEE", "MELENCIO-HERRERA", "PLANA", "GUTIERREZ, JR.")}
    assert got[1] == {("no_part", "ABAD SANTOS"), ("dissenting", "REYES, JR.")} and got[3] == set()  # the later of two names has the shared key
    assert got[2] == {("concurring", "FERNAN"), ("concurring", "ALAMPAY"), ("unmatched", "Nobody")}


def plain_persons(registry, persons, overrides):
    def words(x):
        return [w for w in re.sub(r"(?i)\b[JS]R\b", " ", re.sub(r"[.,\-]", " ", x)).upper().split()]

    claimed, out = set(), set()
    for name in sorted(registry, key=lambda n: -len(words(n))):
        fixed = [p for n, p in overrides if n == name and p in persons]
        if fixed:
            claimed |= set(fixed)
            out |= {(name, p) for p in fixed}
            continue
        fits = []
        for p in persons:
            own = set(words(p)) | set(p.upper().split())
            if p not in claimed and (not re.search(r"(?i)\bjr\b", name) or re.search(r"(?i)\bjr\b", p)) and all(any(x.startswith(w) for x in words(p)) if len(w) == 1 else w in own for w in words(name)):
                fits.append(p)
        out |= {(name, p) for p in fits}
        if len(fits) == 1:
            claimed.add(fits[0])
    return out


def test_persons_of_registry_names(spark):
    persons = ["Claudio Teehankee", "Vicente Abad Santos", "Roberto A. Abad", "Hugo Gutierrez, Jr.", "Jose Gutierrez", "Andres Reyes, Jr.", "Jose C. Reyes, Jr.", "Ruben Reyes", "Mario Lopez", "Jhosep Lopez", "Conchita Carpio-Morales", "Antonio Carpio", "Ameurfina Melencio-Herrera", "Arturo Brion", "Manuel Briones"]
    registry = ["TEEHANKEE", "ABAD", "ABAD SANTOS", "GUTIERREZ", "GUTIERREZ, JR.", "A. REYES, JR.", "J. REYES, JR.", "REYES", "M. LOPEZ", "LOPEZ", "CARPIO", "CARPIO MORALES", "MELENCIO-HERRERA", "BRION", "BRIONES", "NOBODY", "SANTOS"]
    overrides = [("BRION", "Arturo Brion"), ("BRION", "Manuel Briones"), ("BRIONES", "Manuel Briones"), ("ABAD", "Roberto A. Abad"), ("NOBODY", "Not A Person")]
    frames = (spark.createDataFrame(list(enumerate(registry)), "ord int, name string"), spark.createDataFrame([(p,) for p in persons], "person string"))
    given = spark.createDataFrame(overrides, "name string, person string")
    assert {tuple(r) for r in registry_names.registry_persons(*frames, given).collect()} == plain_persons(registry, persons, overrides)
    assert {tuple(r) for r in registry_names.registry_persons(*frames).collect()} == plain_persons(registry, persons, [])
    assert registry_names.registry_persons(frames[0].where("false"), frames[1]).count() == 0
