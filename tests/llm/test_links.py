"""URL rules, token alignment and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from foliograph.llm import _common, alignment, prefix_trie, url_rules
from foliograph.llm.bpe_dp import byte_symbols
from foliograph.llm.url_rules import PATTERNS, PLACES, Rule, closed_tokens, expression, indexed, judge, placed


def plainly_judged(url):
    """(host, path, rule, verdict) by the places alone; verdict None where none of them fits."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in PLACES if (host == (h := r.place.split("/")[0]) or host.endswith("." + h)) and path.startswith(r.place[len(h) :])]
    best = max(fits, key=lambda r: len(r.place), default=None)
    return host, path, best and best.place, best and best.verdict


@pytest.fixture(scope="module")
def urls():
    draw = random.Random(2)
    parts = ["http://", "https://", "www.", "example", ".com", "com", "net", ".", "/", "en/", "es/", "fr/", "?", "#", "x", "EXAMPLE", "Com", "/en/", "://", "é", "\n", "ads-", "xxx"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 9))) for _ in range(1500)]
    fixed = [None, "", "example.com/en/", "http://example.com/en/", "http://WWW.Example.com/en/x", "http://a.net/fr/?q", "http://net", "http://notexample.com/en/", "http://example.com:80/en/", "http://x.org/?http://example.com/en/", "http://a.net/ES/"]
    return fixed + made + fixed


def test_places(spark, urls):
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, host string")
    rows = judge(df, PLACES + PATTERNS).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(urls)))
    for r in rows:
        host, path, rule, verdict = plainly_judged(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict), urls[r.page_id]


def test_patterns_run_only_where_needed_but_miss_none(spark, urls, monkeypatch):
    rules = [*PLACES, *PATTERNS, Rule("||x*xxx|", "block"), Rule("/en/^", "allow", priority=3), Rule("|example.", "block"), Rule("es", "block", priority=2), placed("block", "é.com/")]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.pattern, r.verdict) for r in judge(df, rules).collect()}
    for k, url in enumerate(urls):
        host, path, _, _ = plainly_judged(url)
        best = max((r for r in rules if re.search(expression(r.pattern).replace(r"\z", r"\Z"), host + path)), key=lambda r: r.rank, default=None)
        assert got[k] == ((best.place, best.pattern, best.verdict) if best else (None, None, "allow")), url
    monkeypatch.setattr(url_rules, "SLICE_BYTES", 150)
    assert {r.page_id: (r.rule, r.pattern, r.verdict) for r in judge(df, rules).collect()} == got


def test_index_takes_the_rarest_closed_token(spark):
    assert closed_tokens("||ads.example.com/a*b/c^") == ["ads", "example", "com", "c"]
    assert closed_tokens("||casino*.") == [] and closed_tokens(".xxx|") == ["xxx"] and closed_tokens("||net/fr/") == ["net", "fr"]
    index = indexed([Rule("||a.b.c^", "block"), Rule("||q*", "block")], {"a": 5, "b": 2, "c": 9})
    assert {t: [r.pattern for r in rs] for t, rs in index.items()} == {"b": ["||a.b.c^"], "": ["||q*"]}
    df = spark.createDataFrame([(1, "http://a.b/c/c"), (2, "http://B.q"), (3, None)], "page_id long, url string")
    assert url_rules.token_counts(df.select(*(c.alias(n) for n, c in url_rules.place_of("url").items())), ["b", "c", "z"]) == {"b": 2, "c": 1}


def test_no_pages_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    assert judge(df.where("false"), PLACES).count() == 0
    assert judge(df, []).first().verdict == "allow"


def plainly_aligned(rows):
    left = Tokenizer.from_file(public_tokenizers.path(alignment.SIDE_A))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SIDE_B))
    byte_of = {s: b for b, s in byte_symbols().items()}
    own, counts = [], Counter()
    for key, text in rows:
        a, b = (left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)) if text else ([], [])
        bytes_a = [bytes(byte_of[c] for c in left.id_to_token(i)) for i in a]
        pieces = [right.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            own.append((key, 0, 0, [], []))
            continue
        ends = []
        for side in (bytes_a, bytes_b):
            at, found = 0, {}
            for k, x in enumerate(side):
                at += len(x)
                found[at] = k + 1
            ends.append(found)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            i2, j2 = ends[0][end], ends[1][end]
            groups.append(f"{','.join(map(str, a[i:i2]))}|{','.join(map(str, b[j:j2]))}")
            links.append((a[i2 - 1], b[j2 - 1]))
            i, j = i2, j2
        counts.update(links)
        own.append((key, len(a), len(b), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(k, a, b, ";".join(g), len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls)) for k, a, b, g, ls in own]


def aligned_rows(df):
    got = alignment.scored(_common.stored(alignment.align(df)))
    assert got.where("n_groups <> n_links").count() == 0
    return sorted((tuple(r) for r in got.select("doc_id", "n_a", "n_b", "groups", "n_links", "n_best", "count_sum").collect()), key=str)


def test_alignment_is_brute_force(spark, docs, empty):
    draw = random.Random(1)
    parts = ["a", "b", "The", " ", "  ", "\n", " \n", "\t", "é", "é", "漢字", "　", "\xa0", "😀", "<|endoftext|>", "<s>", "▁", "'s", "12", "\x00", "\x1c", "\x85", "ſ", "<0x41>", "!", "​", " the", "\r\n"]
    rows = [(k, "".join(draw.choices(parts, weights=[4] * 8 + [1] * (len(parts) - 8), k=draw.randint(0, 14)))) for k in range(1200)]
    rows += [(-1, None), (-2, ""), (-3, "a b ") , (-4, " a"), (-4, " a"), (None, "no id"), (-5, "x" * 30_000 + " y")]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n_a long")
    assert aligned_rows(df) == sorted(plainly_aligned(rows), key=str)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert aligned_rows(docs) == sorted(plainly_aligned(rows), key=str)
    assert aligned_rows(empty) == []


def test_heavy_pairs_and_others_are_joined_alike(docs, monkeypatch):
    want = aligned_rows(docs)
    for bound in (1, 3, 100_000):
        monkeypatch.setattr(_common, "HEAVY", bound)
        assert aligned_rows(docs) == want


def test_forgetful_workers(docs, monkeypatch):
    own = alignment.sides(alignment.SIDE_A, alignment.SIDE_B)
    texts = [r.text for r in docs.collect()]
    want = own.aligned(texts)
    for name, value in (("REMEMBERED", 0), ("LONGEST", 2), ("BATCH_BYTES", 40)):
        monkeypatch.setattr(alignment, name, value)
        assert own.aligned(texts) == want


def test_overlaps():
    first, last = alignment.overlaps([0, 3, 5], [3, 5, 9], [0, 2, 5], [2, 5, 9])
    assert list(zip(first.tolist(), last.tolist())) == [(0, 1), (1, 1), (2, 2)]


def plain_trie(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conv[c].append((turn is not None, turn or 0, role or "", text or ""))
    conv = {c: [x[2:] for x in sorted(turns)] for c, turns in conv.items()}
    made = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        made[c] = conv.get(base, [])[:h] + own[h:]
    held = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            held[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(p[:-1] for p in held if p), Counter(), Counter()
    for p, cs in held.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    ends = lambda p, cs: hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(made[c]) == len(p)).encode()).hexdigest()
    return sorted(((min(cs), len(p), min(held[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], ends(p, cs)) for p, cs in held.items()), key=str)


@pytest.fixture(scope="module")
def turns():
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "bé", None])) for c in range(-130, 320) if c != 200 and draw.random() > 0.1 for t in range(draw.choice([0, 1, 2, 3, 7, 9]))]
    rows += [(c, t + 20, "user", "x") for c in (5, 100, 305) for t in range(90)]  # longer than a chunk
    rows += [(c, None, "system", "first") for c in (7, 8)] + [(None, 1, "user", "q"), (7, 50, "user", "z"), (7, 50, "user", "z")]
    rows += [(1000 + c, t, "user", f"same {t}") for c in (0, 1, 2) for t in range(4)]
    return rows


def trie_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, conv long")
    return sorted((tuple(r) for r in prefix_trie.trie(df.repartition(3)).collect()), key=str)


def test_trie_is_brute_force(spark, turns, monkeypatch):
    want = plain_trie(turns)
    assert trie_rows(spark, turns) == want
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "SPAN", 2)
    monkeypatch.setattr(_common, "HEAVY", 2)
    assert trie_rows(spark, turns) == want


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_rows(spark, []) == []
    rows = [(c, 0, "u", "t") for c in (1, 2, 3, 201, 202)]
    assert trie_rows(spark, rows) == plain_trie(rows)
    assert trie_rows(spark, [(None, 0, "u", "t")]) == []
