"""Span matching by label against a plain reading of the rules."""

import random

from foliograph.operators import span_scores

KINDS = "case_id int, label string, ord int, grp int, s int, e int"


def iou(a, b):
    both = max(0, min(a[2], b[2]) - max(a[1], b[1]))
    either = a[2] - a[1] + b[2] - b[1] - both
    return both / either if either else 0.0


def plain(truth, guess, label):
    """Spans are (grp, s, e) in order; set of (s, e, s2, e2)."""
    left, out = list(range(len(guess))), []

    def take(a, allowed):
        best = max((j for j in left if allowed(a, guess[j])), key=lambda j: (iou(a, guess[j]), -order[j]), default=None)
        if best is None or iou(a, guess[best]) == 0:
            return False
        left.remove(best)
        out.append((*a[1:], *guess[best][1:]))
        return True

    enough = lambda a, b: iou(a, b) >= 0.8
    order = {j: j for j in range(len(guess))}
    if label in span_scores.GROUPED:
        seen = list(dict.fromkeys(a[0] for a in truth))
        truth = sorted(truth, key=lambda a: seen.index(a[0]))
        truth = [a for a in truth if not take(a, lambda a, b: a[0] == b[0] and enough(a, b))]
    order = {j: k for k, j in enumerate(sorted(range(len(guess)), key=lambda j: guess[j][1]))}
    for a in sorted(truth, key=lambda a: a[1]):
        if not take(a, (lambda a, b: iou(a, b) > 0) if label in span_scores.POSITIONS else enough):
            out.append((*a[1:], None, None))
    return sorted([*out, *((None, None, *guess[j][1:]) for j in left)], key=str)


def test_matches_and_scores(spark):
    draw, sides = random.Random(31), {}
    for case in range(60):
        for label in ("date", "parties", "case_number", "start_of_case"):
            make = lambda: [(draw.choice([0, 1, 2, None]), s, s + draw.choice([0, 10, 11, 12])) for s in (draw.randint(0, 40) for _ in range(draw.randint(0, 6)))]
            sides[case, label] = (make(), make())
    frames = [spark.createDataFrame([(c, label, k, *x) for (c, label), pair in sides.items() for k, x in enumerate(pair[side])], KINDS) for side in (0, 1)]
    found = span_scores.matches(*frames, ["case_id"]).cache()
    rows = found.collect()
    for (case, label), (truth, guess) in sides.items():
        got = sorted(((r.s, r.e, r.s2, r.e2) for r in rows if (r.case_id, r.label) == (case, label)), key=str)
        assert got == plain(truth, guess, label), (truth, guess, label)
    for r in span_scores.label_scores(found, ["label"]).collect():
        own = [x for (c, label), pair in sides.items() if label == r.label for x in plain(*pair, label)]
        tp, fp, fn = sum(x[0] is not None and x[2] is not None for x in own), sum(x[0] is None for x in own), sum(x[2] is None for x in own)
        assert (r.tp, r.fp, r.fn) == (tp, fp, fn) and abs(r.f1 - 2 * tp / (2 * tp + fp + fn)) < 1e-4
    assert span_scores.matches(frames[0].where("false"), frames[1].where("false"), ["case_id"]).count() == 0
