"""Changes of spans against plain loops."""

import random

from foliograph.operators import span_changes


def plain(before, after):
    out = [("exact", *x, *x[1:]) for x in before & after]
    gone, new = before - after, after - before
    old_places, new_places = {x[1:] for x in gone}, {x[1:] for x in new}
    out += [("label_changed", *x, *x[1:]) for x in gone if x[1:] in new_places]
    free = sorted(x for x in new if x[1:] not in old_places)
    for label, s, e in sorted(x for x in gone if x[1:] not in new_places):
        near = [x for x in free if x[0] == label and abs(x[1] - s) <= span_changes.NEAR]
        best = min(near, key=lambda x: (abs(x[1] - s), x[1:]), default=None)
        if best:
            free.remove(best)
        out.append(("span_adjusted" if best else "removed", label, s, e, *(best[1:] if best else (None, None))))
    return sorted([*out, *(("added", x[0], None, None, *x[1:]) for x in free)], key=str)


def test_five_way(spark):
    draw, sides = random.Random(41), {}
    for case in range(50):
        make = lambda: {(draw.choice(["date", "votes"]), s := draw.choice([0, 100, 199, 200, 350, 401, 900]), s + draw.choice([5, 9])) for _ in range(draw.randint(0, 7))}
        sides[case] = (make(), make())
    frames = [spark.createDataFrame([(c, *x) for c, pair in sides.items() for x in pair[k]], "case_id int, label string, s int, e int") for k in (0, 1)]
    rows = span_changes.five_way(*frames).collect()
    for case, pair in sides.items():
        assert sorted(((r.kind, r.label, r.s, r.e, r.s2, r.e2) for r in rows if r.case_id == case), key=str) == plain(*pair)
    assert span_changes.five_way(frames[0].where("false"), frames[1].where("false")).count() == 0
