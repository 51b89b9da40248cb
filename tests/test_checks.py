"""Checks that follow changes equal the full checks after every batch, in both directions."""

import random


from tributary.operators.checks import orphan_rows, unique_violations
from tributary.streaming.checks import OrphanCheck, UniqueCheck

CHILD, PARENT, KEYED = "item_id long, venda_id long, v string", "venda_id long", "sku string, v long"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_orphans_follow_children_and_parents(spark, scratch):
    rnd = random.Random(2)
    check = OrphanCheck(spark, scratch("orphans"), "item_id", "venda_id")
    children = {i: (i, rnd.choice([None, *range(12)]), "a") for i in range(30)}
    parents = set(range(0, 12, 2))

    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)
    check.rebuild(frame(children.values(), CHILD), frame([(p,) for p in parents], PARENT), {})
    for day in range(3):
        changed = set(rnd.sample(range(36), 6))
        for i in changed:
            if rnd.random() < .3:
                children.pop(i, None)
            else:
                children[i] = (i, rnd.choice([None, *range(12)]), f"d{day}")
        flips = set(rnd.sample(range(12), 3))
        arrived, left = flips - parents, flips & parents
        parents ^= flips
        known, all_children = frame([(p,) for p in parents], PARENT), frame(children.values(), CHILD)
        for _ in range(2):      # the second time changes nothing
            got = check.apply(frame([(i,) for i in changed], "item_id long"),
                              frame([children[i] for i in changed if i in children], CHILD),
                              lambda keys: known.join(keys, "venda_id", "left_semi"), frame([(p,) for p in arrived], PARENT), {},
                              frame([(p,) for p in left], PARENT), lambda keys: all_children.join(keys, "venda_id", "left_semi"))
            assert _rows(got) == _rows(orphan_rows(all_children, known, "venda_id")), day


def test_duplicates_follow_rows_that_come_and_go(spark, scratch):
    rnd = random.Random(3)
    check = UniqueCheck(spark, scratch("unique"), scratch("counts"), ["sku"])
    rows = [(rnd.choice([None, "a", "b", "c", "d"]), i) for i in range(6)]

    def frame(some):
        return spark.createDataFrame(some, KEYED)
    check.rebuild(frame(rows), {"v": 0})
    for day in range(1, 4):
        gone = rnd.sample(rows, 2)
        came = [(rnd.choice([None, "a", "b", "c", "e"]), 10 * day + i) for i in range(3)]
        rows = [r for r in rows if r not in gone] + came
        for _ in range(2):      # a run that is repeated counts once
            got = check.apply(frame(gone), frame(came), {"v": day})
        assert _rows(got) == _rows(unique_violations(frame(rows), ["sku"])), day
    check.rebuild(frame(rows[:2]), {"v": 9})
    assert _rows(check.apply(frame([]), frame(rows[:1]), {"v": 10})) == _rows(
        unique_violations(frame(rows[:2] + rows[:1]), ["sku"]))
