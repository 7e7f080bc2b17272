"""The undo stack against a plain one, with the log cut anywhere."""

import random

import pytest

from docloom.operators import undo

SCHEMA = "seq long, kind string, item string, old string, new string"


def plain(log):
    """undone_by of each change, and the statuses left."""
    stack, by, status, known = [], {}, {}, set()
    for seq, kind, item, old, new in sorted((r for r in log if r[0] is not None), key=lambda r: r[0]):
        if kind == "change":
            stack.append((seq, item, old))
            by[seq], status[item] = None, new
        elif kind == "undo" and stack:
            at, of, before = stack.pop()
            by[at], status[of] = seq, before
        elif kind == "save":
            stack = []
    return by, status


def real_log(n, seed, saves):
    """Changes as they are recorded: each with the status that the item had then."""
    rng, log, stack, status = random.Random(seed), [], [], {}
    for seq in range(n):
        mood = (seq // 700) % 2  # long runs of changes, then of undos
        x = rng.random()
        if x < saves:
            log.append((seq * 7 - 500, "save", None, None, None))
            stack = []
        elif x < (0.25 if mood else 0.7):
            item, new = f"i{rng.randint(0, 30)}", rng.choice(["approved", "rejected", "flagged"])
            if status.get(item) != new:
                log.append((seq * 7 - 500, "change", item, status.get(item), new))
                stack.append((item, status.get(item)))
                status[item] = new
        else:
            log.append((seq * 7 - 500, "undo", None, None, None))
            if stack:
                item, old = stack.pop()
                status[item] = old
    return log


@pytest.mark.parametrize("saves, ranges", [(0.0, 1), (0.0, 13), (0.002, 13), (0.05, 40)])
def test_equals_a_plain_stack(spark, saves, ranges):
    log = real_log(10_000, ranges, saves)
    random.Random(1).shuffle(log)
    df = spark.createDataFrame(log, SCHEMA).repartition(5)
    by, status = plain(log)
    got = undo.matched(df, ranges=ranges).collect()
    assert len(got) == len(by) and {r.seq: r.undone_by for r in got} == by
    assert {r.item: r.status for r in undo.statuses(df, ranges).collect()} == status


def test_odd_logs(spark):
    log = [(1, "undo", None, None, None), (2, "change", "a", "x", "y"), (None, "change", "b", None, "z"), (3, "note", "c", None, "q"), (4, "undo", None, None, None), (5, "undo", None, None, None), (6, "change", None, None, "w")]
    df = spark.createDataFrame(log, SCHEMA)
    assert {r.seq: r.undone_by for r in undo.matched(df, ranges=3).collect()} == {2: 4, 6: None}
    assert {r.item: r.status for r in undo.statuses(df, 3).collect()} == {"a": "x", None: "w"}
    assert [r.seq for r in undo.standing(df, 3).collect()] == [6]
    assert undo.matched(df.limit(0)).count() == 0 and undo.statuses(df.limit(0)).count() == 0
