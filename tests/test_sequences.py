from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

from conftest import table

from cartwise.operators import sequence
from cartwise.windows import Suffixes, WindowSpec

END = datetime(2024, 1, 11)
W = WindowSpec(datetime(2024, 1, 1), END)


def brute_dwell(rows, key, gap):
    times = defaultdict(set)
    for r in rows:
        times[key(r)].add(r[2])
    out = {}
    for k, ts in times.items():
        ts = sorted(ts)
        steps = [(b - a).total_seconds() for a, b in zip(ts, ts[1:])]
        out[k] = 1 + int(sum(s for s in steps if s <= gap))
    return out


def brute_runs(rows):
    rows = sorted((r[0], r[2], r[1]) for r in rows)
    ends = Counter()
    for i, (user, _, item) in enumerate(rows):
        last = i + 1 == len(rows) or rows[i + 1][0] != user or rows[i + 1][2] != item
        if last:
            ends[(user, item)] += 1
    return dict(ends)


def random_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        t = END - timedelta(seconds=rng.choice([rng.randrange(1, 200), rng.randrange(1, 9 * 86400)]))
        item = rng.randrange(6)
        rows.append((rng.randrange(5), item, t, rng.randrange(1, 7), 8 if item < 3 else 5))
    return rows


def test_dwell_edges(make_log):
    log = make_log(
        [
            (1, 1, "2024-01-05 10:00:00", 1),
            (1, 1, "2024-01-05 10:03:00", 1),  # exactly 180 s later: counted
            (1, 1, "2024-01-05 10:06:01", 1),  # 181 s later: not counted
            (2, 1, "2024-01-05 10:00:00", 1),  # a single moment
            (3, 1, "2024-01-05 10:00:00", 1),
            (3, 2, "2024-01-05 10:00:00", 1),  # same moment twice
        ]
    )
    got = {u: r["dwell"] for u, r in table(sequence.dwell(log, W, ["user_id"])).items()}
    assert got == {1: 181, 2: 1, 3: 1}


def test_dwell_and_runs_match_brute_force(make_log):
    for seed in (1, 2):
        rows = random_rows(seed)
        log = make_log(rows)
        got = table(sequence.dwell(log, W, ["user_id", "cate"], 300), ["user_id", "cate"])
        assert {k: r["dwell"] for k, r in got.items()} == brute_dwell(rows, lambda r: (r[0], r[4]), 300)
        runs = table(sequence.visit_runs(log, W), ["user_id", "sku_id"])
        assert {k: r["runs"] for k, r in runs.items()} == brute_runs(rows)
        in_cate = [r for r in rows if r[4] == 8]
        runs = table(sequence.visit_runs(log, W, 8), ["user_id", "sku_id"])
        assert {k: r["runs"] for k, r in runs.items()} == brute_runs(in_cate)


def test_ties_inside_a_second(make_log):
    log = make_log(
        [
            (1, 1, "2024-01-05 10:00:00", 1),
            (1, 2, "2024-01-05 10:00:00", 1),
            (1, 2, "2024-01-05 10:00:05", 1),  # continues item 2
            (1, 2, "2024-01-05 10:00:05", 6),
            (1, 1, "2024-01-05 10:00:09", 1),
        ]
    )
    runs = table(sequence.visit_runs(log, W), ["user_id", "sku_id"])
    assert {k: r["runs"] for k, r in runs.items()} == {(1, 1): 2, (1, 2): 1}


def test_multi_window_pass_matches_separate_windows(make_log):
    rows = random_rows(7)
    log = make_log(rows)
    s = Suffixes.days(END, (1, 3, 7))
    block = table(sequence.user_sequence_block(log, s, 8, 300, burst_label="7d"))
    pair_dwell = table(sequence.dwell_multi(log, s, ["user_id", "sku_id"], 300), ["user_id", "sku_id"])
    pair_runs = table(sequence.visit_runs_multi(log, s), ["user_id", "sku_id"])
    for label, seconds in s.spans:
        part = [r for r in rows if r[2] >= END - timedelta(seconds=seconds)]
        cate = [r for r in part if r[4] == 8]
        by_user, by_cate = (brute_dwell(p, lambda r: r[0], 300) for p in (part, cate))
        runs, cate_runs = Counter(), Counter()
        for (user, _), n in brute_runs(part).items():
            runs[user] += n
        for (user, _), n in brute_runs(cate).items():
            cate_runs[user] += n
        for user, row in block.items():
            assert row[f"dwell_{label}"] == by_user.get(user)
            assert row[f"cate_dwell_{label}"] == by_cate.get(user)
            assert row[f"runs_{label}"] == runs.get(user)
            assert row[f"cate_runs_{label}"] == cate_runs.get(user)
        expected = brute_dwell(part, lambda r: (r[0], r[1]), 300)
        assert {k: r[f"dwell_{label}"] for k, r in pair_dwell.items() if r[f"dwell_{label}"]} == expected
        assert {k: r[f"runs_{label}"] for k, r in pair_runs.items() if r[f"runs_{label}"]} == brute_runs(part)
    week = [r for r in rows if r[2] >= END - timedelta(days=7)]
    moments = Counter((r[0], r[2]) for r in week)
    for user, row in block.items():
        own = [n for (u, _), n in moments.items() if u == user]
        assert row["max_burst"] == max(own)
        assert abs(row["mean_burst"] - sum(own) / len(own)) < 1e-9


def test_window_groups_are_bounded_by_seconds(make_log):
    """A hot user's repeats collapse before ordering: the ordered rows are distinct seconds."""
    rows = [(1, i % 50, END - timedelta(seconds=1 + i % 20), 1) for i in range(4000)]
    moments = sequence.user_moments(make_log(rows), Suffixes.days(END, (1,)), 8)
    assert moments.count() == 20
