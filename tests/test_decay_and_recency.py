from __future__ import annotations

import random
from datetime import datetime, timedelta

from conftest import table

from cartwise.operators import decay, recency
from cartwise.schema import TIME_DECAY, USERS
from cartwise.windows import WindowSpec

END = datetime(2024, 1, 11)
W = WindowSpec(datetime(2024, 1, 1), END)


def brute_curve(rows, buyers, hours):
    shares = []
    for h in range(1, hours + 1):
        users = {r[0] for r in rows if r[4] == 8 and max(W.start, END - timedelta(hours=h)) <= r[2] < END}
        shares.append(len(users & buyers) / len(users) if users else None)
    known = [s for s in shares if s is not None]
    low, high = min(known), max(known)
    return [None if s is None else (s - low) / (high - low) for s in shares]


def test_curve_matches_hourly_scans(spark, make_log):
    rng = random.Random(3)
    rows = [
        (rng.randrange(40), 1, END - timedelta(seconds=rng.randrange(3 * 3600, 5 * 86400)), 1, rng.choice([8, 5]))
        for _ in range(150)
    ]
    rows.append((1, 1, END - timedelta(hours=7), 1, 8))  # exactly on an hour
    buyers = {1, 4, 9, 17, 30, 77}
    frame = spark.createDataFrame([(b,) for b in buyers], "user_id long")
    got = {r.time_dist: r.weight for r in decay.decay_curve(make_log(rows), W, frame, 8, 100).collect()}
    expected = brute_curve(rows, buyers, 100)
    assert len(got) == 100
    for h, want in enumerate(expected, 1):
        assert (got[h] is None) == (want is None)
        assert want is None or abs(got[h] - want) < 1e-12


def test_decayed_counts_and_the_hour_beyond_the_curve(spark, make_log):
    curve = spark.createDataFrame([(1, 1.0), (2, 0.5)], TIME_DECAY)
    log = make_log(
        [
            (1, 1, END - timedelta(seconds=3599), 1),  # hour distance 1
            (1, 1, END - timedelta(seconds=3600), 1),  # hour distance 2
            (1, 1, END - timedelta(hours=2), 2),  # beyond the curve
        ]
    )
    got = table(decay.decayed_counts(log, W, curve, ["user_id"]))[1]
    assert got["decay_1"] == 1.5 and got["decay_2"] == 0.0 and got["decay_4"] == 0.0
    assert table(decay.decayed_totals(log, W, curve, ["user_id"]))[1]["total_decay"] == 1.5


def test_fitted_curve_equals_lazy_curve(spark, make_log):
    log = make_log([(u, 1, END - timedelta(hours=u + 1), 1) for u in range(5)])
    buyers = spark.createDataFrame([(1,), (3,)], "user_id long")
    curve = decay.decay_curve(log, W, buyers, 8, 10)
    assert sorted(map(tuple, decay.fit_curve(curve).collect())) == sorted(map(tuple, curve.collect()))


def test_second_latest_time_ignores_repeats(make_log):
    log = make_log(
        [
            (1, 1, "2024-01-05 10:00:00", 2),
            (1, 2, "2024-01-05 10:00:00", 2),
            (1, 1, "2024-01-04 10:00:00", 2),
            (1, 1, "2024-01-05 11:00:00", 1),
            (2, 1, "2024-01-05 10:00:00", 2),
            (2, 1, "2024-01-05 10:00:00", 2),
        ]
    )
    got = table(recency.type_second_distance(log, W, ["user_id", "cate"], 2), ["user_id", "cate"])
    assert got == {(1, 8): {"second_dist": int((END - datetime(2024, 1, 4, 10)).total_seconds())}}


def test_distances_by_type(make_log):
    log = make_log([(1, 1, "2024-01-10 23:59:50", 2), (1, 1, "2024-01-10 00:00:00", 1)])
    got = table(recency.last_distance_by_type(log, W, ["user_id"]))[1]
    assert got["last_dist_2"] == 10 and got["last_dist_1"] == 86400 and got["last_dist_4"] is None
    assert table(recency.first_distance(log, W, ["user_id"]))[1]["first_dist"] == 86400


def test_user_base_defaults(spark):
    default, cutoff = datetime(2023, 1, 1), datetime(2024, 1, 5)
    users = spark.createDataFrame(
        [
            (1, 3, None),
            (2, 1, datetime(2024, 1, 6)),  # after the cutoff
            (3, 2, datetime(2024, 1, 5)),  # on the cutoff
            (4, 2, datetime(2023, 12, 31, 12)),
        ],
        USERS,
    )
    got = table(recency.user_base(users, END, default, cutoff))
    assert [got[u]["reg_days"] for u in (1, 2, 3, 4)] == [375, 375, 6, 10]
