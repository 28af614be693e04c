"""Coverage spans, gaps, validity and as-of joins against brute force."""

import random
from datetime import date, timedelta
from itertools import takewhile

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from veilmark.operators import dated

DAY = date(2020, 1, 1)
HOT = {"rows_per_slice": 50, "one_in": 1}


def later(n):
    return DAY + timedelta(days=n)


@pytest.fixture(scope="module")
def drawn():
    """Claims and intervals of members, one of them hot, with NULLs and backward ends."""
    pick = random.Random(7)
    members = ["hot"] * 10 + [f"m{i}" for i in range(15)] + [None]
    claims = [
        (f"c{i}", pick.choice(members), None if i % 40 == 9 else later(pick.randrange(-30, 330)))
        for i in range(900)
    ]
    intervals = []
    for i in range(300):
        start = later(pick.randrange(300))
        end = None if i % 25 == 3 else start + timedelta(days=pick.randrange(-3, 90))
        member = pick.choice(members[9:])
        intervals.append((f"a{i:03}", member, pick.choice("AB"), None if i % 31 == 5 else start, end))
    return claims, intervals


@pytest.fixture(scope="module")
def sides(spark, drawn):
    claims = spark.createDataFrame(drawn[0], "claim_id string, member_id string, service_date_from date")
    schema = "id string, member_id string, coverage_type string, effective_date date, termination_date date"
    return claims, spark.createDataFrame(drawn[1], schema)


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def may_broadcast(spark, request):
    if not request.param:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def holds(start, end, day):
    return start is not None and start <= day and (end is None or day <= end)


def test_valid_on_by_force(sides, drawn, may_broadcast):
    claims, intervals = sides
    got = dated.valid_on(
        claims, intervals, "member_id", "service_date_from", "effective_date",
        "termination_date", "id", "claim_id", **HOT,
    )
    expected = []
    for claim, member, day in drawn[0]:
        found = [
            (start, i)
            for i, m, _, start, end in drawn[1]
            if member is not None and m == member and day is not None and holds(start, end, day)
        ]
        expected.append((claim, len(found), max(found)[1] if found else None))
    assert rows(got) == sorted(expected, key=repr)
    assert sum(e[1] for e in expected) > 300


def test_intervals_of_one_bucket_are_few(spark):
    """However many intervals a key has, a bucket of days holds a bounded number."""
    starts = spark.range(20_000).selectExpr(
        "'m' AS member_id", "CAST(id AS STRING) AS auth_id",
        "date_add(DATE '2020-01-01', CAST(id % 64 AS INT)) AS effective_date",
        "date_add(DATE '2020-01-01', CAST(id % 64 + id % 40 AS INT)) AS expiration_date",
    )
    claims = spark.range(64).selectExpr(
        "CAST(id AS STRING) AS claim_id", "'m' AS member_id",
        "date_add(DATE '2020-01-01', CAST(id AS INT)) AS service_date_from",
    )
    got = {r["claim_id"]: r["n_valid"] for r in dated.claims_in_authorization(claims, starts).collect()}
    assert got == {
        str(d): sum(i % 64 <= d <= i % 64 + i % 40 for i in range(20_000)) for d in range(64)
    }


def test_days_and_not_points_meet_intervals(spark, may_broadcast):
    """Points of one key and day are one row where they meet intervals."""
    starts = spark.range(500).selectExpr(
        "'m' AS member_id", "CAST(id AS STRING) AS auth_id",
        "date_add(DATE '2020-01-01', CAST(id % 30 AS INT)) AS effective_date",
        "date_add(DATE '2020-01-01', CAST(id % 30 + id % 7 AS INT)) AS expiration_date",
    )
    claims = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS claim_id", "'m' AS member_id",
        "date_add(DATE '2020-01-01', CAST(id % 40 AS INT)) AS service_date_from",
    )
    found = dated.claims_in_authorization(claims, starts, **HOT)
    lines = plan(found).splitlines()
    at = next(i for i, line in enumerate(lines) if "Join" in line and "i_place" in line)
    below = list(takewhile(lambda line: line.find("- ") > lines[at].find("- "), lines[at + 1 :]))
    assert below and not any("claim_id" in line for line in below)
    got = {int(r["claim_id"]): r["n_valid"] for r in found.collect()}
    assert got == {
        c: sum(i % 30 <= c % 40 <= i % 30 + i % 7 for i in range(500)) for c in range(3000)
    }


def spans_by_force(intervals, by):
    far = later(100_000)
    days, n_rows = {}, {}
    for _, member, kind, start, end in intervals:
        if member is None or start is None or (end is not None and end < start):
            continue
        key = (member, kind)[:by]
        days.setdefault(key, []).append((start, end or far))
    out = []
    for key, pieces in days.items():
        merged = []
        for start, end in sorted(pieces):
            if merged and start <= merged[-1][1] + timedelta(days=1):
                merged[-1][1] = max(merged[-1][1], end)
                merged[-1][2] += 1
            else:
                merged.append([start, end, 1])
        out += [(*key, s, None if e == far else e, n) for s, e, n in merged]
    return sorted(out, key=repr)


@pytest.mark.parametrize("by", [1, 2])
def test_spans_and_gaps_by_force(sides, drawn, by):
    keys = ["member_id", "coverage_type"][:by]
    spans = dated.coverage_spans(sides[1], keys)
    expected = spans_by_force(drawn[1], by)
    assert rows(spans) == expected
    in_order = sorted(expected, key=lambda s: (repr(s[:by]), s[by]))
    gaps = [
        (*a[:by], a[by + 1] + timedelta(days=1), b[by] - timedelta(days=1), (b[by] - a[by + 1]).days - 1)
        for a, b in zip(in_order, in_order[1:], strict=False)
        if a[:by] == b[:by]
    ]
    assert rows(dated.coverage_gaps(spans, keys)) == sorted(gaps, key=repr) and gaps


def test_spans_reduce_rows_before_they_move(sides):
    text = plan(dated.coverage_spans(sides[1]))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.rindex("partial_max") > text.rindex("Exchange hashpartitioning")


def test_uncovered_by_force(sides, drawn, may_broadcast):
    claims, intervals = sides
    spans = spans_by_force(drawn[1], 1)
    expected = []
    for claim, member, day in drawn[0]:
        mine = [s for s in spans if s[0] == member and day is not None and s[1] <= day]
        last = max(mine, key=lambda s: s[1]) if mine else None
        if member is None:
            reason = "no member"
        elif day is None:
            reason = "no date"
        elif last is None:
            reason = "never covered"
        elif last[2] is not None and last[2] < day:
            reason = "not covered"
        else:
            continue
        end = last[2] if last and member is not None else None
        expected.append((claim, member, day, end, reason))
    got = dated.claims_uncovered(claims, intervals, **HOT)
    assert rows(got) == sorted(expected, key=repr)
    assert {e[4] for e in expected} == {"no member", "no date", "never covered", "not covered"}


def test_a_hot_member_is_many_orders(spark, sides):
    """The window that orders claims and spans cuts a hot member into slices."""
    hot = dated.hot_keys(sides[0], "member_id", ["claim_id"], **HOT)
    cut = dated.sliced(sides[0], "member_id", hot, ["claim_id"], "s").where("member_id = 'hot'")
    sizes = [r["count"] for r in cut.groupBy("s").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 90


def test_empty_sides(sides):
    claims, intervals = sides
    none, nothing = claims.where(F.lit(False)), intervals.where(F.lit(False))
    assert dated.claims_uncovered(none, intervals).count() == 0
    assert dated.claims_uncovered(claims, nothing).count() == claims.count()
    assert dated.coverage_gaps(dated.coverage_spans(nothing)).count() == 0
    held = dated.valid_on(
        claims, nothing, "member_id", "service_date_from", "effective_date",
        "termination_date", "id", "claim_id",
    )
    assert held.where("n_valid > 0").count() == 0 and held.count() == claims.count()
