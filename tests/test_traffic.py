"""The set-based extract merge against a row-by-row model of it."""

import random
from datetime import timedelta

import pytest
from support import OPEN, at, extract, frame, referral, rows

from chronostar.operators.keys import assign_keys
from chronostar.operators.traffic import KEY, PASS, SEQ, merge_extract, partial_key_matches, union_sources
from chronostar.plans.entities import USER_TRAFFIC, Batch

TS = "2024-02-02 00:00:00"
BATCH = Batch(7, TS, 2)
SCHEMA = USER_TRAFFIC.stored_schema
NAMES = SCHEMA.names


def row_by_row(csv, history, users, sources):
    """One extract row after the other over a list of referral dicts; returns the history."""
    history = [dict(h) for h in history]
    next_sk = max((h["user_traffic_sk"] for h in history), default=0) + 1

    def open_of(r):
        same = [h for h in history if h["end_date"] == OPEN and tuple(h[k] for k in KEY) == r[:3]]
        return sorted(same, key=lambda h: h["user_traffic_sk"])

    def insert(batch):
        nonlocal next_sk
        for r in batch:
            if r[0] in users and r[1] in sources:
                values = (users[r[0]], sources[r[1]], r[2], r[3], at(TS), OPEN, 2, 7, None, r[0], r[1])
                history.append(dict(zip(NAMES, (next_sk, *values))))
                next_sk += 1

    insert([r for r in csv if not open_of(r)])
    again = []
    for r in csv:
        standing = open_of(r)
        if standing and (standing[0]["campaign_code"] or "") != (r[3] or ""):
            for h in standing:
                h["end_date"], h["update_id"] = at(TS), 7
            again.append(r)
    insert(again)
    return sorted((tuple(h[n] for n in NAMES) for h in history), key=repr)


def merged(spark, csv, history, users, sources):
    active = frame(spark, [tuple(h[n] for n in NAMES) for h in history], SCHEMA)
    user_df = spark.createDataFrame(list(users.items()), "user_id long, user_sk long")
    source_df = spark.createDataFrame(list(sources.items()), "source_id int, traffic_source_sk long")
    out = merge_extract(extract(spark, csv), active, user_df, source_df, BATCH).cache()
    start = max((h["user_traffic_sk"] for h in history), default=0)
    opened, _ = assign_keys(out.filter("row_state = 'opened'"), USER_TRAFFIC.sk, (PASS, SEQ), start)
    result = rows(out.filter("row_state <> 'opened'").select(*NAMES).unionByName(opened.select(*NAMES)))
    out.unpersist()
    return result


def stored(sk, user_id, user_sk, source_id=1, when="2020-01-05", campaign="A"):
    values = (sk, user_sk, source_id, at(when), campaign, at("2024-02-01"), OPEN, 1, 1, None, user_id, source_id)
    return dict(zip(NAMES, values))


CASES = {
    "new": ([referral(1)], []),
    "unchanged": ([referral(1)], [stored(1, 1, 1)]),
    "changed": ([referral(1, campaign="B")], [stored(1, 1, 1)]),
    "null is empty": ([referral(1, campaign=None)], [stored(1, 1, 1, campaign=None)]),
    "new repeated, equal": ([referral(1), referral(1)], []),
    "new repeated, different": ([referral(1), referral(1, campaign="B"), referral(1, campaign="C")], []),
    "changed repeated": ([referral(1, campaign="B"), referral(1, campaign="C")], [stored(1, 1, 1)]),
    "back and forth": ([referral(1), referral(1, campaign="B"), referral(1)], [stored(1, 1, 1)]),
    "several open": ([referral(1, campaign="B")], [stored(1, 1, 1), stored(2, 1, 1, campaign="B")]),
    "matches an older user version": ([referral(1, campaign="B")], [stored(1, 1, 90)]),
    "deleted user is closed without successor": ([referral(9, campaign="B")], [stored(1, 9, 9)]),
    "deleted user is not inserted": ([referral(9)], []),
    "unknown source": ([referral(1, 8)], []),
    "late": ([referral(1, when="1999-01-01")], [stored(1, 1, 1)]),
}


@pytest.mark.parametrize("case", CASES)
def test_case(spark, case):
    csv, history = CASES[case]
    users, sources = {1: 11, 2: 12}, {1: 1, 2: 2}
    assert merged(spark, csv, history, users, sources) == row_by_row(csv, history, users, sources)


@pytest.mark.parametrize("seed", range(4))
def test_random_extracts_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    users = {i: 100 + i for i in range(1, 6)}
    sources = {1: 1, 2: 2}

    def key():
        if rng.random() < 0.35:  # one key holds a third of everything
            return 1, 1, at("2020-01-05")
        return rng.randint(1, 7), rng.randint(1, 3), at("2020-01-05") + timedelta(days=rng.randint(0, 2))

    history = []
    for sk in range(1, 40):
        u, s, when = key()
        row = stored(sk, u, rng.choice([u, 100 + u]), s, campaign=rng.choice(["A", "B", None, ""]))
        row["referred_at"] = when
        history.append(row)
    csv = [(*key(), rng.choice(["A", "B", "C", ""])) for _ in range(120)]
    assert merged(spark, csv, history, users, sources) == row_by_row(csv, history, users, sources)


def test_partial_key_counts_equal_the_pairs(spark):
    rng = random.Random(3)
    days = ["2020-01-05", "2020-01-05", "2020-01-06"]
    source = [(i, 1, at(rng.choice(days)), rng.choice(["A", "B", None, ""])) for i in range(40)]
    active = [(at(rng.choice(days)), rng.choice(["A", "B", None, ""])) for _ in range(50)]
    pairs = {}
    for s in source:
        n = sum(1 for w in active if w[0] == s[2] and (w[1] or "") != (s[3] or ""))
        if n:
            pairs[s[0]] = n
    source_df = spark.createDataFrame(
        source, "user_sk long, traffic_source_sk long, referred_at timestamp_ntz, campaign_code string"
    )
    active_df = spark.createDataFrame(active, "referred_at timestamp_ntz, campaign_code string")
    assert {r.user_sk: r.versions for r in partial_key_matches(source_df, active_df).collect()} == pairs


def test_union_tags_both_sources(spark):
    both = union_sources(extract(spark, [referral(1)]), extract(spark, [referral(1, campaign="B")]))
    assert rows(both, "campaign_code", "source_id_audit") == [("A", 1), ("B", 2)]
