"""Identity, interval and resolution operators against small sequential models."""

import random

from tideweave.operators import identity, intervals, quality, resolve


def fold(rows):
    """One account's creations in order: (time, evidence, name)."""
    time = evidence = name = None
    for ts, ev, who in rows:
        if time is None:
            time, evidence, name = ts, ev, who
        elif ts < time:
            other = who and name and who != name
            time, evidence = ts, ev + ("_username_differs_from_existing" if other else "")
            name = name or who
    return name, time, evidence


def test_fold_matches_sequential_model(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for account in range(300):
        own = [(f"2020-01-0{rng.randint(1, 5)}", f"e{i}", rng.choice([None, "a", "b"])) for i in range(rng.randint(1, 6))]
        want[str(account)] = fold(own)
        rows += [("s", str(account), n, t, e, "1", 0, i) for i, (t, e, n) in enumerate(own)]
    df = spark.createDataFrame(rows, "site string, account_id string, username string, timestamp string, evidence string, logid string, phase int, seq long")
    found = {r.account_id: (r.username, r.creation_timestamp, r.creation_evidence) for r in identity.fold_creations(df).collect()}
    assert found == want


def longest_brute(values):
    """Earliest longest non-decreasing subsequence, by dynamic programming from the right."""
    n = len(values)
    best = [1] * n
    for i in range(n - 1, -1, -1):
        best[i] = 1 + max([best[j] for j in range(i + 1, n) if values[j] >= values[i]], default=0)
    keep, need, last = [False] * n, max(best, default=0), None
    for i, v in enumerate(values):
        if need and best[i] >= need and (last is None or v >= last):
            keep[i], last, need = True, v, need - 1
    return keep


def test_longest_in_order_matches_brute_force():
    rng = random.Random(4)
    for _ in range(2000):
        values = [rng.randint(0, 6) for _ in range(rng.randint(0, 12))]
        assert identity.longest_in_order(values) == longest_brute(values)


def test_keep_in_order_by_segments(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for site in range(60):
        ids = sorted(rng.sample(range(1, 200), 14))
        values = sorted(rng.randint(1, 40) for _ in ids)
        for _ in range(4):
            values[rng.randrange(14)] = rng.randint(1, 40)
        want |= {(str(site), str(i)): k for i, k in zip(ids, longest_brute(values), strict=True)}
        rows += [(str(site), str(i), f"{v:03d}") for i, v in zip(ids, values, strict=True)]
    df = spark.createDataFrame(rows, "site string, account_id string, t string")
    found = {(r.site, r.account_id): r.in_order for r in identity.keep_in_order(df, ["site"], "account_id", "t").collect()}
    assert found == want


def intervals_model(events):
    """The sequential rule over all names at once."""
    open_, out = {}, []
    for time, kind, logid, name, account, new, evidence in events:
        if kind == 0:
            if account not in {i[1] for i in open_.get(name, [])}:
                i = [name, account, time, None, evidence, logid, None]
                out.append(i)
                open_.setdefault(name, []).append(i)
        else:
            held = open_.get(name, [])
            if len({i[1] for i in held}) == 1:
                for i in held:
                    i[3], i[6] = time, logid
                account, open_[name] = held[0][1], []
                if account not in {i[1] for i in open_.get(new, [])}:
                    i = [new, account, time, None, "renameuser_interval", logid, None]
                    out.append(i)
                    open_.setdefault(new, []).append(i)
    return sorted(map(tuple, out), key=str)


def random_case(rng, n):
    names, accounts = [f"n{i}" for i in range(8)], [str(i) for i in range(1, 6)]
    aliases, renames = [], []
    for i in range(n):
        time, logid = f"2020-01-{rng.randint(1, 20):02d}T00:00:00Z", str(i + 1)
        if rng.random() < 0.6:
            aliases.append((time, logid, rng.choice(names), rng.choice(accounts), "e"))
        else:
            renames.append((time, logid, *rng.sample(names[:6], 2)))
    seen, unique = set(), []
    for a in aliases:
        if (a[0], a[2], a[3]) not in seen:
            seen.add((a[0], a[2], a[3]))
            unique.append(a)
    return unique, renames


def test_intervals_match_sequential_model(spark):
    rng = random.Random(6)
    alias_rows, rename_rows, want = [], [], []
    for site in range(40):
        aliases, renames = random_case(rng, 14)
        events = [(t, 0, lg, n, a, None, e) for t, lg, n, a, e in aliases] + [(t, 1, lg, o, None, w, None) for t, lg, o, w in renames]
        events.sort(key=lambda e: (e[0], e[1], len(e[2]), e[2]))
        want += [(f"s{site}", *i) for i in intervals_model(events)]
        alias_rows += [(f"s{site}", n, a, t, e, lg) for t, lg, n, a, e in aliases]
        rename_rows += [(f"s{site}", i, lg, t, o, w, "parsed") for i, (t, lg, o, w) in enumerate(renames)]
    aliases = spark.createDataFrame(alias_rows, "site string, username string, account_id string, timestamp string, evidence string, logid string")
    renames = spark.createDataFrame(rename_rows, "site string, seq long, logid string, timestamp string, old_username string, new_username string, parse_status string")
    accounts = aliases.select("site", "account_id").distinct().selectExpr("site", "account_id", "'2000-01-01T00:00:00Z' AS creation_timestamp")
    found = [tuple(r) for r in intervals.build_intervals(aliases, accounts, renames).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_resolution_matrix(spark):
    t = "2020-06-01T00:00:00Z"
    edges = spark.createDataFrame([("s", str(i), t, "99", n) for i, n in enumerate(("two", "same", "past", "none", "late", "undated", "now", "edge_end", "edge_start"))], "site string, logid string, timestamp string, source_id string, target_username string")
    held = [("two", "1", None), ("two", "2", None), ("same", "3", None), ("past", "4", None), ("edge_end", "10", t)]
    rows = [("s", n, a, "2019-01-01T00:00:00Z", e) for n, a, e in held] + [("s", "edge_start", "11", t, None)]
    spans = spark.createDataFrame(rows, "site string, username string, account_id string, start string, end string")
    current = spark.createDataFrame([("s", n, a) for n, a in (("same", "3"), ("past", "5"), ("late", "6"), ("undated", "7"), ("now", "8"), ("edge_start", "11"))], "site string, username string, account_id string")
    made = [("s", a, "2010-01-01T00:00:00Z") for a in ("1", "2", "3", "4", "5", "8", "10", "11")] + [("s", "6", "2021-01-01T00:00:00Z"), ("s", "7", None)]
    accounts = spark.createDataFrame(made, "site string, account_id string, creation_timestamp string")
    found = {r.target_username: (r.target_resolution, r.target_account) for r in resolve.resolve_targets(edges, spans, current, accounts).collect()}
    assert found == {
        "two": ("ambiguous_multiple_active_intervals", None),
        "same": ("interval_and_current_username_same", "3"),
        "past": ("missing_historical_label_confirmation", None),
        "none": ("missing_no_identity_evidence", None),
        "late": ("missing_current_created_after_thank", None),
        "undated": ("current_username_no_creation_timestamp", "7"),
        "now": ("current_username_no_interval_conflict", "8"),
        "edge_end": ("missing_no_identity_evidence", None),
        "edge_start": ("interval_and_current_username_same", "11"),
    }


def test_order_violations_by_bucket(spark):
    rng = random.Random(8)
    ids = rng.sample(range(1, 3_000_000), 400)
    rows = [("s", str(i), f"{rng.randint(1, 60) + i // 50_000:04d}") for i in ids]
    most, want = "", set()
    for _, i, t in sorted(rows, key=lambda r: int(r[1])):
        if t < most:
            want.add(i)
        most = max(most, t)
    df = spark.createDataFrame(rows, "site string, logid string, timestamp string")
    assert {r.logid for r in quality.order_violations(df).collect()} == want
