import datetime as dt

from pyspark.sql import functions as F

from marketbars.queries.q_payloads import _payloads, minute_bars


def _ticks(spark):
    base = dt.datetime(2024, 1, 5, 10, 0, 0)
    rows = []
    # user 1 is hot: 900 ticks over three minutes; user 2 has two ticks
    for i in range(900):
        rows.append((i, base + dt.timedelta(seconds=i // 5), 1, "click", float(i % 97), "{}"))
    rows.append((5000, base, 2, "view", 3.0, "{}"))
    rows.append((5001, base + dt.timedelta(seconds=30), 2, "view", 9.0, "{}"))
    return spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def test_minute_bars_ohlc_and_hash_aggregate(spark):
    ev = _ticks(spark)
    b = minute_bars(ev, "user_id", F.concat(F.lit("U"), F.col("user_id").cast("string")))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    got = {(r["symbol"], r["epoch"]): r for r in b.collect()}
    assert len(got) == 3 + 1
    t0 = int(dt.datetime(2024, 1, 5, 10, 0).replace(tzinfo=dt.timezone.utc).timestamp())
    first = got[("U1", t0)]
    assert (first["o"], first["v"], first["first_id"], first["oi"]) == (0.0, 300, 0, 299)
    assert first["c"] == float(299 % 97)
    assert first["h"] == 96.0 and first["l"] == 0.0
    u2 = got[("U2", t0)]
    assert (u2["o"], u2["c"], u2["h"], u2["l"], u2["v"]) == (3.0, 9.0, 9.0, 3.0, 2)


def test_payload_size_bounded_by_minutes(spark):
    ev = _ticks(spark)
    b = minute_bars(ev, "user_id", F.concat(F.lit("U"), F.col("user_id").cast("string")))
    candle = F.array(*[F.col(c).cast("double") for c in ("epoch", "o", "h", "l", "c", "v", "oi")])
    p = {r["symbol"]: r for r in _payloads(b, candle).collect()}
    assert len(p["U1"]["candles"]) == 3          # 900 ticks, three minutes
    assert [c[0] for c in p["U1"]["candles"]] == sorted(c[0] for c in p["U1"]["candles"])
    assert p["U1"]["k"] == 0 and p["U2"]["k"] == 5000 % 10


def test_minute_bars_match_a_plain_python_rollup(spark):
    """Random ticks (one hot user, ties in time) against a direct rollup."""
    import random
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 5, 9, 0, 0)
    rows = []
    for i in range(2000):
        user = 1 if rnd.random() < 0.6 else rnd.randint(2, 6)
        ts = base + dt.timedelta(seconds=rnd.randint(0, 600), microseconds=rnd.choice([0, 500000]))
        rows.append((i, ts, user, "click", float(rnd.randint(1, 50)), "{}"))
    rnd.shuffle(rows)
    ev = spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    got = {(r["symbol"], r["epoch"]): (r["o"], r["h"], r["l"], r["c"], r["v"], r["oi"], r["first_id"])
           for r in minute_bars(ev, "user_id", F.concat(F.lit("U"), F.col("user_id").cast("string"))).collect()}
    want = {}
    epoch0 = dt.datetime(1970, 1, 1)
    for eid, ts, user, _, value, _ in sorted(rows):
        key = (f"U{user}", int((ts - epoch0).total_seconds()) // 60 * 60)
        o, h, lo, c, v, oi, first = want.get(key, (value, value, value, value, 0, eid, eid))
        want[key] = (o, max(h, value), min(lo, value), value, v + 1, eid, first)
    assert got == want
