"""Routing, dead letters, gaps and heartbeats on hand-made messages."""

import json

import pytest
from tickflow import schemas
from tickflow.operators import gaps, monitor, quality, router
from tickflow.spec import FeedSpec


def raw(spark, *values):
    rows = [
        (v if v is None or isinstance(v, str) else json.dumps(v), i, 3, "2026-07-27T21:15:37Z")
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, schemas.RAW_MESSAGE)


def match(tid, product="A", kind="match", **more):
    return {"type": kind, "product_id": product, "trade_id": tid, "price": "1.5", "size": "2",
            **more}


def heartbeat(tid, product="A"):
    return {"type": "heartbeat", "product_id": product, "sequence": 1, "last_trade_id": tid}


def routes(spark, *values):
    rows = router.route(raw(spark, *values)).orderBy("arrival_seq").collect()
    return [(r.route, r.error) for r in rows]


REST = [' {"type": "match"}', "}", " junk}", ', {"type": "match"}', "]", ",null]", ",null] junk", "] junk"]
REST += ["],[1", ",null", "] ]", "\x0b", "[", ", "]


@pytest.mark.parametrize("whole", [
    '{"type": "match", "product_id": "A"}',
    ' {"type": "match", "product_id": "A", "more": {"a": "}"}}\n',
])
def test_nothing_may_follow_an_object(spark, whole):
    found = routes(spark, whole, *(whole + rest for rest in REST))
    assert found == [("trades", None)] + [("dlq", "invalid json: malformed")] * len(REST)


def test_blanks_before_an_object(spark):
    """Blanks of JSON alone are passed over, and no text is gone through for its start."""
    whole = '{"type": "match", "product_id": "A", "more": {"a": 1}}'
    assert routes(spark, *(b + whole for b in (" ", "\t", "\r\n", "\n \t "))) == [("trades", None)] * 4
    odd = routes(spark, *(b + whole for b in ("\x0b", "\u00a0", "\x00", "\n\x0b")))
    assert odd == [("dlq", "invalid json: malformed")] * 4
    assert routes(spark, "\t[1]", "\r\n7") == [("dlq", "invalid json: not a JSON object")] * 2
    plan = router.route(raw(spark, whole))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan


def test_ids_that_stand_for_nothing(spark):
    empty = [0, 0.0, -0.0, False, "", None, [], {}]
    found = routes(spark, *(match(1, product=p) for p in empty))
    assert found == [("dlq", "missing product_id in match")] * len(empty)
    kept = ["0", "false", "[]", 7, True, "0x"]
    assert [r for r, _ in routes(spark, *(match(1, product=p) for p in kept))] == ["trades"] * len(kept)
    keys = router.route(raw(spark, match(1, product="0"), match(1, product=0)))
    keys = keys.orderBy("arrival_seq").select(router.product_key(keys).alias("k")).collect()
    assert [r.k for r in keys] == ["0", "unknown"]


def test_routes_and_reasons(spark):
    malformed = ("dlq", "invalid json: malformed")
    invalid = ("dlq", "invalid json: not a JSON object")
    assert routes(
        spark,
        match(7),
        match(7, kind="last_match"),
        {"type": "snapshot", "product_id": "A", "bids": [], "asks": []},
        {"type": "l2update", "product_id": "A", "changes": []},
        "{not json",
        "[1, 2]",
        '"text"',
        "null",
        "",
        None,
        '{"type": "match"} tail',
        "{'type': 'match'}",
        {"type": "match", "trade_id": 1},
        {"type": "match", "product_id": "", "trade_id": 1},
        {"type": "l2update", "product_id": None},
        {"type": "ticker", "product_id": "A"},
        {"product_id": "A"},
        {"type": "error", "message": "bad", "reason": "why"},
        {"type": "error", "message": "bad"},
        {"type": "subscriptions", "channels": []},
        heartbeat(1),
        ' {"type": "heartbeat"} \n',
    ) == [
        ("trades", None),
        ("trades", None),
        ("book", None),
        ("book", None),
        malformed,
        *[invalid] * 3,
        *[malformed] * 4,
        ("dlq", "missing product_id in match"),
        ("dlq", "missing product_id in match"),
        ("dlq", "missing product_id in l2update"),
        ("dlq", "unrecognized type: 'ticker'"),
        ("dlq", "unrecognized type: None"),
        ("dlq", "feed error: bad why"),
        ("dlq", "feed error: bad "),
        ("control", None),
        ("heartbeat", None),
        ("heartbeat", None),
    ]


def test_message_stays_intact_and_gains_the_envelope(spark):
    row = router.route(raw(spark, match(7, extra={"a": 1}))).first()
    assert json.loads(row.value)["extra"] == {"a": 1}
    assert (row.conn_epoch, row.ingest_ts) == (3, "2026-07-27T21:15:37Z")
    trade = router.trades(router.route(raw(spark, match(7, extra=1)))).first()
    assert (trade.trade_id, trade.price, trade.conn_epoch) == (7, "1.5", 3)


def test_event_time_needs_milliseconds(spark):
    times = ["2026-07-27T21:15:37.945472Z", "2026-07-27T21:15:37Z", "junk", None]
    rows = router.matches(
        router.trades(router.route(raw(spark, *[match(i, time=t) for i, t in enumerate(times)])))
    ).orderBy("arrival_seq")
    assert [str(r.event_ts) for r in rows.collect()] == [
        "2026-07-27 21:15:37.945000",
        *["1970-01-01 00:00:00"] * 3,
    ]


def missed(spark, *values, rows=1 << 20):
    routed = router.route(raw(spark, *values))
    found = gaps.running_gaps(
        router.trades(routed), router.heartbeats(routed), FeedSpec(chunk_rows=rows)
    )
    return {r.arrival_seq: r.missed for r in found.collect() if r.missed}


def test_running_gaps(spark):
    assert missed(spark, match(71), match(72), match(73), match(74)) == {}
    assert missed(spark, match(71), match(80), match(81), match(90)) == {1: 8, 3: 8}
    assert missed(spark, match(71), match(9, "B"), match(72), match(10, "B")) == {}
    assert missed(spark, match(71), heartbeat(75), match(76)) == {1: 4}


def test_running_gaps_across_chunks(spark):
    feed = [
        heartbeat(90),  # before any trade: ignored
        match(10),
        match("x"),  # no integer id: ignored
        match(14, kind="last_match"),  # 3 missed
        match(12),  # late: does not lower the maximum
        heartbeat(14),  # nothing new
        match(15),
        heartbeat(20),  # 5 missed, raises the maximum
        match(22),  # 1 missed
    ]
    for rows in (1, 3, 100):
        assert missed(spark, *feed, rows=rows) == {3: 3, 7: 5, 8: 1}


def test_sorted_gaps_ignore_late_fills_and_repeats(spark):
    feed = [match(t) for t in (10, 14, 12, 12, 11, 13, 20, 18)]
    trades = router.trades(router.route(raw(spark, *feed, match(99, kind="last_match"))))
    for rows in (2, 7, 100):
        report = gaps.gap_report(trades, FeedSpec(chunk_rows=rows)).first()
        assert (report.trades, report.first_id, report.last_id) == (8, 10, 20)
        assert (report.gaps, report.missed, report.epochs) == (2, 4, "3")


def test_feed_gate(spark):
    def passed(*values):
        routed = router.route(raw(spark, *values))
        return quality.feed_gate(router.trades(routed), router.dead_letters(routed)).first().passed

    assert passed(match(1), match(2))
    assert not passed(match(1), match(3))
    assert not passed(match(1), match(2), "{oops")
    assert not passed(heartbeat(1))


def test_oversize_goes_to_the_dead_letters(spark):
    spec = FeedSpec(max_message_bytes=2048, truncated_bytes=1024)
    routed = router.route(raw(spark, match(1, pad="x" * 5000), match(2)))
    letters = router.oversize_letters(routed, spec).collect()
    assert len(letters) == 1 and letters[0].arrival_seq == 0
    assert len(letters[0].raw) == 1024 + 3 and letters[0].raw.endswith("...")
    assert letters[0].error.startswith("message too large (")


def test_epochs_count_connections(spark):
    opened = {"type": "subscriptions"}
    routed = router.route(raw(spark, opened, match(1), match(2), opened, match(3)))
    for rows in (1, 2, 100):
        found = gaps.connection_epochs(routed, FeedSpec(chunk_rows=rows)).orderBy("arrival_seq")
        assert [r.epoch for r in found.collect()] == [1, 1, 1, 2, 2]


def test_product_list_and_key(spark):
    assert router.split_products(" A, B ,,") == ("A", "B")
    routed = router.route(raw(spark, match(1), match(1, "C"), "{bad"))
    kept = router.allow_products(routed, ("A", "B"))
    assert sorted(r.arrival_seq for r in kept.collect()) == [0, 2]
    keys = routed.select(router.product_key(routed).alias("k")).collect()
    assert sorted(r.k for r in keys) == ["A", "C", "unknown"]
    assert monitor.first_letters(router.dead_letters(routed)).count() == 1


def test_unreadable_levels_are_dead_letters(spark):
    feed = [
        {"type": "l2update", "product_id": "A", "changes": [["buy", "1", "x"], ["buy", "2", "1"], ["sell"]]},
        {"type": "l2update", "product_id": "A", "changes": [["buy", "1", "1"]]},
        {"type": "snapshot", "product_id": "A", "bids": [["", "1"]], "asks": None},
        {"type": "snapshot", "product_id": "A"},
        match(1),
    ]
    letters = router.unreadable_levels(router.route(raw(spark, *feed))).orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.error) for r in letters] == [
        (0, "unreadable levels in l2update: 2"),
        (2, "unreadable levels in snapshot: 1"),
    ]
    assert json.loads(letters[0].raw) == feed[0]


def test_a_message_is_parsed_once_whatever_is_asked_of_it(spark):
    """Filters on what routing found do not bring copies of the parser with them."""
    routed = router.route(raw(spark, match(1), heartbeat(2), "{bad"))
    asked = [router.trades(routed), router.book_messages(routed), router.heartbeats(routed),
             router.dead_letters(routed), router.oversize_letters(routed),
             router.unreadable_levels(routed), router.counters(routed)]
    for rows in asked:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField(type,") == 1
