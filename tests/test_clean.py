import datetime as dt

from pyspark.sql import functions as F

from footfall.operators import clean
from tests.conftest import rows


def test_newest_copy_decides(make_events):
    later = dt.datetime(2026, 7, 10, 10, 0, 5)
    events = make_events(
        [
            ("u1", "page_view", "2026-07-10 10:00:00", {"event_id": "a", "city": "old"}),
            ("u1", "page_view", "2026-07-10 10:00:00", {"event_id": "a", "city": "new", "server_time": later}),
            ("u1", "page_view", "2026-07-10 10:00:00", {"event_id": "b"}),
            ("", "page_view", "2026-07-10 10:00:00", {"event_id": "b", "server_time": later}),
        ]
    )
    assert rows(clean.ods_to_dwd(events), "event_id", "city") == [("a", "new")]


def test_illegal_rows_and_defaults(make_events):
    events = make_events(
        [
            ("u1", "page_view", "2026-07-10 10:00:00", {"city": "", "device_model": None, "duration": None}),
            (None, "page_view", "2026-07-10 10:00:00"),
            ("null", "page_view", "2026-07-10 10:00:00"),
            ("u1", "error", "2026-07-10 10:00:00"),
        ]
    )
    assert rows(clean.ods_to_dwd(events), "city", "device_model", "duration") == [("未知", "未知", 0)]
    assert rows(clean.cleaning_report(events)) == [(4, 0, 4, 1, 1)]


def test_cleaning_twice_changes_nothing(make_events):
    events = make_events([("u1", "page_view", "2026-07-10 10:00:00", {"city": ""}), ("u2", "ad_click", "2026-07-10 11:00:00")])
    once = clean.ods_to_dwd(events)
    assert rows(clean.ods_to_dwd(once), "event_id", "city") == rows(once, "event_id", "city")


def test_ties_are_decided_by_content(make_events):
    copies = [("u1", "page_view", "2026-07-10 10:00:00", {"event_id": "a", "page": p}) for p in ("x", "z", "y")]
    for order in (copies, copies[::-1]):
        assert rows(clean.ods_to_dwd(make_events(order)), "page") == [("z",)]


def test_bad_time_text_is_null(spark):
    df = spark.createDataFrame([("2026-07-10 10:00:00", "junk")], "event_time string, server_time string")
    assert rows(clean.parse_times(df).select(F.hour("event_time"), F.col("server_time").isNull())) == [(10, True)]


def test_day_filters(make_events):
    events = make_events([("u", "page_view", f"2026-07-{d:02d} 23:59:59") for d in range(1, 15)])
    assert clean.on_day(events, "2026-07-03").count() == 1
    assert clean.last_days(events, "2026-07-14", 7).count() == 8
    assert clean.between_days(events, "2026-07-02", "2026-07-03").count() == 2


def test_city_from_ip(spark, make_events):
    ranges = spark.createDataFrame(
        [("10.0.0.0", "10.0.0.255", "A"), ("10.0.1.0", "10.2.0.255", "B")], "ip_from string, ip_to string, city string"
    )
    events = make_events(
        [("u", "page_view", "2026-07-10 10:00:00", {"ip": ip, "city": city}) for ip, city in
         [("10.0.0.255", ""), ("10.0.1.0", None), ("10.1.7.7", ""), ("10.2.1.0", ""), ("10.0.0.9", "kept"), ("bad", "")]]
    ).filter("ip <> 'bad'")
    got = rows(clean.enrich_city(events, ranges), "ip", "city")
    assert got == [("10.0.0.255", "A"), ("10.0.0.9", "kept"), ("10.0.1.0", "B"), ("10.1.7.7", "B"), ("10.2.1.0", "")]


def test_ties_do_not_depend_on_the_columns_asked_for(make_events):
    same = {"event_id": "a", "server_time": dt.datetime(2026, 7, 11)}
    copies = [("u", "page_view", "2026-07-09 10:00:00", {**same, "city": "z"}), ("u", "page_view", "2026-07-10 10:00:00", {**same, "city": "a"})]
    events = make_events(copies)
    assert rows(clean.ods_to_dwd(events), "event_time") == rows(clean.ods_to_dwd(events, ["city"]), "event_time")


def test_rows_without_an_id_are_counted_not_merged(make_events):
    events = make_events([("u", "page_view", "2026-07-10 10:00:00", {"event_id": None})] * 2 + [("u", "page_view", "2026-07-10 10:00:00")])
    assert clean.ods_to_dwd(events).count() == 1
    assert rows(clean.cleaning_report(events)) == [(3, 2, 1, 1, 1)]


def test_city_of_a_busy_network(spark, make_events):
    ranges = spark.createDataFrame([("10.0.0.0", "10.0.255.255", "A"), ("10.1.0.7", "10.1.0.7", "B"), ("10.1.0.8", "10.2.3.4", "C")], "ip_from string, ip_to string, city string")
    ips = ["10.0.0.0", "10.0.200.9", "10.0.255.255", "10.1.0.6", "10.1.0.7", "10.1.0.8", "10.2.3.4", "10.2.3.5"]
    events = make_events([("u", "page_view", "2026-07-10 10:00:00", {"city": "", "ip": ip}) for ip in ips])
    got = {r.ip: r.city for r in clean.enrich_city(events, ranges).collect()}
    assert [got[ip] for ip in ips] == ["A", "A", "A", "", "B", "C", "C", ""]


def test_address_blocks_cover_ranges_exactly(spark):
    """Single addresses, aligned and crooked ranges, a /8 and the whole space: each address lies in one block."""
    ends = [("0.0.0.0", "0.0.0.0"), ("0.0.0.1", "0.0.0.6"), ("0.0.1.0", "0.0.3.255"), ("9.0.0.1", "9.255.255.254"), ("11.0.0.0", "11.255.255.255"), ("128.0.0.0", "255.255.255.255")]
    ranges = spark.createDataFrame([(a, b, str(i)) for i, (a, b) in enumerate(ends)], "ip_from string, ip_to string, city string")
    number = lambda ip: sum(int(x) << s for x, s in zip(ip.split("."), (24, 16, 8, 0)))
    found = {}
    for bits, prefix, city in clean.address_blocks(ranges).select("bits", "prefix", "city").collect():
        found.setdefault(city, []).append((prefix << bits, (prefix + 1) << bits))
    for i, (a, b) in enumerate(ends):
        blocks = sorted(found[str(i)])
        assert blocks[0][0] == number(a) and blocks[-1][1] == number(b) + 1
        assert all(x[1] == y[0] for x, y in zip(blocks, blocks[1:])) and len(blocks) <= 62
    assert len(found["4"]) == len(found["5"]) == 1
