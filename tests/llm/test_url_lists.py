import datetime as dt
import random

from tapewire.llm.url_lists import host, intervals, on_lists

DAY = dt.date(2024, 1, 1)
ENTRY = "list string, domain string, day date, listed boolean"
CAPTURE = "page_id long, url string, fetched date"


def day(n):
    return None if n is None else DAY + dt.timedelta(n)


def plain(captures, entries):
    """Lists of each capture, from all entries up to its day."""
    out = []
    for page, url, fetched in captures:
        name = url.split("://")[1].split("/")[0].lower()
        found = set()
        for one in {e[0] for e in entries}:
            for domain in {e[1].lower() for e in entries}:
                if name != domain and not name.endswith("." + domain):
                    continue
                known = [e for e in entries if e[0] == one and e[1].lower() == domain and e[2] <= fetched]
                last = max((e[2] for e in known), default=None)
                if known and all(e[3] for e in known if e[2] == last):
                    found.add(one)
        out.append((page, ",".join(sorted(found))))
    return sorted(out)


def test_equals_all_entries_up_to_the_day(spark):
    rng = random.Random(5)
    hosts = ["a.example", "www.a.example", "b.a.example", "example", "c.test", "xa.example"]
    entries = [
        (f"l{rng.randrange(3)}", rng.choice(hosts).upper(), day(rng.randrange(0, 700, 5)), rng.random() < 0.6)
        for _ in range(150)
    ]
    captures = [(i, f"https://{rng.choice(hosts)}/p", day(rng.randrange(700))) for i in range(400)]
    out = on_lists(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(entries, ENTRY))
    assert sorted((r.page_id, r.lists) for r in out.collect()) == plain(captures, entries)


def test_intervals(spark):
    entries = [
        ("l", "A.b", day(3), True), ("l", "a.b", day(3), True), ("l", "a.b", day(5), True),
        ("l", "a.b", day(9), False), ("l", "a.b", day(9), True), ("l", "a.b", day(20), True),
        ("l", "c.d", day(1), False), (None, "c.d", day(1), True), ("l", "c.d", None, True),
    ]
    out = intervals(spark.createDataFrame(entries, ENTRY))
    assert sorted(map(tuple, out.collect())) == [
        ("l", "a.b", day(3), day(9)), ("l", "a.b", day(20), None)
    ]


def test_odd_rows(spark):
    urls = ["https://u:p@A.b:80/x", "ftp://a.b.", "no url", None, "", "https://", "http://z.a.b?q" + "x" * 99999]
    rows = [(i, u, day(4), "x", 1) for i, u in enumerate(urls)] + [(8, urls[0], None, "x", 1)] * 2
    captures = spark.createDataFrame(rows, CAPTURE + ", host string, domain int")
    entries = spark.createDataFrame([("l", "a.b", day(0), True)], ENTRY)
    assert [r[0] for r in captures.limit(7).select(host("url")).collect()] == [
        "a.b", "a.b", None, None, None, None, "z.a.b"
    ]
    out = on_lists(captures, entries).collect()
    assert sorted((r.page_id, r.blocked) for r in out) == [
        (0, True), (1, True), (2, False), (3, False), (4, False), (5, False), (6, True), (8, False), (8, False)
    ]
    assert not any(r.blocked for r in on_lists(captures, entries.limit(0)).collect())
    assert on_lists(captures.limit(0), entries).collect() == []
