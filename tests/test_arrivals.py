import json
import uuid

from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.functions import urls
from tapewire.operators.news import clean_sector_news, publish_window
from tapewire.sources.readers import read_landing
from tapewire.streaming.ingest import late_rows, load_first_arrivals
from tests.conftest import rows


def land(root, day, *items):
    """Items (address, publish instant) as one landed file of a run."""
    folder = root / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({"sector_id": 1, "title": f"t {url.strip()}", "content": "c", "date_published": at,
                    "source_url": url, "author": "a", "source_id": "s", "source_name": "n"})
        for url, at in items
    ]
    (folder / f"{uuid.uuid4().hex}.json").write_text("\n".join(lines))


def test_copies_and_late_rows_over_replays(spark, tmp_path):
    landing, table = tmp_path / "sector", str(tmp_path / "unique")
    name = f"first_{uuid.uuid4().hex}"

    def load():
        query = load_first_arrivals(spark, str(landing), table, name)
        query.awaitTermination()
        kept = spark.read.parquet(table)
        states = [s["numRowsTotal"] for b in query.recentProgress for s in b["stateOperators"]]
        return sorted(r.source_url for r in kept.collect()), late_rows(query), states

    land(landing, "2024-01-08", ("https://a/1", "2024-01-07T10:00:00Z"),
         ("https://a/2", "2024-01-06T10:00:00Z"), ("https://a/old", "2024-01-01T10:00:00Z"),
         ("https://a/plain", None))
    assert load()[0] == ["https://a/1", "https://a/2", "https://a/plain"]
    # The next run lands a copy with blanks and a new article.
    land(landing, "2024-01-09", (" https://a/1 ", "2024-01-07T10:00:00Z"),
         ("https://a/3", "2024-01-08T23:00:00Z"))
    urls_, late, _ = load()
    assert urls_ == ["https://a/1", "https://a/2", "https://a/3", "https://a/plain"] and late == 0
    batch = read_landing(spark, str(landing), schemas.RAW_SECTOR_NEWS)
    wanted = clean_sector_news(publish_window(batch, "run_date"), "run_date", first_run_wins=True)
    stored = spark.read.parquet(table).select(*wanted.columns)
    assert sorted(map(str, rows(stored))) == sorted(map(str, rows(wanted)))
    # Much later, the watermark has passed: state is dropped, and a copy that comes now is late.
    land(landing, "2024-02-02", ("https://a/9", "2024-02-01T10:00:00Z"))
    load()
    land(landing, "2024-01-09", ("https://a/2", "2024-01-07T12:00:00Z"))
    land(landing, "2024-02-03", ("https://a/10", "2024-02-02T10:00:00Z"))
    urls_, late, states = load()
    assert "https://a/10" in urls_ and urls_.count("https://a/2") == 1 and late == 1
    assert states[-1] <= 2
    assert load()[0] == urls_


def test_rule_table_of_any_size(spark, tmp_path):
    rules = ["// comment", "co.uk", "*.ck", "!www.ck", "uk", "com", "K12.ca.us  // note", ""]
    hosts = ["a.b.co.uk", "co.uk", "x.y.ck", "y.ck", "a.www.ck", "www.ck", "ck", "1.2.3.4", "h.k12.ca.us",
             "A.Example.COM.", "single", "", None, "a.b.co.uk"]
    table = spark.createDataFrame([(h, i) for i, h in enumerate(hosts)], "host string, i int")
    sizes = []
    for extra in (0, 10_000):
        path = tmp_path / f"rules{extra}"
        path.write_text("\n".join(rules + [f"none{k}.zz" for k in range(extra)]))
        found = urls.with_registered_domain(table, urls.suffix_rules(spark, str(path)))
        sizes.append(len(found._jdf.queryExecution().toString()))
        got = {r.i: r.registered for r in found.collect()}
        known = urls.read_suffixes(spark, str(path))
        want = table.select("i", urls.registered_domain("host", known).alias("r")).collect()
        assert got == {r.i: r.r for r in want}
    assert abs(sizes[0] - sizes[1]) < 200
    kept = urls.with_registered_domain(table, urls.suffix_rules(spark, str(path)))
    assert kept.where(F.col("host").isNull()).count() == 1 and kept.count() == len(hosts)
