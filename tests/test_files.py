import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.functions import urls
from tapewire.sinks import writers
from tapewire.sources import payloads, readers
from tests.conftest import rows

D = dt.date


def write_lines(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))


def quote(symbol, date, close=2.0):
    return {"symbol": symbol, "date": date, "open": 1.0, "high": 2.0, "low": 1.0, "close": close}


def test_landing_reads_all_files_and_keeps_the_trade_date(spark, tmp_path):
    write_lines(tmp_path / "date=2024-01-06" / "a.jsonl", quote("A", "2024-01-05"))
    write_lines(tmp_path / "date=2024-01-06" / "b.jsonl", quote("B", "2024-01-05"))
    write_lines(tmp_path / "date=2024-01-09" / "a.jsonl", quote("A", "2024-01-08"))
    df = readers.read_landing(spark, str(tmp_path), schemas.MARKET_OHLC)
    got = rows(df.select("symbol", "date", "run_date").orderBy("run_date", "symbol"))
    assert got == [
        ("A", D(2024, 1, 5), D(2024, 1, 6)),
        ("B", D(2024, 1, 5), D(2024, 1, 6)),
        ("A", D(2024, 1, 8), D(2024, 1, 9)),
    ]
    one = readers.read_landing(spark, str(tmp_path), schemas.MARKET_OHLC, [D(2024, 1, 9)])
    assert rows(one.select("run_date")) == [(D(2024, 1, 9),)]


def test_landing_tolerates_missing_fields_and_broken_lines(spark, tmp_path):
    file = tmp_path / "date=2024-01-06" / "part.jsonl"
    write_lines(file, {"ticker": "A"}, {"ticker": "B", "title": None, "extra": 1})
    file.write_text(file.read_text() + "not json\n")
    df = readers.read_landing(spark, str(tmp_path), schemas.RAW_TICKER_NEWS)
    assert df.columns == [*schemas.RAW_TICKER_NEWS.fieldNames(), "run_date"]
    assert {r.ticker for r in df.collect()} == {"A", "B", None}


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(None, "n", "t", "c", None, "u", "A", "2024-01-05")],
        "source_id string, source_name string, title string, content string, "
        "date_published string, source_url string, ticker string, date string",
    )
    assert writers.write_partitioned(df, str(tmp_path / "news"), "date", "json") == 1
    back = readers.read_landing(spark, str(tmp_path / "news"), schemas.RAW_TICKER_NEWS)
    assert rows(back) == [(None, "n", "t", "c", None, "u", "A", D(2024, 1, 5))]
    text = next((tmp_path / "news" / "date=2024-01-05").glob("*.json")).read_text()
    assert '"source_id":null' in text


def test_only_the_written_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, date string")
    assert writers.write_partitioned(first, path, "date") == 2
    again = spark.createDataFrame([(3, "2024-01-02"), (4, "2024-01-02")], "v int, date string")
    assert writers.write_partitioned(again, path, "date") == 2
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3, 4]


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows_ = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, "2024-01-01")
            .otherwise(F.concat(F.lit("2024-02-"), F.col("id") % 20 + 10))
            .alias("date"),
            F.sha2(F.col("id").cast("string"), 256).alias("body"),
        )
        assert writers.write_partitioned(rows_, str(tmp_path / "t"), "date") == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t" / "date=2024-01-01").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_empty_tables_keep_their_schema(spark, tmp_path):
    path = str(tmp_path / "empty")
    empty = spark.createDataFrame([], schemas.SOURCES)
    assert writers.write_table(empty, path) == 0
    assert spark.read.parquet(path).schema == schemas.SOURCES


def test_csv_export_and_import(spark, tmp_path):
    df = spark.createDataFrame(
        [("A", D(2024, 1, 5), 1.0, 2.0, 0.5, 1.5)], schemas.MARKET_OHLC
    )
    path = str(tmp_path / "out")
    assert writers.write_table(df, path, "csv") == 1
    assert rows(readers.read_csv(spark, path, schemas.MARKET_OHLC)) == rows(df)
    text = spark.createDataFrame([(1, 'two\nlines, "quoted"')], schemas.SECTORS)
    assert writers.write_table(text, path, "csv") == 1
    assert rows(readers.read_csv(spark, path, schemas.SECTORS)) == rows(text)


def test_csv_header_in_any_case_and_order(spark, tmp_path):
    file = tmp_path / "market.csv"
    file.write_text("Close,OPEN,Symbol,Date,volume\n2.5,1.0,A,2024-01-05,9\nx,,B,bad,1\n")
    df = readers.read_table(spark, str(file), schemas.MARKET_OHLC)
    assert df.schema == schemas.MARKET_OHLC
    assert rows(df) == [
        ("A", D(2024, 1, 5), 1.0, None, None, 2.5),
        ("B", None, None, None, None, None),
    ]


def test_format_dispatch(spark, tmp_path):
    both, csv_only, neither = (tmp_path / n for n in ("both", "csv", "neither"))
    for folder in (both, csv_only, neither):
        folder.mkdir()
    (neither / "x.txt").write_text("x")
    (csv_only / "x.csv").write_text("sector_id,sector_name\n1,from csv\n")
    (both / "x.csv").write_text("sector_id,sector_name\n1,from csv\n")
    table = spark.createDataFrame([(1, "from parquet")], schemas.SECTORS).coalesce(1)
    table.write.mode("append").parquet(str(both))
    table.write.mode("append").parquet(str(both))

    def names(path):
        return [r.sector_name for r in readers.read_table(spark, str(path), schemas.SECTORS).collect()]

    assert names(both) == ["from parquet"] * 2
    assert names(csv_only) == ["from csv"]
    assert names(next(both.glob("*.parquet"))) == ["from parquet"]
    for missing in (neither, tmp_path / "absent"):
        with pytest.raises(FileNotFoundError):
            readers.read_table(spark, str(missing), schemas.SECTORS)


def test_insert_new_appends_only(spark, tmp_path):
    path = str(tmp_path / "sectors")
    writers.create_table(spark, path, schemas.SECTORS)
    order = [F.col("sector_id").asc()]
    first = spark.createDataFrame([(1, "a"), (2, "b")], schemas.SECTORS)
    assert writers.insert_new(spark, path, schemas.SECTORS, first, ["sector_name"], order) == 2
    more = spark.createDataFrame([(9, " a"), (3, "c")], schemas.SECTORS)
    assert writers.insert_new(spark, path, schemas.SECTORS, more, ["sector_name"], order) == 1
    writers.create_table(spark, path, schemas.SECTORS)
    assert sorted(rows(spark.read.parquet(path))) == [(1, "a"), (2, "b"), (3, "c")]


def test_merge_results_never_overwrite_their_source(spark, tmp_path):
    path = str(tmp_path / "v1")
    writers.write_table(spark.range(3).toDF("id"), path)
    merged = spark.read.parquet(path).where("id > 0")
    with pytest.raises(ValueError, match="new path"):
        writers.write_merged(merged, path, path + "/")
    assert writers.write_merged(merged, path, str(tmp_path / "v2")) == 2


def payload_rows(spark, *values):
    return spark.createDataFrame(
        [(t, i, json.dumps(p) if isinstance(p, dict) else p) for i, (t, p) in enumerate(values)],
        "ticker string, sector_id int, payload string",
    )


def test_payloads(spark):
    article = {
        "source": {"id": "bbc", "name": "BBC"},
        "author": "x",
        "title": "t1",
        "content": "c1",
        "url": "u1",
        "publishedAt": "2024-01-01T00:00:00Z",
    }
    df = payload_rows(
        spark,
        ("A", {"status": "ok", "articles": [article, {"title": "t2"}, {"source": None, "title": "t3"}]}),
        ("B", {"status": "error", "message": "limit", "articles": [article]}),
        ("C", {"status": "ok", "articles": []}),
        ("D", {"status": "ok"}),
        ("E", "not json"),
        ("F", None),
    )
    flat = payloads.flatten_ticker_payloads(df).orderBy("position")
    assert rows(flat.select("ticker", "position", "source_id", "source_name", "title", "source_url")) == [
        ("A", 0, "bbc", "BBC", "t1", "u1"),
        ("A", 1, None, None, "t2", None),
        ("A", 2, None, None, "t3", None),
    ]
    sector = payloads.flatten_sector_payloads(df).orderBy("position").first()
    assert (sector.sector_id, sector.author, sector.source_name) == (0, "x", "BBC")
    outcomes = dict(rows(payloads.payload_outcomes(df)))
    assert outcomes == {"used": 1, "empty": 2, "error": 3}


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sector_id,SECTOR_NAME\n1,x\n")
    (tmp_path / "b.csv").write_text("sector_id,sector_name\n2,y\n")
    both = readers.read_csv(spark, str(tmp_path), schemas.SECTORS)
    assert sorted(rows(both)) == [(1, "x"), (2, "y")]
    for header in ("sector_name,sector_id\ny,2\n", "sector_id,sector_name,more\n2,y,z\n"):
        (tmp_path / "b.csv").write_text(header)
        with pytest.raises(Exception, match="(?i)header"):
            readers.read_csv(spark, str(tmp_path), schemas.SECTORS).collect()


def test_bad_json_lines_are_kept_and_counted(spark, tmp_path):
    folder = tmp_path / "date=2024-01-08"
    folder.mkdir()
    (folder / "part.jsonl").write_text('{"ticker": "A"}\n{"ticker": \n[1\n{"ticker": "B"}\n')
    landed = readers.read_landing(
        spark, str(tmp_path), schemas.RAW_TICKER_NEWS, bad_col="bad"
    )
    assert readers.bad_lines(landed, "bad") == 2
    assert sorted(r.ticker for r in landed.cache().where("bad is null").collect()) == ["A", "B"]


def test_suffix_rules_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.dat"
    path.write_text("// comment\n\ncom\nco.uk\n*.ck // more\n!www.ck\n")
    rules = urls.read_suffixes(spark, str(path))
    assert rules == ["!www.ck", "*.ck", "co.uk", "com"]
    hosts = spark.createDataFrame([("a.b.co.uk",), ("x.y.z.ck",), ("a.www.ck",), ("b.a.com",)], "h string")
    found = [r[0] for r in hosts.select(urls.registered_domain("h", rules)).collect()]
    assert found == ["b.co.uk", "y.z.ck", "www.ck", "a.com"]
    with pytest.raises(ValueError, match="more than 2"):
        urls.read_suffixes(spark, str(path), 2)


def test_csv_files_with_other_headers_are_aligned_by_name(spark, tmp_path):
    files = {
        "a [1]+%20.csv": "sector_id,SECTOR_NAME\n1,x\n",
        "b.csv": 'Sector_Name,sector_id\n"two, and\nlines",2\n',
        "c.csv": "sector_id,more,sector_name\n3,dropped,z\nbad,,w\n",
        "d.csv": "sector_name\nonly a name\n",
        "e.csv": "\ufeffsector_id,sector_name\r\n4,v\r\n",
        "empty.csv": "",
        "header.csv": "sector_id,sector_name\n",
        "other.txt": "sector_id,sector_name\n9,no\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content.encode())
    found = readers.read_csv(spark, str(tmp_path), schemas.SECTORS, by_name=True)
    assert found.schema == schemas.SECTORS
    assert sorted(rows(found), key=str) == sorted(
        [(1, "x"), (2, "two, and\nlines"), (3, "z"), (None, "w"), (None, "only a name"), (4, "v")],
        key=str,
    )
    # Files are grouped by header, however many there are.
    for i in range(30):
        (tmp_path / f"many{i}.csv").write_text(f"sector_name,sector_id\nn{i},{i}\n")
    assert len(readers.csv_headers(spark, str(tmp_path))) == 4
    assert readers.read_csv(spark, str(tmp_path), schemas.SECTORS, by_name=True).count() == 36


def test_csv_headers_by_name_odd_folders(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("")
    none = readers.read_csv(spark, str(tmp_path), schemas.SECTORS, by_name=True)
    assert (none.schema, none.count()) == (schemas.SECTORS, 0)
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    monkeypatch.setattr(readers, "MAX_HEADERS", 1)
    with pytest.raises(ValueError, match="more than 1"):
        readers.csv_headers(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("x,X\n2,1\n")
    with pytest.raises(ValueError, match="twice"):
        readers.csv_headers(spark, str(tmp_path))


def test_a_large_csv_file_has_one_header(spark, tmp_path):
    side = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(side)
    (tmp_path / "a.csv").write_text("sector_name,sector_id\n" + "name,1\n" * 5000)
    (tmp_path / "b.csv").write_text("sector_id,sector_name\n" + "2,name\n" * 5000)
    spark.conf.set(side, "4096")
    try:
        assert len(readers.csv_headers(spark, str(tmp_path))) == 2
        found = readers.read_csv(
            spark, str(tmp_path), schemas.SECTORS, multi_line=False, by_name=True
        )
        counts = found.groupBy("sector_id", "sector_name").count()
        assert sorted(rows(counts)) == [(1, "name", 5000), (2, "name", 5000)]
    finally:
        spark.conf.set(side, before)
