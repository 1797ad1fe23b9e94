import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedweave.operators import bookkeeping as B
from feedweave.plans import ingest as I
from feedweave.sources import archive

FEED = """id,title,description,value,category,timestamp
btc-bitcoin,Bitcoin,"Oldest, of many",312.25,coin,2023-11-03T07:45:00Z
eth-ethereum,Ethereum,Runs programs,87.5,coin,2023-11-04T21:05:00Z
usdt-tether,Tether,Pegged,4,token,2023-11-09T16:00:00Z
"""


class Clock:
    """Advances a minute at every look."""

    def __init__(self):
        self.now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

    def __call__(self):
        self.now += dt.timedelta(minutes=1)
        return self.now


@pytest.fixture
def lake(spark, tmp_path):
    return I.Lake(spark, str(tmp_path / "lake"), clock=Clock())


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def counters(result):
    return result.processed, result.inserted, result.updated, result.failed, result.skipped


def test_csv_run_and_rerun(spark, lake, tmp_path):
    feed = I.csv_feed(spark, write(tmp_path, "a.csv", FEED))
    first = lake.run(feed)
    assert first.status == "success", first.error
    assert counters(first) == (3, 3, 0, 0, 0)
    rows = {r["source_id"]: r for r in lake.records.read().collect()}
    btc = rows["csv_btc-bitcoin"]
    assert btc["canonical_id"] == "bitcoin" and btc["value"] == 312.25
    assert btc["description"] == "Oldest, of many"
    assert btc["tags"] is None and btc["extra_metadata"] == {"original_id": "btc-bitcoin"}
    assert btc["updated_at"] is None

    # Everything is at or below the mark now.
    assert counters(lake.run(feed)) == (0, 0, 0, 0, 3)
    # Without the mark every row is an update and the table stays the same size.
    again = lake.run(feed, incremental=False)
    assert counters(again) == (3, 0, 3, 0, 0)
    after = {r["source_id"]: r for r in lake.records.read().collect()}
    assert set(after) == set(rows)
    assert after["csv_btc-bitcoin"]["created_at"] == btc["created_at"]
    assert after["csv_btc-bitcoin"]["updated_at"] is not None
    assert lake.raw.read().count() == 3
    runs = lake.runs().collect()
    assert len(runs) == 3 and {r["status"] for r in runs} == {"success"}
    assert all(r["duration_seconds"] > 0 for r in runs)
    point = lake.checkpoints.read().first()
    assert point["records_processed"] == 6
    assert point["last_processed_timestamp"] == dt.datetime(2023, 11, 9, 16, 0)


def test_invalid_rows_are_quarantined(spark, lake, tmp_path):
    text = FEED.splitlines()[0] + "\n1,,d,-99.99,c,2030-01-01T00:00:00Z\n2,Ok,d,5,c,invalid-date\n3,NA,d,x,c,\n"
    result = lake.run(I.csv_feed(spark, write(tmp_path, "a.csv", text)))
    assert counters(result) == (1, 1, 0, 2, 0)
    bad = {r["source_id"]: r for r in lake.quarantine.read().collect()}
    assert sorted(bad["csv_1"]["reasons"]) == ["title_missing", "value_negative"]
    assert json.loads(bad["csv_1"]["raw_data"])["value"] == "-99.99"
    kept = lake.records.read().first()
    assert kept["source_id"] == "csv_2" and kept["source_timestamp"] is None
    # Row 3 has a value that is no number.
    drift = {r["record_id"]: r for r in lake.drift_log.read().collect()}
    assert [m["field"] for m in drift["csv_3"]["type_mismatches"]] == ["value"]


def test_last_row_wins_within_a_file(spark, lake, tmp_path):
    text = FEED.splitlines()[0] + "\n" + "".join(f"k,T{i},d,{i},c,\n" for i in range(5))
    result = lake.run(I.csv_feed(spark, write(tmp_path, "a.csv", text)))
    assert counters(result) == (5, 1, 4, 0, 0)
    assert [r["title"] for r in lake.records.read().collect()] == ["T4"]


def test_missing_column_is_drift(spark, lake, tmp_path):
    text = "id,title,value,category,timestamp\n1,A,1,c,\n2,B,2,c,\n3,C,3,d,\n"
    lake.run(I.csv_feed(spark, write(tmp_path, "a.csv", text)))
    log = lake.drift_log.read().collect()
    assert [r["missing_fields"] for r in log] == [["description"]] * 3


def test_recovery_after_a_failed_run(spark, lake, tmp_path):
    text = "id,title,description,value,category,timestamp\n" + "".join(
        f"{name}-mine,{name.title()} output,tonnes a day,{len(name) * 12.5},metal,2022-0{k}-17T06:30:00Z\n"
        for k, name in enumerate(["tin", "zinc", "lead", "nickel", "copper"], 3)
    )
    good = I.csv_feed(spark, write(tmp_path, "a.csv", text))

    def broken():
        return good.parse().withColumn("title", F.raise_error(F.lit("source went away")).cast("string"))

    failed = lake.run(I.Feed("csv", broken))
    assert failed.status == "failure" and "source went away" in failed.error
    assert B.should_resume(lake.checkpoints.read(), "csv")
    assert lake.records.read().count() == 0
    done = lake.run(good)
    assert counters(done) == (5, 5, 0, 0, 0)
    assert not B.should_resume(lake.checkpoints.read(), "csv")
    statuses = {r["status"]: r for r in lake.runs().collect()}
    assert "source went away" in statuses["failure"]["error_message"]
    assert statuses["success"]["records_processed"] == 5
    assert lake.checkpoints.read().first()["error_message"] is None


def test_all_sources_together(spark, lake, tmp_path):
    api1 = write(tmp_path, "one.json", json.dumps({"data": [
        {"id": "b1", "name": "Bitcoin", "symbol": "BTC", "amount": "45001", "type": "coin", "tags": ["x"], "created_at": "2024-01-15T10:30:00Z"},
        {"id": 7, "name": "Number id"},
        {"id": "b2", "title": "Other", "value": 5, "category": "c", "created_at": None},
        {"id": "b3", "name": None},
        {"id": "b4", "name": "Tags", "tags": [1]},
    ]}))
    api2 = write(tmp_path, "two.json", json.dumps([{"id": "e", "name": "Ethereum", "symbol": "ETH"}]))
    rss = write(tmp_path, "feed.xml", """<?xml version="1.0"?><rss><channel><title>n</title>
      <item><title>Bitcoin climbs</title><link>https://n/1</link><description>up &amp; up</description>
      <guid isPermaLink="false">g1</guid><pubDate>Mon, 15 Jan 2024 10:30:00 GMT</pubDate><category>markets</category><category>btc</category></item>
      <item><title>Zebra gym</title><link>https://n/coins/ltc/2</link></item></channel></rss>""")
    results = lake.run_all([
        I.csv_feed(spark, write(tmp_path, "a.csv", FEED)),
        I.csv_feed(spark, str(tmp_path / "absent.csv")),
        I.api_feed(spark, api1, "api1", whole_files=True),
        I.api_feed(spark, api2, "api2", whole_files=True),
        I.rss_feed(spark, rss),
    ])
    assert [r.status for r in results] == ["success", "failure", "success", "success", "success"]
    assert counters(results[2]) == (2, 2, 0, 3, 0)
    rows = {r["source_id"]: r for r in lake.records.read().collect()}
    one = rows["api_api1_b1"]
    assert (one["source_type"], one["value"], one["category"], one["tags"]) == ("api1", 45001.0, "coin", ["x"])
    assert one["extra_metadata"] == {"original_id": "b1", "source_name": "api1"}
    assert rows["api_api1_b2"]["title"] == "Other" and rows["api_api1_b2"]["tags"] == []
    news = rows["rss_g1"]
    assert (news["canonical_id"], news["category"], news["tags"]) == ("bitcoin", "markets", ["markets", "btc"])
    assert news["description"] == "up & up" and news["source_timestamp"] == dt.datetime(2024, 1, 15, 10, 30)
    assert rows["rss_https://n/coins/ltc/2"]["canonical_id"] == "litecoin"
    reasons = {r["source_id"]: sorted(r["reasons"]) for r in lake.quarantine.read().collect()}
    assert reasons == {
        "api_api1_7": ["id_not_string"], "api_api1_b3": ["name_not_string"],
        "api_api1_b4": ["tags_not_string_list"],
    }
    assert {r["source_name"] for r in lake.drift_log.read().collect()} == {"api1", "api2", "rss"}

    doc = json.loads(lake.metrics().first()["metrics"])
    assert doc["runs"]["csv"] == {"total": 2, "success": 1, "failure": 1}
    assert doc["records"] == {"csv": 3, "api1": 2, "api2": 1, "rss": 2}
    assert doc["checkpoints"]["api1"]["records_processed"] == 2
    lake.write_event_log(str(tmp_path / "log"))
    events = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert sum(e["event"] == "etl_run_started" for e in events) == 5
    assert [e["level"] for e in events if e["event"] == "etl_run_failed"] == ["ERROR"]

    # Old records can be normalised again from the archive.
    before = {r["source_id"]: r["created_at"] for r in rows.values()}
    for parsed in (archive.archived_csv(lake.raw.read()), archive.archived_api(lake.raw.read(), "api1"), archive.archived_rss(lake.raw.read())):
        lake.renormalize(parsed)
    again = {r["source_id"]: r for r in lake.records.read().collect()}
    assert {k: r["created_at"] for k, r in again.items()} == before
    for k, r in again.items():
        assert r.asDict() | {"updated_at": None} == rows[k].asDict() | {"updated_at": None}


def test_payload_shapes(spark, tmp_path):
    from feedweave.sources.files import read_json_payloads

    lines = ['[{"a":1},{"a":2}]', '{"data":[{"a":3}]}', '{"results":[{"a":4},{"a":5}]}', '{"a":6}', "broken", '{"data":[]}', "[]"]
    path = write(tmp_path, "p.txt", "\n".join(lines))
    got = sorted(str(r["raw_data"]) for r in read_json_payloads(spark, path).collect())
    assert got == sorted([*[f'{{"a":{i}}}' for i in range(1, 7)], "broken"])


def test_atom(spark, tmp_path):
    from feedweave.sources.files import read_atom

    path = write(tmp_path, "a.xml", """<feed><entry><id>i1</id><title type="html">T</title><summary>S</summary>
      <link rel="self" href="https://n/self"/><link href="https://n/1"/><updated>2024-01-15T10:30:00Z</updated>
      <category term="c1"/><category term="c2"/></entry></feed>""")
    row = read_atom(spark, path).first().asDict()
    assert row == {"id": "i1", "title": "T", "summary": "S", "link": "https://n/1",
                   "published": "2024-01-15T10:30:00Z", "categories": ["c1", "c2"], "_unreadable": None}


def test_provider_mappings(spark):
    from feedweave.operators import normalize as N

    ticker = '{"id":"btc-bitcoin","name":"Bitcoin","symbol":"BTC","rank":1,"quotes":{"USD":{"price":45000.5}}}'
    market = '{"id":"bitcoin","symbol":"btc","name":"Bitcoin","current_price":45000.5,"market_cap_rank":11,"last_updated":"2024-01-15T10:30:00.000Z"}'
    df = spark.createDataFrame([(ticker,), (market,)], "raw_data string").withColumn("record", F.try_parse_json("raw_data"))
    one, _ = N.parse_api(df, "api1", N.TICKER_FEED).collect()
    assert (one["value"], one["title"], one["reasons"]) == (45000.5, "Bitcoin", [])
    _, two = N.parse_api(df, "api2", N.MARKET_FEED).collect()
    assert (two["value"], two["source_timestamp"]) == (45000.5, dt.datetime(2024, 1, 15, 10, 30))
    quotes = df.select(*[c.alias(n) for n, c in N.market_quote(F.col("record")).items()]).collect()
    assert quotes[1]["category"] == "top-100" and quotes[0]["category"] is None


def test_archived_cells_are_read_once(spark):
    """What is asked of archived rows, filters too, looks at cells that have been read; each text is parsed once."""
    raw = spark.createDataFrame([("csv", "csv_1", '{"id":"1","title":"a","value":"x"}')], "source_type string, source_id string, raw_data string")
    found = archive.archived_csv(raw).filter("size(reasons) = 0 AND title IS NOT NULL")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [tuple(r) for r in archive.archived_csv(raw).select("source_id", "title", "fields").collect()] == [("csv_1", "a", ["id", "title", "value"])]
