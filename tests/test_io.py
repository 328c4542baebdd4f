import json
import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from rateloom import schemas
from rateloom.plans.latest_rates import check_bases, run_latest_rates
from rateloom.plans.latest_rates import main as latest_rates_main
from rateloom.session import scratch_dir, shuffle_partitions
from rateloom.sinks.manifest import read_manifest
from rateloom.sinks.objects import write_objects
from rateloom.sinks.parquet import write_parquet
from rateloom.sinks.sheet import write_sheet_table
from rateloom.sources import files, requests, tables
from rateloom.sources.envelope import latest_responses
from rateloom.streaming.landing import run_landing


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


# ---- requests


def calls(spark, *keys, method="GET"):
    return spark.createDataFrame([(k, method, "x", {"q": "1"}, {}, None) for k in keys], schemas.REQUESTS)


class Flaky:
    """Fails until attempt ``good``, with the given statuses (None is a connection error)."""

    def __init__(self, good, statuses):
        self.good, self.statuses = good, statuses

    def __call__(self, request, attempt):
        if attempt >= self.good:
            return requests.Reply(200, json.dumps({"key": request["request_key"]}))
        status = self.statuses[attempt - 1]
        if status is None:
            raise ConnectionError
        return requests.Reply(status, headers={"retry-after": "9"})


class Waits:
    """Notes the waits in a file, because the calls happen in other processes."""

    def __init__(self, path):
        self.path = path

    def __call__(self, seconds):
        with open(self.path, "a") as out:
            out.write(f"{seconds}\n")


def test_fetch_retries(spark, tmp_path):
    waits = Waits(str(tmp_path / "waits"))
    got = requests.fetch_responses(calls(spark, "a"), Flaky(4, [None, 429, 503]), sleep=waits)
    assert rows(got, "request_key", "status", "body") == [("a", 200, '{"key": "a"}')]
    assert (tmp_path / "waits").read_text().split() == ["2", "9", "2"]
    assert got.schema == schemas.LANDED


@pytest.mark.parametrize("statuses,last", [([500] * 5, 500), ([None] * 5, None), ([400] * 5, 400)])
def test_fetch_gives_up(spark, statuses, last):
    got = requests.fetch_responses(calls(spark, "a", "b"), Flaky(9, statuses), sleep=lambda s: None)
    assert {r["status"] for r in got.select("status").collect()} == {last}


class Locked:
    """401 until the credentials are renewed, which leaves a file."""

    def __init__(self, path):
        self.path = path

    def __call__(self, request, attempt):
        return requests.Reply(200 if os.path.exists(self.path) else 401, "{}")


@pytest.mark.parametrize("method,renews,status", [("GET", True, 200), ("POST", True, 200), ("GET", False, 401), ("PUT", True, 401)])
def test_fetch_renews_credentials(spark, tmp_path, method, renews, status):
    path = str(tmp_path / "token")

    def renew():
        if renews:
            open(path, "w").close()
        return renews

    got = requests.fetch_responses(calls(spark, "a", method=method), Locked(path), reauthenticate=renew, sleep=lambda s: None)
    assert got.first()["status"] == status


def paged(request, attempt):
    page = int(request["params"].get("page_token", 0)) if isinstance(request["params"], dict) else 0
    return requests.Reply(200, json.dumps({"page": page, "next_page_token": str(page + 1) if page < 2 else None}))


def test_fetch_follows_pages(spark):
    got = requests.fetch_responses(calls(spark, "a", "b"), paged, max_concurrency=2)
    assert sorted(tuple(r) for r in got.select("request_key", "page", F.get_json_object("body", "$.page")).collect()) == [
        (k, i, str(i)) for k in "ab" for i in range(3)
    ]
    assert len({r["run_id"] for r in got.select("run_id").collect()}) == 1


def test_fetch_concurrency_is_bounded(spark):
    many = calls(spark, *[f"k{i}" for i in range(50)])
    got = requests.fetch_responses(many, Flaky(1, []), max_concurrency=3)
    assert got.rdd.getNumPartitions() == 3 and got.count() == 50


def test_http_requests():
    request = {"endpoint": "/v1/x", "params": {"a": "1 2", "none": None}, "headers": {"X": "2"}}
    built = requests.build_http_request("http://h/", request, {"X": "1", "Y": "3"})
    assert built.full_url == "http://h/v1/x?a=1+2" and built.get_method() == "GET" and built.data is None
    assert built.headers == {"X": "2", "Y": "3"}
    post = {"method": "POST", "endpoint": "x?z=1", "params": {"a": "b"}, "body": '{"k": "v w"}'}
    built = requests.build_http_request("http://h", post)
    assert built.full_url == "http://h/x?z=1&a=b" and built.data == b"k=v+w" and built.get_method() == "POST"
    built = requests.build_http_request("http://h", {**post, "headers": {"content-type": "application/json; x"}})
    assert built.data == b'{"k": "v w"}'


def test_request_params(spark):
    df = spark.createDataFrame([(1, "B"), (1, "A"), (1, "A"), (2, "C")], "g int, s string")
    got = requests.request_params(df, ["g"], "s", {"feed": None, "timeframe": "1Day", "group": F.col("g")})
    assert {r["g"]: r["params"] for r in got.collect()} == {
        1: {"symbols": "A,B", "timeframe": "1Day", "group": "1"},
        2: {"symbols": "C", "timeframe": "1Day", "group": "2"},
    }
    many = spark.range(100).select(F.lit(1).alias("g"), F.col("id").cast("string").alias("s"))
    split = requests.request_params(many, ["g"], "s", per_request=25).collect()
    assert len(split) == 4 and max(len(r["params"]["symbols"].split(",")) for r in split) < 50 and sorted(x for r in split for x in r["params"]["symbols"].split(",")) == sorted(map(str, range(100)))


# ---- objects


def test_objects_round_trip(spark, folder):
    data = [
        ("a/x 1.json", b"{}", {"k": "v w"}),
        ("a/b/y.gz", bytes(range(256)), {}),
        ("a/b/.hidden", b"h", None),
        ("_z", b"", None),
    ]
    df = spark.createDataFrame(data, "key string, content binary, tags map<string,string>")
    assert rows(write_objects(df, folder), "key") == sorted((k,) for k, _, _ in data)
    assert sorted((r["key"], bytes(r["content"])) for r in files.read_objects(spark, folder).collect()) == sorted(
        (k, c) for k, c, _ in data
    )
    assert rows(files.list_objects(spark, folder, "a/"), "key", "name", "length") == [
        ("a/b/.hidden", ".hidden", 1),
        ("a/b/y.gz", "y.gz", 256),
        ("a/x 1.json", "x 1.json", 2),
    ]
    assert rows(files.list_objects(spark, folder, "a/x"), "key") == [("a/x 1.json",)]
    assert rows(files.list_objects(spark, folder, "a/b"), "key") == [("a/b/.hidden",), ("a/b/y.gz",)]
    assert rows(files.list_objects(spark, folder, "gone/x"), "key") == []
    assert rows(files.list_objects(spark, folder, where=F.col("mime_type") == "application/json"), "key") == [("a/x 1.json",)]
    noted = read_manifest(spark, folder)
    assert sorted(tuple(r) for r in noted.select("key", "tags").collect()) == [
        ("_z", None), ("a/b/.hidden", None), ("a/b/y.gz", None), ("a/x 1.json", "k=v+w")
    ]
    found = files.read_keys(spark.createDataFrame([("_z",), ("gone",), ("a/b/y.gz",)], "key string"), folder)
    assert {r["key"]: r["content"] and len(r["content"]) for r in found.collect()} == {"a/b/y.gz": 256, "_z": bytearray(), "gone": None}


def test_objects_are_replaced_and_stamped(spark, folder):
    def put(content, **options):
        return write_objects(spark.createDataFrame([("k", content)], "key string, content string"), folder, **options)

    put("old"), put("new")
    assert bytes(files.read_objects(spark, folder).first()["content"]) == b"new"
    key = put("x", use_timestamp=True).first()["key"]
    assert key.endswith("_k") and os.path.exists(f"{folder}/{key}")
    assert sorted(os.listdir(folder)) == sorted(["_pending", "_manifest", "k", key])
    assert write_objects(spark.createDataFrame([], "key string, content string"), folder).count() == 0


def test_objects_are_computed_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    data = spark.createDataFrame([(f"k{i}", b"x") for i in range(50)], "key string, content binary")
    keys = write_objects(data.mapInArrow(note, data.schema), folder)
    assert keys.count() == 50 and seen.value == 50


# ---- parquet


def test_write_parquet(spark, folder):
    df = spark.range(100).withColumn("p", F.col("id") % 3)
    uri = write_parquet(df, folder, "/a/b/", "x.parquet", {"k": "v"}, ["p"])
    assert uri == f"{folder}/a/b/x.parquet" and rows(spark.read.parquet(uri), "id") == rows(df, "id")
    assert rows(read_manifest(spark, folder), "key", "tags") == [("a/b/x.parquet", "k=v")]
    with pytest.raises(PySparkException):
        write_parquet(df, folder, "a/b", "x.parquet")
    named = write_parquet(df, folder, "c", single_file=True)
    datetime.strptime(os.path.basename(named), "%Y%m%dT%H%M%S.parquet")
    assert len([n for n in os.listdir(named) if n.endswith(".parquet")]) == 1


@pytest.mark.parametrize("name", ["x", "x.parquet.gz", "x.parquet_old"])
def test_parquet_names(spark, folder, name):
    with pytest.raises(ValueError):
        write_parquet(spark.range(1), folder, "a", name)


def test_nothing_is_left_of_an_empty_result(spark, folder):
    for nothing in (spark.range(0), spark.range(10).where("id > 10"), spark.createDataFrame([], "a int")):
        with pytest.raises(ValueError, match="no rows"):
            write_parquet(nothing, folder, "a", "x.parquet")
        assert not os.path.exists(f"{folder}/a/x.parquet")
    nothing = spark.range(10).withColumn("p", F.col("id") % 2).groupBy("id", "p").count().where("count > 1")
    for options in ({"partition_by": ["p"]}, {"single_file": True}):
        with pytest.raises(ValueError, match="no rows"):
            write_parquet(nothing, folder, "a", "x.parquet", **options)
        assert not os.path.exists(f"{folder}/a/x.parquet")


# ---- sheets


def test_sheet_round_trip(spark, folder):
    data = [(1, 'a "q", x', 1.5), (2, " lead\nline ", None), (3, None, 2.0), (4, "", -1.0)]
    df = spark.createDataFrame(data, "i int, t string, d double")
    assert write_sheet_table(df, folder)
    got = tables.read_sheet_table(spark, folder, {"d": DoubleType(), "t": StringType()}, multi_line=True)
    assert got.dtypes == [("i", "string"), ("t", "string"), ("d", "double")]
    assert rows(got, "i", "t", "d") == [("1", 'a "q", x', 1.5), ("2", " lead\nline ", None), ("3", "", 2.0), ("4", "", -1.0)]
    assert tables.read_sheet_table(spark, folder, multi_line=True).dtypes == [("i", "int"), ("t", "string"), ("d", "double")]
    with pytest.raises(PySparkException):
        tables.read_sheet_table(spark, folder, {"t": DoubleType()}, multi_line=True).collect()
    with pytest.raises(ValueError, match="gone"):
        tables.read_sheet_table(spark, folder, {"gone": DoubleType()})


def test_sheet_is_replaced_only_on_demand(spark, folder):
    one, two = spark.range(1), spark.range(2)
    assert write_sheet_table(one, folder)
    assert not write_sheet_table(two, folder)
    assert tables.read_sheet_table(spark, folder).count() == 1
    assert not write_sheet_table(spark.range(0), folder, replace=True)
    assert tables.read_sheet_table(spark, folder).count() == 1
    assert write_sheet_table(two, folder, replace=True)
    assert tables.read_sheet_table(spark, folder).count() == 2


def test_missing_and_empty_sheets(spark, folder):
    assert tables.read_sheet_table(spark, folder).count() == 0
    os.makedirs(folder)
    got = tables.read_sheet_table(spark, folder, {"a": DoubleType()})
    assert got.count() == 0 and got.dtypes == [("a", "double")]
    open(f"{folder}/x.csv", "w").close()
    assert tables.read_sheet_table(spark, folder, {"a": DoubleType()}).count() == 0


def test_query(spark):
    got = tables.query(spark, "select sum(id) as n from t", {"t": spark.range(4)})
    assert got.first()["n"] == 6


# ---- jobs


def test_check_bases():
    assert check_bases(["USD", "EUR"]) == ["USD", "EUR"]
    with pytest.raises(ValueError, match="XXX"):
        check_bases(["USD", "XXX"])


def test_latest_rates_job(spark, folder):
    def body(base):
        return json.dumps({"response": {"base": base, "rates": {"EUR": 0.9}}})

    landed = spark.createDataFrame(
        [(b, {"base": b}, 200, body(b) if b != "PHP" else "{", datetime(2024, 1, 1)) for b in ("USD", "JPY", "PHP")],
        schemas.LANDING,
    )
    uri, _ = run_latest_rates(spark, landed, ["USD", "JPY"], folder, "fx", filename="r.parquet")
    got = spark.read.parquet(uri)
    assert rows(got, "base_currency") == [("JPY",), ("USD",)] and got.columns == schemas.EXCHANGE_RATES.names
    with pytest.raises(ValueError, match="no rows"):
        run_latest_rates(spark, landed, ["AUD"], folder, "fx", filename="none.parquet")
    landed.write.parquet(f"{folder}/landing")
    uri = latest_rates_main(["--responses", f"{folder}/landing", "--bases", "USD", "--root", folder, "--prefix", "cli"])
    assert rows(spark.read.parquet(uri), "base_currency") == [("USD",)]
    with pytest.raises(SystemExit):
        latest_rates_main(["--responses", "x", "--bases", "XXX", "--root", folder, "--prefix", "cli"])


def test_incremental_landing(spark, folder):
    def deliver(name, *deliveries, status=200, run="r"):
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{name}.json", "w") as out:
            for key, at in deliveries:
                row = {"request_key": key, "params": {}, "status": status, "body": key, "fetched_at": at, "run_id": run, "page": 0}
                out.write(json.dumps(row) + "\n")

    def load():
        run_landing(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint")
        return rows(spark.read.parquet(f"{folder}/out"), "request_key")

    day = "2024-01-01T{:02d}:00:00Z"
    # The hot response comes many times, in one file and across files; its nine polls are all kept.
    deliver("one", ("a", day.format(0)), ("b", day.format(0)), *[("hot", day.format(i % 9)) for i in range(500)])
    deliver("two", *[("hot", day.format(i % 9)) for i in range(500)])
    assert load() == [("a",), ("b",), *[("hot",)] * 9]
    assert load() == [("a",), ("b",), *[("hot",)] * 9]
    deliver("three", ("b", day.format(10)), ("c", day.format(10)), ("hot", day.format(1)))
    assert load() == [("a",), ("b",), ("b",), ("c",), *[("hot",)] * 9]
    landed = spark.read.parquet(f"{folder}/out")
    assert landed.columns == schemas.LANDED.names
    # A failed copy, then a good one: both land, and the good one counts.
    deliver("four", ("d", day.format(11)), ("a", day.format(11)), status=500, run="r2")
    load()
    deliver("five", ("d", day.format(12)))
    load()
    # Fetched long before the others, delivered last.
    deliver("six", ("late", "2023-06-01T00:00:00Z"), ("late", "2023-06-02T00:00:00Z"), ("c", "2023-06-01T00:00:00Z"))
    load()
    landed = spark.read.parquet(f"{folder}/out")
    assert rows(landed.where("request_key = 'd'"), "status") == [(200,), (500,)]
    assert rows(latest_responses(landed), "request_key", "status") == [(k, 200) for k in ("a", "b", "c", "d", "hot", "late")]
    # Stream and batch choose the same copy.
    assert rows(latest_responses(landed).where("request_key = 'late'"), F.day("fetched_at")) == [(2,)]


def test_bad_lines_go_to_the_rejects(spark, folder):
    os.makedirs(f"{folder}/in")
    bad = ['{"request_key": "x"', "no json", '{"status": 200}', "", '{"request_key": null, "body": "b"}']
    good = json.dumps({"request_key": "k", "status": 200, "body": "b", "fetched_at": "2024-01-01T00:00:00Z"})
    with open(f"{folder}/in/a.json", "w") as out:
        out.write("\n".join([*bad, good, good]) + "\n")
    for _ in range(2):
        run_landing(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", rejects=f"{folder}/rejects")
    assert rows(spark.read.parquet(f"{folder}/out"), "request_key") == [("k",)]
    assert sorted(r.line for r in spark.read.parquet(f"{folder}/rejects").collect()) == sorted(bad)


def test_shuffle_partitions():
    assert [shuffle_partitions(n) for n in (0, 40 << 30, 2 << 40, 100 << 40)] == [200, 205, 10486, 524_288]


def test_scratch_is_shared(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x", "s3a://b/c").startswith("s3a://b/c/rateloom/x-")


def test_failed_write_leaves_nothing(spark, folder):
    boom = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        write_parquet(boom, folder, "p", "b.parquet")
    uri = write_parquet(spark.range(5).toDF("x"), folder, "p", "b.parquet")
    with pytest.raises(PySparkException, match="exists"):
        write_parquet(boom, folder, "p", "b.parquet")
    assert spark.read.parquet(uri).count() == 5
