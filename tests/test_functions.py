import json
from datetime import UTC, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rateloom import functions as fn
from rateloom.functions.status import decide


def texts(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


TIMES = {
    "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
    "2024-01-02T03:04:05+02:00": datetime(2024, 1, 2, 1, 4, 5),
    "2024-01-02T03:04:05-0530": datetime(2024, 1, 2, 8, 34, 5),
    "2024-01-02T03:04:05.123456789Z": datetime(2024, 1, 2, 3, 4, 5, 123456),
    "2024-01-02T03:04:05": datetime(2024, 1, 2, 3, 4, 5),
    "2024-01-02": datetime(2024, 1, 2),
    # Does not exist, and exists twice, on clocks in New York.
    "2024-03-10T02:30:00Z": datetime(2024, 3, 10, 2, 30),
    "2024-11-03T06:30:00+01:00": datetime(2024, 11, 3, 5, 30),
    None: None,
}


def test_parse_iso_utc(spark):
    assert column(texts(spark, list(TIMES)), fn.parse_iso_utc("v")) == list(TIMES.values())


def test_parse_iso_utc_in_another_zone(other_zone):
    assert column(texts(other_zone, list(TIMES)), fn.parse_iso_utc("v")) == list(TIMES.values())


def test_parse_iso_utc_rejects_bad_text(spark):
    with pytest.raises(PySparkException):
        texts(spark, ["yesterday"]).select(fn.parse_iso_utc("v")).collect()
    lenient = fn.parse_iso_utc("v", strict=False)
    assert column(texts(spark, ["yesterday", "2024-01-02T03:04:05+x", *TIMES]), lenient) == [None, None, *TIMES.values()]


def test_now_is_utc_in_any_zone(other_zone):
    now = other_zone.range(1).select(fn.now_utc()).first()[0]
    assert abs((datetime.now(UTC).replace(tzinfo=None) - now).total_seconds()) < 60


def test_epoch_micros_in_another_zone(other_zone):
    times = [datetime(1970, 1, 1, 0, 0, 0, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 3, 10, 2, 30)]
    expected = [round((t - datetime(1970, 1, 1)).total_seconds() * 1_000_000) for t in times]
    assert column(texts(other_zone, times, "timestamp_ntz"), fn.epoch_micros("v")) == expected


def test_order_key_is_lexicographic(spark):
    a, z = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(0, a, -(2**63)), (1, a, 2**63 - 1), (2, z, -(2**63)), (3, z, 2**63 - 1)]
    df = spark.createDataFrame(rows, "i int, t timestamp_ntz, id bigint")
    keys = column(df, fn.order_key("t", "id"))
    assert keys == sorted(keys) and len(set(keys)) == 4


def test_ordering_aggregate_stays_hash_based(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), 1)], "i int, t timestamp_ntz, id bigint")
    plan = df.groupBy("i").agg(F.max_by("id", fn.order_key("t", "id")))._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


PERCENTS = {
    "50%": (0.5, None),
    "1,234.5%": (12.345, None),
    " 7 ": (0.07, None),
    "-3e2%": (-3.0, None),
    ".5": (0.005, None),
    "50 %": (0.5, None),
    "": (None, ""),
    "   ": (None, ""),
    None: (None, ""),
    "n/a": (None, "n/a"),
    "1d": (None, "1d"),
    "2f%": (None, "2f%"),
    " x ": (None, " x "),
}


def test_normalize_percent(spark):
    df = texts(spark, list(PERCENTS))
    rows = df.orderBy("i").select(fn.normalize_percent("v"), fn.percent_text("v")).collect()
    assert [tuple(r) for r in rows] == list(PERCENTS.values())


def test_safe_ratio_and_zero_fill(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.safe_ratio("a", "b")).collect()] == [0.5, 0.0, None]
    assert [r[0] for r in df.select(fn.zero_fill("a", "long")).collect()] == [1, 1, 0]
    assert df.select(fn.zero_fill("a", enabled=False)).collect()[2][0] is None


def test_json_string_of_scalars(spark):
    values = [5.0, 1e20, 1e7, 1.5e-5, 0.0001, 123456789.125, -2.5e-7, 1e16, 1e100]
    values += [float("inf"), float("-inf"), float("nan"), -0.0, None]
    got = column(df := texts(spark, values, "double"), fn.json_string(df, "v"))
    assert got == [None if v is None else json.dumps(str(v)) for v in values]
    got = column(df := texts(spark, [True, False, None], "boolean"), fn.json_string(df, "v"))
    assert got == ['"True"', '"False"', None]
    got = column(df := texts(spark, ['a "b" \\', "é\n", None]), fn.json_string(df, "v"))
    assert [g and json.loads(g) for g in got] == ['a "b" \\', "é\n", None]
    got = column(df := texts(spark, [5, None], "bigint"), fn.json_string(df, "v"))
    assert got == ['"5"', None]
    times = [datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5, 500000), datetime(2024, 1, 2, 3, 4, 5, 1)]
    got = column(df := texts(spark, times, "timestamp_ntz"), fn.json_string(df, "v"))
    assert got == [json.dumps(str(t)) for t in times]


def test_json_string_of_nested_values(spark):
    df = spark.createDataFrame(
        [(0, ([(1, "x"), (None, "y")], {"k": None}, [1, None], (1, None)))],
        "i int, v struct<rows:array<struct<a:int,b:string>>, m:map<string,int>, l:array<int>, s:struct<a:int,b:int>>",
    ).select("i", "v.*")
    row = df.select(*[fn.json_string(df, c).alias(c) for c in ("rows", "m", "l", "s")]).first()
    assert json.loads(row["rows"]) == {"a": [1, None], "b": ["x", "y"]}
    assert json.loads(row["m"]) == {"k": None}
    assert json.loads(row["l"]) == [1, None]
    assert json.loads(row["s"]) == {"a": 1, "b": None}


def test_tag_string(spark):
    from urllib.parse import urlencode

    tags = {"a b": "1&2", "ü": "x=y/z", "p": "*~-_.", "e": ""}
    df = spark.createDataFrame([(0, tags), (1, {})], "i int, v map<string,string>")
    got = column(df, fn.tag_string("v"))
    assert sorted(got[0].split("&")) == sorted(urlencode(tags).split("&")) and got[1] == ""


def test_stamped_key(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, 678),)], "t timestamp_ntz")
    row = df.select(
        fn.stamped_key(F.lit("f.bin"), "t", F.lit("/a/b/")),
        fn.stamped_key(F.lit("f.bin"), prefix=F.lit("a")),
        fn.stamped_key(F.lit("f.bin")),
    ).first()
    assert list(row) == ["a/b/20240102T030405_f.bin", "a/f.bin", "f.bin"]


def test_mime_type(spark):
    got = column(texts(spark, ["x/a.JSON", "b.parquet", "c", "d.tar.gz", "e.unknown"]), fn.mime_type("v"))
    assert got == [
        "application/json",
        "application/vnd.apache.parquet",
        "application/octet-stream",
        "application/gzip",
        "application/octet-stream",
    ]


# status, attempt, reauth, Retry-After, action, wait
RULES = [
    (200, 1, "pending", None, "ok", None),
    (302, 5, "pending", None, "ok", None),
    (400, 1, "pending", None, "bad_request", None),
    (429, 1, "pending", None, "retry", 1),
    (429, 1, "pending", 7, "retry", 7),
    (429, 5, "pending", 7, "stop", None),
    (401, 1, "pending", None, "reauth", None),
    (401, 1, "failed", None, "auth_error", None),
    (401, 1, "done", None, "retry", 2),
    (401, 1, "none", None, "retry", 2),
    (403, 1, "pending", None, "retry", 2),
    (404, 4, "pending", None, "retry", 2),
    (500, 1, "pending", None, "retry", 2),
    (503, 5, "pending", None, "stop", None),
    (None, 1, "pending", None, "retry", 2),
    (None, 5, "pending", None, "stop", None),
]


@pytest.mark.parametrize("rule", RULES)
def test_decide(rule):
    status, attempt, reauth, after, action, wait = rule
    assert decide(status, attempt, 5, reauth, None if after is None else str(after)) == (action, wait or 0)


def test_classify_response(spark):
    df = spark.createDataFrame(
        [(i, *r[:4]) for i, r in enumerate(RULES)], "i int, status int, attempt int, reauth string, after int"
    )
    verdict = fn.classify_response(F.col("status"), F.col("after"), F.col("attempt"), 5, F.col("reauth"))
    got = [tuple(r[0]) for r in df.orderBy("i").select(verdict).collect()]
    assert got == [r[4:] for r in RULES]
