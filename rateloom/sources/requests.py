"""API calls from a table of requests: planning, fetching on executors, transports."""

from __future__ import annotations

import http.client
import json
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateloom.functions import decide
from rateloom.functions.status import MAX_ATTEMPTS
from rateloom.schemas import LANDED

# A list of this many symbols still fits a URL.
SYMBOLS_PER_REQUEST = 1000

# Full lists that one task cuts out of a share of the symbols.
SHARE = 16

# Calls at once, unless the caller knows the limit of the API better.
CONCURRENCY = 4

_FLUSH_BYTES = 8 << 20


@dataclass
class Reply:
    """What a transport returns. A connection error is raised as OSError instead."""

    status: int
    body: str = ""
    headers: dict[str, str] = field(default_factory=dict)


# (request, attempt) -> Reply. The request has the fields of schemas.REQUESTS.
Transport = Callable[[dict, int], Reply]


def request_params(
    df: DataFrame,
    group: Sequence[str],
    symbol: str,
    fixed: dict[str, Column | str | None] | None = None,
    per_request: int = SYMBOLS_PER_REQUEST,
) -> DataFrame:
    """Requests that between them name every symbol of a group, joined by commas.

    Gives ``group``, ``part`` and ``params``; optional parameters that are null are left out. No list
    is longer than ``per_request``. A group of up to that many symbols is one request; a larger one is
    first spread over shares of about ``SHARE`` full lists by hash, and each share is cut into lists.
    """
    optional = [
        F.struct(F.lit(k).alias("key"), (v if isinstance(v, Column) else F.lit(v)).cast("string").alias("value"))
        for k, v in (fixed or {}).items()
    ]
    # Without group columns all symbols are one group.
    named = df.select(*group, F.lit(0).alias("_group"), F.col(symbol).cast("string").alias("_symbol")).distinct()
    keys = [*group, "_group"]
    sizes = named.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARE * per_request)).alias("_shares"))
    share = F.pmod(F.xxhash64("_symbol"), F.col("_shares")).cast("int")
    sized = named.join(sizes, keys).withColumn("_share", share)
    order = Window.partitionBy(*keys, "_share").orderBy("_symbol")
    listed = sized.withColumn("_list", F.floor((F.row_number().over(order) - 1) / F.lit(per_request)).cast("int"))
    part = F.concat_ws("-", "_share", "_list").alias("part")
    joined = F.concat_ws(",", F.array_sort(F.collect_list("_symbol")))
    grouped = listed.groupBy(*group, part).agg(joined.alias("_symbols"))
    entries = F.array(F.struct(F.lit("symbols").alias("key"), F.col("_symbols").alias("value")), *optional)
    kept = F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != ""))
    return grouped.select(*group, "part", F.map_from_entries(kept).alias("params"))


def join_url(base_url: str, endpoint: str) -> str:
    """Base and endpoint with exactly one slash between them."""
    return base_url.rstrip("/") + "/" + endpoint.lstrip("/")


def build_http_request(
    base_url: str, request: dict, default_headers: dict[str, str] | None = None
) -> urllib.request.Request:
    """The HTTP request for one row: merged headers, query string, JSON or form body."""
    headers = dict(default_headers or {}) | dict(request.get("headers") or {})
    url = join_url(base_url, request["endpoint"])
    query = {k: v for k, v in dict(request.get("params") or {}).items() if v is not None}
    if query:
        parts = urllib.parse.urlsplit(url)
        joined = "&".join(p for p in (parts.query, urllib.parse.urlencode(query)) if p)
        url = urllib.parse.urlunsplit(parts._replace(query=joined))
    data = None
    if request.get("body"):
        kind = next((v for k, v in headers.items() if k.lower() == "content-type"), "").lower()
        fields = request["body"]
        data = fields if "application/json" in kind else urllib.parse.urlencode(json.loads(fields))
        data = data.encode()
    return urllib.request.Request(url, data=data, headers=headers, method=request.get("method") or "GET")


@dataclass
class HttpTransport:
    """Calls a real endpoint from the executors. Headers come ready-made, credentials included."""

    base_url: str
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 5.0

    def __call__(self, request: dict, attempt: int) -> Reply:
        call = build_http_request(self.base_url, request, self.headers)
        try:
            with urllib.request.urlopen(call, timeout=self.timeout) as reply:
                return Reply(reply.status, reply.read().decode(errors="replace"), dict(reply.headers))
        except urllib.error.HTTPError as error:
            return Reply(error.code, error.read().decode(errors="replace"), dict(error.headers))
        except http.client.HTTPException as error:
            # A broken-off answer is a failed connection, but not an OSError by itself.
            raise ConnectionError(str(error)) from error


def _call(request, transport, max_attempts, reauthenticate, sleep) -> Reply | None:
    """One request with retries; None when the last attempt was a connection error."""
    reauth_once = (request.get("method") or "GET").upper() in ("GET", "POST")
    attempt, reauth, reply = 1, "pending" if reauth_once else "none", None
    while True:
        try:
            reply = transport(request, attempt)
        except OSError:
            reply = None
        after = next((v for k, v in reply.headers.items() if k.lower() == "retry-after"), None) if reply else None
        action, wait = decide(reply.status if reply else None, attempt, max_attempts, reauth, after)
        if action == "reauth":
            reauth = "done" if reauthenticate is not None and reauthenticate() else "failed"
            if reauth == "failed":
                return reply
        elif action == "retry":
            sleep(wait)
            attempt, reauth = attempt + 1, "pending" if reauth_once else "none"
        else:
            return reply


def _page_token(reply: Reply | None) -> str | None:
    if reply is None or reply.status >= 400 or "next_page_token" not in reply.body:
        return None
    try:
        body = json.loads(reply.body)
    except ValueError:
        return None
    return body.get("next_page_token") if isinstance(body, dict) else None


@dataclass
class Caller:
    """Makes the calls of one request: retries, renewed credentials, and the pages that follow.

    ``run_id`` names the run that calls, so that the pages of an answer stay together.
    """

    transport: Transport
    max_attempts: int = MAX_ATTEMPTS
    reauthenticate: Callable[[], bool] | None = None
    sleep: Callable[[float], None] = time.sleep
    run_id: str | None = None

    def pages(self, request: dict) -> Iterator[dict]:
        """One landing row per page."""
        key, params, page = request["request_key"], dict(request.get("params") or {}), 0
        while True:
            reply = _call(
                {**request, "params": params}, self.transport, self.max_attempts, self.reauthenticate, self.sleep
            )
            now = datetime.now(timezone.utc)
            yield {
                "request_key": key,
                "params": list(params.items()),
                "status": reply.status if reply else None,
                "body": reply.body if reply else None,
                "fetched_at": now,
                "run_id": self.run_id,
                "page": page,
                "feed": request.get("endpoint"),
                "request_date": _asked_date(params) or now.date(),
            }
            token = _page_token(reply)
            if not token:
                return
            page += 1
            params["page_token"] = token


def _asked_date(params: dict) -> date | None:
    """The day a request asks for, or starts with."""
    try:
        return date.fromisoformat((params.get("date") or params.get("start") or "")[:10])
    except ValueError:
        return None


def landing_arrow() -> pa.Schema:
    return pa.schema(
        [
            ("request_key", pa.string()),
            ("params", pa.map_(pa.string(), pa.string())),
            ("status", pa.int32()),
            ("body", pa.string()),
            ("fetched_at", pa.timestamp("us", tz="UTC")),
            ("run_id", pa.string()),
            ("page", pa.int32()),
            ("feed", pa.string()),
            ("request_date", pa.date32()),
            ("usable", pa.bool_()),
        ]
    )


def batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of a few MB of body text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["body"] or "")
        if size >= _FLUSH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def fetch_responses(
    requests: DataFrame, transport: Transport, max_concurrency: int = CONCURRENCY, **options
) -> DataFrame:
    """Make the calls of ``requests`` on executors and return one landing row per page.

    Rate limits hold per API key, so at most ``max_concurrency`` tasks call at once. Page tokens are
    followed inside a task; requests spread over tasks by key. A row whose status is not ok keeps
    its last status for the audit (null for a connection error). Calls repeat when a task is lost:
    land the result before parsing it, and let ``latest_responses`` settle the copies. All rows carry
    the id of this run. ``options`` are those of ``Caller``.
    """
    caller = Caller(transport, **{"run_id": uuid.uuid4().hex} | options)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for request in batch.to_pylist() for row in caller.pages(request))
        yield from batched(rows, landing_arrow())

    return requests.repartition(max_concurrency, "request_key").mapInArrow(fetch, LANDED)
