"""Table schemas, landing layout and fixed lists."""

from __future__ import annotations

from pyspark.sql.types import MapType, StringType, StructType

_TEXTS = MapType(StringType(), StringType())

# The five output tables. Timestamps hold UTC without a zone.
EXCHANGE_RATES = (
    StructType()
    .add("base_currency", "string")
    .add("target_currency", "string")
    .add("rate", "double")
    .add("rate_date", "date")
    .add("rate_timestamp", "timestamp_ntz")
    .add("ingestion_datetime", "timestamp_ntz")
)
CONVERSION = (
    StructType()
    .add("from_currency", "string")
    .add("to_currency", "string")
    .add("amount", "double")
    .add("converted_amount", "double")
    .add("rate", "double")
    .add("rate_timestamp", "timestamp_ntz")
    .add("ingestion_datetime", "timestamp_ntz")
)
CURRENCIES = (
    StructType()
    .add("currency_code", "string")
    .add("currency_name", "string")
    .add("short_code", "string")
    .add("symbol", "string")
    .add("ingestion_datetime", "timestamp_ntz")
)
STOCK_BARS = (
    StructType()
    .add("symbol", "string")
    .add("timestamp", "timestamp_ntz")
    .add("bar_date", "date")
    .add("open", "double")
    .add("high", "double")
    .add("low", "double")
    .add("close", "double")
    .add("volume", "long")
    .add("trade_count", "long")
    .add("vwap", "double")
    .add("ingestion_datetime", "timestamp_ntz")
)
STOCK_SNAPSHOT = (
    StructType()
    .add("symbol", "string")
    .add("latest_trade_price", "double")
    .add("latest_trade_size", "long")
    .add("latest_trade_timestamp", "timestamp_ntz")
    .add("latest_quote_ask_price", "double")
    .add("latest_quote_bid_price", "double")
    .add("latest_quote_timestamp", "timestamp_ntz")
    .add("prev_daily_close", "double")
    .add("ingestion_datetime", "timestamp_ntz")
)

# One row per API response. fetched_at is an instant, so it is a TIMESTAMP.
LANDING = (
    StructType()
    .add("request_key", "string")
    .add("params", _TEXTS)
    .add("status", "integer")
    .add("body", "string")
    .add("fetched_at", "timestamp")
)

# A row as it is fetched: which run called, which page of the answer it is, what it can be found by, and
# whether its feed can use it (null: not judged yet).
LANDED = (
    StructType(list(LANDING.fields))
    .add("run_id", "string")
    .add("page", "integer")
    .add("feed", "string")
    .add("request_date", "date")
    .add("usable", "boolean")
)

# One row per API call to make.
REQUESTS = (
    StructType()
    .add("request_key", "string")
    .add("method", "string")
    .add("endpoint", "string")
    .add("params", _TEXTS)
    .add("headers", _TEXTS)
    .add("body", "string")
)

# Response bodies, read with from_json. Rates are text because one non-number would null a whole
# map<string,double>; whole numbers are doubles because 10.0 read as bigint is null.
_BAR = "struct<t:string, o:double, h:double, l:double, c:double, v:double, n:double, vw:double>"
_SNAP = (
    "struct<latestTrade:struct<p:double, s:double, t:string>, "
    "latestQuote:struct<ap:double, bp:double, t:string>, prevDailyBar:struct<c:double>>"
)
BODY_LATEST_RATES = (
    "meta struct<last_updated_at:string>, response struct<base:string, rates:map<string,string>>"
)
BODY_HISTORICAL_RATES = "response struct<base:string, date:string, rates:map<string,string>>"
BODY_CONVERSION = "meta struct<last_updated_at:string>, response struct<value:double>"
BODY_CURRENCIES = (
    "response array<struct<id:string, name:string, short_code:string, symbol:string>>"
)
BODY_LATEST_BARS = f"bars map<string,{_BAR}>"
BODY_HISTORICAL_BARS = f"bars map<string,array<{_BAR}>>, next_page_token string"
BODY_SNAPSHOTS = f"snapshots map<string,{_SNAP}>"
BODY_SNAPSHOTS_BARE = f"map<string,{_SNAP}>"

# The bar timeframes on offer and the window length of each.
TIMEFRAMES = {
    "1Min": "1 minute",
    "5Min": "5 minutes",
    "15Min": "15 minutes",
    "30Min": "30 minutes",
    "1Hour": "1 hour",
    "4Hour": "4 hours",
    "1Day": "1 day",
}

# The currency codes accepted as a base.
CURRENCY_CODES = [
    "AED", "AFN", "ALL", "AMD", "ANG", "AOA", "ARS", "AUD", "AWG", "AZN", "BAM", "BBD",
    "BDT", "BGN", "BHD", "BIF", "BMD", "BND", "BOB", "BOV", "BRL", "BSD", "BTN", "BWP",
    "BYN", "BZD", "CAD", "CDF", "CHF", "CLF", "CLP", "CNY", "COP", "CRC", "CUC", "CUP",
    "CVE", "CZK", "DJF", "DKK", "DOP", "DZD", "EGP", "ERN", "ETB", "EUR", "FJD", "FKP",
    "GBP", "GEL", "GHS", "GIP", "GMD", "GNF", "GTQ", "GYD", "HKD", "HNL", "HRK", "HTG",
    "HUF", "IDR", "ILS", "INR", "IQD", "IRR", "ISK", "JMD", "JOD", "JPY", "KES", "KGS",
    "KHR", "KMF", "KPW", "KRW", "KWD", "KYD", "KZT", "LAK", "LBP", "LKR", "LRD", "LSL",
    "LTL", "LVL", "LYD", "MAD", "MDL", "MGA", "MKD", "MMK", "MNT", "MOP", "MRO", "MUR",
    "MVR", "MWK", "MXN", "MYR", "MZN", "NAD", "NGN", "NIO", "NOK", "NPR", "NZD", "OMR",
    "PAB", "PEN", "PGK", "PHP", "PKR", "PLN", "PYG", "QAR", "RON", "RSD", "RUB", "RWF",
    "SAR", "SBD", "SCR", "SDG", "SEK", "SGD", "SHP", "SLL", "SOS", "SRD", "SSP", "STD",
    "SVC", "SYP", "SZL", "THB", "TJS", "TMT", "TND", "TOP", "TRY", "TTD", "TWD", "TZS",
    "UAH", "UGX", "USD", "UYU", "UZS", "VEF", "VND", "VUV", "WST", "XAF", "XCD", "XOF",
    "XPF", "YER", "ZAR", "ZMW", "ZWL",
]

# File kinds by extension, as IANA lists them.
MIME_TYPES = {
    "csv": "text/csv",
    "gz": "application/gzip",
    "html": "text/html",
    "json": "application/json",
    "parquet": "application/vnd.apache.parquet",
    "pdf": "application/pdf",
    "png": "image/png",
    "txt": "text/plain",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "application/xml",
    "zip": "application/zip",
}
