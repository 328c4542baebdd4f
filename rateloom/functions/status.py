"""What to do after a response, as column expressions and for one call."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Attempts per call, fallback wait, and the wait on 429 without Retry-After (seconds).
MAX_ATTEMPTS = 5
RETRY_WAIT = 2
RATE_LIMIT_WAIT = 1

# Statuses from and to, state of the credentials (any, if none is named), what to do. The
# first rule that holds counts; all else is tried again as long as attempts are left.
RULES = (
    (-(1 << 31), 399, None, "ok"),
    (400, 400, None, "bad_request"),
    (401, 401, "pending", "reauth"),
    (401, 401, "failed", "auth_error"),
)


def classify_response(
    status: Column,
    retry_after: Column | None = None,
    attempt: Column | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    reauth: Column | None = None,
) -> Column:
    """``struct<action, wait_seconds>`` for a response; a null status is a connection error.

    ``reauth`` tells what became of a 401: 'pending' (not tried yet), 'failed', 'done' (tried and
    repeated), or 'none' for calls that never reauthenticate. The actions are ok, bad_request,
    auth_error, reauth, retry and stop (attempts used up).
    """
    attempt = F.lit(1) if attempt is None else attempt
    reauth = F.lit("pending") if reauth is None else reauth
    retry_after = F.lit(None).cast("int") if retry_after is None else retry_after
    action = F.when(attempt >= max_attempts, "stop").otherwise("retry")
    for least, most, state, name in reversed(RULES):
        holds = F.coalesce(status.between(least, most), F.lit(False))
        action = F.when(holds if state is None else holds & (reauth == state), name).otherwise(action)
    wait = F.when(
        action == "retry",
        F.when(status == 429, F.coalesce(retry_after, F.lit(RATE_LIMIT_WAIT))).otherwise(F.lit(RETRY_WAIT)),
    )
    return F.struct(action.alias("action"), wait.cast("int").alias("wait_seconds"))


def decide(
    status: int | None, attempt: int, max_attempts: int, reauth: str, retry_after: str | None
) -> tuple[str, int]:
    """The same rules for one call inside a fetch task."""
    for least, most, state, name in RULES:
        if status is not None and least <= status <= most and state in (None, reauth):
            return name, 0
    if attempt >= max_attempts:
        return "stop", 0
    if status == 429:
        return "retry", int(retry_after) if (retry_after or "").isdigit() else RATE_LIMIT_WAIT
    return "retry", RETRY_WAIT
