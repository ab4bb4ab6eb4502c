"""Pages of the read-out queries, each with an opaque token for the page after it.

The token carries the query's name, all of its parameters and the last key shown, so a caller needs nothing else to go on.
It has a checksum, keyed by a secret where one is given, and is refused if it was changed or belongs to another query.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import hmac
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row

from candlelake.plans.restitution import daily_summary_query, history_query, signals_query

#: The queries that can be paged, and the column that orders them.
PAGED: dict[str, tuple[Callable[..., DataFrame], str]] = {
    "history": (history_query, "open_time"),
    "signals": (signals_query, "open_time"),
    "daily": (daily_summary_query, "event_date"),
}
LONGEST_TOKEN = 4096
DIGEST_BYTES = 16


@dataclass(frozen=True)
class Page:
    rows: list[Row]
    next_token: str | None


def _digest(text: bytes, secret: str) -> bytes:
    return hmac.digest(secret.encode(), text, hashlib.sha256)[:DIGEST_BYTES]


def write_token(query: str, parameters: Mapping[str, object], before: str, secret: str = "") -> str:
    content = {"query": query, "parameters": dict(parameters), "before": before}
    text = json.dumps(content, sort_keys=True, separators=(",", ":")).encode()
    return base64.urlsafe_b64encode(_digest(text, secret) + text).decode()


def read_token(token: str, query: str, secret: str = "") -> tuple[dict, str]:
    """The parameters and the last key of a token for this query; ``ValueError`` for any other text."""
    try:
        data = base64.b64decode(token[: LONGEST_TOKEN + 1], altchars=b"-_", validate=True)
    except (binascii.Error, ValueError) as wrong:
        raise ValueError("the page token is not readable") from wrong
    given, text = data[:DIGEST_BYTES], data[DIGEST_BYTES:]
    if len(token) > LONGEST_TOKEN or not text or not hmac.compare_digest(given, _digest(text, secret)):
        raise ValueError("the page token is not readable")
    content = json.loads(text)
    if content["query"] != query:
        raise ValueError(f"the page token is for the query {content['query']}, not for {query}")
    return content["parameters"], content["before"]


def read_page(
    query: str, frame: DataFrame, parameters: Mapping[str, object] | None = None, token: str | None = None, *, secret: str = "", **allowed
) -> Page:
    """A page of ``PAGED[query]``: the first one of ``parameters``, which have a ``limit``, or the one after ``token``.

    With a token the parameters may be left out; those given must be the token's. The rows of a page reach the driver, so
    choose the limit for that; ``allowed`` (symbols, intervals) is not part of the token.
    """
    build, order = PAGED[query]
    given, before = dict(parameters or {}), None
    if token:
        asked, before = read_token(token, query, secret)
        for name, value in given.items():
            if asked.get(name) != value:
                raise ValueError(f"the page token is for another {name}")
        given = asked
    limit = given.get("limit")
    if not isinstance(limit, int) or limit < 1:
        raise ValueError("a page needs a limit of 1 or more")
    # One row more than shown tells whether there is a next page.
    rows = build(frame, **{**given, "limit": limit + 1}, before=before, **allowed).collect()
    if len(rows) <= limit:
        return Page(rows, None)
    return Page(rows[:limit], write_token(query, given, str(rows[limit - 1][order]), secret))
