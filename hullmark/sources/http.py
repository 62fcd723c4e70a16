"""Transports over HTTP, by the standard library alone.

Named as ``module:function`` in options; what follows a question mark is given to the function
first: ``hullmark.sources.http:encyclopedia?https://host/w/api.php``. Requests of one machine keep a common distance,
whatever task makes them; on several machines give each its part of the rate.
"""

from __future__ import annotations

import fcntl
import json
import os
import tempfile
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from functools import partial
from importlib import import_module

from hullmark.sources.readers import Refused

AGENT = "hullmark/1 (wreck inventory)"
# Answers that another try may change.
PASSING = {429, 500, 502, 503, 504}
LONG = 1500  # parameters of more letters are sent in the body


class Later(Exception):
    """An answer that says when to try again."""

    def __init__(self, said: str, retry_after: float | None):
        super().__init__(said)
        self.retry_after = retry_after


class Spacing:
    """A least distance in seconds between requests of all processes of a machine, by a locked file."""

    def __init__(self, seconds: float, name: str = "requests"):
        self.seconds, self.path = seconds, os.path.join(tempfile.gettempdir(), f"hullmark-{os.getuid()}-{name}")

    def wait(self, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> None:
        if self.seconds <= 0:
            return
        with open(self.path, "a+") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            f.seek(0)
            last = float(f.read() or 0)
            sleep(max(0.0, min(self.seconds, last + self.seconds - clock())))
            f.truncate(0)
            f.write(str(clock()))


def fetch(address: str, params: dict | None = None, spacing: float = 0.2, timeout: float = 60.0, every_error_passes: bool = False) -> bytes:
    """The body of an answer. ``Later`` where another try may help, ``Refused`` where it will not."""
    Spacing(spacing).wait()
    query = urllib.parse.urlencode(params or {})
    body = query.encode() if len(query) > LONG else None
    url = address if body is not None or not query else f"{address}?{query}"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, body, {"User-Agent": AGENT}), timeout=timeout) as answer:
            return answer.read()
    except urllib.error.HTTPError as error:
        told = error.headers.get("Retry-After") if error.headers else None
        if error.code in PASSING or every_error_passes:
            raise Later(f"{error.code} {url[:200]}", float(told) if told and told.isdigit() else None) from error
        raise Refused(f"{error.code} {url[:200]}") from error
    except urllib.error.URLError as error:
        raise Later(str(error.reason), None) from error


def charts(address: str, params: dict) -> str:
    """A chart service's answer. Any failing answer, an error told in it and a broken one are tried again."""
    text = fetch(address, params, spacing=0.3, every_error_passes=True).decode()
    told = json.loads(text)
    if "error" in told:
        raise Later(str(told["error"])[:300], None)
    return text


def encyclopedia(address: str, params: dict) -> str:
    """An encyclopedia's answer to a call of its interface."""
    return fetch(address, {"formatversion": "2", **params}).decode()


def transport(name: str) -> Callable:
    """The function that a name stands for, with what follows its question mark as the first argument."""
    path, _, first = name.partition("?")
    module, _, function = path.partition(":")
    found = getattr(import_module(module), function)
    return partial(found, first) if first else found
