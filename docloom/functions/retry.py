"""Bounded retries for calls over a network, as an injected OCR or embedding function makes them inside a task."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

TRANSIENT_STATUS = {408, 429, 500, 502, 503, 504}
TRANSIENT_WORDS = ("timed out", "timeout", "connection", "temporarily", "reset", "unreachable", "ssl", "eof")


def is_transient(error: BaseException) -> bool:
    """May the same call do better later? By its status, its kind, or its words."""
    status = getattr(error, "status", None) or getattr(getattr(error, "resp", None), "status", None)
    if status is not None:
        return int(status) in TRANSIENT_STATUS
    if isinstance(error, (TimeoutError, ConnectionError)):
        return True
    return isinstance(error, OSError) and any(w in str(error).lower() for w in TRANSIENT_WORDS)


def retried(action: Callable[[], object], *, attempts: int = 4, cap: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """The action's result; a transient error waits 2^n seconds and a bit, or as long as it says, ``cap`` at most."""
    for n in range(attempts):
        try:
            return action()
        except Exception as error:
            if n + 1 == attempts or not is_transient(error):
                raise
            asked = getattr(error, "retry_after", None)
            sleep(min(cap, float(asked) if asked is not None else 2**n + random.random()))
    raise ValueError("attempts must be positive")
