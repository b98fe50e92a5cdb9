"""Errors by kind, retries, and a rate limiter for calls to services from within tasks."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")
TRANSIENT, PERMANENT = "transient", "permanent"
# Fixed values.
_TRANSIENT_NAMES = {"RateLimitError", "APITimeoutError", "APIConnectionError", "ConnectionError", "TimeoutError", "InternalServerError", "ServiceUnavailableError"}
_PERMANENT_TYPES = (FileNotFoundError, PermissionError, IsADirectoryError, UnicodeDecodeError, ValueError)


def error_kind(error: BaseException) -> str:
    """Permanent: missing or forbidden files, bad values, damaged compressed data. All else may pass."""
    kind = type(error)
    if isinstance(error, _PERMANENT_TYPES):
        return PERMANENT
    damaged = "zlib" in f"{kind.__module__}.{kind.__name__}".lower() or "decompres" in str(error).lower()
    return PERMANENT if damaged and kind.__name__ not in _TRANSIENT_NAMES else TRANSIENT


def with_retries(call: Callable[[], T], retries: int = 3, base: float = 1.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """Calls until it succeeds, at most `retries` times more; permanent errors are raised at once."""
    for attempt in range(retries + 1):
        try:
            return call()
        except Exception as e:
            if attempt == retries or error_kind(e) == PERMANENT:
                raise
            sleep(min(base * 2**attempt + random.uniform(0, 1), most))
    raise AssertionError


class RateLimiter:
    """Requests and tokens a minute, with a second's budget at first and ten seconds' at most. What could never be granted
    is an error. Tasks that share a rate each keep one and acquire what all of them send, in one order."""

    def __init__(self, requests: float = 3000, tokens: float = 900_000, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rates, self.clock, self.sleep = (requests / 60, tokens / 60), clock, sleep
        self.budgets, self.at = list(self.rates), clock()

    def acquire(self, tokens: int = 0) -> None:
        wanted = (1, tokens)
        if any(w > 10 * r for w, r in zip(wanted, self.rates, strict=True)):
            raise ValueError("more than ten seconds' budget: split the request")
        while True:
            now = self.clock()
            self.budgets = [min(b + r * (now - self.at), 10 * r) for b, r in zip(self.budgets, self.rates, strict=True)]
            self.at = now
            missing = max((w - b) / r for w, b, r in zip(wanted, self.budgets, self.rates, strict=True))
            if missing <= 1e-9:
                self.budgets = [b - w for b, w in zip(self.budgets, wanted, strict=True)]
                return
            self.sleep(missing)
