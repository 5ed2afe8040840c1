"""A polite HTTP getter for the driver-side connectors: spaced requests and retries with growing pauses."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

# Seconds between requests, attempts, and the statuses that are tried again.
GAP, JITTER, ATTEMPTS = 0.6, 0.25, 5
RETRY_STATUS = frozenset({429, 500, 502, 503, 504})


class Throttled:
    """get(url, **options) through ``call``, which returns an object with status_code; errors are retried as well."""

    def __init__(self, call: Callable, errors: tuple[type[Exception], ...] = (OSError, TimeoutError), sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> None:
        self.call, self.errors, self.sleep, self.clock = call, errors, sleep, clock
        self.last: float | None = None

    def get(self, url: str, **options):
        for attempt in range(ATTEMPTS):
            if self.last is not None:
                wait = self.last + GAP + random.uniform(0, JITTER) - self.clock()
                if wait > 0:
                    self.sleep(wait)
            self.last = self.clock()
            final = attempt == ATTEMPTS - 1
            try:
                response = self.call(url, **options)
            except self.errors:
                if final:
                    raise
                self.sleep(2**attempt + random.uniform(0, 1))
                continue
            if response.status_code not in RETRY_STATUS or final:
                return response
            self.sleep(3 * 2**attempt + random.uniform(0, 2))
        raise AssertionError("unreachable")
