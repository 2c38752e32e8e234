"""What runs beside the plans: configuration, logging, retries, rate limits, isolation of targets."""

from __future__ import annotations

import json
import logging
import os
import random
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import wraps
from pathlib import Path
from typing import Any, TypeVar

T = TypeVar("T")


def env(name: str, default: str = "") -> str:
    return os.environ.get(name, "").strip() or default


def env_int(name: str, default: int) -> int:
    try:
        return int(env(name))
    except ValueError:
        return default


def env_bool(name: str, default: bool = False) -> bool:
    value = env(name).lower()
    return value in ("1", "true", "yes", "on") if value else default


def env_list(name: str, default: list[str] | None = None) -> list[str]:
    found = [x.strip() for x in env(name).split(",") if x.strip()]
    return found or list(default or [])


def load_env(path: str) -> dict[str, str]:
    """Settings of a file of NAME=value lines; those already set in the environment win."""
    found = {}
    for line in Path(path).read_text().splitlines():
        name, sep, value = line.partition("=")
        if sep and not name.strip().startswith("#"):
            found[name.strip()] = value.strip().strip("\"'")
            os.environ.setdefault(name.strip(), found[name.strip()])
    return found


class JsonLines(logging.Formatter):
    """Log records as one JSON object a line, extra fields included."""

    usual = frozenset(logging.makeLogRecord({}).__dict__) | {"message", "asctime", "taskName"}

    def format(self, record: logging.LogRecord) -> str:
        own = {k: v for k, v in record.__dict__.items() if k not in self.usual}
        return json.dumps({"time": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage()} | own, default=str)


def logger(name: str) -> logging.Logger:
    log = logging.getLogger(name)
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(JsonLines())
        log.addHandler(handler)
        log.setLevel(env("LOG_LEVEL", "INFO"))
        log.propagate = False
    return log


def retry(attempts: int = 5, base: float = 2.0, most: float = 120.0, on: tuple[type[Exception], ...] = (Exception,), sleep: Callable[[float], None] = time.sleep) -> Callable:
    """Repeat a call that fails, waiting longer each time with some jitter; the last error goes through."""

    def around(call: Callable[..., T]) -> Callable[..., T]:
        @wraps(call)
        def run(*args: Any, **kwargs: Any) -> T:
            for n in range(attempts):
                try:
                    return call(*args, **kwargs)
                except on:
                    if n + 1 == attempts:
                        raise
                    sleep(min(most, base**n) * random.uniform(0.5, 1.0))
            raise AssertionError

        return run

    return around


class TokenBucket:
    """At most `rate` permits a second on average, `burst` at once."""

    def __init__(self, rate: float, burst: float | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst or rate, clock, sleep
        self.level, self.at = self.burst, clock()

    def take(self, n: float = 1.0) -> None:
        while True:
            now = self.clock()
            self.level, self.at = min(self.burst, self.level + (now - self.at) * self.rate), now
            if self.level >= n:
                self.level -= n
                return
            self.sleep((n - self.level) / self.rate)


@dataclass
class Token:
    name: str
    remaining: int
    reset: float


def pick_token(tokens: list[Token], now: float, floor: int = 0) -> tuple[Token, float]:
    """The token with the largest budget and no wait; if all are used up the one that resets first and how long to wait."""
    fresh = [t for t in tokens if t.remaining > floor or t.reset <= now]
    if fresh:
        return max(fresh, key=lambda t: (t.remaining if t.reset > now else 1 << 60, -t.reset)), 0.0
    soonest = min(tokens, key=lambda t: t.reset)
    return soonest, max(0.0, soonest.reset - now)


def each(targets: Iterable[str], work: Callable[[str], Any]) -> tuple[dict[str, Any], dict[str, str]]:
    """Work on every target; a failure is noted and the others go on."""
    done: dict[str, Any] = {}
    failed: dict[str, str] = {}
    for t in targets:
        try:
            done[t] = work(t)
        except Exception as e:  # a broken target must not stop the rest
            failed[t] = f"{type(e).__name__}: {e}"
    return done, failed
