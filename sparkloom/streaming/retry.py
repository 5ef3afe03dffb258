"""Reconnection: when to try again, and when to stop."""

from __future__ import annotations

import threading
from collections.abc import Callable

INITIAL_DELAY, MAX_DELAY = 1.0, 60.0


def next_delay(delay: float) -> float:
    """The delay before the next attempt after a failure: doubled before it is slept, 60 s at most."""
    return min(delay * 2, MAX_DELAY)


def keep_connected(connect: Callable[[], bool], stop: threading.Event, initial: float = INITIAL_DELAY, sleep: Callable[[float], object] | None = None) -> None:
    """Runs connect until stop is set. connect returns True after a connection that ended well, False or an error after one that failed.

    A clean end reconnects at once and resets the delay; a failure waits for the next delay, or until stop is set.
    """
    delay = initial
    while not stop.is_set():
        try:
            well = connect()
        except OSError:
            well = False
        if well:
            delay = initial
            continue
        delay = next_delay(delay)
        (sleep or stop.wait)(delay)


class Shutdown:
    """A stop signal that ends everything below it: child() is set with its parent, and wait() returns when all work has ended."""

    def __init__(self, parent: Shutdown | None = None):
        self.event = threading.Event()
        self.children: list[Shutdown] = []
        self.running = 0
        self.idle = threading.Condition()
        self.parent = parent

    def child(self) -> Shutdown:
        below = Shutdown(self)
        self.children.append(below)
        if self.event.is_set():
            below.shutdown()
        return below

    def shutdown(self) -> None:
        self.event.set()
        for below in self.children:
            below.shutdown()

    def __enter__(self) -> Shutdown:
        with self.idle:
            self.running += 1
        return self

    def __exit__(self, *_: object) -> None:
        with self.idle:
            self.running -= 1
            self.idle.notify_all()

    def wait(self, timeout: float | None = None) -> bool:
        with self.idle:
            done = self.idle.wait_for(lambda: self.running == 0, timeout)
        return done and all(below.wait(timeout) for below in self.children)
