"""Keeps one subscription for each live component: polls the topology and starts and stops what changed."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Hashable, Iterable

POLL_SECONDS = 30.0
log = logging.getLogger(__name__)


class Watcher:
    """fetch gives the live components (any error keeps the set as it is); start returns whether a component can be subscribed to.

    Only subscribed components are held, so the others are offered to start again at every poll.
    """

    def __init__(self, fetch: Callable[[], Iterable[Hashable]], start: Callable[[Hashable], bool], stop: Callable[[Hashable], object]):
        self.fetch, self.start, self.stop = fetch, start, stop
        self.current: set[Hashable] = set()

    def poll(self) -> bool:
        """One round; whether anything changed."""
        try:
            latest = set(self.fetch())
        except Exception as e:  # noqa: BLE001  the service may be away for a while
            log.error("fetching the topology failed: %s", e)
            return False
        started = {c for c in latest - self.current if self.start(c)}
        stopped = self.current - latest
        for c in stopped:
            self.stop(c)
        self.current = (self.current - stopped) | started
        return bool(started or stopped)

    def run(self, ended: threading.Event, seconds: float = POLL_SECONDS) -> None:
        """Polls until ended, seconds after each round has come back, then stops all that runs."""
        while not ended.is_set():
            self.poll()
            ended.wait(seconds)
        for c in self.current:
            self.stop(c)
        self.current = set()
