"""A lock for one writer: it never expires and is never taken over; an unknown outcome keeps it held."""

from __future__ import annotations

import json
import os
import signal
import time


class LeaseHeld(RuntimeError):
    pass


class Terminated(RuntimeError):
    pass


class Lease:
    def __init__(self, root: str, holder: str):
        self.path, self.holder, self.unknown = os.path.join(root, "lease.json"), holder, False

    def _state(self) -> dict | None:
        try:
            with open(self.path) as f:
                return json.load(f)
        except FileNotFoundError:
            return None

    def acquire(self) -> None:
        """Atomic: of any number of callers one succeeds."""
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        part = f"{self.path}.{self.holder}"
        with open(part, "w") as f:
            json.dump({"holder": self.holder, "acquired_at": time.time(), "heartbeat_at": time.time(), "stage": None}, f)
        try:
            os.link(part, self.path)  # whole or not at all, and only where none is
        except FileExistsError:
            raise LeaseHeld(f"held by {(self._state() or {}).get('holder')}") from None
        finally:
            os.unlink(part)

    def require(self) -> None:
        if (self._state() or {}).get("holder") != self.holder:
            raise LeaseHeld("This load no longer holds the lease.")

    def renew(self, stage: str) -> None:
        self.require()
        part = f"{self.path}.{self.holder}"
        with open(part, "w") as f:
            json.dump(self._state() | {"heartbeat_at": time.time(), "stage": stage}, f)
        os.replace(part, self.path)

    def submitting(self) -> None:
        """From here until ``resolved`` nobody knows what came of the write."""
        self.unknown = True

    def resolved(self) -> None:
        self.unknown = False

    def release(self) -> bool:
        """Frees the lock if this load holds it and its outcome is known."""
        if self.unknown or (self._state() or {}).get("holder") != self.holder:
            return False
        os.unlink(self.path)
        return True


def raise_on_sigterm() -> None:
    """A termination becomes an exception, so that it is recorded and the lock is freed."""

    def stop(*_):
        raise Terminated("terminated")

    signal.signal(signal.SIGTERM, stop)
