"""Settings, their checks, the workspace lock and stage times."""

from __future__ import annotations

import contextlib
import os
import time
from dataclasses import dataclass

from inkspool.operators.paths import target_error


@dataclass(frozen=True)
class Settings:
    """What a run may be told; ``error`` says why it cannot be."""

    workers: int = 4
    metadata_workers: int = 1
    requests_per_minute: int = 10
    largest_side: int = 2048
    grid: str = "4x4"
    kind: str = "illustration"
    target: float | None = None

    @property
    def megapixels(self) -> float:
        return self.target if self.target is not None else 25.0 if self.kind == "illustration" else 16.0

    @property
    def cells(self) -> tuple[int, int]:
        rows, columns = map(int, self.grid.lower().split("x"))
        return rows, columns

    def error(self) -> str | None:
        if min(self.workers, self.metadata_workers, self.requests_per_minute, self.largest_side) < 1:
            return "numbers must be positive"
        try:
            if min(self.cells) < 1:
                return "the grid needs rows and columns"
        except ValueError:
            return "the grid is rows x columns"
        if self.kind not in ("illustration", "icon", "icon-sheet"):
            return "unknown kind"
        return target_error(self.megapixels, self.kind)


@contextlib.contextmanager
def workspace(path: str):
    """The workspace for one run; a second one fails at once. The lock is the driver's, and goes with its process."""
    import fcntl

    with open(os.path.join(path, "workspace.lock"), "w") as file:
        try:
            fcntl.flock(file, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as error:
            raise RuntimeError("another run uses this workspace") from error
        yield


@contextlib.contextmanager
def timed(times: dict[str, float], stage: str):
    """Adds the seconds that a stage took, whether it ended well or not."""
    begun = time.monotonic()
    try:
        yield
    finally:
        times[stage] = times.get(stage, 0.0) + time.monotonic() - begun
