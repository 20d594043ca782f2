"""Progress lines: share done, rate of the current window and of the whole, time left."""

from __future__ import annotations

from dataclasses import dataclass, field


def _clock(seconds: float) -> str:
    return f"{int(seconds) // 60:02d}:{int(seconds) % 60:02d}"


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def progress_line(done: float, total: float, elapsed: float, divider: float = 1.0, unit: str = "rows", window: tuple[float, float] | None = None) -> str:
    """What can be said at one moment; window: (done, seconds) since it began, else the whole time."""
    mean = _ratio(done, elapsed)
    rate = _ratio(*window) if window else mean
    left, whole = _ratio(total - done, mean), _ratio(total, mean)
    return f"{_ratio(100 * done, total):.2f}% {done / divider:.0f}/{total / divider:.0f} | {rate / divider:.1f} {unit}/s ({mean / divider:.1f} {unit}/s) | {_clock(left)} ({_clock(whole)})"


@dataclass
class Progress:
    """Lines over time; the window starts anew once it is at least window seconds old."""

    total: float
    divider: float = 1.0
    unit: str = "rows"
    window: float = 5.0
    start: float | None = None
    _since: tuple[float, float] | None = field(default=None, repr=False)

    def line(self, done: float, now: float) -> str:
        if self.start is None:
            self.start = now
        if self._since is None:
            self._since = (0.0, self.start)
        count, at = self._since
        out = progress_line(done, self.total, now - self.start, self.divider, self.unit, (done - count, now - at))
        if now - at >= self.window:
            self._since = (done, now)
        return out
