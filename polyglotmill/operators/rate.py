"""One rate for all tasks of a stage: tasks that run side by side agree on their shares of it.

The tasks of a barrier stage run at the same time. Again and again each says
whether it still has work, in a thread beside its calls; the rate is divided by
the number of those that do, so a task that is done hands its share on. A task
that has ended goes on answering until all have.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


class Pace:
    """At most `per_second` calls, evenly spaced; none without a rate."""

    def __init__(self, per_second: float | None, now: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.next, self.now, self.sleep = 1 / per_second if per_second else 0.0, 0.0, now, sleep

    def wait(self) -> None:
        now = self.now()
        if self.gap and now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap

    def finish(self) -> None:
        pass


class SharedPace(Pace):
    """A share of `per_second` calls, agreed with the other tasks of the stage. gather(message) gives the messages of all of them.

    Until the first agreement it is an equal part.
    """

    def __init__(self, per_second: float, tasks: int, gather: Callable[[str], list[str]], now: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        super().__init__(per_second / tasks, now, sleep)
        self.per_second, self.gather, self.busy = per_second, gather, True

    def agree(self) -> bool:
        """One round; whether some task is still busy. All tasks see the same answers, so all stop after the same round."""
        active = self.gather("busy" if self.busy else "done").count("busy")
        self.gap = active / self.per_second if active else self.gap
        return active > 0

    def wait(self) -> None:
        # A share that has grown is not held up by the gap of the smaller one.
        self.next = min(self.next, self.now() + self.gap)
        super().wait()

    def start(self, period: float) -> SharedPace:
        def rounds() -> None:
            while self.agree():
                time.sleep(period)

        self._rounds = ThreadPoolExecutor(1)
        self._ended = self._rounds.submit(rounds)
        return self

    def finish(self) -> None:
        self.busy = False
        self._ended.result()
        self._rounds.shutdown()


def in_stage(per_second: float, period: float = 1.0) -> SharedPace:
    """To be called in a task of a barrier stage, which has to call `finish` at its end."""
    from pyspark import BarrierTaskContext

    stage = BarrierTaskContext.get()
    return SharedPace(per_second, len(stage.getTaskInfos()), stage.allGather).start(period)
