"""Frame by frame readers of a change feed, pulled or pushed."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.errors import FELL_BEHIND, STREAM_FAILED, UNSUPPORTED, FreshetError, fault
from freshet.streaming.stream import EPOCH, Stream

_POLL_SECONDS = 0.05


@dataclass(frozen=True)
class Frame:
    """``data`` with the rows of one epoch, or ``barrier`` with its checkpoint."""

    kind: str
    sequence: int
    batch: DataFrame | None = None
    epoch: int | None = None
    checkpoint_id: int | None = None
    through_sequence: int | None = None


class Subscription:
    """Frames in order, from the tail or after a given epoch.

    A frame's rows stay a DataFrame: reading them is a job on that epoch's
    partition only. A terminal failure is raised once, then the end follows.

    A named ``reader`` is a consumer of the feed: it goes on after the last
    epoch whose barrier it was handed, and retention waits for it.
    """

    def __init__(self, stream: Stream, where: str | None = None, after: int | None = None, reader: str | None = None):
        self.stream = stream
        self.schema = stream.schema
        self._where = where
        self._reader = f"reader {reader}" if reader else None
        last = stream.feed.last()
        if self._reader and after is None:
            after = stream.consumers.positions().get(self._reader)
        self._position = after if after is not None else (-1 if last is None else last)
        if self._reader:
            stream.consumers.reach(self._reader, self._position)
        self._queued: list[Frame] = []
        self._active = True
        self._check_retained()

    def _check_retained(self) -> None:
        feed, due = self.stream.feed, self._position + 1
        if feed.retained(due):
            return
        first = feed.first_retained()
        if first is not None and due < first:
            self._active = False
            raise fault(FELL_BEHIND, f"the reader is {first - due} commits behind what is kept")

    @property
    def is_active(self) -> bool:
        return self._active

    def cancel(self) -> None:
        self._active = False
        self._queued.clear()

    def _fetch(self) -> bool:
        """Queue the frames of the next committed epoch, if there is one."""
        feed = self.stream.feed
        epoch = self._position + 1
        if not feed.has(epoch):
            return False
        self._check_retained()
        if feed.entry(epoch)["rows"]:
            rows = feed.read(after=epoch - 1, upto=epoch).drop(EPOCH)
            if self._where:
                rows = rows.where(F.expr(self._where))
            self._queued.append(Frame("data", epoch, batch=rows))
        self._queued.append(
            Frame("barrier", epoch, epoch=epoch, checkpoint_id=epoch + 1, through_sequence=epoch)
        )
        self._position = epoch
        return True

    def next_frame(self, timeout: float | None = None) -> Frame | None:
        """The next frame, waiting for it; None after the end or ``cancel``.

        Raises ``TimeoutError`` when ``timeout`` seconds pass without one.
        """
        deadline = None if timeout is None else time.monotonic() + timeout
        while self._active:
            if self._queued:
                return self._handed()
            if self._fetch():
                continue
            failure = self.stream.failure()
            if failure or self.stream.stopped:
                self._active = False
                raise fault(STREAM_FAILED, failure or f"stream '{self.stream.name}' stopped")
            if deadline is not None and time.monotonic() > deadline:
                raise TimeoutError(f"no frame within {timeout} s")
            time.sleep(_POLL_SECONDS)
        return None

    def committed(self) -> Iterator[Frame]:
        """The frames committed by now, without waiting for more."""
        while self._active and (self._queued or self._fetch()):
            yield self._handed()

    def _handed(self) -> Frame:
        frame = self._queued.pop(0)
        if self._reader and frame.kind == "barrier":
            self.stream.consumers.reach(self._reader, frame.epoch)
        return frame

    def __iter__(self) -> Iterator[Frame]:
        try:
            while (frame := self.next_frame()) is not None:
                yield frame
        finally:
            self.cancel()


class PushSubscription:
    """Hands frames to a handler one at a time, in a thread of the driver.

    The next frame is taken only after the handler returned. A failure is
    reported once, and the closing callback runs exactly once.
    """

    def __init__(
        self,
        open_pull: Callable[[], Subscription],
        on_data: Callable[[Frame], None],
        on_error: Callable[[FreshetError], None],
        on_close: Callable[[], None],
    ):
        self._open_pull = open_pull
        self._on_data, self._on_error, self._on_close = on_data, on_error, on_close
        self._closing = threading.Event()
        self._active = True
        self._ready = threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()
        self._ready.wait()

    def _run(self) -> None:
        try:
            try:
                pull = self._open_pull()
            finally:
                self._ready.set()
            while not self._closing.is_set():
                try:
                    frame = pull.next_frame(timeout=0.2)
                except TimeoutError:
                    continue
                if frame is None or self._closing.is_set():
                    break
                try:
                    self._on_data(frame)
                except Exception as error:
                    raise fault(UNSUPPORTED, f"data handler failed: {error}") from error
        except FreshetError as error:
            self._on_error(error)
        except Exception as error:
            self._on_error(fault(STREAM_FAILED, str(error)))
        finally:
            self._active = False
            self._on_close()

    @property
    def is_active(self) -> bool:
        return self._active

    def close(self) -> None:
        """Stop delivery and wait for the handler; again is a no-op."""
        self._closing.set()
        self._thread.join()
