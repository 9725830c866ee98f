"""Extractors that can't take their task with them (OP-70, OP-46).

A codec or a model may crash its process or never return. ``contained(extractor)`` runs it in a child process of the task:
a value goes in, a vector or a reason comes out, one at a time. So if the child dies, or gives no answer in time, the
value that did it is known at once: it gets its reason (and the zero vector, by ``featurize``), a new child
is started, and the rest goes on. While a child is slow (``GRACE_S``) the next values go to another one, up to ``CHILDREN``
of them, so values that hang are waited for together. The children end with their task, also where that is killed.
"""

from __future__ import annotations

import ctypes
import multiprocessing
import os
import resource
import signal
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import replace
from multiprocessing.connection import wait

from vigil.operators.featurize import Extractor

GRACE_S, CHILDREN = 0.1, 8
AHEAD_VALUES, AHEAD_BYTES = 8192, 32 << 20  # read beyond a value that hangs
PR_SET_PDEATHSIG = 1  # Linux: the signal that a process gets when its parent ends


class Spoiled(Exception):
    """What became of a value that has no vector."""


def _limit_memory(megabytes: int) -> None:
    with open("/proc/self/statm") as f:
        used = int(f.read().split()[0]) * resource.getpagesize()
    limit = used + (megabytes << 20)
    resource.setrlimit(resource.RLIMIT_AS, (limit, limit))


def _serve(init: Callable, pipe, other, memory_mb: int | None) -> None:
    try:
        ctypes.CDLL(None).prctl(PR_SET_PDEATHSIG, signal.SIGKILL)
    except (OSError, AttributeError):
        pass  # not Linux: the child ends when its pipe does
    other.close()
    try:
        if memory_mb is not None:
            _limit_memory(memory_mb)
        extract = init()
        pipe.send((True, None))
        while True:
            value = pipe.recv()
            try:
                answer = (True, extract(value))
            except Exception as e:  # MemoryError included
                answer = (False, str(e) or type(e).__name__)
            pipe.send(answer)
    except EOFError:
        pass
    except Exception as e:
        pipe.send((False, f"init: {e}"))
    finally:
        os._exit(0)


class _Child:
    def __init__(self, init: Callable, seconds: float, init_seconds: float, memory_mb: int | None):
        self.init, self.seconds, self.init_seconds, self.memory_mb = init, seconds, init_seconds, memory_mb
        self.process = None

    def _start(self) -> None:
        context = multiprocessing.get_context("fork")  # init may be any function
        self.pipe, far = context.Pipe()
        self.process = context.Process(target=_serve, args=(self.init, far, self.pipe, self.memory_mb), daemon=True)
        self.process.start()
        far.close()
        self._answer(self.init_seconds)

    def _answer(self, seconds: float, since: float | None = None):
        """The answer to what was sent, now or at ``since``."""
        try:
            left = seconds if since is None else max(0.0, since + seconds - time.monotonic())
            if not self.pipe.poll(left):
                self.close()
                raise Spoiled(f"no answer in {seconds:g} s")
            good, answer = self.pipe.recv()
        except (EOFError, ConnectionResetError):
            self.process.join()
            code = self.process.exitcode
            self.close()
            raise Spoiled(f"killed by signal {-code}" if code < 0 else f"ended with code {code}") from None
        if not good:
            raise Spoiled(answer)
        return answer

    def send(self, value: object) -> None:
        if self.process is None:
            self._start()
        try:
            self.pipe.send(value)
        except (BrokenPipeError, ConnectionResetError):  # it died between two values: not this one's fault
            self.close()
            self._start()
            self.pipe.send(value)

    def answer(self, since: float) -> tuple[bool, object]:
        try:
            return True, self._answer(self.seconds, since)
        except Spoiled as e:
            return False, e

    def __call__(self, value: object) -> object:
        self.send(value)
        return self._answer(self.seconds)

    def close(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.pipe.close()
            self.process = None


def _bytes(value: object) -> int:
    return len(value) if hasattr(value, "__len__") else 64


class _Children:
    """Several children, of which all but one are waited for."""

    def __init__(self, *args):
        self.args, self.children = args, [_Child(*args)]

    @property
    def process(self):
        return self.children[0].process

    def __call__(self, value: object) -> object:
        return self.children[0](value)

    def stream(self, values: Iterator[object]) -> Iterator[tuple[bool, object]]:
        """``(True, answer)`` or ``(False, reason)`` of each value, in order."""
        # by order: result (None: not yet) and bytes of each value; children at work: slot, since when
        slots, busy, size, more = deque(), {}, 0, True
        while more or slots:
            while slots and slots[0][0] is not None:
                found, n = slots.popleft()
                size -= n
                yield found
            now = time.monotonic()
            fresh = [since for _, since in busy.values() if now < since + GRACE_S]
            child = None
            if more and not fresh and len(slots) < AHEAD_VALUES and size < AHEAD_BYTES:
                child = next((c for c in self.children if c not in busy), None)
                if child is None and len(self.children) < CHILDREN:
                    child = _Child(*self.args)
                    self.children.append(child)
            if child is not None:
                try:
                    value = next(values)
                except StopIteration:
                    more = False
                    continue
                slot = [None, _bytes(value)]
                slots.append(slot)
                size += slot[1]
                try:
                    child.send(value)
                    busy[child] = slot, time.monotonic()
                except Spoiled as e:
                    slot[0] = False, e
            if busy:
                until = min([since + c.seconds for c, (_, since) in busy.items()] + [s + GRACE_S for _, s in busy.values() if more and s + GRACE_S > now])
                ready = wait([c.pipe for c in busy], max(0.0, until - time.monotonic()))
                now = time.monotonic()
                for c in [c for c, (_, since) in busy.items() if c.pipe in ready or now >= since + c.seconds]:
                    slot, since = busy.pop(c)
                    slot[0] = c.answer(since)

    def close(self) -> None:
        for c in self.children:
            c.close()


def contained(extractor: Extractor, seconds: float = 60, init_seconds: float = 600, memory_mb: int | None = None) -> Extractor:
    """``extractor`` in a child process per task; ``seconds`` for a value, ``memory_mb`` beyond what the task holds at its start.
    An ``init`` that fails gives every value of the task that reason."""
    def init() -> Callable[[object], object]:
        return _Children(extractor.init, seconds, init_seconds, memory_mb)
    return replace(extractor, init=init)
