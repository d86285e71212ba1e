"""Memory of Python workers between tasks.

Spark keeps a worker for later tasks, and while others run; what it has freed stays
with its allocators, and what it has cached stays too, beside the executor's heap.
"""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa

from cohortia.llm import tokens, words


def release(encoders: bool = True) -> None:
    """Drop what is cached for the next batch, and the ``encoders``; give free memory back to the system."""
    if encoders:
        tokens.close_encoders()
    words.drop_powers()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def light(run, encoders: bool = True):
    """``run`` (batches -> batches) whose worker keeps nothing at its end; ``encoders``: nor at
    its beginning those of earlier work.  Without, they stay for the next task that cuts words."""
    @functools.wraps(run)
    def task(batches):
        if encoders and tokens.any_open():
            release()
        yield from run(batches)
        release(encoders)
    return task
