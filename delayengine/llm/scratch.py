"""Binary files below the shared folder, written by tasks and mapped into memory by workers."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyarrow import fs

_mapped: dict[tuple[str, str, str], np.ndarray] = {}
_held: dict[str, Callable[[], None]] = {}
MAX_MAPPED = 100_000


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def put(folder: str, name: str, data: np.ndarray) -> None:
    """Write an array; a task that runs twice replaces the file by an equal one in one step."""
    system, base = _place(folder)
    system.create_dir(base, recursive=True)
    mine = f"{base}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(mine) as out:
        out.write(memoryview(np.ascontiguousarray(data)).cast("B") if len(data) else b"")
    system.move(mine, f"{base}/{name}")


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """The array in a file, mapped read-only. A file that is not on a mounted folder is fetched once per worker."""
    found = _mapped.get((folder, name, dtype))
    if found is None:
        system, base = _place(folder)
        path = f"{base}/{name}"
        if not isinstance(system, fs.LocalFileSystem):
            handle, local = tempfile.mkstemp(prefix="mapped-")
            with os.fdopen(handle, "wb") as out, system.open_input_stream(path) as source:
                while block := source.read(16 << 20):
                    out.write(block)
            found = _map(local, dtype)
            os.unlink(local)  # the mapping keeps it until the worker ends
        else:
            found = _map(path, dtype)
        if len(_mapped) >= MAX_MAPPED:
            _mapped.clear()
        _mapped[folder, name, dtype] = found
    return found


def _map(path: str, dtype: str) -> np.ndarray:
    return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)


def give_back() -> None:
    """Return memory that Arrow and malloc keep for later to the system: a worker outlives its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def holds(name: str, forget: Callable[[], None]) -> None:
    """An operator keeps much in its workers between tasks; ``forget`` lets go of it."""
    _held[name] = forget


def alone(name: str) -> None:
    """A task of this operator begins: what others left in the worker goes. Only caches are lost."""
    others = [forget for held, forget in _held.items() if held != name]
    for forget in others:
        forget()
    if others:
        give_back()
