"""Rows through an external program, one process a row, within tasks."""

from __future__ import annotations

import selectors
import subprocess
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of output, and seconds, after which a process is ended.
MAX_OUTPUT, SECONDS = 64 << 20, 600.0
#: Bytes of its error output that are kept.
ERROR_BYTES = 2000
RESULT = "text string, code int, error string"


def run_one(command: list[str], cwd: str | None, max_output: int, seconds: float) -> tuple[str | None, int | None, str | None]:
    """(output, return code, error) of one process; one that fails, floods or hangs has an error and no output."""
    try:
        process = subprocess.Popen(command, cwd=cwd, stdin=subprocess.DEVNULL, stdout=subprocess.PIPE, stderr=subprocess.PIPE, start_new_session=True)
    except OSError as e:
        return None, None, f"{type(e).__name__}: {e}"
    out, err, error, ends = bytearray(), bytearray(), None, time.monotonic() + seconds
    with process, selectors.DefaultSelector() as ready:
        for stream, kept in ((process.stdout, out), (process.stderr, err)):
            ready.register(stream, selectors.EVENT_READ, kept)
        while ready.get_map() and error is None:
            left = ends - time.monotonic()
            found = ready.select(left) if left > 0 else []
            if not found:
                error = f"not done after {seconds:g} s"
            for key, _ in found:
                part = key.fileobj.read1(1 << 16)
                if not part:
                    ready.unregister(key.fileobj)
                key.data.extend(part)
            del err[:-ERROR_BYTES]
            if len(out) > max_output:
                error = f"more than {max_output} bytes of output"
        if error is None:
            try:
                process.wait(max(0.0, ends - time.monotonic()))
            except subprocess.TimeoutExpired:
                error = f"not done after {seconds:g} s"
        if error is not None:
            process.kill()
    if error is None and process.returncode:
        error = err.decode("utf-8", "replace") or f"return code {process.returncode}"
    if error is None:
        try:
            return out.decode("utf-8"), process.returncode, None
        except UnicodeDecodeError as e:
            error = str(e)
    return None, process.returncode, error


def through_program(df: DataFrame, key: str, command: list[str], cwd: str | None = None, max_output: int = MAX_OUTPUT, seconds: float = SECONDS) -> DataFrame:
    """(key, text, code, error): for each row, what the command prints with ``{}`` replaced by the key, a string.

    A task runs one process at a time; every row gives one row, with the output or with an error. Keys are
    arguments of their own and pass no shell. A null key gives an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                k = value.as_py()
                made = (None, None, "no key") if k is None else run_one([k if a == "{}" else a for a in command], cwd, max_output, seconds)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.string()), pa.array([made[0]], pa.string()), pa.array([made[1]], pa.int32()), pa.array([made[2]], pa.string())], [key, "text", "code", "error"])

    return df.select(df[key].cast("string").alias(key)).mapInArrow(run, f"`{key}` string, {RESULT}")
