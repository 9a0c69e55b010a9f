"""Array files in the shared folder: written whole by tasks, memory-mapped by others."""

from __future__ import annotations

import json
import mmap
import os
import shutil
import tempfile
import uuid

import numpy as np
from pyspark import TaskContext
from pyspark.sql import SparkSession

from passagemill.llm.common import worker_state
from passagemill.session import new_path

_ALIGN = 64


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, with its file system's scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(new_path(spark, label))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    return system.makeQualified(path).toString()


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return uri if uri.startswith("/") else None


def save_arrays(folder: str, name: str, arrays: dict[str, np.ndarray], **numbers) -> str:
    """Write arrays and numbers as one file and return its address.

    The name holds the task attempt, so an attempt that is run again never touches a finished file;
    the caller's rows tell which file counts.
    """
    entries, at = {}, 0
    for key, array in arrays.items():
        at += -at % _ALIGN
        entries[key] = (at, str(array.dtype), len(array))
        at += array.nbytes
    header = json.dumps({"arrays": entries, "numbers": numbers}).encode()
    header += b" " * (-(len(header) + 8) % _ALIGN)
    context = TaskContext.get()
    attempt = context.taskAttemptId() if context else 0
    uri = f"{folder}/{name}-{attempt}-{uuid.uuid4().hex[:8]}"

    def write(out) -> None:
        out.write(len(header).to_bytes(8, "little") + header)
        done = 0
        for key, array in arrays.items():
            out.write(b"\0" * (entries[key][0] - done))
            out.write(np.ascontiguousarray(array).tobytes())
            done = entries[key][0] + array.nbytes

    if path := _local(uri):
        with open(path, "wb") as out:
            write(out)
    else:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(uri)
        with system.open_output_stream(inner) as out:
            write(out)
    return uri


def load_arrays(uri: str) -> tuple[dict[str, np.ndarray], dict]:
    """The arrays of a file, memory-mapped once per worker.

    A file that is not on a mounted file system is first copied to a temporary file that has no name
    any more, so nothing is left behind.
    """
    opened = worker_state("mapped_files")
    if uri not in opened:
        path = _local(uri)
        with open(path, "rb") if path else tempfile.TemporaryFile() as source:
            if not path:
                from pyarrow import fs

                system, inner = fs.FileSystem.from_uri(uri)
                with system.open_input_stream(inner) as far:
                    shutil.copyfileobj(far, source)
                source.flush()
            whole = np.frombuffer(
                mmap.mmap(source.fileno(), os.fstat(source.fileno()).st_size, access=mmap.ACCESS_READ),
                np.uint8,
            )
        size = int.from_bytes(whole[:8].tobytes(), "little")
        header = json.loads(whole[8 : 8 + size].tobytes())
        body = whole[8 + size :]
        arrays = {}
        for key, (begin, kind, count) in header["arrays"].items():
            dtype = np.dtype(kind)
            arrays[key] = body[begin : begin + count * dtype.itemsize].view(dtype)
        opened[uri] = arrays, header["numbers"]
    return opened[uri]
