"""Raw files below the shared folder, from the driver or from tasks, through Arrow's file systems
(local or mounted paths, HDFS, object stores)."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/|/", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def publish(uri: str, chunks) -> int:
    """Write ``chunks`` under a name of this attempt, then move them to ``uri``: a task that runs
    again (lost executor, speculation) replaces the file by the same content, and no reader sees
    half of one. Returns the bytes written."""
    system, path = resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    own, size = f"{path}.{uuid.uuid4().hex}.part", 0
    with system.open_output_stream(own) as out:
        for c in chunks:
            out.write(c)
            size += len(c)
    system.move(own, path)
    return size


def open_input(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)


def names(uri: str) -> list[str]:
    """Names of the files in a folder."""
    system, path = resolve(uri)
    return [i.base_name for i in system.get_file_info(fs.FileSelector(path))]
