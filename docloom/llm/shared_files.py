"""Files in the shared folder, written and read by tasks.

A task writes to a hidden name of its own and renames it when whole. Names hold the task attempt's number, so an attempt
that runs twice, or whose executor is lost, never touches another attempt's file; which files count is what the attempts
that Spark accepted report. Nothing is deleted or overwritten.
"""

from __future__ import annotations

import uuid

from pyarrow.fs import FileSystem


def write_file(folder: str, name: str, data: bytes) -> None:
    fs, path = FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        out.write(data)
    fs.move(own, f"{path}/{name}")


def read_file(uri: str) -> bytes:
    fs, path = FileSystem.from_uri(uri)
    with fs.open_input_file(path) as file:
        return file.read()
