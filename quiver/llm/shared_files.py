"""Binary files that tasks write into a shared folder (the one of spark.checkpoint.dir).

A file is written under a name of its own and renamed when complete, so a retried or
doubled task leaves one whole file of the same content.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse


def write_file(folder: str, name: str, parts) -> None:
    """Write the byte strings ``parts`` as ``folder/name``; ``folder`` is a path or URI."""
    url = urlparse(folder)
    if url.scheme in ("", "file"):
        root = unquote(url.path) if url.scheme else folder
        os.makedirs(root, exist_ok=True)
        draft = os.path.join(root, f".{name}.{uuid.uuid4().hex}")
        with open(draft, "wb") as out:
            for part in parts:
                out.write(part)
        os.replace(draft, os.path.join(root, name))
        return
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    draft = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, f"{root}/{name}")


class Reader:
    """Ranges of files in a shared folder; keeps the last file open."""

    def __init__(self, folder: str):
        url = urlparse(folder)
        if url.scheme in ("", "file"):
            root = unquote(url.path) if url.scheme else folder
            self._open = lambda name: open(os.path.join(root, name), "rb")
        else:
            from pyarrow import fs

            store, root = fs.FileSystem.from_uri(folder)
            self._open = lambda name: store.open_input_file(f"{root}/{name}")
        self._name, self._file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self._name:
            self.close()
            self._file, self._name = self._open(name), name
        self._file.seek(offset)
        return self._file.read(length)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._name, self._file = None, None
