"""Where a path lies: a local folder, or a store that Arrow can open."""

from __future__ import annotations

import re

from pyarrow.fs import FileSystem, LocalFileSystem


def opened_for(path: str) -> tuple[FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if "://" in path and not path.startswith("file:"):
        return FileSystem.from_uri(path)
    return LocalFileSystem(), re.sub("^file:/*", "/", path)
