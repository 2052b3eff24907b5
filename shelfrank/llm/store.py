"""Files of own formats in the shared folder, written and read inside tasks."""

from __future__ import annotations

import os

from shelfrank.sources.parts import located


def create(uri: str):
    """Output stream to a new file; its folder is made if it is missing."""
    system, path = located(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)


def read_range(uri: str, start: int, length: int) -> bytes:
    system, path = located(uri)
    with system.open_input_file(path) as file:
        return file.read_at(length, start)
