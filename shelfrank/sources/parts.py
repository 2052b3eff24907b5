"""Parquet tables in the shared folder, read inside tasks without passing through the JVM."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style address or a plain path."""
    if re.match(r"file:/(?!/)", uri):
        uri = uri.replace("file:/", "file:///", 1)
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    if "://" not in uri:
        uri = os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def batches_of(folders: Sequence[str], columns: Sequence[str], where: ds.Expression | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of tables that were written whole, a batch at a time; a folder that is missing has none."""
    for folder in folders:
        system, path = located(folder)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        files = sorted(f.path for f in found if f.is_file and f.size and f.base_name[0] not in "._")
        for file in files:
            table = ds.dataset(file, filesystem=system, format="parquet")
            every = table.to_batches(columns=list(columns), filter=where, use_threads=False)
            yield from (batch for batch in every if batch.num_rows)
