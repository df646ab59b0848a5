"""Binary files in the shared folder, written and read by tasks.

Spark's writers have no format for archives or id files, so tasks open files themselves, through
Arrow's file systems (local or mounted folders, S3, GCS, ABFS, HDFS). A task that is run twice
writes a second file under another name; only files named in the manifest, a table that Spark
commits, are ever read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs

#: Names Hadoop uses, and the names Arrow has for the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def opened(url: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``url`` and the path in it; without a scheme, a local path."""
    scheme, mark, rest = url.partition(":")
    if not mark or "/" in scheme:
        return fs.LocalFileSystem(), url
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def new_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def create(url: str):
    """A stream to write a new file; missing folders are made."""
    store, path = opened(url)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def read(url: str):
    """A stream over a file from its start."""
    store, path = opened(url)
    return store.open_input_stream(path, compression=None)


def seekable(url: str):
    """A file for reads at given places."""
    store, path = opened(url)
    return store.open_input_file(path)
