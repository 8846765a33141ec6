"""Binary files that tasks write to the folder all executors share.

A task writes under a name of its own and renames at the end, so a repeated or speculative attempt
never leaves half a file under the final name. Names depend on the partition only.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from cohortica.session import shared_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """URI of a new folder below ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def opened(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def replacing(*uris: str):
    """Output streams that appear under their names together, when the block ends well."""
    system, _ = opened(uris[0])
    paths = [opened(u)[1] for u in uris]
    system.create_dir(paths[0].rpartition("/")[0], recursive=True)
    drafts = [f"{p}.{uuid.uuid4().hex}.draft" for p in paths]
    streams = [system.open_output_stream(d, compression=None) for d in drafts]
    try:
        yield streams
    finally:
        for s in streams:
            s.close()
    for draft, path in zip(drafts, paths, strict=True):
        system.move(draft, path)


def mapped(uri: str, dtype):
    """A numpy view of a whole file, memory-mapped where the file system is local."""
    import numpy as np
    from pyarrow import fs

    system, path = opened(uri)
    if system.get_file_info(path).size == 0:
        return np.empty(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)
