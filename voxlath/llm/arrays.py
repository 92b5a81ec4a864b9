"""Named arrays in the shared folder: written as a whole, mapped into memory by workers."""

from __future__ import annotations

import functools
import io
import os
import shutil
import uuid

import numpy as np

from . import common


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """All arrays appear at once or not at all; a repeated task writes the same again."""
    if (local := common.local_path(path)) is not None:
        made = f"{local}.{uuid.uuid4().hex}"
        os.makedirs(made)
        for name, a in arrays.items():
            np.save(f"{made}/{name}.npy", a)
        try:
            os.rename(made, local)
        except OSError:  # another attempt of this task was first
            shutil.rmtree(made)
        return
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    made = f"{base}.{uuid.uuid4().hex}"
    store.create_dir(made)
    for name, a in arrays.items():
        buffer = io.BytesIO()
        np.save(buffer, a)
        with store.open_output_stream(f"{made}/{name}.npy") as out:
            out.write(buffer.getvalue())
    if store.get_file_info(base).type == fs.FileType.NotFound:
        store.move(made, base)
    else:
        store.delete_dir(made)


@functools.lru_cache(maxsize=4096)
def _local(path: str) -> dict[str, np.ndarray] | None:
    if not os.path.isdir(path) or not os.listdir(path):
        return None
    return {f[:-4]: np.load(f"{path}/{f}", mmap_mode="r") for f in os.listdir(path)}


@functools.lru_cache(maxsize=64)
def _remote(path: str) -> dict[str, np.ndarray] | None:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    out = {}
    for info in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        with store.open_input_file(info.path) as source:
            out[info.base_name[:-4]] = np.load(io.BytesIO(source.read()))
    return out or None


def mapped(path: str) -> dict[str, np.ndarray] | None:
    """The arrays, mapped where the folder is mounted, else read, a bounded number at a time; None if there are none."""
    local = common.local_path(path)
    return _remote(path) if local is None else _local(local)
