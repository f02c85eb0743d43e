"""Sorted hash arrays in the shared folder, memory-mapped by Python workers.

A store is a folder of numpy files, one per shard and field. A shard holds
the 64-bit keys with the same leading bits, ascending. Tasks write shards
under a temporary name and rename them, so a task that runs twice leaves
one whole file; workers map the files they look into and read only the
pages they touch. Where the shared folder is not a mounted one, pyarrow's
file systems move the files and a worker maps its own temporary copy.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid

import numpy as np

from panelflow.llm.common import worker_cache


def _local(uri: str) -> str | None:
    return ("/" + uri[5:].lstrip("/")) if uri.startswith("file:") else uri if "://" not in uri else None


def _remote(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write(uri: str, shard: int, field: str, array: np.ndarray) -> None:
    """One field of one shard, whole or not at all."""
    name, folder = f"{field}-{shard:06d}.npy", _local(uri)
    if folder is None:
        store, path = _remote(uri)
        store.create_dir(path, recursive=True)
        data = io.BytesIO()
        np.save(data, array)
        with store.open_output_stream(f"{path}/{name}") as out:      # an object appears when it is closed
            out.write(data.getbuffer())
        return
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, array)
    os.replace(part, f"{folder}/{name}")


class Store:
    """Read side; files are mapped when first looked into. A shard that was never written is empty."""

    def __init__(self, uri: str, bits: int):
        self.uri, self.bits, self.maps = uri, bits, {}

    def field(self, shard: int, field: str) -> np.ndarray:
        if (shard, field) not in self.maps:
            self.maps[shard, field] = self._map(f"{field}-{shard:06d}.npy")
        return self.maps[shard, field]

    def _map(self, name: str) -> np.ndarray:
        folder = _local(self.uri)
        if folder is not None:
            path = f"{folder}/{name}"
            return np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, np.uint64)
        from pyarrow import fs
        store, path = _remote(self.uri)
        if store.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
            return np.zeros(0, np.uint64)
        with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{path}/{name}") as data:
            while chunk := data.read(8 << 20):
                copy.write(chunk)
            copy.seek(0)
            version = np.lib.format.read_magic(copy)
            shape, _, kind = np.lib.format.read_array_header_1_0(copy) if version == (1, 0) else np.lib.format.read_array_header_2_0(copy)
            return np.memmap(copy, kind, "r", copy.tell(), shape) if shape[0] else np.zeros(0, kind)

    def find(self, keys: np.ndarray, shard: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(shard, position) of ``keys``, which ascend (within ``shard``, if given); position -1 where a key is not stored."""
        shard = shard_of(keys, self.bits) if shard is None else shard
        at = np.full(len(keys), -1, np.int64)
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if i < j and len(have := self.field(int(shard[i]), "keys")):
                p = np.minimum(np.searchsorted(have, keys[i:j]), len(have) - 1)
                at[i:j] = np.where(have[p] == keys[i:j], p, -1)
        return shard, at

    def get(self, shard: np.ndarray, at: np.ndarray, field: str, kind=np.uint64) -> np.ndarray:
        """The field at what ``find`` returned; 0 where a key is not stored."""
        out, cuts = np.zeros(len(at), kind), np.flatnonzero(np.diff(shard)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            rows = np.flatnonzero(at[i:j] >= 0) + i
            if len(rows):
                out[rows] = self.field(int(shard[i]), field)[at[rows]]
        return out


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def bits_for(n_keys: float, per_shard: int) -> int:
    """Leading bits that leave about ``per_shard`` keys to a shard."""
    return max(0, int(np.ceil(np.log2(max(n_keys, 1) / per_shard))))


def opened(uri: str, bits: int) -> Store:
    """This worker's store; the mappings of the last few stores are kept between tasks."""
    kept = worker_cache().setdefault("stores", {})
    if (uri, bits) not in kept:
        while len(kept) > 3:
            kept.pop(next(iter(kept)))
        kept[uri, bits] = Store(uri, bits)
    return kept[uri, bits]
