"""Decoding of NIfTI-1 volumes to voxel rows."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F, types as T

from ..schema import SUBJECT
from ..session import scatter

# Data type codes of the format (fixed values of the NIfTI-1 standard).
DTYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}


def parse_header(raw: bytes) -> dict:
    """Grid, voxel size, affine and storage of a volume from its 348-byte header."""
    order = "<" if struct.unpack("<i", raw[:4])[0] == 348 else ">"
    dim = struct.unpack(f"{order}8h", raw[40:56])
    datatype = struct.unpack(f"{order}h", raw[70:72])[0]
    pixdim = struct.unpack(f"{order}8f", raw[76:108])
    offset, slope, inter = struct.unpack(f"{order}3f", raw[108:120])
    qcode, scode = struct.unpack(f"{order}2h", raw[252:256])
    if scode > 0:
        affine = np.vstack([np.reshape(struct.unpack(f"{order}12f", raw[280:328]), (3, 4)), [0, 0, 0, 1]])
    elif qcode > 0:
        affine = quaternion_affine(struct.unpack(f"{order}6f", raw[256:280]), pixdim)
    else:
        affine = np.diag([*pixdim[1:4], 1.0])
    shape = tuple(max(1, n) for n in dim[1:4])
    frames = int(np.prod([max(1, n) for n in dim[4:1 + max(dim[0], 3)]])) if dim[0] > 3 else 1
    return {"shape": shape, "frames": frames, "voxel": pixdim[1:4], "affine": affine, "dtype": np.dtype(order + DTYPES[datatype]),
            "offset": int(offset), "slope": slope if np.isfinite(slope) and slope != 0 else 1.0, "inter": inter if np.isfinite(inter) else 0.0}


def quaternion_affine(q: tuple, pixdim: tuple) -> np.ndarray:
    b, c, d, x, y, z = q
    a = np.sqrt(max(0.0, 1 - b * b - c * c - d * d))
    rot = np.array([[a * a + b * b - c * c - d * d, 2 * (b * c - a * d), 2 * (b * d + a * c)],
                    [2 * (b * c + a * d), a * a + c * c - b * b - d * d, 2 * (c * d - a * b)],
                    [2 * (b * d - a * c), 2 * (c * d + a * b), a * a + d * d - b * b - c * c]])
    handed = -1.0 if pixdim[0] < 0 else 1.0
    out = np.eye(4)
    out[:3, :3] = rot * np.array([pixdim[1], pixdim[2], pixdim[3] * handed])
    out[:3, 3] = x, y, z
    return out


def where(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def open_volume(path: str) -> pa.NativeFile:
    """The bytes of a volume from its start on, unpacked on the way if they are gzipped."""
    store, name = where(path)
    return _unpacked(store.open_input_file(name))


def _unpacked(raw: pa.NativeFile) -> pa.NativeFile:
    packed = raw.read(2) == b"\x1f\x8b"
    raw.seek(0)
    return pa.CompressedInputStream(raw, "gzip") if packed else raw


def _exactly(stream: pa.NativeFile, count: int) -> bytes:
    got = stream.read(count)
    while len(got) < count:
        more = stream.read(count - len(got))
        if not more:
            raise ValueError("the volume ends before its last plane")
        got += more
    return got


def _skip(stream: pa.NativeFile, count: int) -> None:
    if stream.seekable():
        stream.seek(count, 1)
        return
    while count:
        count -= len(_exactly(stream, min(count, 1 << 20)))


def read_planes(stream: pa.NativeFile, name: str, frame: int | None = None, slab: int = 0, slabs: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(k, plane as (nj, ni)) of a slab of a volume, one plane in memory at a time."""
    head = parse_header(_exactly(stream, 348))
    ni, nj, nk = head["shape"]
    if frame is None and head["frames"] > 1 or frame is not None and frame >= head["frames"]:
        raise ValueError(f"{name} has {head['frames']} frames, asked for {'one file of one' if frame is None else frame}")
    size = ni * nj * head["dtype"].itemsize
    first, last = nk * slab // slabs, nk * (slab + 1) // slabs
    _skip(stream, head["offset"] - 348 + ((frame or 0) * nk + first) * size)
    for k in range(first, last):
        plane = np.frombuffer(_exactly(stream, size), head["dtype"]).reshape(nj, ni)
        yield k, plane.astype(float) * head["slope"] + head["inter"]


def _scans(scans: DataFrame) -> DataFrame:
    """Scan rows to be read where they are: a dataset scanned with ``content=True`` has the bytes of its files, of others the tasks open the paths
    themselves (any store that Arrow opens), a few files each."""
    if "content" in scans.columns:
        return scans.select(SUBJECT, "acq", "path", "content")
    return scatter(scans.select(SUBJECT, "acq", "path"), "path").withColumn("content", F.lit(None).cast("binary"))


def _stream(row) -> pa.NativeFile:
    return open_volume(row.path) if row.content is None else _unpacked(pa.BufferReader(row.content))


def read_headers(scans: DataFrame) -> DataFrame:
    """``images`` columns of each scan: grid, voxel size, affine."""
    schema = ("subject_id string, acq string, path string, ni int, nj int, nk int, vx double, vy double, vz double, affine array<double>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            heads = [parse_header(_exactly(_stream(row), 348)) for row in pdf.itertuples(index=False)]
            out = pdf[[SUBJECT, "acq", "path"]].copy()
            for n, (a, b) in enumerate(zip(("ni", "nj", "nk"), ("vx", "vy", "vz"))):
                out[a] = [h["shape"][n] for h in heads]
                out[b] = [float(h["voxel"][n]) for h in heads]
            out["affine"] = [h["affine"].ravel().astype(float).tolist() for h in heads]
            yield out

    return _scans(scans).mapInPandas(run, schema)


def read_volumes(scans: DataFrame, frame: int | None = None) -> DataFrame:
    """Non-zero voxels of each scan. Files are opened in the tasks and read plane by plane.

    A file with several frames is an error unless ``frame`` names the one to read.
    """
    schema = T.StructType.fromDDL("subject_id string, acq string, i int, j int, k int, v double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                for k, plane in read_planes(_stream(row), f"{row.subject_id} {row.acq}", frame):
                    j, i = np.nonzero(plane)
                    if len(i):
                        yield pd.DataFrame({SUBJECT: row.subject_id, "acq": row.acq, "i": i.astype("int32"),
                                            "j": j.astype("int32"), "k": np.int32(k), "v": plane[j, i]})

    return _scans(scans).mapInPandas(run, schema)


def store_voxels(voxels: DataFrame, path: str) -> None:
    """Write voxel rows so that later stages prune by subject: a few files a subject, whatever the number of tasks."""
    voxels.repartition(SUBJECT, F.floor(F.col("k") / 64)).write.mode("overwrite").partitionBy(SUBJECT).parquet(path)
