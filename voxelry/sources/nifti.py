"""NIfTI-1 volumes as a Spark data source: ``spark.read.format("nifti")`` over a directory tree or a manifest.

Options: ``path`` (a tree) or ``manifest`` (a Parquet or JSON-lines file of subject_id, acq, path); ``layout`` and ``acquisitions`` (JSON object, name here to name in
the paths) of a tree, as for ``layout.scan_dataset``; ``frame`` for files of several frames; ``slabBytes`` and ``partitionBytes``; ``headers`` = true for one row a scan instead of its voxels.

Partitions of a tree are planned from its listing: small files share one, a large uncompressed volume is cut into slabs of planes that are read by their offset.
Partitions of a manifest are ranges of its rows; neither their paths nor any file come to the driver. Executors open the files themselves, plane by plane, so
neither a file nor a volume is ever held whole. Filters on subject_id and acq prune files before any is opened. Stores are those that Arrow
opens by URI (local, HDFS, S3, GCS); for a store that only Spark reads there is ``layout.scan_dataset(content=True)``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from .layout import LAYOUTS
from .volumes import _exactly, open_volume, parse_header, read_planes, where

VOXELS = "subject_id string, acq string, i int, j int, k int, v double"
HEADERS = "subject_id string, acq string, path string, ni int, nj int, nk int, vx double, vy double, vz double, affine array<double>"
#: Bytes of an uncompressed volume from which on it is cut into slabs, and of files that share a partition.
SLAB_BYTES, PARTITION_BYTES = 64 << 20, 128 << 20
#: Rows of a manifest that are one partition.
MANIFEST_ROWS = 64
#: Voxels of a batch that is given to Spark.
BATCH = 1 << 16


def voxel_batches(subject: str, acq: str, planes: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Non-zero voxels as Arrow batches of bounded size."""
    names = ["subject_id", "acq", "i", "j", "k", "v"]
    for k, plane in planes:
        for first in range(0, max(1, plane.shape[0]), max(1, BATCH // max(1, plane.shape[1]))):
            part = plane[first:first + max(1, BATCH // max(1, plane.shape[1]))]
            j, i = np.nonzero(part)
            if len(i):
                arrays = [pa.array([subject] * len(i)), pa.array([acq] * len(i)), pa.array(i.astype(np.int32)), pa.array((j + first).astype(np.int32)),
                          pa.array(np.full(len(i), k, np.int32)), pa.array(part[j, i])]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


@dataclass
class Scan:
    subject_id: str
    acq: str
    path: str
    slab: int = 0
    slabs: int = 1


@dataclass
class Files(InputPartition):
    """Scans, or slabs of one, that a task reads; of a manifest only its rows' numbers."""

    scans: list[Scan] = field(default_factory=list)
    manifest: str | None = None
    first: int = 0
    last: int = 0


def manifest_rows(path: str) -> int:
    store, name = where(path)
    if name.endswith(".parquet"):
        with store.open_input_file(name) as f:
            return parquet.ParquetFile(f).metadata.num_rows
    with store.open_input_stream(name) as f:
        return sum(block.count(b"\n") for block in iter(lambda: f.read(1 << 20), b"")) + 1


def manifest_scans(path: str, first: int, last: int) -> Iterator[Scan]:
    """The scans of some rows of a manifest."""
    store, name = where(path)
    if name.endswith(".parquet"):
        with store.open_input_file(name) as f:
            at, source = 0, parquet.ParquetFile(f)
            for group in range(source.num_row_groups):
                rows = source.metadata.row_group(group).num_rows
                if at < last and at + rows > first:
                    table = source.read_row_group(group, ["subject_id", "acq", "path"]).slice(max(0, first - at), min(last, at + rows) - max(first, at))
                    yield from (Scan(**r) for r in table.to_pylist())
                at += rows
        return
    with store.open_input_stream(name) as f:
        rest, at = b"", 0
        for block in iter(lambda: f.read(1 << 20), b""):
            *lines, rest = (rest + block).split(b"\n")
            for line in lines:
                if first <= at < last and line.strip():
                    yield _scan(line)
                at += 1
            if at >= last:
                return
        if first <= at < last and rest.strip():
            yield _scan(rest)


def _scan(line: bytes) -> Scan:
    row = json.loads(line)
    return Scan(row["subject_id"], row["acq"], row["path"])


class NiftiReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = {k.lower(): v for k, v in options.items()}
        if ("path" in self.options) == ("manifest" in self.options):
            raise ValueError("give either a path (a tree) or a manifest")
        self.headers = self.options.get("headers", "false").lower() == "true"
        self.frame = int(self.options["frame"]) if "frame" in self.options else None
        self.asked: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            names = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if names is not None and f.attribute in (("subject_id",), ("acq",)):
                column = f.attribute[0]
                self.asked[column] = self.asked.get(column, names) & names
            else:
                yield f

    def wanted(self, subject: str, acq: str) -> bool:
        return all(value in self.asked.get(column, (value,)) for column, value in (("subject_id", subject), ("acq", acq)))

    def listed(self) -> Iterator[tuple[Scan, int]]:
        """Scans of the tree with their sizes."""
        store, root = where(self.options["path"])
        names = json.loads(self.options.get("acquisitions", "{}"))
        layout = self.options.get("layout", "standard")
        pattern = re.compile(LAYOUTS[layout])
        prefix = self.options["path"][:len(self.options["path"]) - len(root)] if "://" in self.options["path"] else ""
        seen = set()
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda f: f.path):
            found = pattern.search(info.path) if info.type == fs.FileType.File else None
            if found is None:
                continue
            subject, text = found.group(1), found.group(2)
            fits = [n for n, t in names.items() if (text == t if layout == "standard" else text.startswith(t))]
            if not fits or not self.wanted(subject, fits[0]):
                continue
            if (subject, fits[0]) in seen:
                raise ValueError(f"more than one file for {(subject, fits[0])}")
            seen.add((subject, fits[0]))
            yield Scan(subject, fits[0], prefix + info.path), info.size

    def partitions(self) -> list[Files]:
        if "manifest" in self.options:
            rows, step = manifest_rows(self.options["manifest"]), int(self.options.get("manifestrows", MANIFEST_ROWS))
            return [Files(manifest=self.options["manifest"], first=at, last=min(at + step, rows)) for at in range(0, max(rows, 1), step)]
        slab_bytes, most = int(self.options.get("slabbytes", SLAB_BYTES)), int(self.options.get("partitionbytes", PARTITION_BYTES))
        plan, held, size = [], [], 0
        for scan, length in self.listed():
            slabs = 1 if self.headers or scan.path.endswith(".gz") else max(1, -(-length // slab_bytes))
            if slabs > 1:
                plan += [Files([Scan(scan.subject_id, scan.acq, scan.path, n, slabs)]) for n in range(slabs)]
                continue
            if held and size + length > most:
                plan.append(Files(held))
                held, size = [], 0
            held.append(scan)
            size += length
        return plan + [Files(held)] if held or not plan else plan

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        scans = partition.scans if partition.manifest is None else manifest_scans(partition.manifest, partition.first, partition.last)
        for scan in scans:
            if not self.wanted(scan.subject_id, scan.acq):
                continue
            with open_volume(scan.path) as stream:
                if self.headers:
                    yield self.header(scan, parse_header(_exactly(stream, 348)))
                else:
                    yield from voxel_batches(scan.subject_id, scan.acq, read_planes(stream, f"{scan.subject_id} {scan.acq}", self.frame, scan.slab, scan.slabs))

    @staticmethod
    def header(scan: Scan, head: dict) -> pa.RecordBatch:
        ints = [pa.array([n], pa.int32()) for n in head["shape"]]
        sizes = [pa.array([float(v)]) for v in head["voxel"]]
        affine = pa.array([head["affine"].ravel().astype(float).tolist()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array([scan.subject_id]), pa.array([scan.acq]), pa.array([scan.path]), *ints, *sizes, affine],
                                          names=[c.split()[0] for c in HEADERS.split(", ")])


class NiftiVolumes(DataSource):
    """Voxels (or, with ``headers``, one row a scan) of NIfTI files."""

    @classmethod
    def name(cls) -> str:
        return "nifti"

    def schema(self) -> str:
        return HEADERS if self.options.get("headers", "false").lower() == "true" else VOXELS

    def reader(self, schema) -> NiftiReader:
        return NiftiReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format ``nifti`` known to a session."""
    spark.dataSource.register(NiftiVolumes)
