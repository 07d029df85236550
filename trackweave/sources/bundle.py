"""Mask bundles as files: `spark.read.format("mask_bundle")` and `write_bundle`.

A bundle is a folder of gzip files, each with the frames of one stretch of a clip:
clip_id=<clip>/<first frame>-<last frame>.bin.  The layout inside is that of `masks.pack_frame`.  Every file is a partition
when read; when written, a task streams its rows frame by frame into files of its own, and they take their names only once
all tasks are done, so a broken run leaves no half bundle.  Frames with ids or numbers of objects beyond 16 bits are refused, or,
with the option `wide`, go to files of their own (<first frame>-<last frame>.wide.bin) with 32 bits for both.
"""

from __future__ import annotations

import gzip
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators.masks import MAX_RUN, NARROW, WIDE, needs_wide, pack_frame

SCHEMA = "clip_id int, f int, tid int, counts array<int>"
_NAME = re.compile(r"clip_id=(-?\d+)/(\d+)-(\d+)(\.wide)?\.bin$")
_TEMPORARY = "_temporary"
#: Rows that a reader hands over at a time.
BATCH = 4096


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _File(InputPartition):
    clip: int
    path: str
    wide: bool


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        filesystem, root = _filesystem(self.path)
        found = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
        named = [(m, x.path) for x in found if x.type == fs.FileType.File and f"/{_TEMPORARY}/" not in x.path and (m := _NAME.search(x.path))]
        return [_File(int(m[1]), path, bool(m[4])) for m, path in sorted(named, key=lambda x: x[1])]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty bundle
            return
        filesystem, _ = _filesystem(self.path)
        head_, each = WIDE if partition.wide else NARROW
        size, n_head = struct.calcsize(each), struct.calcsize(head_)
        with filesystem.open_input_stream(partition.path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as file:
            rows: list[tuple[int, int, list[int]]] = []
            while head := file.read(n_head):
                f, n = struct.unpack(head_, head)
                for _ in range(n):
                    tid, count = struct.unpack(each, file.read(size))
                    rows.append((f, tid, _joined(struct.unpack(f"<{count}H", file.read(2 * count)))))
                if len(rows) >= BATCH:
                    yield _batch(partition.clip, rows)
                    rows = []
            yield _batch(partition.clip, rows)


def _joined(stored: tuple[int, ...]) -> list[int]:
    """Runs, those that were stored in pieces put together."""
    out, held = [], 0
    for v in stored:
        held += v
        if v != MAX_RUN:
            out.append(held)
            held = 0
    return out


def _batch(clip: int, rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([clip] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["clip_id", "f", "tid", "counts"])


class _Writer(DataSourceWriter):
    def __init__(self, path: str, frames: int, overwrite: bool, wide: bool):
        self.path, self.frames, self.overwrite, self.wide = path, frames, overwrite, wide
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        filesystem, root = _filesystem(self.path)
        folder = f"{root}/{_TEMPORARY}/{self.run}"
        filesystem.create_dir(folder, recursive=True)
        files: list[tuple[str, str]] = []
        open_, now, raw, first, last = None, None, None, 0, 0

        def close() -> None:
            if open_ is not None:
                open_.close()
                raw.close()
                files.append((temporary, f"clip_id={now[0]}/{first:08d}-{last:08d}{'.wide' if now[2] else ''}.bin"))

        for (clip, f), objects in _by_frame(iterator):
            if (wide := needs_wide(objects)) and not self.wide:
                raise ValueError(f"ids and numbers of objects of a bundle have 16 bits, not {max(len(objects), *(t for t, _ in objects))}")
            if now != (clip, f // self.frames, wide):
                close()
                now, first, temporary = (clip, f // self.frames, wide), f, f"{folder}/{uuid.uuid4().hex}"
                raw = filesystem.open_output_stream(temporary, compression=None)
                open_ = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0)
            last = f
            open_.write(pack_frame(f, objects, wide))
        close()
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, root = _filesystem(self.path)
        if self.overwrite:
            for x in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if x.type == fs.FileType.Directory and x.base_name.startswith("clip_id="):
                    filesystem.delete_dir(x.path)
        for message in messages:
            for temporary, final in message.files if message else ():
                filesystem.create_dir(f"{root}/{final.split('/')[0]}", recursive=True)
                filesystem.move(temporary, f"{root}/{final}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, root = _filesystem(self.path)
        if filesystem.get_file_info(f"{root}/{_TEMPORARY}/{self.run}").type == fs.FileType.Directory:
            filesystem.delete_dir(f"{root}/{_TEMPORARY}/{self.run}")


def _by_frame(rows: Iterator[Row]) -> Iterator[tuple[tuple[int, int], list[tuple[int, list[int]]]]]:
    """((clip, frame), its objects) of sorted rows."""
    key, held = None, []
    for r in rows:
        if r.tid < 0:
            raise ValueError(f"ids of a bundle are not negative, as {r.tid} is")
        if key != (r.clip_id, r.f):
            if held:
                yield key, held
            key, held = (r.clip_id, r.f), []
        held.append((r.tid, list(r.counts)))
    if held:
        yield key, held


class MaskBundle(DataSource):
    """Options: `path`; when written, `frames`, the frames of a file, and `wide`, whether frames beyond 16 bits are written."""

    @classmethod
    def name(cls) -> str:
        return "mask_bundle"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], int(self.options.get("frames", 1500)), overwrite, self.options.get("wide", "false").lower() == "true")


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """clip_id, f, tid, counts of all files of a bundle."""
    spark.dataSource.register(MaskBundle)
    return spark.read.format("mask_bundle").option("path", path).load()


def write_bundle(masks: DataFrame, path: str, fps: float = 25.0, seconds: float = 60.0, mode: str = "overwrite", wide: bool = False) -> None:
    """Writes masks (clip_id, f, tid, counts) in files of `seconds` each; objects of a frame in order of id.  `wide`: frames with
    ids or numbers of objects beyond 16 bits are written in the wide layout instead of refused."""
    frames = max(1, round(fps * seconds))
    masks.sparkSession.dataSource.register(MaskBundle)
    dealt = masks.select("clip_id", "f", "tid", "counts").repartition("clip_id", F.floor(F.col("f") / frames)).sortWithinPartitions("clip_id", "f", "tid")
    dealt.write.format("mask_bundle").option("path", path).option("frames", frames).option("wide", str(wide).lower()).mode(mode).save()
