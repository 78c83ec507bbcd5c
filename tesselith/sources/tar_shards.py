"""A Spark data source that writes patches to TAR shards, and lists the members of shards.

Tasks write hidden files of their own; only commit() gives them their names, so that a task that runs twice, or is lost,
leaves no shard behind. Rows of one shard must be in one partition, in order. A shard may have folders before its name. Paths
are on a file system that all executors share.

    rows.write.format("tar_shards").option("path", folder).mode("append").save()   # shard, name, data
"""

from __future__ import annotations

import io
import os
import tarfile
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    files: list


class TarWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, mode: int = 0o644):
        self.path, self.overwrite, self.mode = path, overwrite, mode

    def write(self, rows):
        os.makedirs(self.path, exist_ok=True)
        done, now, tar = [], None, None
        for r in rows:
            if r.shard != now:
                if tar:
                    tar.close()
                now, hidden = r.shard, os.path.join(self.path, f".{uuid.uuid4().hex}.part")
                done.append((hidden, os.path.join(self.path, r.shard)))
                tar = tarfile.open(hidden, "w")
            info = tarfile.TarInfo(r.name)
            info.size, info.mtime, info.mode = len(r.data), 0, self.mode
            tar.addfile(info, io.BytesIO(bytes(r.data)))
        if tar:
            tar.close()
        return Written(done)

    def commit(self, messages):
        made = [f for m in messages if m for f in m.files]
        names = [to for _, to in made]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("rows of one shard were in several partitions")
        taken = [] if self.overwrite else [to for to in names if os.path.exists(to)]
        if taken:  # before any shard gets its name
            self.abort(messages)
            raise FileExistsError(taken[0])
        for folder in {os.path.dirname(to) for to in names}:
            os.makedirs(folder, exist_ok=True)
        for hidden, to in made:
            os.replace(hidden, to)
        if self.overwrite:  # shards of an earlier, larger run do not stay behind
            for folder in {os.path.dirname(to) for to in names}:
                for f in os.listdir(folder):
                    if f.endswith(".tar") and os.path.join(folder, f) not in names:
                        os.unlink(os.path.join(folder, f))

    def abort(self, messages):
        for hidden, _ in (f for m in messages if m for f in m.files):
            if os.path.exists(hidden):
                os.unlink(hidden)


@dataclass
class Shard(InputPartition):
    path: str


class TarReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [Shard(os.path.join(d, f)) for d, _, fs in sorted(os.walk(self.path)) for f in sorted(fs) if f.endswith(".tar")]

    def read(self, partition):
        if partition is None:
            return
        with tarfile.open(partition.path) as tar:
            for m in tar:
                yield os.path.relpath(partition.path, self.path), m.name, tar.extractfile(m).read()


class TarShards(DataSource):
    @classmethod
    def name(cls):
        return "tar_shards"

    def schema(self):
        return "shard string, name string, data binary"

    def reader(self, schema):
        return TarReader(self.options["path"])

    def writer(self, schema, overwrite):
        return TarWriter(self.options["path"], overwrite, int(self.options.get("mode", "644"), 8))
