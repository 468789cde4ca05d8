"""Files through Hadoop's FileSystem, so one code serves local disks, HDFS and object stores."""

from __future__ import annotations

import gc
import json
import tempfile
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._spark, self._jvm = spark, spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def make_folder(self, path: str) -> None:
        p, fs = self._at(path)
        fs.mkdirs(p)

    def names(self, path: str) -> list[str]:
        p, fs = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def size(self, path: str) -> int | None:
        """Bytes of a file; None if there is no such file."""
        p, fs = self._at(path)
        return fs.getFileStatus(p).getLen() if fs.exists(p) and not fs.getFileStatus(p).isDirectory() else None

    def sha256(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()

    def copy(self, source: str, target: str) -> None:
        """Copies a file between any two file systems; readers see the target whole or not at all."""
        s, from_fs = self._at(source)
        aside = f"{target}.{uuid.uuid4().hex}"
        t, to_fs = self._at(aside)
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, s, to_fs, t, False, self._conf)
        self.rename(aside, target)

    def fingerprint(self, path: str) -> int:
        """Hash of the names, sizes and times of what lies directly in a folder, and one level below."""
        p, fs = self._at(path)
        found = []
        for s in fs.listStatus(p):
            inside = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
            found += [(str(x.getPath()), x.getLen(), x.getModificationTime()) for x in inside]
        return hash(tuple(sorted(found)))

    def rename(self, source: str, target: str) -> None:
        """Atomic where the file system's rename is; replaces an existing target file."""
        s, fs = self._at(source)
        t = self._jvm.org.apache.hadoop.fs.Path(target)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(s.toUri() if s.toUri().getScheme() else fs.getUri(), self._conf)
        option = self._spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        option[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(s, t, option)

    def write_json(self, path: str, value: object) -> None:
        """Writes beside the target and renames, so readers see the old or the new content."""
        aside = f"{path}.{uuid.uuid4().hex}"
        p, fs = self._at(aside)
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            out.close()
        self.rename(aside, path)

    def read_json(self, path: str) -> object:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a local one only where that is unset.

    An unset folder is accepted in local mode only, where every task runs on this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Scratch paths of this process, for clear_scratch, and how often they were cleared.
_MADE: list[str] = []
_CLEARED: list[int] = [0]


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the written intermediate tables of this process once their results are stored elsewhere."""
    files, n = Files(spark), len(_MADE)
    while _MADE:
        files.delete(_MADE.pop())
    _CLEARED[0] += 1
    return n


def times_cleared() -> int:
    """Changes when written tables of this process are gone."""
    return _CLEARED[0]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing exists there yet."""
    path = f"{shared_dir(spark)}/tidewater/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs that are over: it does so once the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def written(df, name: str):
    """The frame written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
