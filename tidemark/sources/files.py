"""Files through Hadoop's file system API, so that any store that Spark knows will do."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def replace(df: DataFrame, path: str) -> None:
    """Write beside `path`, then take its place; the old table stays readable until the new one is whole."""
    spark = df.sparkSession
    fs, p, Path = _fs(spark, path)
    new, old = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    if fs.exists(p):
        fs.rename(p, Path(old))
    fs.rename(Path(new), p)
    fs.delete(Path(old), True)


def make(spark: SparkSession, path: str) -> None:
    """A folder, with those above it."""
    fs, p, _ = _fs(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"can't make {path}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    fs, p, _ = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def writable(spark: SparkSession, path: str) -> bool:
    """Whether a file can be made in a folder."""
    probe = f"{path.rstrip('/')}/.probe-{uuid.uuid4().hex}"
    try:
        write_text(spark, probe, "")
        delete(spark, probe)
    except Exception:  # whatever the store raises
        return False
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, put in place by a rename."""
    write_bytes(spark, path, text.encode())


def write_bytes(spark: SparkSession, path: str, raw: bytes) -> None:
    """A file that fits the driver, put in place by a rename."""
    fs, p, Path = _fs(spark, path)
    tmp = Path(f"{path}.tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(raw))
    out.close()
    fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"can't put {path} in place")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file; a missing one raises FileNotFoundError."""
    return read_bytes(spark, path).decode()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A file that fits the driver; a missing one raises FileNotFoundError."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
