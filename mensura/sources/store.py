"""Small steps on the file system that Spark itself uses: any store a path of a read or write may name."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class _Store:
    """The file system of one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(self.conf)

    def is_local(self) -> bool:
        return self.fs.getUri().getScheme() == "file"


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder.  Hidden ones are left out."""
    store = _Store(spark, folder)
    if not store.fs.exists(store.path):
        return []
    found = [status.getPath().getName() for status in store.fs.listStatus(store.path)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    store = _Store(spark, path)
    stream = store.fs.open(store.path)
    try:
        return store.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file that nobody else has created; False when it is already there.

    The content is written aside and then takes its name in one step that fails if
    the name is taken: a rename without overwriting, on a local disk a hard link.
    So a reader sees no file or a whole one, and of two writers exactly one wins.
    The store must rename atomically (HDFS and stores with its semantics).
    """
    store = _Store(spark, path)
    parent = store.path.getParent()
    draft = store.jvm.org.apache.hadoop.fs.Path(parent, f"_draft-{uuid.uuid4().hex}")
    store.fs.mkdirs(parent)
    stream = store.fs.create(draft, False)
    try:
        stream.write(bytearray(content.encode()))
        stream.close()
        if store.is_local():
            whole = lambda p: store.jvm.java.io.File(p.toUri().getPath()).toPath()
            store.jvm.java.nio.file.Files.createLink(whole(store.path), whole(draft))
        else:
            context = store.jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.fs.getUri(), store.conf)
            options = spark.sparkContext._gateway.new_array(store.jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = store.jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(draft, store.path, options)
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
            return False
        raise
    finally:
        store.fs.delete(draft, False)
    return True


def put(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file, in place of an older one."""
    store = _Store(spark, path)
    stream = store.fs.create(store.path, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, unpacked where its name says so; nothing behind it is read."""
    store = _Store(spark, path)
    codec = store.jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(store.conf).getCodec(store.path)
    stream = store.fs.open(store.path)
    try:
        unpacked = codec.createInputStream(stream) if codec else stream
        return store.jvm.java.io.BufferedReader(store.jvm.java.io.InputStreamReader(unpacked, "UTF-8")).readLine()
    finally:
        stream.close()
