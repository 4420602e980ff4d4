"""Small file operations by way of Hadoop's file systems, so that every path Spark reads works."""

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on a mounted file system (`file:`); None if it is elsewhere."""
    system, file = _located(spark, path)
    uri = system.makeQualified(file).toUri()
    return str(uri.getPath()) if uri.getScheme() == "file" else None


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None if it is absent."""
    system, file = _located(spark, path)
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, file = _located(spark, path)
    stream = system.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Paths of the folders directly below `path` whose names begin with `prefix`."""
    system, folder = _located(spark, path)
    if not system.exists(folder):
        return []
    return [str(x.getPath().toString()) for x in system.listStatus(folder) if x.isDirectory() and x.getPath().getName().startswith(prefix)]


def files_below(spark: SparkSession, path: str, suffix: str) -> Iterator[str]:
    """Paths, relative to `path`, of the files below it whose names end with `suffix`."""
    system, folder = _located(spark, path)
    if not system.exists(folder):
        return
    root = system.makeQualified(folder).toString()
    found = system.listFiles(folder, True)
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(suffix):
            yield name[len(root) + 1 :]


def size_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below `path`."""
    system, folder = _located(spark, path)
    return system.getContentSummary(folder).getLength() if system.exists(folder) else 0


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file into a folder that need not exist yet."""
    system, file = _located(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(goal.getParent())
    if not system.rename(file, goal):
        raise OSError(f"Cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, if it is there."""
    system, file = _located(spark, path)
    system.delete(file, True)
