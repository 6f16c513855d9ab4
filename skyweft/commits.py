"""Files that appear once: whole, at one moment, and only if there is none of that name."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Whether this call has made the file. On a local file system by a hard link, elsewhere by a rename that refuses to replace (as HDFS does it); of any
    number of callers one gets True."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    if fs.getScheme() == "file":
        local = lambda p: jvm.java.nio.file.Path.of(fs.makeQualified(p).toUri())
        jvm.java.nio.file.Files.writeString(local(draft), content, spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
        try:
            jvm.java.nio.file.Files.createLink(local(target), local(draft))
            return True
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            jvm.java.nio.file.Files.deleteIfExists(local(draft))
    out = fs.create(draft, True)
    out.write(bytearray(content.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, target, none)
        return True
    except Exception as e:
        fs.delete(draft, False)
        if "AlreadyExists" in str(e):
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
