"""The MD5 of the bytes of files, as `md5sum` prints it."""

import hashlib
import string
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs

CHUNK_BYTES = 4 << 20
_DIGESTS = pa.schema([("file_path", pa.string()), ("length", pa.int64()), ("md5_sum", pa.string())])


def _digester(chunk_bytes):
    def one(path):
        # pyarrow knows the store of s3a by its plain name, and takes URIs of ASCII characters.
        uri = quote(path.replace("s3a://", "s3://", 1), safe=string.punctuation)
        files, name = fs.FileSystem.from_uri(uri)
        digest, length = hashlib.md5(usedforsecurity=False), 0
        with files.open_input_stream(name, buffer_size=0) as stream:
            while chunk := stream.read(chunk_bytes):
                digest.update(chunk)
                length += len(chunk)
        return length, digest.hexdigest()

    def digests(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                length, md5_sum = one(path)
                yield pa.record_batch([[path], [length], [md5_sum]], schema=_DIGESTS)

    return digests


def content_md5(files, tasks=None, chunk_bytes=CHUNK_BYTES):
    """file_path, length and md5_sum of each listed file.

    `files` has file_path, URL-encoded as `list_files` gives it. MD5 runs from the first byte to the last,
    so a file is one task's work; files are dealt to tasks, and a task holds `chunk_bytes` of a file at
    a time, whatever its size. The built-in md5 over a binary file would hold the file whole, and no
    file over 2 GB. A file that is gone fails the job; an empty one has the MD5 of nothing.
    """
    spark = files.sparkSession
    paths = files.select("file_path").distinct()
    dealt = paths.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "file_path")
    return dealt.mapInArrow(_digester(chunk_bytes), "file_path string, length long, md5_sum string")
