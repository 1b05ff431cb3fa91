"""Pointer files: small, never changed, and put in place by one rename after all that they point to.

A reader takes the newest pointer, or an older one by its number, and reads what it names; so it sees a
publication as a whole or not at all. Works on every file system that Spark reads.
"""

import json


class Pointers:
    """Numbered pointer files below one folder."""

    def __init__(self, spark, folder):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils.toString
        self.folder = folder.rstrip("/")
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _named(self, number):
        return self._path(f"{self.folder}/{number:018d}.json")

    def numbers(self):
        """The numbers of all pointers, ascending."""
        return sorted(int(name[:-5]) for name in self.children(self.folder) if name.endswith(".json") and name[0] != "_")

    def children(self, folder):
        """Names of what lies in a folder; none where there is no folder."""
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(path)]

    def read(self, number):
        stream = self._files.open(self._named(number))
        try:
            return json.loads(self._text(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self):
        """(number, content) of the newest pointer, or None."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def publish(self, number, content):
        """Write a pointer aside, then rename it to its number, which must be new."""
        aside = self._path(f"{self.folder}/_{number:018d}.tmp")
        stream = self._files.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if self._files.exists(self._named(number)) or not self._files.rename(aside, self._named(number)):
            raise ValueError(f"pointer {number} was published by another load")

    def delete(self, number):
        self._files.delete(self._named(number), False)

    def delete_folder(self, folder):
        self._files.delete(self._path(folder), True)
