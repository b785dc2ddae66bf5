"""Small JSON documents under rising numbers, of which the newest counts.

Publishing writes a draft and moves it to its number; the file system refuses where that number is taken, so of two writers one
knows that it has to look again. Readers see whole documents only, and earlier ones stay.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass
class Manifests:
    spark: SparkSession
    folder: str

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/{name}")

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The published numbers, oldest first."""
        found = self._files().globStatus(self._path("*.json"))
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in found or [])

    def read(self, number: int) -> dict:
        if number not in self.numbers():
            raise LookupError(f"no document {number} in {self.folder}")
        stream = self._files().open(self._path(f"{number:010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, number: int, content: dict) -> bool:
        """False where the number is taken."""
        jvm, draft = self.spark._jvm, self._path(f".{uuid.uuid4().hex}.draft")
        out = self._files().create(draft, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files().getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, self._path(f"{number:010d}.json"), options)
        except Py4JJavaError as error:
            self._files().delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True
