"""Reading parts of files in whatever store Spark reads: SRC-2 and SRC-5 rest on it.

Tasks open files with pyarrow's file systems, set up from the same Hadoop settings as Spark's readers (keys, endpoints and
regions of object stores, also per bucket). A store for which that fails, as pyarrow has no file system for its scheme, no
library for it or no credentials, is read through Hadoop's own file system from the driver, side by side and by ranges of
bytes. Which of the two it is, is found out once per store, not per file.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyarrow import fs
from pyspark.sql import SparkSession

LOCAL = "^file:/+"
DRIVER_THREADS = 16
TAIL_BYTES = 1 << 16  # what is read of a file's end at first; longer footers take a second read

# Where each scheme's Hadoop settings are found.
PREFIXES = {"s3a": "fs.s3a.", "s3n": "fs.s3a.", "s3": "fs.s3a.", "gs": "fs.gs.", "abfs": "fs.azure.", "abfss": "fs.azure."}


@dataclass(frozen=True)
class Store:
    """How tasks reach the files of some locations; small, and shipped with what uses it."""

    settings: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(spark: SparkSession, *locations: str) -> Store:
        """With the settings of the locations' schemes."""
        wanted = {PREFIXES.get(urlsplit(qualified(spark, x)).scheme) for x in locations} - {None}
        found: dict[str, str] = {}
        for prefix in sorted(wanted):
            found |= {prefix + k: v for k, v in dict(spark._jsc.hadoopConfiguration().getPropsWithPrefix(prefix)).items()}
        return Store(found)

    def opened(self, url: str) -> tuple[fs.FileSystem, str]:
        """The file system of a URL, as Spark spells it, and the path in it."""
        local = re.match(LOCAL, url)
        if local:
            return fs.LocalFileSystem(), "/" + unquote(url[local.end() :])
        parts = urlsplit(url)
        place = unquote(parts.path)
        if PREFIXES.get(parts.scheme) == "fs.s3a.":
            return self._s3(parts.netloc), parts.netloc + place
        if parts.scheme == "gs":
            return fs.GcsFileSystem(project_id=self.settings.get("fs.gs.project.id")), parts.netloc + place
        if PREFIXES.get(parts.scheme) == "fs.azure.":
            container, _, host = parts.netloc.partition("@")
            key = self.settings.get(f"fs.azure.account.key.{host}")
            return fs.AzureFileSystem(account_name=host.split(".")[0], account_key=key), container + place
        return fs.FileSystem.from_uri(url)

    def _s3(self, bucket: str) -> fs.FileSystem:
        def told(name: str) -> str | None:
            return self.settings.get(f"fs.s3a.bucket.{bucket}.{name}") or self.settings.get(f"fs.s3a.{name}") or None

        options = {"access_key": told("access.key"), "secret_key": told("secret.key"), "session_token": told("session.token")}
        if not options["access_key"]:  # whatever else the machine has, as a role
            options = {}
        endpoint = told("endpoint")
        scheme = "http" if told("connection.ssl.enabled") == "false" or (endpoint or "").startswith("http://") else "https"
        own_host = endpoint and not endpoint.endswith("amazonaws.com")
        return fs.S3FileSystem(
            **options,
            region=told("endpoint.region") or "us-east-1",
            scheme=scheme,
            endpoint_override=re.sub("^https?://", "", endpoint) if own_host else None,
        )

    def reaches(self, url: str) -> bool:
        """Whether pyarrow can look at a location that exists."""
        try:
            system, place = self.opened(url)
            return system.get_file_info(place).type != fs.FileType.NotFound
        except Exception:  # no such scheme, no library, no credentials: each means the other way
            return False


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the path, with scheme and host."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(target)


def qualified(spark: SparkSession, path: str) -> str:
    return hadoop_path(spark, path)[1].toUri().toString()


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist."""

    def there(path: str) -> bool:
        system, target = hadoop_path(spark, path)
        return system.exists(target)

    with ThreadPoolExecutor(DRIVER_THREADS) as pool:
        return [p for p, found in zip(paths, pool.map(there, paths)) if found]


def split_by_reach(spark: SparkSession, paths: list[str], store: Store) -> tuple[list[str], list[str]]:
    """Paths that tasks can open, and those that only Hadoop can; found out with one path per store."""
    known: dict[tuple[str, str], bool] = {}
    near, far = [], []
    for path in paths:
        url = qualified(spark, path)
        parts = urlsplit(url)
        if parts[:2] not in known:
            known[parts[:2]] = store.reaches(url)
        (near if known[parts[:2]] else far).append(path)
    return near, far


Tail = Callable[[int], bytes]  # the last so many bytes of a file, or all if it has fewer


def tail_by_task(store: Store, url: str) -> Tail:
    """Reads with pyarrow; what goes wrong is raised, so that Spark tries the task again."""
    system, place = store.opened(url)

    def read(n: int) -> bytes:
        with system.open_input_file(place) as source:
            size = source.size()
            return source.read_at(min(n, size), size - min(n, size))

    return read


def tail_by_hadoop(spark: SparkSession, path: str) -> Tail:
    """Reads with Hadoop's file system, from the driver."""
    system, target = hadoop_path(spark, path)

    def read(n: int) -> bytes:
        size = system.getFileStatus(target).getLen()
        stream = system.open(target)
        try:
            stream.seek(size - min(n, size))
            return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(n, size)))
        finally:
            stream.close()

    return read
