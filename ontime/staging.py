"""Folders that a run stages its tables in, who owns them, and when they go.

Every staged folder lies under the application's own shared folder and belongs to the innermost
``owner`` that is open, or to the session. An owner's folders are removed when it closes, whether its
work succeeded or failed, so what a job holds on disk is what its open steps still read. Nothing that
another run or the caller wrote is ever removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from ontime.session import forget_shared_folder, shared_folder

SESSION = "session"

_owner: ContextVar[str] = ContextVar("ontime_owner", default=SESSION)
# Per application: staged folders with their owners, in the order in which they were staged.
_staged: dict[str, dict[str, str]] = {}


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder or file wherever Spark reads; one that is not there is no error."""
    files, found = _file_system(spark, path)
    files.delete(found, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder in their order; none if there is no such folder."""
    files, found = _file_system(spark, path)
    if not files.exists(found):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(found))


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file; False if it is there already, in which case it stays as it is."""
    files, found = _file_system(spark, path)
    if files.exists(found):
        return False
    try:
        out = files.create(found, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is no such file."""
    files, found = _file_system(spark, path)
    if not files.exists(found):
        return None
    opened = files.open(found)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def staged_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the open owner. The caller writes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _staged.setdefault(spark.sparkContext.applicationId, {})[path] = _owner.get()
    return path


def staged_folders(spark: SparkSession, owner: str | None = None) -> list[str]:
    """Folders staged and not yet removed, of one owner or of all."""
    found = _staged.get(spark.sparkContext.applicationId, {})
    return [path for path, mine in found.items() if owner in (None, mine)]


def _place(path: str) -> str:
    """A path without its scheme, which Spark writes with one or three slashes or not at all."""
    return path.split(":", 1)[-1].lstrip("/")


def release(spark: SparkSession, owner: str, read: Iterable[str] = ()) -> None:
    """Remove an owner's folders, but for those that hold one of the files in ``read``."""
    found = _staged.get(spark.sparkContext.applicationId, {})
    read = [_place(file) for file in read]
    for path in staged_folders(spark, owner):
        if not any(file.startswith(f"{_place(path)}/") for file in read):
            remove(spark, path)
            del found[path]


def release_all(spark: SparkSession) -> None:
    """The end of a run: everything it staged goes, and its shared folder with it."""
    _staged.pop(spark.sparkContext.applicationId, None)
    folder = forget_shared_folder(spark)
    if folder:
        remove(spark, folder)


@contextmanager
def owner(spark: SparkSession, name: str | None = None, keep: bool = False) -> Iterator[str]:
    """Folders staged inside belong to this owner and go at its end, unless ``keep`` leaves that to :func:`release`.

    Owners nest; each removes its own folders only. Frames that still read them must be written, or
    collected, inside.
    """
    name = name or uuid.uuid4().hex
    token = _owner.set(name)
    try:
        yield name
    finally:
        _owner.reset(token)
        if not keep:
            release(spark, name)
