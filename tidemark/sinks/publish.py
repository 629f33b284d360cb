"""Publication of written folders: all or nothing, and repeatable after a failure.

Data is written to a folder of its own below the destination. Only when that is
complete, a small numbered file beside it names the folders that count. Readers
go by the newest such file, so a write that fails, or is still running, is never
seen, and what was there before stays whole. It needs no rename, so it holds on
object stores as well.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.session import remove_folder

POINTERS = "_published"
DATA = "gen-"
# Pointers of earlier generations that stay for readers which have just listed them.
KEPT_POINTERS = 2


def publish(
    spark: SparkSession, dest: str, write: Callable[[str], None], name: str = "", once: bool = False, alone: bool = False
) -> str:
    """Let ``write`` fill a new folder, then make it the one that ``name`` stands for in ``dest``.

    ``once`` refuses a name that is published already. ``alone`` removes all
    else in ``dest`` afterwards; otherwise only the folder that was replaced
    goes. Two writers at once get numbers of their own, and the later one keeps
    what the earlier one has published.
    """
    dest = dest.rstrip("/")
    _refuse(once and name in published(spark, dest), dest, name)
    folder = f"{DATA}{uuid.uuid4().hex}"
    try:
        write(f"{dest}/{folder}")
    except BaseException:
        remove_folder(spark, f"{dest}/{folder}")
        raise
    while True:
        number, names = _newest(spark, dest)
        if once and name in names:
            remove_folder(spark, f"{dest}/{folder}")
            _refuse(True, dest, name)
        if _create(spark, dest, max([number, *_numbers(spark, dest)]) + 1, names | {name: folder}):
            break
    _clean(spark, dest, [folder] if alone else None, names.get(name))
    return f"{dest}/{folder}"


def published(spark: SparkSession, dest: str) -> dict[str, str]:
    """The folder that each name in ``dest`` stands for; none if nothing is published there."""
    dest = dest.rstrip("/")
    return {name: f"{dest}/{folder}" for name, folder in _newest(spark, dest)[1].items()}


def current(spark: SparkSession, dest: str) -> str:
    """The folder that ``dest`` stands for."""
    found = published(spark, dest).get("")
    if found is None:
        raise FileNotFoundError(f"nothing is published in {dest}")
    return found


def _refuse(refused: bool, dest: str, name: str) -> None:
    if refused:
        raise FileExistsError(f"{dest} has {name or 'its version'} already")


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _children(spark: SparkSession, folder: str) -> list[str]:
    files, path = _path(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def _numbers(spark: SparkSession, dest: str) -> list[int]:
    names = [n.removesuffix(".json") for n in _children(spark, f"{dest}/{POINTERS}")]
    return sorted(int(n) for n in names if n.isdigit())


def _pointer(dest: str, number: int) -> str:
    return f"{dest}/{POINTERS}/{number:020d}.json"


def _newest(spark: SparkSession, dest: str) -> tuple[int, dict[str, str]]:
    """Number and content of the newest pointer that is whole."""
    for number in reversed(_numbers(spark, dest)):
        files, path = _path(spark, _pointer(dest, number))
        try:
            source = files.open(path)
            text = bytes(source.readAllBytes()).decode()
            source.close()
            return number, json.loads(text)["folders"]
        except (Py4JJavaError, ValueError):  # just removed, or its writer was lost
            continue
    return 0, {}


def _create(spark: SparkSession, dest: str, number: int, names: dict[str, str]) -> bool:
    """Write a pointer unless its number is taken."""
    files, path = _path(spark, _pointer(dest, number))
    try:
        out = files.create(path, False)
    except Py4JJavaError as error:
        if files.exists(path):
            return False
        raise error
    out.write(bytearray(json.dumps({"folders": names}).encode()))
    out.close()
    return True


def _clean(spark: SparkSession, dest: str, only: list[str] | None, replaced: str | None) -> None:
    for number in _numbers(spark, dest)[:-KEPT_POINTERS]:
        remove_folder(spark, _pointer(dest, number))
    if only is not None:
        for name in _children(spark, dest):
            if name not in [*only, POINTERS]:
                remove_folder(spark, f"{dest}/{name}")
    elif replaced is not None:
        remove_folder(spark, f"{dest}/{replaced}")
