"""Swaps of stored files that happen whole or not at all.

New content is written beside the old one first. Then a journal file names every folder that goes and every folder that takes a
place; from that moment on the swap is decided. A swap that was cut short is finished by whoever opens the table next, and
staged folders that no journal names are thrown away. One writer per table is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

#: Called with the name of each step that has been done; tests put a failure here.
watch: Callable[[str], None] = lambda step: None


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a file or folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), root


def _beside(path: str, kind: str) -> str:
    """A hidden name in the folder of ``path``: Spark does not read files that begin with an underscore."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{kind}"


def _read(spark: SparkSession, path: str) -> dict | None:
    fs, file = file_system(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, content: dict) -> None:
    """The whole file appears at once: it is written under another name and renamed."""
    fs, file = file_system(spark, path)
    _, draft = file_system(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    fs.delete(file, False)
    if not fs.rename(draft, file):
        raise OSError(f"cannot write {path}")


def staging(path: str) -> str:
    """A new folder for content that is to take the place of (parts of) the table at ``path``."""
    return _beside(path, f"staged-{uuid.uuid4().hex[:12]}")


def swap(spark: SparkSession, path: str, moves: Mapping[str, str], drops: Sequence[str] = (), notes: Mapping | None = None) -> None:
    """Put the folders ``moves`` (staged: place) in their places and remove ``drops``; ``notes`` are kept with the table."""
    watch("staged")
    _write(spark, _beside(path, "swap"), {"moves": sorted(moves.items()), "drops": list(drops), "notes": dict(notes or {})})
    watch("journaled")
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a swap that was decided; remove what an undecided one has left. True if a swap was finished here."""
    journal = _beside(path, "swap")
    entry = _read(spark, journal)
    fs, file = file_system(spark, journal)
    if entry is not None:
        for place in entry["drops"]:
            fs.delete(file_system(spark, place)[1], True)
            watch("dropped")
        for staged, place in entry["moves"]:
            source, target = file_system(spark, staged)[1], file_system(spark, place)[1]
            if not fs.exists(source):  # moved before
                continue
            fs.delete(target, True)
            watch("cleared")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"cannot move {staged}")
            watch("moved")
        if entry["notes"]:
            _write(spark, _beside(path, "notes"), {**notes(spark, path), **entry["notes"]})
            watch("noted")
        fs.delete(file, False)
    parent, prefix = file.getParent(), _beside(path, "staged-").rsplit("/", 1)[1]
    if fs.exists(parent):
        for status in fs.listStatus(parent):
            if status.getPath().getName().startswith(prefix):
                fs.delete(status.getPath(), True)
    return entry is not None


def notes(spark: SparkSession, path: str) -> dict:
    """What finished swaps have noted with the table at ``path``."""
    return _read(spark, _beside(path, "notes")) or {}
