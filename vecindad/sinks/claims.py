"""Claims on import files: two imports at the same time do not store one file twice.

A file is claimed by creating the next numbered entry in its folder, which only one writer
can do; the entry with the highest number holds the file.  An import claims its files,
then looks them up in the registry, and releases them after its registry rows are written;
so whoever claims a file later finds it registered.  A claim may be taken over by the batch
that made it (a run that was cut short is repeated) and, when it is older than ``STALE``
seconds, by any other.

Creating a file that must not exist has to be atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import SparkSession

from vecindad.sinks.batches import children
from vecindad.sinks.versions import file_system

#: Seconds after which a claim counts as left behind.
STALE = 6 * 3600.0


class FileClaimed(RuntimeError):
    """Another import holds the file."""


class Claim(NamedTuple):
    """What one run holds: its entry for each file."""

    batch: str
    run: str
    entries: dict[str, int]


def _folder(root: str, name: str) -> str:
    return f"{root}/_reservas/{hashlib.sha256(name.encode()).hexdigest()}"


def _entries(spark: SparkSession, root: str, name: str) -> list[int]:
    return sorted(int(n) for n in children(spark, _folder(root, name)) if n.isdigit())


def _read(spark: SparkSession, root: str, name: str, number: int) -> dict:
    files, file = file_system(spark, f"{_folder(root, name)}/{number:08d}")
    age = time.time() - files.getFileStatus(file).getModificationTime() / 1000
    stream = files.open(file)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    # An entry that is not written yet belongs to nobody known.
    return {"edad": age, **(json.loads(text) if text.endswith("}") else {})}


def _create(spark: SparkSession, root: str, name: str, number: int, batch: str, run: str) -> bool:
    files, file = file_system(spark, f"{_folder(root, name)}/{number:08d}")
    try:
        stream = files.create(file, False)
    except Exception:
        if files.exists(file):
            return False
        raise
    stream.write(bytearray(json.dumps({"lote": batch, "corrida": run, "archivo": name}).encode()))
    stream.close()
    return True


def claim(spark: SparkSession, root: str, names: Iterable[str], batch: str, stale: float = STALE) -> Claim:
    """Claims all files, in one order for every import; gives back what it has when one is held by another."""
    run = uuid.uuid4().hex
    held = Claim(batch, run, {})
    for name in sorted(names):
        numbers = _entries(spark, root, name)
        if numbers:
            last = _read(spark, root, name, numbers[-1])
            if last.get("lote") != batch and last["edad"] < stale:
                release_claim(spark, root, held)
                raise FileClaimed(f"{name}: held by batch {last.get('lote')}")
        number = (numbers[-1] if numbers else 0) + 1
        if not _create(spark, root, name, number, batch, run):
            release_claim(spark, root, held)
            raise FileClaimed(f"{name}: claimed by another import at this moment")
        held.entries[name] = number
    return held


def check_claim(spark: SparkSession, root: str, held: Claim) -> None:
    """Fails if another run has taken a file over."""
    for name, number in held.entries.items():
        if _entries(spark, root, name)[-1:] != [number]:
            raise FileClaimed(f"{name}: taken over by another import")


def release_claim(spark: SparkSession, root: str, held: Claim) -> None:
    """Removes the claims of a run, with the older ones it took over; a later holder keeps its own."""
    for name, number in held.entries.items():
        for n in _entries(spark, root, name):
            if n <= number:
                files, file = file_system(spark, f"{_folder(root, name)}/{n:08d}")
                files.delete(file, False)
