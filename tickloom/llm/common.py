"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import posixpath
import sys
import uuid
from collections.abc import Callable
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.session import shared_folder, shuffles_removed
from tickloom.sources.tables import _remove


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task: one thing, so that one operator's tables make room for the next's.

    It lives in a module of its own: the functions of this folder reach each task as new copies.
    """
    home = vars(sys.modules.setdefault("tickloom_worker_tables", ModuleType("tickloom_worker_tables")))
    if home.get("name") != name:
        home.pop("value", None)
        gc.collect()
        pa.default_memory_pool().release_unused()
        give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if give_back is not None:
            give_back(0)
        home["value"] = make()
        home["name"] = name
    return home["value"]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: read back as often as needed, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing reads any more, frames still to be computed included."""
    for table in tables:
        for folder in {posixpath.dirname(f) for f in table.inputFiles()}:
            _remove(table.sparkSession, folder)


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8, A-Z in lower case; null has none.

    On bytes, ``lower`` touches A-Z only and ``split`` cuts at exactly the six ASCII blanks.
    """
    return text.encode("utf-8").lower().split() if text else []


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words, repeats included; of fewer words the whole run, of none nothing."""
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [joined]
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends[: len(ends) - size]]
    return [joined[s:e] for s, e in zip(starts, ends[size - 1 :], strict=True)]
