"""Small helpers on texts as bytes, used inside tasks."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20  # bytes of a text that are looked at together
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A long text in pieces of about ``size`` bytes that end at ASCII white space."""
    start = 0
    while len(text) - start > size:
        cut = _SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def third(id_column: str) -> Column:
    """crc32 of the id as text, modulo 3; 0 for a NULL id.  1 marks held-out rows."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(3)), F.lit(0))


def release() -> None:
    """Give memory that a task no longer needs back to the machine; an idle worker keeps it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, with underscores appended until no column of ``df`` begins with it, whatever the case."""
    names = [c.lower() for c in df.columns]
    while any(c.startswith(prefix.lower()) for c in names):
        prefix += "_"
    return prefix
