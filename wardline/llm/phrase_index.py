"""An index of fingerprints dealt out by their leading bits, and its compact rows for the shuffle.

A task folds the fingerprints of its block of documents first: one entry per fingerprint and block, so
that a phrase found in a third of all documents reaches its index block as one entry per block of text
instead of one per document. Entries travel as one row per (block, index block): the sorted fingerprints as
differences, byte plane by byte plane so that the shuffle's compression finds the empty planes, and the
owner of each as a number in a small table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession


def index_blocks(spark: SparkSession) -> int:
    """Number of index blocks: a power of two, some for each shuffle partition.

    At least 128, so that findings, which are one row for each block and document, follow the documents
    and not the number of partitions where both are small.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(7, (2 * partitions - 1).bit_length())


def pack_codes(codes: np.ndarray) -> bytes:
    """Sorted fingerprints as bytes."""
    steps = np.diff(codes, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_codes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_owners(owners: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct owners, and the owner of each entry as a number among them."""
    known, number = np.unique(owners, return_inverse=True)
    return known.tobytes(), number.astype(np.uint16 if len(known) <= 1 << 16 else np.uint32).tobytes()


def unpack_owners(known: bytes, number: bytes) -> np.ndarray:
    table = np.frombuffer(known, np.int64)
    return table[np.frombuffer(number, np.uint16 if len(table) <= 1 << 16 else np.uint32)]


def dealt(codes: np.ndarray, owners: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Rows (index block, fingerprints, owners, owner numbers) of sorted fingerprints."""
    shift = np.uint64(64 - (parts.bit_length() - 1))
    cuts = np.searchsorted(codes >> shift, np.arange(parts + 1))
    for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            yield part, pack_codes(codes[a:b]), *pack_owners(owners[a:b])


def fold(codes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of (fingerprint, owner), which of them open a fingerprint, and the order taken."""
    order = np.lexsort((owners, codes))
    codes, owners = codes[order], owners[order]
    opens = np.ones(len(codes), bool)
    opens[1:] = codes[1:] != codes[:-1]
    return opens, order, np.cumsum(opens) - 1
