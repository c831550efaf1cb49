"""Document fingerprints by winnowing.

Every run of `gram` characters is hashed; of each `window` neighbouring hashes the least is kept, the rightmost of
equal ones, with its position.  Two texts that share `gram + window - 1` characters in a row keep at least one hash
in common.  A text shorter than `gram` is one gram; one with fewer than `window` grams keeps its least hash.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle
from millrace.llm.neighbours import AFTER, ranged
from millrace.llm.wordhash import mix, powers

GRAM, WINDOW = 16, 32
_LOW = np.uint64(0xFFFFFFFF)


def code_points(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept 32-bit hashes and their positions, in order of position."""
    points = code_points(text).astype(np.uint64)
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    size = min(gram, n)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(points + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[size:] - sums[:-size]) * down[: n - size + 1] + np.uint64(size)) >> np.uint64(32)
    place = np.arange(len(hashes), dtype=np.uint64)
    # The greater position is the lesser low half, so the least value is the rightmost of the least hashes.
    least = (hashes << np.uint64(32)) | (_LOW - place)
    span, want = 1, min(window, len(least))
    while span < want:
        step = min(span, want - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    kept = least[new]
    return (kept >> np.uint64(32)).astype(np.uint32), (_LOW - (kept & _LOW)).astype(np.int64)


def packed(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """Base64 of the hashes (little-endian 32 bits) and then the steps between their positions (one byte each,
    as no step is longer than the window)."""
    hashes, places = print_
    steps = np.diff(places, prepend=0).astype(np.uint8)
    return base64.b64encode(hashes.astype("<u4").tobytes() + steps.tobytes()).decode()


def unpacked(code: str) -> tuple[np.ndarray, np.ndarray]:
    data = base64.b64decode(code)
    n = len(data) // 5
    return np.frombuffer(data[: 4 * n], "<u4"), np.cumsum(np.frombuffer(data[4 * n :], np.uint8).astype(np.int64))


def likeness(a: tuple, b: tuple) -> float:
    """Jaccard similarity of the kept hashes; two empty fingerprints are alike."""
    x, y = np.unique(a[0]), np.unique(b[0])
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprint of each text: doc_id, n_chars, fingerprint (see `packed`), hashes, positions."""
    settle(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            prints = [fingerprint(t, gram, window) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([packed(p) for p in prints], pa.string()),
                 pa.array([p[0].astype(np.int64) for p in prints], pa.list_(pa.int64())),
                 pa.array([p[1] for p in prints], pa.list_(pa.int64()))],
                names=["doc_id", "n_chars", "fingerprint", "hashes", "positions"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string, hashes array<long>, positions array<long>"
    )


def edited_fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last quarter is replaced.

    The last floor(n_chars / 4) characters give way to the first as many (or all) of the next document by ascending
    id; after the last comes the first.  Null texts are empty; a null id sorts first; rows that repeat an id follow in
    order of text.  A table of one row is its own next document.  Texts move once, to the range of their id.
    """
    settle(docs.sparkSession)
    key = {"_id": F.coalesce(F.col("doc_id"), F.lit(-(2**63))), "_tie": F.xxhash64("text")}
    rows = ranged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), key, wrap=True)

    def run(batches):
        waiting = None  # id, text and fingerprint of the row before

        def result(one, following):
            doc_id, text, own = one
            cut = len(text) // 4
            edited = text[: len(text) - cut] + following[1][:cut] if cut else text
            changed = fingerprint(edited, gram, window) if cut else own
            return (
                doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), packed(own), packed(changed),
                likeness(own, changed), likeness(own, following[2]),
            )

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "_side"))
            for doc_id, text, side in zip(*columns, strict=True):
                row = (doc_id, text or "", fingerprint(text or "", gram, window))
                if waiting:
                    out.append(result(waiting, row))
                waiting = row if side != AFTER else None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], names=NAMES)

    return rows.select("doc_id", "text", "_side").mapInArrow(
        run, ", ".join(f"{n} {k}" for n, k in zip(NAMES, ("long", "long", "string", "string", "string", "double", "double")))
    )


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
