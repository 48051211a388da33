"""Hashed character trigrams, shared by language training and labelling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BUCKETS = 4096  # a power of two; sums of three code points stay within 32 bits
SLICE = 64  # texts of an Arrow batch that are Python objects at once


def slices(*columns: pa.Array) -> Iterator[list]:
    """Columns of an Arrow batch as lists, a few rows at a time; of several columns, tuples of a row each."""
    for at in range(0, len(columns[0]), SLICE):
        lists = [column.slice(at, SLICE).to_pylist() for column in columns]
        yield lists[0] if len(lists) == 1 else list(zip(*lists))


def trigram_buckets(text: str) -> np.ndarray:
    """Bucket of each trigram of the lower-cased text, blanks runs as one blank."""
    padded = " " + " ".join(text.lower().split()) + " "
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return (points[:-2] * 961 + points[1:-1] * 31 + points[2:]) & (BUCKETS - 1)


def best_languages(texts: list[str | None], model) -> list[str | None]:
    """Language with the highest summed weight per text, the first one on a tie."""
    labels: list[str | None] = []
    for text in texts:
        if not text:
            labels.append(None)
            continue
        counts = np.bincount(trigram_buckets(text), minlength=BUCKETS)
        labels.append(model.languages[int(np.argmax(model.weights @ counts))])
    return labels
