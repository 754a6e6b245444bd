"""Helpers shared by the operators: saved intermediate tables, folder checks, word hashing over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

PIECE = 1 << 18


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, beginning with ``name``; names don't differ by case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def id_crc(id_column: str) -> Column:
    """CRC-32 of the id written as text; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary"))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_UP = _powers(_BASE, PIECE + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)

_ascii = np.arange(256)
LOWER = np.where((_ascii >= 65) & (_ascii <= 90), _ascii + 32, _ascii).astype(np.uint8)
IS_GAP = (_ascii == 32) | ((_ascii >= 9) & (_ascii <= 13))
# Bytes of characters beyond ASCII count as letters.
NO_LETTER = (_ascii < 128) & ~(((_ascii | 32) >= 97) & ((_ascii | 32) <= 122))


def hash_words(data: np.ndarray, edge: np.ndarray, gap: np.ndarray, values: np.ndarray, prefixes: tuple[int, ...]):
    """Hashes and first bytes of the words of up to PIECE bytes; ``edge`` marks bytes where a new text begins."""
    word = ~gap[data]
    start = word.copy()
    start[1:] &= gap[data[:-1]] | edge[1:]
    stop = word.copy()
    stop[:-1] &= gap[data[1:]] | edge[1:]
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * _UP[: len(data)], out=sums[1:])
    whole = mix((sums[stops] - sums[starts]) * _DOWN[starts])
    if not prefixes:
        return whole, starts
    heads = [whole]
    for size in prefixes:  # of a shorter word: the word again
        longer = stops - starts > size
        head = mix((sums[np.minimum(starts + size, len(data))] - sums[starts]) * _DOWN[starts] + np.uint64(size))
        heads.append(np.where(longer, head, whole))
    return np.stack(heads, axis=1).ravel(), np.repeat(starts, len(heads))


def words_of(
    column: pa.Array, gap: np.ndarray = IS_GAP, lower: bool = True, prefixes: tuple[int, ...] = ()
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per run of rows: the first row, 64-bit hashes of all words in order, and the number of words of each row.

    Rows without text have no words. Runs hold up to PIECE bytes; a longer text is a run of its own, hashed in pieces
    that are cut between words; a word of any length has one hash. With ``prefixes``, each word is followed by the hash of
    its first bytes, for each of these lengths.
    """
    values = BYTE[LOWER] if lower else BYTE
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    missing = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else None
    row = 0
    while row < len(column):
        begin = offsets[row]
        end = max(row + 1, int(np.searchsorted(offsets, begin + PIECE, "right")) - 1)
        if end > row + 1 or offsets[end] - begin <= PIECE:
            part = data[begin : offsets[end]]
            edge = np.zeros(len(part) + 1, bool)
            edge[offsets[row:end] - begin] = True
            if len(part):
                hashes, starts = hash_words(part, edge[:-1], gap, values, prefixes)
                counts = np.diff(np.searchsorted(starts, offsets[row : end + 1] - begin))
            else:
                hashes, counts = np.zeros(0, np.uint64), np.zeros(end - row, np.int64)
            if missing is not None and missing[row:end].any() and counts[missing[row:end]].any():
                keep = np.repeat(~missing[row:end], counts)
                hashes, counts = hashes[keep], np.where(missing[row:end], 0, counts)
            yield row, hashes, counts
        else:
            hashes = _long(data[begin : offsets[end]], gap, values, prefixes)
            yield row, hashes, np.array([len(hashes)])
        row = end


def _long(text: np.ndarray, gap: np.ndarray, values: np.ndarray, prefixes: tuple[int, ...]) -> np.ndarray:
    found, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            gaps = np.flatnonzero(gap[text[at:end]])
            if not len(gaps):
                hashes, at = _long_word(text, at, gap, values, prefixes)
                found.append(hashes)
                continue
            end = at + int(gaps[-1]) + 1
        part = text[at:end]
        found.append(hash_words(part, np.zeros(len(part), bool), gap, values, prefixes)[0])
        at = end
    return np.concatenate(found)


def _long_word(text: np.ndarray, at: int, gap: np.ndarray, values: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """Hashes of the word of at least PIECE bytes that begins at ``at``, and where it ends; its sum is carried from piece to piece."""
    total, up, end = np.zeros(1, np.uint64), 1, at
    while end < len(text):
        part = text[end : end + PIECE]
        gaps = np.flatnonzero(gap[part])
        part = part[: gaps[0]] if len(gaps) else part
        total += (values[part] * _UP[: len(part)]).sum(keepdims=True) * np.uint64(up)
        up = up * pow(_BASE, len(part), 1 << 64) % (1 << 64)
        end += len(part)
        if len(gaps):
            break
    heads = [(values[text[at : at + size]] * _UP[:size]).sum(keepdims=True) + np.uint64(size) for size in prefixes]
    return mix(np.concatenate([total, *heads])), end
