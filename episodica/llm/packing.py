"""Packing documents into sequences of a fixed size by best fit and a swap-based local search.

Texts become token ids with an end id; ids beyond one sequence are cut into pieces of its size. Shorter pieces are dealt
into groups of bounded size, where best fit makes bins and a local search improves them: an underfull bin moves a
document, or exchanges one or two of its own for one of another underfull bin, as long as the sum of squared fills
rises. So the emptiest bins empty. Underfull bins of all groups are then dealt anew, whole, and searched again, until a
round empties hardly any bin or one group holds them all.

Edge cases: null text is empty, and its piece holds the end id only; a null id is an id like any other; repeated rows are
packed each; a text of any length is encoded in slices that end at white space; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.llm.common import IS_GAP, LOWER, PIECE
from episodica.llm.units import UnitEncoder
from episodica.session import Scratch

GAP = re.compile(rb"[\x20\x09-\x0D]")
GAPS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")

_ascii = np.arange(256)
_LETTER = ((_ascii | 32) >= 97) & ((_ascii | 32) <= 122) & (_ascii < 128)
_DIGIT = (_ascii >= 48) & (_ascii <= 57)
_MARK = (_ascii > 32) & (_ascii < 127) & ~_LETTER & ~_DIGIT & (_ascii != ord("'"))
KIND = (_LETTER * 1 + _MARK * 2).astype(np.uint8)


@dataclass(frozen=True)
class Sequences:
    size: int = 2048
    end_id: int = 0
    #: Pieces that one group holds at most on average.
    group: int = 4096
    #: A round that empties no more than this share of all sequences is the last.
    least: float = 1e-4


class Encoder(UnitEncoder):
    """Ids of a tokenizer whose tokens all end at white space and between an ASCII letter and an ASCII mark.

    What lies between two such places is a unit. An apostrophe is no such mark. Case is dropped, so units are hashed in
    lower case; a letter before a byte beyond ASCII keeps its case, as it may compose with it.
    """

    gap = IS_GAP

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control tokens spelled out in a text stay text

    def edges(self, data: np.ndarray) -> np.ndarray:
        kind = KIND[data]
        edge = np.zeros(len(data), bool)
        edge[1:] = (kind[1:] ^ kind[:-1]) == 3
        return edge

    def folded(self, data: np.ndarray) -> np.ndarray:
        lower = LOWER[data]
        beyond = np.flatnonzero(data[1:] >= 128)
        lower[beyond] = data[beyond]
        return lower

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode([u.decode() for u in units], is_pretokenized=True, add_special_tokens=False)
        ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(units) + 1))
        return np.array(found.ids, "<u4"), np.diff(ends)

    def encode_long(self, text: bytes) -> np.ndarray:
        return np.concatenate([self._part(part) for part in slices(text)])

    def _part(self, part: bytes) -> np.ndarray:
        if len(part) <= PIECE:
            return self.encode([part])[0]
        return np.array(self.tokenizer.encode(part.decode(), add_special_tokens=False).ids, "<u4")


def slices(text: bytes) -> Iterator[bytes]:
    """Parts of a text that end at white space, of up to PIECE bytes or, where there is none, as long as one word."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            cut = max(text.rfind(gap, at, end) for gap in GAPS) + 1
            if not cut:
                after = GAP.search(text, end)
                cut = after.start() if after else len(text)
            end = cut
        yield text[at:end]
        at = end


@cache
def encoder(path: str) -> Encoder:
    """One per worker."""
    return Encoder(path)


def pieces(docs: DataFrame, path: str, rule: Sequences = Sequences(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids, cut into pieces of a sequence's size."""
    kind = docs.schema[id].dataType
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, t) for n, t in fields]])
    end, size = np.array([rule.end_id], "<u4").tobytes(), rule.size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            texts = (column[i].as_py() or b"" for i in range(batch.num_rows))
            of, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encoder(path).encode_all(texts)):
                whole = memoryview(ids.tobytes() + end)
                for n, at in enumerate(range(0, len(whole), 4 * size)):
                    part = whole[at : at + 4 * size]
                    of.append(row), piece.append(n), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, room: int) -> np.ndarray:
    """The bin of each size, largest first: the fullest bin that it fits into."""
    bins, spaces, opened = np.empty(len(sizes), np.int64), [], 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(spaces, (size, -1))
        if at < len(spaces):
            space, to = spaces.pop(at)
        else:
            space, to, opened = room, opened, opened + 1
        bins[i] = to
        if space > size:
            bisect.insort(spaces, (space - size, to))
    return bins


def local_search(sizes: np.ndarray, bins: np.ndarray, room: int) -> np.ndarray:
    """Bins after exchanges that raise the sum of squared fills, from the emptiest bin on, until none is left.

    A bin gives one or two of its documents and gets one or none, so that ``d`` more tokens lie in a fuller bin; the sum of
    squares rises by ``2 d (fuller - emptier + d)``. Of each receiver only the largest sum that fits is looked at.
    """
    bins = bins.copy()
    fill = np.bincount(bins, sizes).astype(np.int64)
    stuck, changed = np.zeros(len(fill), bool), False
    while True:
        underfull = (fill > 0) & (fill < room)
        left = np.flatnonzero(underfull & ~stuck)
        if not len(left):
            if not changed:
                return bins
            stuck[:], changed = False, False
            continue
        giver = left[np.argmin(fill[left])]
        own = np.flatnonzero(bins == giver)
        i, j = np.triu_indices(len(own), 1)
        sums = np.concatenate([sizes[own], sizes[own[i]] + sizes[own[j]]])
        first, second = np.concatenate([own, own[i]]), np.concatenate([np.full(len(own), -1), own[j]])
        order = np.argsort(sums, kind="stable")
        sums, first, second = sums[order], first[order], second[order]
        underfull[giver] = False
        others, theirs = np.flatnonzero(underfull), np.flatnonzero(underfull[bins])
        receiver = np.concatenate([others, bins[theirs]])
        back = np.concatenate([np.zeros(len(others), np.int64), sizes[theirs]])
        largest = np.searchsorted(sums, back + room - fill[receiver], "right") - 1
        moved = np.where(largest >= 0, sums[largest], 0) - back
        gain = np.where(moved > 0, moved * (fill[receiver] - fill[giver] + moved), 0)
        best = int(np.argmax(gain)) if len(gain) else -1
        if best < 0 or gain[best] <= 0:
            stuck[giver] = True
            continue
        to = receiver[best]
        bins[first[largest[best]]] = to
        if second[largest[best]] >= 0:
            bins[second[largest[best]]] = to
        if best >= len(others):
            bins[theirs[best - len(others)]] = giver
        fill[to] += moved[best]
        fill[giver] -= moved[best]
        stuck[to], changed = False, True


def _searcher(room: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        """Bins of one group, kept where they have them; every bin is named after its first piece."""
        rows = rows.sort_values("uid").reset_index(drop=True)
        sizes = rows["length"].to_numpy(np.int64)
        given = rows["sequence_id"]
        bins = best_fit(sizes, room) if given.isna().all() else given.factorize()[0].astype(np.int64)
        bins = local_search(sizes, bins, room)
        by = pd.Series(sizes).groupby(bins)
        rows["offset"] = by.cumsum().to_numpy() - sizes
        rows["sequence_id"] = rows["uid"].groupby(bins).transform("min")
        rows["open"] = by.transform("sum").to_numpy() < room
        return rows

    return search


def pack(
    docs: DataFrame, scratch: Scratch, path: str, rule: Sequences = Sequences(), id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A group's rows are a few numbers per piece and its size is bounded, as pieces (and later whole bins, of at most
    ``size`` pieces) are dealt by a hash of numbers that no two of them share.
    """
    cut = scratch.save(pieces(docs, path, rule, id, text).withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    placed = ["uid", "length", "sequence_id", "offset", "open"]
    schema = "uid long, length long, sequence_id long, offset long, open boolean"
    short = cut.filter(F.col("length") < rule.size).select("uid", "length", F.lit(None).cast("long").alias("sequence_id"))
    key, before, closed, number = "uid", None, [], 0
    total = cut.agg(F.count_if(F.col("length") == rule.size).alias("whole"), F.count_if(F.col("length") < rule.size).alias("short")).first()
    count = total["short"]
    while count:
        groups = math.ceil(count / rule.group)
        dealt = short.withColumn("group", F.pmod(F.xxhash64(F.lit(number), key), F.lit(groups)))
        done = dealt.groupBy("group").applyInPandas(_searcher(rule.size), f"{schema}, group long").select(*placed)
        done = scratch.save(done, f"pack-round-{number}")
        opened = F.col("open")
        seen = done.agg(F.count_if(opened).alias("rows"), F.count_if(opened & (F.col("offset") == 0)).alias("bins"), F.count_if(F.col("offset") == 0).alias("all")).first()
        if before is None:
            sequences = total["whole"] + seen["all"]
        emptied = None if before is None else before - seen["all"]
        if groups == 1 or not seen["rows"] or (emptied is not None and emptied <= rule.least * sequences):
            closed.append(done)
            break
        closed.append(done.filter(~opened))
        short = done.filter(opened).select("uid", "length", "sequence_id")
        key, before, count, number = "sequence_id", seen["bins"], seen["rows"], number + 1
    alone = cut.filter(F.col("length") == rule.size).withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    result = alone.select(*columns)
    if closed:
        found = closed[0]
        for more in closed[1:]:
            found = found.unionByName(more)
        result = result.unionByName(cut.drop("length").join(found, "uid").select(*columns))
    return result
