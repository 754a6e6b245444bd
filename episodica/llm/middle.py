"""Fill-in-the-middle: texts cut at two seeded places and put into the order prefix, suffix, middle or another.

The places where a text's units begin are a compressed set of byte offsets with one container per 65,536 bytes: an array
of offsets, a bitmap, or runs, whichever is smallest. Cumulative cardinalities lead to a container, a select inside it to
the offset; both cuts are bytes of the text, so nothing is decoded.

Edge cases: null text is empty and plain; a text that holds a mark stays plain, so that every output reads back exactly;
a null id draws as the empty name; repeated rows give repeated rows; a text of any length takes one container at a time
to build; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.llm.common import IS_GAP

BLOCK = 1 << 16
MOST_IN_ARRAY = 4096

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Array:
    """Sorted offsets."""

    def __init__(self, offsets: np.ndarray):
        self.offsets = offsets.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.offsets[k])


class Bitmap:
    """One bit per byte of the block, with the bits before every 64-bit word counted."""

    def __init__(self, offsets: np.ndarray):
        bits = np.zeros(BLOCK, np.uint8)
        bits[offsets] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.through = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.through, k, "right"))
        word = int(self.words[at])
        for _ in range(k - (int(self.through[at - 1]) if at else 0)):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class Runs:
    """First offsets of runs of neighbours, with the members up to the end of each counted."""

    def __init__(self, firsts: np.ndarray, lengths: np.ndarray):
        self.firsts, self.through = firsts.astype(np.uint16), np.cumsum(lengths, dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.through, k, "right"))
        return int(self.firsts[at]) + k - (int(self.through[at - 1]) if at else 0)


def container(offsets: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest container of sorted offsets: four bytes a run, two an array's member, 8,192 a bitmap."""
    breaks = np.flatnonzero(np.diff(offsets) != 1) + 1
    if 2 + 4 * (len(breaks) + 1) < min(2 * len(offsets), BLOCK // 8):
        edges = np.concatenate([[0], breaks, [len(offsets)]])
        return Runs(offsets[edges[:-1]], np.diff(edges))
    return Array(offsets) if len(offsets) <= MOST_IN_ARRAY else Bitmap(offsets)


def _characters(block: np.ndarray, before: int) -> np.ndarray:
    return (block & 0xC0) != 0x80


def _after(ends: Callable[[np.ndarray], np.ndarray], begins: Callable[[np.ndarray], np.ndarray]):
    def starts(block: np.ndarray, before: int) -> np.ndarray:
        earlier = np.concatenate([[np.uint8(before)], block[:-1]])
        return ends(earlier) & begins(block)

    return starts


#: Where units begin, as a function of a block of bytes and the byte before it. The first byte always begins one.
UNITS = {
    "characters": _characters,
    "words": _after(lambda b: IS_GAP[b], lambda b: ~IS_GAP[b]),
    "lines": _after(lambda b: b == 10, lambda b: np.ones(len(b), bool)),
}


class Boundaries:
    """The offsets where the units of a text begin, and its end as the last one; ``units`` counts the units."""

    def __init__(self, data: np.ndarray, unit: str = "characters"):
        self.end, self.keys, self.containers, through = len(data), [], [], []
        self.units = 0
        for base in range(0, len(data), BLOCK):
            block = data[base : base + BLOCK]
            begins = UNITS[unit](block, int(data[base - 1]) if base else 0)
            if not base:
                begins[0] = True
            offsets = np.flatnonzero(begins)
            if len(offsets):
                self.units += len(offsets)
                self.keys.append(base)
                self.containers.append(container(offsets))
                through.append(self.units)
        self.through = np.array(through, np.int64)

    def select(self, k: int) -> int:
        """The byte where unit ``k`` begins; the text's length for ``k == units``."""
        if k == self.units:
            return self.end
        at = int(np.searchsorted(self.through, k, "right"))
        return self.keys[at] + self.containers[at].select(k - (int(self.through[at - 1]) if at else 0))


@dataclass(frozen=True)
class Draw:
    """Which texts are cut, in which order, and where: by digests of the id."""

    seed: int = 1
    plain_percent: int = 10
    #: Of the texts that are cut, those that begin with the suffix.
    spm_percent: int = 20
    unit: str = field(default="characters")


def _numbers(rule: Draw, id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    name = F.concat(F.lit(f"{rule.seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    hex = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(hex, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, rule: Draw = Draw(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_units, middle_units (null if plain), output."""
    whole = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = _numbers(rule, F.col(id))
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    plain = (whole == "") | marked | (h3 % 100 >= 100 - rule.plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < rule.spm_percent, "spm").otherwise("psm")
    drawn = docs.select(F.col(id).alias("doc_id"), whole.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    counts = [T.StructField(n, T.LongType()) for n in ("n", "prefix_units", "middle_units")]
    fields = [T.StructField("doc_id", docs.schema[id].dataType), T.StructField("form", T.StringType()), *counts, T.StructField("output", T.StringType())]
    schema, unit = T.StructType(fields), rule.unit
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            forms, first, second = (batch.column(c).to_pylist() for c in (2, 3, 4))
            n, prefixes, middles, outputs = [], [], [], []
            for row, form in enumerate(forms):
                data = memoryview(texts[row].as_buffer())
                found = Boundaries(np.frombuffer(data, np.uint8), unit)
                n.append(found.units)
                if form == "plain":
                    prefixes.append(None), middles.append(None), outputs.append(data.tobytes())
                    continue
                a, b = sorted((first[row] % (found.units + 1), second[row] % (found.units + 1)))
                prefixes.append(a), middles.append(b - a)
                a, b = found.select(a), found.select(b)
                prefix, suffix = (marks[0], data[:a]), (marks[1], data[b:])
                parts = (*prefix, *suffix) if form == "psm" else (*suffix, *prefix)
                outputs.append(b"".join((*parts, marks[2], data[a:b])))
            long = [pa.array(c, pa.int64()) for c in (n, prefixes, middles)]
            output = pa.array(outputs, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *long, output], names=schema.names)

    return drawn.mapInArrow(cut, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that became ``output``; exact, as a text that is cut holds no mark."""
    part = F.split(output, "<[PSM]>", 4)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
