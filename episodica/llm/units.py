"""Encoding texts by units: what a tokenizer makes of a text is what it makes of its units, one after another.

A tokenizer says where units end and how one is encoded; here each unit is encoded once and remembered under a 64-bit
hash, so a text costs a few array operations, however long the tokenizer takes for a word. What a worker remembers is
bounded in units and in ids; beyond that, only units that were met again stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from episodica.llm.common import BYTE, PIECE, hash_words

#: Bytes encoded at a time; units remembered before some are forgotten; ids remembered, on average for each of them.
SLICE = 1 << 20
UNITS = 1 << 20
IDS_PER_UNIT = 8


class UnitEncoder:
    """Ids of texts, given as UTF-8. Subclasses define the units."""

    #: Bytes that belong to no unit, by value.
    gap: np.ndarray
    #: What stands before every text.
    lead = b""
    #: Units that a worker remembers at most.
    most = UNITS

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.begins, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, "<u4")
        self.met = np.zeros(0, bool)  # again, after they were learned or last kept

    @property
    def room(self) -> int:
        return min(self.most, UNITS)

    def _is_full(self) -> bool:
        return len(self.hashes) > self.room or len(self.ids) > self.room * IDS_PER_UNIT

    def _shrink(self) -> None:
        """Keep the units that were met again; none, if these alone take more than half of the room."""
        counts = self.counts[self.met]
        through = np.cumsum(counts, dtype=np.int64)
        if not len(counts) or len(counts) > self.room // 2 or through[-1] > self.room * IDS_PER_UNIT // 2:
            self._forget()
            return
        begins = through - counts
        self.ids = self.ids[np.repeat(self.begins[self.met] - begins, counts) + np.arange(through[-1])]
        self.hashes, self.begins, self.counts = self.hashes[self.met], begins, counts
        self.met = np.zeros(len(counts), bool)

    def edges(self, data: np.ndarray) -> np.ndarray:
        """Where a unit begins though no gap is before it."""
        raise NotImplementedError

    def folded(self, data: np.ndarray) -> np.ndarray:
        """The bytes to hash: units that agree in them have the same ids."""
        return data

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these units and how many each has."""
        raise NotImplementedError

    def encode_long(self, text: bytes) -> np.ndarray:
        """The ids of a text of more than PIECE bytes."""
        raise NotImplementedError

    def _units(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, first bytes and ends of the units."""
        edge = self.edges(data)
        hashes, starts = hash_words(self.folded(data), edge, self.gap, BYTE, ())
        last = ~self.gap[data]
        last[:-1] &= self.gap[data[1:]] | edge[1:]
        return hashes, starts, np.flatnonzero(last) + 1

    def _learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        """Remember units; ``hashes`` ascend and none is known yet."""
        ids, counts = self.encode_units(units)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begins = np.insert(self.begins, at, np.cumsum(counts) - counts + len(self.ids))
        self.counts = np.insert(self.counts, at, counts)
        self.met = np.insert(self.met, at, False)
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text; together about SLICE bytes, and none longer than PIECE."""
        datas, hashes, firsts, units_of, run, held = [], [], [], [], [], 0
        for text in [*texts, None]:
            if run and (text is None or held + len(text) > PIECE):
                data = np.frombuffer(self.lead + b" ".join(run) or b" ", np.uint8)
                hashed, starts, stops = self._units(data)
                ends = np.cumsum([len(t) + 1 for t in run])
                units_of.append(np.diff(np.searchsorted(starts, ends), prepend=0))
                datas.append((data, starts, stops)), hashes.append(hashed), firsts.append(len(hashed))
                run, held = [], 0
            if text is not None:
                run.append(text)
                held += len(text) + 1
        if not datas:
            return []
        distinct, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        self.met[at[known]] = True
        if not known.all():
            bases = np.cumsum([0, *firsts])
            unknown = first[~known]
            runs = np.searchsorted(bases, unknown, "right") - 1
            new = []
            for r, u in zip(runs.tolist(), (unknown - bases[runs]).tolist()):
                data, starts, stops = datas[r]
                new.append(data[starts[u] : stops[u]].tobytes())
            self._learn(distinct[~known], new)
            at = np.searchsorted(self.hashes, distinct)
        begins, counts = self.begins[at][which], self.counts[at][which]
        through = np.cumsum(counts, dtype=np.int64)
        total = int(through[-1]) if len(through) else 0
        ids = self.ids[np.repeat(begins - (through - counts), counts) + np.arange(total)]
        if self._is_full():
            self._shrink()
        ends = np.concatenate([[0], through])[np.cumsum(np.concatenate(units_of))]
        return np.split(ids, ends[:-1])

    def encode_all(self, texts: Iterator[bytes]) -> Iterator[np.ndarray]:
        run, held = [], 0
        for text in texts:
            if len(text) > PIECE - len(self.lead):
                yield from self.encode(run)
                run, held = [], 0
                yield self.encode_long(text)
                continue
            run.append(text)
            held += len(text)
            if held > SLICE:
                yield from self.encode(run)
                run, held = [], 0
        yield from self.encode(run)
