"""Exact encoding with a merge-type SentencePiece model by backtracking, and decoding.

A sequence of pieces is what merging would give exactly if every two neighbours are: merging their joined text gives
these two again. So the encoder takes the longest piece that matches at a position (an Aho-Corasick automaton runs over
the text once and finds all), checks it against the piece before by merging the two anew (the outcome is kept), and on a
dead end marks the position as failed, steps back and takes the next shorter piece.

Pieces never hold a space mark after another character, so a text is encoded in units that begin at space marks and
where no piece holds the two neighbouring characters; each distinct unit is encoded once. Runs of several marks merge by
place, not by rank, and are merged directly.

Edge cases: null or empty text gives the end id alone; characters outside the vocabulary become byte pieces; a space
mark in the text reads back as a space, as in the library; repeated rows are encoded each.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import PIECE
from episodica.llm.units import UnitEncoder

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: What a Python worker keeps: units; words for texts with runs of marks before the older half goes; checked neighbours
#: before they start afresh. They stay for the worker's life, beside an executor's heap, so they are small.
UNITS = 3 << 17
KEPT = 1 << 14
PAIRS = 1 << 18
#: Texts of up to so many characters are merged without a heap.
SHORT = 24
ROWS = 256
#: Bits of a piece's number in the key of two neighbours.
BITS = 21


class Pieces:
    """A merge-type model: its pieces, the encoder and the decoder."""

    def __init__(self, path: str):
        # The library only lists the vocabulary here.
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = model.eos_id()
        self.ids, self.scores, self.bytes, self.surface = {}, {}, {}, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append("")
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(" ⁇ " if model.is_unknown(i) else "")
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.surface.append(piece.replace(MARK, " "))
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if any(MARK in p.lstrip(MARK) or p.startswith(MARK * 2) and p.strip(MARK) for p in self.ids) or len(self.bytes) != 256:
            raise ValueError("the model joins words or has no byte pieces")
        self.texts = {i: p for p, i in self.ids.items()}
        self.size_of = {i: len(p) for p, i in self.ids.items()}
        self.reach = max(self.size_of.values())
        self.others: dict[str, int] = {}  # characters outside the vocabulary, numbered after it
        self.first_other = model.get_piece_size()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.cut: dict[str, list[int]] = {}
        self.seams = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            found.add_word(piece, i)
        found.make_automaton()
        return found

    @cached_property
    def shorter(self) -> dict[int, int]:
        """The longest other piece that a piece begins with. Where a single character is none, ``_other`` takes its place."""
        found = {}
        for piece, i in self.ids.items():
            sizes = range(len(piece) - 1, 0, -1)
            found[i] = next((self.ids[piece[:n]] for n in sizes if piece[:n] in self.ids), -1)
            if found[i] < 0 and len(piece) > 1:
                found[i] = self.others.setdefault(piece[0], self.first_other + len(self.others))
                self.texts[found[i]], self.size_of[found[i]], found[found[i]] = piece[0], 1, -1
        return found

    def merge(self, text: str) -> list[str]:
        """Pieces by merging: the best-ranked neighbours first, of equal ranks the leftmost."""
        if len(text) <= SHORT:
            return self._merge_short(list(text))
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                joined = parts[i] + parts[j]
                if joined in self.scores:
                    heapq.heappush(heap, (-self.scores[joined], i, j, joined))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _merge_short(self, parts: list[str]) -> list[str]:
        rank = self.scores.get
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = rank(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the two joined gives them again; with no ``left`` (-1), whether ``right`` stays whole."""
        expected = [self.texts[i] for i in (left, right) if i >= 0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[(left + 1) << BITS | right] = self.merge("".join(expected)) == expected
        return found

    def _other(self, char: str) -> int:
        i = self.others.setdefault(char, self.first_other + len(self.others))
        self.texts[i], self.size_of[i], self.shorter[i] = char, 1, -1
        return i

    def split(self, chunk: str) -> list[int]:
        """Pieces of a chunk by longest matches and backtracking.

        One run of the automaton finds the longest matches one after another; where a step back leads to another place, the
        match there is looked up. ``shorter`` leads from a piece to the longest piece that begins it.
        """
        end, pairs, size_of, shorter = len(chunk), self.pairs, self.size_of, self.shorter
        longest = {last + 1 - size_of[i]: i for last, i in self.automaton.iter_long(chunk)}
        failed = 0  # one bit per place from which no way leads to the end
        taken: list[int] = []
        at, left = 0, -1
        i = longest[0] if 0 in longest else self._longest(chunk, 0)
        while True:
            while i >= 0:
                stop = at + size_of[i]
                if not failed >> stop & 1:
                    known = pairs.get((left + 1) << BITS | i)
                    if known or known is None and self._compatible(left, i):
                        break
                i = shorter[i]
            if i >= 0:
                taken.append(i)
                if stop == end:
                    return taken
                at, left = stop, i
                i = longest[at] if at in longest else self._longest(chunk, at)
            else:
                failed |= 1 << at
                if not taken:
                    raise ValueError("no sequence of compatible pieces")
                i = taken.pop()
                at -= size_of[i]
                left = taken[-1] if taken else -1
                i = shorter[i]

    def _longest(self, chunk: str, at: int) -> int:
        size = self.automaton.longest_prefix(chunk[at : at + self.reach])
        while size > 1 and chunk[at : at + size] not in self.ids:
            size -= 1
        i = self.ids.get(chunk[at : at + size]) if size else None
        return self._other(chunk[at]) if i is None else i

    def _parts(self, chunk: str) -> list[int]:
        """Pieces of a chunk, cut first where no piece holds the two neighbouring characters: no merge crosses there."""
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.seams]
        if not cuts:
            return self.split(chunk)
        found = []
        for start, stop in zip([0, *cuts], [*cuts, len(chunk)]):
            part = chunk[start:stop]
            known = self.cut.get(part)
            if known is None:
                known = self.split(part)
                if len(part) <= 64:
                    if len(self.cut) >= KEPT:
                        self.cut.clear()
                    self.cut[part] = known
            found += known
        return found

    def _with_bytes(self, found: list[int]) -> tuple[int, ...]:
        if max(found) < self.first_other:
            return tuple(found)
        return tuple(chain.from_iterable((i,) if i < self.first_other else [self.bytes[b] for b in self.texts[i].encode()] for i in found))

    def whole(self, unit: str) -> tuple[int, ...]:
        """Ids of a unit with a mark at its beginning or none."""
        return self._with_bytes(self._parts(unit))

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a word with one mark before it."""
        found = self.words.get(word)
        if found is None:
            found = self.older.get(word) or self.whole(MARK + word)
            if len(word) <= 64:
                if len(self.words) >= KEPT:
                    self.words, self.older = {}, self.words
                self.words[word] = found
        return found

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        word = chunk.lstrip(MARK)
        marks = len(chunk) - len(word)
        if marks == 1 and word:
            return self._word(word)
        # Pieces of several marks rank last: the word takes its mark first if it can.
        alone = self.ids[MARK]
        found = self._word(word) if word else (alone,)
        run = marks if found[0] == alone else marks - 1
        return tuple(self.ids[p] for p in self.merge(MARK * run)) + (found[1:] if run == marks else found)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, the end id last."""
        if not text:
            return [self.end]
        words = text.split(" ")
        if MARK in text or "" in words:
            found = [self._chunk(c) for c in CHUNK.findall(MARK + text.replace(" ", MARK))]
        else:
            found = list(map(self.words.get, words))
            if None in found:
                found = [self._word(w) if f is None else f for w, f in zip(words, found)]
        ids = list(chain.from_iterable(found))
        ids.append(self.end)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts in front is dropped."""
        surface = self.surface
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join(map(surface.__getitem__, ids))
        else:
            out, held = [], bytearray()
            for i in ids:
                byte = self.byte_of.get(i)
                if byte is not None:
                    held.append(byte)
                    continue
                if held:
                    out.append(held.decode("utf-8", "replace"))
                    held = bytearray()
                out.append(surface[i])
            out.append(held.decode("utf-8", "replace"))
            text = "".join(out)
        return text.removeprefix(" ")


class PieceUnits(UnitEncoder):
    """Ids of texts without runs of spaces, by units.

    A unit begins at a space and between two ASCII characters that no piece holds next to each other.
    """

    gap = np.zeros(256, bool)
    lead = b" "
    most = UNITS

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces
        apart = np.zeros((256, 256), bool)
        for a in range(128):
            for b in range(128):
                pair = (MARK if a == 32 else chr(a)) + chr(b)
                apart[a, b] = pair not in pieces.seams
        apart[:, 32] = True
        self.apart = apart.ravel()

    def edges(self, data: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(data), bool)
        edge[1:] = self.apart[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        return edge

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for unit in units:
            text = unit.decode()
            found.append(self.pieces.whole(MARK + text[1:] if text[0] == " " else text))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), "<u4", int(counts.sum())), counts

    def encode_rows(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text, the end id last."""
        plain = [i for i, t in enumerate(texts) if t and self._is_plain(t)]
        found = [None] * len(texts)
        for i, ids in zip(plain, self.encode_all(texts[i] for i in plain)):
            found[i] = np.append(ids, np.uint32(self.pieces.end))
        return [np.array(self.pieces.encode(t.decode() if t else ""), "<u4") if f is None else f for t, f in zip(texts, found)]

    def _is_plain(self, text: bytes) -> bool:
        return len(text) < PIECE and text[0] != 32 and text[-1] != 32 and b"  " not in text and MARK.encode() not in text


@cache
def load(path: str) -> Pieces:
    """The model of a path, once per Python worker."""
    return Pieces(path)


@cache
def load_units(path: str) -> PieceUnits:
    return PieceUnits(load(path))


def _encoded(batch: pa.RecordBatch, path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of a batch (doc_id, text), with the ids of their texts."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        texts = part.column("text").cast(pa.large_binary())
        yield part, load_units(path).encode_rows([t.as_py() for t in texts])


def _as_lists(ids: list[np.ndarray]) -> pa.Array:
    return pa.array([i.view(np.int32) for i in ids], pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids: every whole text encoded. ``path`` is the model's place on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ids in _encoded(batch, path):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _as_lists(ids)], ["doc_id", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def encode_and_decode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and the text decoded from them, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = load(path).decode
        for batch in batches:
            for part, ids in _encoded(batch, path):
                texts = pa.array([decode(i.tolist()) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _as_lists(ids), texts], ["doc_id", "ids", "text"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """doc_id, ids and the decoded text; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [pieces.decode(x or []) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    rows = encoded.select("doc_id", F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
