"""Language identification: scripts narrow the candidates, then Viterbi over word scores labels spans.

A word is a run of letters of one script. Its score under a language is the sum over its letters of the log chance of
the letter with its two neighbours, learnt from labelled texts; languages that were (almost) never seen in the word's
script are no candidates. The best labelling of all words, where each change of language costs a penalty, gives spans;
the language with most letters is the text's.

Edge cases: null texts and texts without letters are `und` with score 0 and have no spans; with no labelled text all
texts are; ties go to the language that sorts first; null languages teach nothing; repeated rows teach each.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The blocks of the scripts that tell languages apart.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("ethiopic", ((0x1200, 0x137F),)),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF))),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
)
OTHER = len(SCRIPTS)
BITS = 17
PIECE = 1 << 18
GROUPS = 64


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: script plus one (0: no letter), and the lower-case code point."""
    kind = np.zeros(sys.maxunicode + 1, np.uint8)
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == "L":
            kind[c] = OTHER + 1
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        elif unicodedata.category(chr(c))[0] == "M":
            kind[c] = 255
    for number, (_, ranges) in enumerate(SCRIPTS):
        for first, last in ranges:
            part = kind[first : last + 1]
            part[part > 0] = number + 1
    kind[kind == 255] = 0
    return kind, lower


@dataclass(frozen=True)
class Words:
    """Words of several texts: code-point offsets (within their text), scripts, and the cells of their letters."""

    counts: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    scripts: np.ndarray
    cells: np.ndarray


def words_of_texts(texts: list[str | None]) -> Words:
    """Words of texts; ``cells`` has one hashed cell per letter, word after word."""
    kind, lower = _tables()
    points = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(p) for p in points])
    # A space after each text keeps words apart.
    flat = np.full(int(sizes.sum()) + len(texts) + 2, 32, np.uint32)
    begins = np.cumsum(np.append(1, sizes + 1))
    for begin, p in zip(begins, points):
        flat[begin : begin + len(p)] = p
    script = kind[flat]
    letter = script > 0
    change = script[1:] != script[:-1]
    starts = np.flatnonzero(letter[1:] & change) + 1
    stops = np.flatnonzero(letter[:-1] & change) + 1
    at = np.flatnonzero(letter)
    small = lower[flat].astype(np.uint64)
    same_before, same_after = ~change[at - 1], ~change[at]
    cell = small[at] * np.uint64(0x9E3779B97F4A7C15)
    cell ^= np.where(same_before, small[at - 1], 0).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    cell += np.where(same_after, small[at + 1], 0).astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    cell *= np.uint64(0xFF51AFD7ED558CCD)
    edges = np.searchsorted(starts, begins)
    return Words(
        np.diff(edges), starts - np.repeat(begins[:-1], np.diff(edges)), stops - starts, script[starts].astype(np.int64) - 1, (cell >> np.uint64(64 - BITS)).astype(np.int64)
    )


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to PIECE characters together, or one longer text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t or "") > PIECE:
            yield first, i
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield first, len(texts)


@dataclass(frozen=True)
class Rule:
    switch: float = 25.0
    smoothing: float = 0.2
    #: A language is a candidate in a script that holds at least this share of its letters.
    script_share: float = 0.01
    #: More languages than this are refused: the model is a table of cells by languages on the driver and in every task.
    most_langs: int = 256


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    logs: np.ndarray  # (cells, langs)
    allowed: np.ndarray  # (scripts, langs)
    switch: float

    def label(self, texts: list[str | None]) -> Iterator[tuple[str, float, list[dict]]]:
        """Language, score and spans of every text, in order."""
        for first, last in _runs(texts):
            words = words_of_texts(texts[first:last])
            if not len(words.starts) or not self.langs:
                yield from [("und", 0.0, [])] * (last - first)
                continue
            edges = np.cumsum(words.lengths) - words.lengths
            scores = np.add.reduceat(self.logs[words.cells], edges, axis=0)
            scores += np.where(self.allowed[words.scripts], 0.0, -1e4)
            for stop, n in zip(np.cumsum(words.counts), words.counts):
                part = slice(stop - n, stop)
                yield self._text(scores[part], words.starts[part], words.lengths[part]) if n else ("und", 0.0, [])

    def _text(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[str, float, list[dict]]:
        path = best_path(scores, self.switch)
        letters = np.bincount(path, lengths, len(self.langs))
        lang = int(np.argmax(letters))
        total = scores.sum(axis=0)
        rest = np.delete(total, lang)
        margin = (total[lang] - rest.max()) / len(path) if len(rest) else 50.0
        sure = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        cuts = np.flatnonzero(np.diff(path)) + 1
        spans = [
            {"start": int(starts[a]), "stop": int(starts[b - 1] + lengths[b - 1]), "lang": self.langs[path[a]]}
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(path)))
        ]
        return self.langs[lang], float(letters[lang] / letters.sum() * sure), spans


def best_path(scores: np.ndarray, switch: float) -> np.ndarray:
    """The labels of words with the highest sum of scores less ``switch`` per change (Viterbi).

    If no stretch of words gains more than half of ``switch`` under another language, one label throughout is the best
    path: k stretches of other languages gain at most k halves, and cost k - 1 changes at least where k is 2 or more.
    Else the table is filled word by word.
    """
    one = int(np.argmax(scores.sum(axis=0)))
    gains = np.cumsum(scores - scores[:, one : one + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros(scores.shape[1]), gains[:-1]]), axis=0)
    if (gains - low).max() <= switch / 2:
        return np.full(len(scores), one)
    value = scores[0].tolist()
    langs = range(len(value))
    back = []
    for row in scores[1:].tolist():
        top = max(value)
        source = value.index(top)
        limit = top - switch
        back.append([k if value[k] >= limit else source for k in langs])
        value = [(value[k] if value[k] >= limit else limit) + row[k] for k in langs]
    path = [value.index(max(value))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def learn(docs: DataFrame, rule: Rule = Rule(), text: str = "text", lang: str = "lang") -> Model:
    """Learn from every row with a language. Tasks send counts by cell; at most cells times languages reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, counts in sums.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "cell", "n"])
            sums.clear()

        for batch in batches:
            langs, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
            order = np.argsort(langs, kind="stable")
            langs, texts = langs[order], [texts[i] for i in order]
            for name in dict.fromkeys(langs):
                own = [t for t, x in zip(texts, langs) if x == name]
                if len(sums) >= GROUPS and name not in sums:
                    yield from flush()
                total = sums.setdefault(name, np.zeros((1 << BITS) + OTHER + 1, np.int64))
                for first, last in _runs(own):
                    words = words_of_texts(own[first:last])
                    total[: 1 << BITS] += np.bincount(words.cells, minlength=1 << BITS)
                    total[1 << BITS :] += np.bincount(words.scripts, words.lengths, OTHER + 1).astype(np.int64)
        yield from flush()

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    named = rows.select("lang").distinct().limit(rule.most_langs + 1).count()
    if named > rule.most_langs:
        raise ValueError(f"{lang} has more than {rule.most_langs} values")
    counts = rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = tuple(sorted(counts["lang"].unique()))
    table = np.zeros(((1 << BITS) + OTHER + 1, len(langs)))
    if langs:
        table[counts["cell"].to_numpy(int), np.searchsorted(np.array(langs, object), counts["lang"].to_numpy(object))] = counts["n"].to_numpy(float)
    cells, scripts = table[: 1 << BITS], table[1 << BITS :]
    logs = np.log((cells + rule.smoothing) / (cells.sum(axis=0) + rule.smoothing * len(cells))).astype(np.float32)
    allowed = scripts >= rule.script_share * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True  # a script that no language was seen in rules nothing out
    return Model(langs, logs, allowed, rule.switch)


def identify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, spans (code-point offsets of labelled stretches), one row per document."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    result = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])))])

    @F.arrow_udf("struct<lang:string,score:double,spans:array<struct<start:int,stop:int,lang:string>>>")
    def label(texts: pa.Array) -> pa.Array:
        found = [{"lang": a, "score": b, "spans": c} for a, b, c in known.value.label(texts.to_pylist())]
        return pa.array(found, result)

    labelled = docs.select(F.col(id).alias("doc_id"), label(F.col(text)).alias("l"))
    return labelled.select("doc_id", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"), F.col("l.spans").alias("spans"))
