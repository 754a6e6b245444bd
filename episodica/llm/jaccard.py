"""N-gram Jaccard join as an exact join in a metric space.

The distance of two shingle sets is one less their Jaccard similarity; it is a metric, and r is the largest distance of
a link. Documents with equal sets are one class; only classes are joined.

Regions of the first level. In the whole space almost every two documents are at distance 1 from each other and from any
pivot, so windows of width r around regions would copy every document everywhere. The universe of shingles is therefore
cut into parts, more than a linked pair can differ in: then the two are equal on some part. On a part, every set is a
pivot of its own, its region is the sets equal to it, and the window is empty. A set joins the regions of its D + 1
rarest parts only (D: shingles in which a linked set may differ): two linked sets share a part, and the first one they
share in order of rarity is among those of both.

Within a region, the most central member (most parts shared with others) is the pivot; the others get their distance
from it, and those within r are linked to it. Where a region then still holds several components, it is divided anew:
large ones get several pivots, a member goes to the region of its nearest pivot and, as a copy, to each whose distance
is at most 2 r more, and these regions are joined in turn. Small ones, and those that pivots don't separate, are joined
between their components by what their members differ in from the pivot: sets s and t differ in |s'| + |t'| - 2 |s' & t'|
shingles, where s' and t' are their differences from it. So a link needs a number of common differences that adds up
from one term of each set; each set is found by its rarest differences, as many as leave too few others for a link. Of
the candidates, those outside the triangle-inequality window (two members whose distances from a pivot differ by more
than r can't be linked) go, and the others are measured.

The links that are returned connect every component; further pairs within a component are not listed.

Edge cases: null texts and texts without words have an empty set and are linked with nothing; fewer words than a shingle
are one shingle; repeated rows and ids are one class if their sets are equal; a class without any id has a null
component; an empty table gives an empty result. Two sets with one 64-bit class key and different check keys raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.llm.common import mix, unused, words_of
from episodica.session import Scratch

#: Stands for the count of parts that are shared by more rows than are counted.
MANY = 1 << 30
RUN = 10_000
SEEN = 1 << 20
FIELD = 28


@dataclass(frozen=True)
class Rule:
    words: int = 5
    percent: int = 80
    #: Regions of up to so many members get no further pivots.
    leaf: int = 64
    pivots: int = 8

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100

    def differ(self, n: int) -> int:
        """Shingles in which a set of n and a linked one can differ at most."""
        return (100 - self.percent) * n // self.percent

    def parts(self, band: int) -> int:
        """Into how many parts the universe is cut for sets of 2 ** band shingles to twice that."""
        low = 1 << band
        spare = 1.15 if low >= 256 else 1.3 if low >= 64 else 1.8
        return max(2, int(spare * 2 * low * (100 - self.percent) / self.percent) + 1)


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_KEY, _CHECK, _PART = (np.uint64(x) for x in mix(np.arange(101, 104, dtype=np.uint64)))
_BAND = mix(np.arange(201, 201 + 128, dtype=np.uint64))


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text."""
    for row, hashes, counts in words_of(column):
        total = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            total += hashes[k : k + len(total)] * _STEPS[k]
        total = mix(total)
        start = 0
        for i, n in enumerate(counts.tolist()):
            if n >= words:
                yield row + i, np.unique(total[start : start + n - words + 1])
            elif n:
                yield row + i, mix((hashes[start : start + n] * _STEPS[:n]).sum(keepdims=True) + np.uint64(n))
            else:
                yield row + i, np.zeros(0, np.uint64)
            start += n


def _keys(mixed: np.ndarray) -> tuple[int, int]:
    """A set's class key and check key from its mixed hashes."""
    n = np.uint64(len(mixed))
    return int(mix(mixed.sum(keepdims=True) + n)[0].view(np.int64)), int(mix(((mixed ^ _CHECK) * _KEY).sum(keepdims=True) + n)[0].view(np.int64))


def _signatures(found: np.ndarray, mixed: np.ndarray, rule: Rule) -> Iterator[tuple[int, np.ndarray]]:
    """Tag and one hash per non-empty part, for each band that a linked set can be in with this one.

    The tag packs the family, the number of parts and D + 1. A set whose parts don't outnumber D has a second family of
    single shingles, which always do; a linked pair needs it only if both have it.
    """
    n, d = len(found), rule.differ(len(found))
    if d == 0:
        return
    band = n.bit_length() - 1
    bands = [band] + [band + 1] * (100 * n >= rule.percent << (band + 1))
    for b in bands:
        part = ((found >> np.uint64(32)) * np.uint64(rule.parts(b))) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sums = np.add.reduceat(mixed, first)
        yield (2 * b << 2 * FIELD) | (len(first) << FIELD) | (d + 1), mix(sums + part[first] * _PART + _BAND[b])
        if len(first) <= d:
            yield ((2 * b + 1) << 2 * FIELD) | (n << FIELD) | (d + 1), mix(mixed + _BAND[b + 64])


def _documents(docs: DataFrame, rule: Rule, id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, cls, proof of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, proof = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, found in shingle_sets(batch.column("text"), rule.words):
                n[row] = len(found)
                cls[row], proof[row] = _keys(mix(found ^ _KEY))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(cls), pa.array(proof)], ["doc_id", "n_shingles", "cls", "proof"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, cls long, proof long")


def _parts(docs: DataFrame, rule: Rule, text: str) -> DataFrame:
    """sig, cls, tag: the parts of every set. A task sends the parts of equal sets once, as far as it remembers them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held, size = [], 0
            for _, found in shingle_sets(batch.column("text"), rule.words):
                if not len(found):
                    continue
                mixed = mix(found ^ _KEY)
                cls = _keys(mixed)[0]
                if cls in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(cls)
                for tag, sigs in _signatures(found, mixed, rule):
                    held.append((sigs, cls, tag))
                    size += len(sigs)
                if size > 1 << 17:
                    yield table(held)
                    held, size = [], 0
            if held:
                yield table(held)

    def table(held) -> pa.RecordBatch:
        counts = [len(s) for s, _, _ in held]
        spread = lambda k: np.repeat(np.array([h[k] for h in held], np.int64), counts)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[0] for h in held]).view(np.int64)), pa.array(spread(1)), pa.array(spread(2))], ["sig", "cls", "tag"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "sig long, cls long, tag long")


def _shared(parts: DataFrame) -> DataFrame:
    """sig, cls, tag, n: parts that several sets have, with the number of rows that have them.

    Rows are dealt by range of (part, set), so that a part of very many sets spreads over tasks. A task counts the runs
    that lie within it. Runs at its ends may go on elsewhere, and runs of over RUN rows aren't held; both count as MANY,
    in every task, so the order by rarity is the same everywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["sig", "cls", "tag"]
        held = [np.zeros(0, np.int64)] * 3
        first, streaming, last = True, None, None

        def out(columns, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(n)], [*names, "n"])

        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in names]
            columns = [np.concatenate([a, b]) for a, b in zip(held, new)]
            sig, cls, tag = columns
            keep = np.append(True, (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1]) | (tag[1:] != tag[:-1]))
            if last is not None and len(sig) and (sig[0], cls[0], tag[0]) == last:
                keep[0] = False  # a repeat of a row that has been sent
            columns = [c[keep] for c in columns]
            sig = columns[0]
            if not len(sig):
                held = columns
                continue
            starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            lengths = np.diff(np.append(starts, len(sig)))
            n = np.repeat(lengths, lengths)
            if first or (streaming is not None and sig[0] == streaming):
                n[: lengths[0]] = MANY
            elif streaming is not None:
                streaming = None
            # The last run may go on in the next batch.
            tail = starts[-1]
            if lengths[-1] > RUN or (len(starts) == 1 and n[0] == MANY):
                streaming, tail = sig[-1], len(sig)
                n[starts[-1] :] = MANY
                last = tuple(int(c[-1]) for c in columns)
            if len(starts) > 1 or tail == len(sig):
                first = False
            send = (n[:tail] > 1)
            if send.any():
                yield out([c[:tail][send] for c in columns], n[:tail][send])
            held = [c[tail:] for c in columns]
        if len(held[0]):
            yield out(held, np.full(len(held[0]), MANY, np.int64))

    dealt = parts.repartitionByRange("sig", "cls").sortWithinPartitions("sig", "cls", "tag")
    return dealt.mapInArrow(run, "sig long, cls long, tag long, n long")


def _regions(shared: DataFrame) -> DataFrame:
    """region, cls, central: the D + 1 rarest parts of each set, as far as other sets have them.

    Parts that no other set has are the rarest; they are gone already and use up places.
    """
    family = Window.partitionBy("cls", "tag")
    mask = (1 << FIELD) - 1
    all_parts = F.shiftright("tag", FIELD).bitwiseAND(F.lit(mask))
    places = F.col("tag").bitwiseAND(F.lit(mask)) - (all_parts - F.col("held"))
    rows = shared.withColumn("held", F.count("*").over(family)).withColumn("place", F.row_number().over(family.orderBy("n", "sig")))
    return rows.filter(F.col("place") <= places).select(F.col("sig").alias("region"), "cls", (F.col("held") / all_parts).alias("central"))


def _sets(docs: DataFrame, wanted: DataFrame, rule: Rule, id: str, text: str) -> DataFrame:
    """cls, shingles of the wanted classes (cls, doc), from one document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                cls, sets = [], []
                for _, found in shingle_sets(batch.column("text").slice(at, 256), rule.words):
                    cls.append(_keys(mix(found ^ _KEY))[0])
                    sets.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "shingles"])

    texts = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    needed = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi")
    return needed.select("text").mapInArrow(run, "cls long, shingles array<long>").join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def _measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both, either: sizes of intersection and union of pairs of classes."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    rows = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")).cast("long"))
    return rows.select("a", "b", "both", (F.size("sa") + F.size("sb") - F.col("both")).alias("either"))


def _measure_by_differences(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """As _measure, for pairs (pivot, a, b) whose members' differences from the pivot are known: those are short."""
    once = pairs.groupBy("a", "b").agg(F.min("pivot").alias("pivot"))
    left = rows.select("pivot", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("differs").alias("da"))
    right = rows.select("pivot", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("differs").alias("db"))
    apart = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    both = ((F.col("na") + F.col("nb") - apart) / 2).cast("long")
    met = once.join(left, ["pivot", "a"]).join(right, ["pivot", "b"]).withColumn("both", both)
    return met.select("a", "b", "both", (F.col("na") + F.col("nb") - F.col("both")).alias("either"))


def _linked(rule: Rule) -> Column:
    return F.col("both") * 100 >= F.col("either") * rule.percent


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """cls, component (its smallest class) of every class in ``links`` (a, b).

    Labels spread along links and then jump to their label's label, so long chains shorten by half each round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.save(both, f"{name}-edges")
    labels = scratch.save(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "cls"), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        told = both.join(labels, F.col("b") == F.col("cls")).groupBy("a").agg(F.min("component").alias("heard"))
        lower = labels.join(told, F.col("cls") == F.col("a")).select("cls", F.least("component", "heard").alias("via"), F.col("component").alias("was"))
        jump = labels.select(F.col("cls").alias("via"), F.col("component").alias("far"))
        moved = lower.join(jump, "via").select("cls", F.least("via", "far").alias("component"), "was")
        saved = scratch.save(moved, f"{name}-{turn}")
        labels = saved.select("cls", "component")
        if saved.filter("component != was").isEmpty():
            return labels


def _open(regions: DataFrame, labels: DataFrame, *kept: str) -> DataFrame:
    """Members of regions that hold several components, with their component; ``reach`` is the mean of the known ``far``."""
    named = regions.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    reach = F.avg("far") if "far" in regions.columns else F.lit(None).cast("double")
    spread = named.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), reach.alias("reach"))
    opened = named.join(spread.filter("low != high").select("region", "members", "reach"), "region")
    return opened.select("region", "cls", "central", "component", "members", "reach", *kept)


def _candidates(group: DataFrame, labels: DataFrame, sets: DataFrame, rule: Rule, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Pairs (pivot, a, b) of ``group`` (pivot, cls, component) to be measured; they hold links that connect what is linked.
    And the members' differences from their pivot.

    With q = 100 + percent and a set's excess e = q * differences - (100 - percent) * size, two sets are linked if and
    only if 2 q * (common differences) >= e + e'. Where the sum isn't above 0, all pairs are links, and the member with the
    lowest excess is in one with every member of such a pair. Other links need common differences; how many at least
    follows from the lowest excess among the partners: members of the pivot's component (inside) have partners outside
    only, the others have both.
    """
    q = 100 + rule.percent
    centre = sets.select(F.col("cls").alias("pivot"), F.col("shingles").alias("centre"))
    home = labels.select(F.col("cls").alias("pivot"), F.col("component").alias("home"))
    own, lacks = F.array_except("shingles", "centre"), F.array_except("centre", "shingles")
    differs = F.concat(own, lacks)
    rows = group.distinct().join(sets, "cls").join(centre, "pivot").join(home, "pivot", "left").select(
        "pivot", "cls", "component", (F.size(differs) / (F.size("shingles") + F.size(lacks))).alias("far"),
        (F.col("component") == F.coalesce("home", "pivot")).alias("inside"), F.size("shingles").alias("n"),
        (F.size(differs) * q - F.size("shingles") * (100 - rule.percent)).alias("excess"), differs.alias("differs"),
    )
    rows = scratch.save(rows, f"{name}-differences")
    lows = rows.groupBy("pivot").agg(
        F.min(F.when(F.col("inside"), F.col("excess"))).alias("low_in"), F.min(F.when(~F.col("inside"), F.col("excess"))).alias("low_out"),
        F.min(F.struct("excess", "cls", "component")).alias("low"),
    )
    bound = rows.join(lows, "pivot")
    sure = bound.filter((F.col("excess") + F.col("low.excess") <= 0) & (F.col("component") != F.col("low.component")))
    size = F.size("differs")

    def places(low: str) -> Column:
        return size + 1 - F.greatest(F.lit(1), F.ceil((F.col("excess") + F.col(low)) / (2 * q)))

    # Differences that a single member has are its rarest; they take places and find nobody.
    parts = bound.select(
        "pivot", "cls", "component", "far", "inside", "excess", size.alias("size"), F.explode("differs").alias("part"),
        places("low_out").alias("to_out"), F.when(~F.col("inside"), places("low_in")).alias("to_in"),
    )
    common = rows.select("pivot", F.explode("differs").alias("part")).groupBy("pivot", "part").agg(F.count("*").alias("n")).filter("n > 1")
    own = Window.partitionBy("pivot", "cls")
    ranked = parts.join(common, ["pivot", "part"]).withColumn("alone", F.col("size") - F.count("*").over(own))
    ranked = ranked.withColumn("place", F.row_number().over(own.orderBy("n", "part")) + F.col("alone"))
    found = scratch.save(ranked.filter(F.col("place") <= F.greatest("to_out", "to_in")).drop("alone", "n", "size"), f"{name}-places")
    one = found.filter(F.col("place") <= F.col("to_out"))
    other = found.filter(~F.col("inside"))
    kept = ("cls", "component", "far", "inside", "excess", "place", "to_out", "to_in")
    left = one.select("pivot", "part", *(F.col(c).alias(f"a_{c}") for c in kept))
    right = other.select("pivot", "part", *(F.col(c).alias(f"b_{c}") for c in kept))
    across = F.col("a_inside") & (F.col("b_place") <= F.col("b_to_in"))
    outside = ~F.col("a_inside") & (F.col("b_place") <= F.col("b_to_out")) & (F.col("a_cls") < F.col("b_cls")) & (F.col("a_component") != F.col("b_component"))
    window = F.abs(F.col("a_far") - F.col("b_far")) <= rule.radius + 1e-9
    met = left.join(right, ["pivot", "part"]).filter((across | outside) & window)
    pairs = sure.select("pivot", F.col("cls").alias("a"), F.col("low.cls").alias("b")).unionByName(
        met.select("pivot", F.col("a_cls").alias("a"), F.col("b_cls").alias("b"))
    )
    return pairs.select("pivot", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), rows


@dataclass(frozen=True)
class Joined:
    documents: DataFrame  # doc_id, n_shingles, class_id, component_id, cls (class key), component (smallest class key, null without words)
    links: DataFrame  # a, b (classes), both, either; enough to connect every component


def join(docs: DataFrame, scratch: Scratch, rule: Rule = Rule(), id: str = "doc_id", text: str = "text") -> Joined:
    """Join all documents with themselves at a Jaccard similarity of ``percent`` of ``words``-word shingles."""
    members = scratch.save(_documents(docs, rule, id, text), "jaccard-documents")
    clash = F.raise_error(F.lit("two shingle sets have one class key"))
    classes = (
        members.filter("n_shingles > 0").groupBy("cls")
        .agg(F.min("doc_id").alias("doc"), F.min("proof").alias("low"), F.max("proof").alias("high"))
        .select("cls", F.when(F.col("low") == F.col("high"), F.col("doc")).otherwise(clash).alias("doc"))
    )
    classes = scratch.save(classes, "jaccard-classes")
    shared = scratch.save(_shared(_parts(docs, rule, text)), "jaccard-shared")
    regions = scratch.save(_regions(shared), "jaccard-regions")
    sets = scratch.save(_sets(docs, classes.join(regions.select("cls").distinct(), "cls", "left_semi"), rule, id, text), "jaccard-sets")

    # The first round: every region has one pivot, and every class meets that of its largest region.
    best = regions.groupBy("region").agg(F.max(F.struct("central", "cls")).alias("top"), F.count("*").alias("of")).select("region", F.col("top.cls").alias("pivot"), "of")
    starred = scratch.save(regions.join(best, "region"), "jaccard-starred")
    largest = starred.filter("cls != pivot").groupBy("cls").agg(F.max(F.struct("of", "pivot")).alias("m"))
    met = scratch.save(_measure(largest.select(F.col("cls").alias("a"), F.col("m.pivot").alias("b")), sets), "jaccard-measured-first")
    links = met.filter(_linked(rule))
    labels = components(links, scratch, "jaccard-components-first")
    # The second: in regions that still hold several components, the pivot meets the members of the others.
    opened = scratch.save(_open(starred.select("region", "cls", "central", "pivot"), labels, "pivot"), "jaccard-open-first")
    home = labels.select(F.col("cls").alias("pivot"), F.col("component").alias("home"))
    apart = opened.filter("cls != pivot").join(home, "pivot", "left").filter(F.col("component") != F.coalesce("home", "pivot"))
    pairs = apart.select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct().join(met, ["a", "b"], "left_anti")
    measured = scratch.save(met.unionByName(_measure(pairs, sets)), "jaccard-measured-0")
    links = measured.filter(_linked(rule))
    labels = components(links, scratch, "jaccard-components-0")
    distance = 1 - F.col("both") / F.col("either")
    near = measured.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), distance.alias("far"))
    # Pivots are done, they met the whole region. Where others are within 2 r of the pivot on average, windows of 2 r take
    # most of them into every region and can't divide it.
    rest = opened.filter("cls != pivot").join(near, ["cls", "pivot"], "left").select("region", "cls", "central", "pivot", "far")
    narrow = F.coalesce(F.col("reach"), F.lit(0.0)) <= 2 * rule.radius + 1e-9
    level = 0
    todo = scratch.save(_open(rest, labels, "pivot").withColumn("narrow", narrow), "jaccard-open-0")
    while not todo.isEmpty():
        level += 1
        small = (F.col("members") <= rule.leaf) | F.col("narrow")
        leaf_pairs, differences = _candidates(todo.filter(small).select("pivot", "cls", "component"), labels, sets, rule, scratch, f"jaccard-leaves-{level}")
        large = todo.filter(~small).drop("pivot").withColumn("slot", F.pmod(F.xxhash64("cls"), F.lit(rule.pivots)))
        tops = large.groupBy("region", "slot").agg(F.max(F.struct("central", "cls")).alias("top")).select("region", F.col("top.cls").alias("pivot"))
        tops = scratch.save(tops, f"jaccard-pivots-{level}")
        to_pivots = large.join(tops, "region").filter("cls != pivot")
        pairs = to_pivots.select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
        measured = scratch.save(_measure(pairs, sets).unionByName(_measure_by_differences(leaf_pairs, differences)), f"jaccard-measured-{level}")
        links = scratch.save(links.select("a", "b", "both", "either").unionByName(measured.filter(_linked(rule))), f"jaccard-links-{level}")
        labels = components(links, scratch, f"jaccard-components-{level}")
        # Voronoi regions of the pivots, with copies in the windows; pivots are done, they met the whole region.
        near = measured.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), distance.alias("gap")).dropDuplicates(["cls", "pivot"])
        plain = large.select("region", "cls", "central", "members").join(tops.withColumnRenamed("pivot", "cls"), ["region", "cls"], "left_anti")
        all_gaps = plain.join(tops, "region").join(near, ["cls", "pivot"])
        closest = all_gaps.groupBy("region", "cls").agg(F.min("gap").alias("home"))
        placed = (
            all_gaps.join(closest, ["region", "cls"]).filter(F.col("gap") <= F.col("home") + 2 * rule.radius + 1e-9)
            .select(F.xxhash64("region", "pivot").alias("region"), "cls", "central", F.col("gap").alias("far"), "pivot", F.col("members").alias("before"))
        )
        stuck = F.col("members") * 10 > F.col("before") * 9
        todo = scratch.save(_open(placed, labels, "pivot", "before").withColumn("narrow", narrow | stuck), f"jaccard-open-{level}")

    named = classes.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    known = named.join(smallest, "component").select("cls", F.col("doc").alias("class_id"), "component_id", "component")
    empty = F.col("n_shingles") == 0
    documents = members.join(known, "cls", "left").select(
        "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "cls", "component",
    )
    return Joined(documents, links)


def class_key(words: int):
    """A column function: the class key of a text's shingle set."""

    @F.arrow_udf("long")
    def key(text: pa.Array) -> pa.Array:
        keys = np.zeros(len(text), np.int64)
        for row, found in shingle_sets(text, words):
            keys[row] = _keys(mix(found ^ _KEY))[0]
        return pa.array(keys)

    return key


def keep_one(docs: DataFrame, scratch: Scratch, rule: Rule = Rule(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one document with the smallest id stays.

    Columns stay as they are. Of rows that share that id the one with the smallest class key stays, and of components
    without any id too. Documents without words stay, those that agree in id once.
    """
    joined = join(docs, scratch, rule, id, text).documents
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "cls")).alias("first")
    chosen = joined.filter("n_shingles > 0").groupBy("component").agg(first).select("first.doc_id", "first.cls")
    chosen = chosen.unionByName(joined.filter("n_shingles = 0").select("doc_id", "cls").distinct())
    key, of = (unused(docs, name) for name in ("kept", "class"))
    chosen = chosen.select(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "cls").alias(key))
    named = docs.withColumn(of, class_key(rule.words)(F.col(text)))
    own = F.struct(F.col(id).isNull().alias("none"), F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(of).alias("cls"))
    return named.withColumn(key, own).join(chosen, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
