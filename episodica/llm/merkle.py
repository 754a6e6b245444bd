"""A Merkle manifest of a dataset: leaves of rows, a tree per group, a tree over the groups' roots, and proofs.

Leaves are numbered by a range partitioning, then cut into superblocks of consecutive ones. On the way up a superblock
shrinks to its top node, and tops are cut into superblocks again until each group has one node. On the way down the
nodes of a layer are cogrouped with the outer nodes of their superblock (the proof of its top), so that reduction,
proofs and folding of a superblock happen in one place, whose size is bounded whatever the group.

Edge cases: null values have a mark of their own in the digest; null groups come first; rows with a null id come first
in their group, and rows that agree in group and id are ordered by their leaf, so a manifest doesn't depend on the order
of rows; equal rows are leaves each; texts of any length are hashed whole; an empty table has no leaves and no root;
columns that are not named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.session import Scratch


@dataclass(frozen=True)
class Shape:
    """Every ``fan`` consecutive nodes have one parent; a superblock is ``levels`` deep."""

    fan: int = 2
    levels: int = 12

    @property
    def block(self) -> int:
        return self.fan**self.levels


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """The digest of a row: each value as its byte count and its text, null as a dash."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(v) for v in values]).cast("binary"), 256)


def levels_of(nodes: list[str], shape: Shape, most: int | None = None) -> list[list[str]]:
    """All levels of a tree, from its nodes up: to one node, or ``most`` levels where others join it later."""
    levels = [nodes]
    while len(levels) <= most if most is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + shape.fan]) for i in range(0, len(below), shape.fan)])
    return levels


def steps_to_top(levels: list[list[str]], at: int, shape: Shape) -> list[str]:
    """A proof: per level the place among its siblings and their digests, as ``place:digests``."""
    steps = []
    for nodes in levels[:-1]:
        first = at - at % shape.fan
        siblings = nodes[first:at] + nodes[at + 1 : first + shape.fan]
        steps.append(f"{at - first}:{''.join(siblings)}")
        at //= shape.fan
    return steps


def fold(node: str, steps: list[str]) -> str:
    """The root that a node and its proof lead to."""
    for step in steps:
        place, siblings = step.split(":")
        cut = 64 * int(place)
        node = digest(siblings[:cut], node, siblings[cut:])
    return node


def proof_digest(steps: list[str]) -> str:
    return digest(*(step.split(":")[1] for step in steps))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their partition and their number in the run of their group (the first column)."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0)
        codes = group.dictionary_encode().indices.to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        nth = np.arange(len(codes)) - np.repeat(begins, np.diff(np.append(begins, len(codes))))
        if group[0].as_py() == last:
            first = begins[1] if len(begins) > 1 else len(codes)
            nth[:first] += seen
        last, seen = group[len(codes) - 1].as_py(), int(nth[-1]) + 1
        added = [pa.array(np.full(len(codes), part), pa.int32()), pa.array(nth, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "part", "nth"])


def placed(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """Rows with ``at``, their place in their group ``g`` by ``order``, and ``size``, the group's; and the largest size.

    ``rows`` is a saved table whose first column is ``g``. A number of its own ends the order, so a partition ends
    anywhere, also among rows that agree in everything.
    """
    named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    keys = ["g", *order, "uid"]
    ranged = rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = scratch.save(ranged.drop("uid").mapInArrow(_number, f"{named}, part int, nth long"), f"{name}-numbered")
    counts = scratch.save(numbered.groupBy("g", "part").agg(F.count("*").alias("n")), f"{name}-counts")
    bases = counts.selectExpr("g", "part", "sum(n) OVER (PARTITION BY g ORDER BY part) - n AS base", "sum(n) OVER (PARTITION BY g) AS size")
    largest = counts.groupBy("g").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    found = numbered.join(bases, ["g", "part"]).withColumn("at", F.col("base") + F.col("nth")).drop("part", "nth", "base")
    return found, largest


def _blocks(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / F.lit(shape.block)).cast("long"))


def _depth(size: int, shape: Shape) -> int | None:
    """Levels of a superblock: all of them where its group has others, else as many as lead to one node."""
    return shape.levels if size > shape.block else None


def tops(nodes: DataFrame, shape: Shape) -> DataFrame:
    """The nodes that superblocks shrink to, as nodes of the next layer: g, at, size, digest."""

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        rows, size = rows.sort_values("at"), int(rows["size"].iloc[0])
        levels = levels_of(rows["digest"].tolist(), shape, _depth(size, shape))
        return pd.DataFrame({"g": rows["g"].iloc[:1], "at": rows["block"].iloc[:1], "size": -(-size // shape.block), "digest": levels[-1][0]})

    slim = _blocks(nodes.select("g", "at", "size", "digest"), shape)
    return slim.groupBy("g", "block").applyInPandas(top, "g string, at long, size long, digest string")


def layers(nodes: DataFrame, largest: int, shape: Shape, scratch: Scratch, name: str) -> list[DataFrame]:
    """The nodes, the tops of their superblocks, and so on; the last has one node per group."""
    found = [nodes]
    while len(found) == 1 or largest > 1:
        found.append(scratch.save(tops(found[-1], shape), f"{name}-layer-{len(found)}"))
        largest = -(-largest // shape.block)
    return found


OUTER = "g string, at long, steps array<string>, subroot string, root string"


def joined_proofs(nodes: DataFrame, outer: DataFrame, shape: Shape) -> DataFrame:
    """OUTER for every node of a layer, from the proofs of the next layer's nodes."""

    def proofs(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        levels = levels_of(rows["digest"].tolist(), shape, _depth(int(rows["size"].iloc[0]), shape))
        above = above.iloc[0]
        steps = [steps_to_top(levels, i, shape) + list(above["steps"]) for i in range(len(rows))]
        return pd.DataFrame({"g": rows["g"], "at": rows["at"], "steps": steps, "subroot": above["subroot"], "root": above["root"]})

    slim = _blocks(nodes.select("g", "at", "size", "digest"), shape)
    return slim.groupBy("g", "block").cogroup(outer.groupBy("g", "at")).applyInPandas(proofs, OUTER)


def verified_leaves(nodes: DataFrame, outer: DataFrame, shape: Shape) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root of every leaf; folded from ``fake`` where there is one."""

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        levels = levels_of(rows["digest"].tolist(), shape, _depth(int(rows["size"].iloc[0]), shape))
        above = above.iloc[0]
        proofs = [steps_to_top(levels, i, shape) + list(above["steps"]) for i in range(len(rows))]
        shown = [fake if isinstance(fake, str) else node for node, fake in zip(rows["digest"], rows["fake"])]
        return pd.DataFrame(
            {
                "id": rows["id"], "leaf": rows["digest"], "subroot": above["subroot"], "root": above["root"],
                "proof_sha256": [proof_digest(p) for p in proofs], "folded_root": [fold(n, p) for n, p in zip(shown, proofs)],
            }
        )

    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _blocks(nodes, shape).groupBy("g", "block").cogroup(outer.groupBy("g", "at")).applyInPandas(finish, schema)


def manifest(
    docs: DataFrame,
    scratch: Scratch,
    columns: list[str],
    shape: Shape = Shape(),
    id: str = "doc_id",
    group: str = "lang",
    shown: tuple[Column, dict[str, Column]] | None = None,
) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``columns`` go into the leaf. ``shown`` is a condition and the values of columns as a verifier sees them where it holds;
    their leaf is folded instead of the original with the original siblings.
    """
    text = F.col(group).cast("string")
    rows = docs.select(
        F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text)).alias("g"),
        F.col(id).alias("key"),
        leaf([F.col(c) for c in columns]).alias("digest"),
        (F.when(shown[0], leaf([shown[1].get(c, F.col(c)) for c in columns])) if shown else F.lit(None).cast("string")).alias("fake"),
    )
    leaves, largest = placed(scratch.save(rows, "merkle-leaves"), ["key", "digest"], scratch, "merkle")
    leaves = leaves.withColumn("id", F.col("key").cast("string")).drop("key")
    trees = layers(leaves, largest, shape, scratch, "merkle")
    subroots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), "digest")
    ordered, count = placed(scratch.save(subroots, "merkle-subroots"), ["of"], scratch, "merkle-top")
    ordered = scratch.save(ordered, "merkle-top")
    crown = layers(ordered, count, shape, scratch, "merkle-top")
    none = F.array().cast("array<string>").alias("steps")
    outer = crown[-1].select("g", "at", none, F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(crown[:-1]):
        outer = joined_proofs(nodes, outer, shape)
    outer = outer.join(ordered.withColumnRenamed("digest", "is"), ["g", "at"])
    outer = scratch.save(outer.select(F.col("of").alias("g"), F.lit(0).cast("long").alias("at"), "steps", F.col("is").alias("subroot"), "root"), "merkle-outer")
    for nodes in reversed(trees[1:-1]):
        outer = joined_proofs(nodes, outer, shape)
    found = verified_leaves(leaves, outer, shape)
    return found.withColumns({"id": F.col("id").cast(docs.schema[id].dataType), "verified": F.col("folded_root") == F.col("root")})
