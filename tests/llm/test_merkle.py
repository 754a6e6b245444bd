"""The manifest against a tree built in one go, for several shapes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from episodica.llm import merkle
from episodica.session import Scratch

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string, g string, at string, digest string, part string"


def shown():
    return (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)), {"n_chars": F.col("n_chars") + 1})


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes, fan):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][i : i + fan]) for i in range(0, len(found[-1]), fan)])
    return found


def walk(tree, at, fan):
    """(siblings before, siblings after) from a node to below the root."""
    for nodes in tree[:-1]:
        first = at - at % fan
        yield nodes[first:at], nodes[at + 1 : first + fan]
        at //= fan


def brute(rows, fan):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([m[2] for m in sorted(groups[g], key=lambda m: m[:3])], fan) for g in names]
    crown = levels([t[-1][0] for t in trees], fan)
    for at, (name, tree) in enumerate(zip(names, trees)):
        for i, member in enumerate(sorted(groups[name], key=lambda m: m[:3])):
            row = member[3]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf((*row[:3], row[3] + 1, row[4])) if tampered and row[3] is not None else member[2]
            proof = []
            for before, after in [*walk(tree, i, fan), *walk(crown, at, fan)]:
                node = H(*before, node, *after)
                proof += before + after
            yield row[0], member[2], tree[-1][0], crown[-1][0], H(*proof), node, node == crown[-1][0]


def documents(n, seed, langs):
    rng = random.Random(seed)
    rows = [(rng.choice([i, i, i, -i]), rng.choice(["a", "ß", None]), rng.choice(langs), rng.choice([i, None]), rng.choice([f"t{i}", "", None, "é漢" * i])) for i in range(n)]
    return rows + [(None, "s", langs[0], 1, "no id"), (None, None, None, None, None), (5, "x", langs[-1], 2, "same"), (5, "x", langs[-1], 2, "same"), (2**60 + 1, "x", "big", 2, "x" * 300_000)]


def order(rows):
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize(("n", "langs", "shape"), [
    (0, ["en"], merkle.Shape()),
    (90, ["en", "de", None, "", "é", "EN"], merkle.Shape()),
    (300, ["en"], merkle.Shape(2, 3)),
    (300, ["en", "en", "en", "de", None], merkle.Shape(2, 2)),
    (200, [f"l{i}" for i in range(60)], merkle.Shape(2, 1)),
    (250, ["en", "fr"], merkle.Shape(3, 2)),
])
def test_equals_one_tree(spark, n, langs, shape):
    rows = documents(n, n, langs)
    table = spark.createDataFrame([(*r, "1", "2", "3", "4") for r in rows], DOCS).repartition(5)
    got = merkle.manifest(table, Scratch(spark), COLUMNS, shape, shown=shown())
    fields = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert order(got.select(fields).collect()) == order(brute(rows, shape.fan))


def test_order_and_partitions_do_not_matter_but_a_change_does(spark):
    rows = documents(60, 1, ["en", "de"])
    table = spark.createDataFrame([(*r, "1", "2", "3", "4") for r in rows], DOCS)
    root = lambda t: {r.root for r in merkle.manifest(t, Scratch(spark), COLUMNS, merkle.Shape(2, 2)).collect()}
    first = root(table.coalesce(1))
    assert len(first) == 1 and root(table.orderBy(F.rand(3)).repartition(6)) == first
    changed = table.withColumn("text", F.when(F.col("doc_id") == 5, "other").otherwise(F.col("text")))
    assert root(changed) != first and root(table.limit(10)) != first


def test_lone_rows_and_empty_table(spark):
    table = spark.createDataFrame([(1, "s", "en", 2, "t", "", "", "", "")], DOCS)
    row = merkle.manifest(table, Scratch(spark), COLUMNS).first()
    assert row.leaf == row.subroot == row.root == leaf((1, "s", "en", 2, "t")) and row.proof_sha256 == H() and row.verified
    assert merkle.manifest(table.limit(0), Scratch(spark), COLUMNS).collect() == []


def test_text_ids(spark):
    table = spark.createDataFrame([(f"d{i}", "en", f"t{i}") for i in range(40)], "name string, kind string, body string")
    rows = merkle.manifest(table, Scratch(spark), ["name", "body"], merkle.Shape(2, 2), id="name", group="kind").collect()
    nodes = [leaf((f"d{i}", f"t{i}")) for i in sorted(range(40), key=lambda i: f"d{i}")]
    assert len(rows) == 40 and {r.root for r in rows} == {levels(nodes, 2)[-1][0]} and all(r.verified for r in rows)


def test_a_hot_group_is_spread_over_superblocks(spark):
    rows = [(i, "s", "en" if i % 3 else f"l{i}", i, "t") for i in range(3000)]
    table = spark.createDataFrame([(*r, "", "", "", "") for r in rows], DOCS)
    scratch = Scratch(spark)
    named = table.select(F.concat(F.lit("="), "lang").alias("g"), F.col("doc_id").alias("key"), F.col("text").alias("digest"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # partitions of so few rows would be merged
    try:
        placed, largest = merkle.placed(scratch.save(named, "rows"), ["key"], scratch, "hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    blocks = merkle._blocks(placed, merkle.Shape(2, 6)).groupBy("g", "block").count()
    assert largest == 2000 and blocks.agg(F.max("count")).first()[0] == 64
    assert scratch.spark.read.parquet(f"{scratch.path}/hot-numbered.parquet").groupBy("part").count().agg(F.max("count")).first()[0] < 1000
