"""The pipeline's stages and the registered queries against plain Python, on the 200 documents of the smallest tables."""

import collections
import hashlib
import math
import re
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece

import corpus_pipeline
from episodica.llm import quality, toxicity, warc
from episodica.llm.queries import QUERIES
from episodica.session import Scratch
from tests.llm.test_operators import MODEL, base, components_by_hand

FOLDER = "/root/testdata/sf0.001"


def read(table):
    return pq.read_table(f"{FOLDER}/{table}.parquet").to_pylist()


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output."""
    scratch, rows, out = Scratch(spark), spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = scratch.save(stage(spark, rows, FOLDER), f"test-{number}")
        out[name] = (rows, after)
        rows = after
    return out


def both(stages, name):
    return [[r.asDict() for r in frame.collect()] for frame in stages[name]]


def as_rows(rows):
    return collections.Counter(tuple(sorted(r.items())) for r in rows)


def test_toxicity_stage_keeps_what_the_model_allows(spark, stages):
    before, after = both(stages, "toxicity")
    model = toxicity.fit(stages["toxicity"][0], spark.read.parquet(f"{FOLDER}/labels.parquet"), Scratch(spark))
    scores = [float(model.scores(pa.array([r["text"]], pa.string()))[0]) for r in before]
    assert len(before) == 200 and as_rows(after) == as_rows(r for r, s in zip(before, scores) if s < 0.5)


def test_quality_stage_drops_by_base_rules_and_verdict(spark, stages):
    before, after = both(stages, "quality")
    kept = {r["doc_id"] for r in quality.judge(stages["quality"][0], Scratch(spark)).filter("kept").collect()}
    failed = {r["doc_id"] for r in before for n, _, _, _, again in [base(r["text"])] if n < 20 or 100 * again > 30 * n}
    assert failed and not kept & failed and as_rows(after) == as_rows(r for r in before if r["doc_id"] in kept)


def test_near_duplicate_stage_keeps_the_first_of_each_component(stages):
    before, after = both(stages, "near duplicates")
    first, _ = components_by_hand([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert as_rows(after) == as_rows(r for r in before if first[r["doc_id"]] == r["doc_id"])


def shares(sizes):
    """Targets of sources by raising a level step by step: weights 5, 2, 1 by name, half as much again, twice at most."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), [s for s in order if sizes[s]]
    while open_ and left > 1e-9:
        step = min(left / sum(weight[s] for s in open_), min((2 * sizes[s] - target[s]) / weight[s] for s in open_))
        for s in open_:
            target[s] += step * weight[s]
            left -= step * weight[s]
        open_ = [s for s in open_ if 2 * sizes[s] - target[s] > 1e-9]
    return target


def check_mix(before, repeats):
    sizes = collections.Counter()
    for r in before:
        sizes[r["source"]] += words(r["text"])
    target = shares(sizes)
    for source, size in sizes.items():
        rows = [(words(r["text"]), repeats[r["doc_id"]]) for r in before if r["source"] == source]
        whole = int((target[source] + 1e-6) // size) if size else 0
        assert all(n == 0 if not w else n in (whole, whole + 1) for w, n in rows)
        rest = round(target[source] - 1e-6) - sum(w * n for w, n in rows)
        assert -1 <= rest <= max(w for w, _ in rows)
    return target


def test_mix_stage_repeats_by_target(stages):
    before, after = both(stages, "mix")
    check_mix(before, collections.Counter(r["doc_id"] for r in after))
    assert set(as_rows(after)) <= set(as_rows(before))


def digests(row, model):
    ids = model.encode(row["text"] or "", add_eos=True)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {"doc_id": row["doc_id"], "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))), "decoded_sha256": sha(model.decode(ids))}


def test_pieces_stage_and_query_equal_the_library(spark, stages):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    before, after = both(stages, "pieces")
    assert before and as_rows(after) == as_rows(digests(r, model) for r in before)
    assert as_rows(r.asDict() for r in QUERIES["op6_pieces"](spark, FOLDER).collect()) == as_rows(digests(r, model) for r in read("documents"))


def test_pipeline_is_its_stages(spark, stages):
    assert as_rows(r.asDict() for r in corpus_pipeline.run(spark, FOLDER).collect()) == as_rows(both(stages, "pieces")[1])


def test_mix_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op2_mix_sources"](spark, FOLDER).collect()}
    given = read("documents")
    assert set(rows) == {r["doc_id"] for r in given}
    target = check_mix(given, {i: r["taken"] // r["size"] if r["size"] else 0 for i, r in rows.items()})
    size = collections.Counter()
    for r in given:
        size[r["source"]] += words(r["text"])
    for r in given:
        got = rows[r["doc_id"]]
        assert got["size"] == words(r["text"]) and got["source_size"] == size[r["source"]] and math.isclose(got["target"], target[r["source"]], abs_tol=1e-6)


def test_quality_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, FOLDER).collect()}
    for r in read("documents"):
        got = rows[r["doc_id"]]
        counts = base(r["text"])
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == counts
        assert got["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0]) and not (got["kept"] and got["base_failed"])


def test_top_k_query(spark):
    got = collections.defaultdict(list)
    for r in QUERIES["op4_topk"](spark, FOLDER).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    vectors = [(r["vec_id"], [math.floor(64 * x) for x in r["embedding"]]) for r in read("embeddings")]
    asked = {i: v for i, v in vectors if i % 20 == 0}
    assert set(got) == set(asked)
    for q, v in asked.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)[:20]
        assert got[q] == [(n, s, i) for n, (s, i) in enumerate(best, 1)]


def test_jaccard_query(spark):
    given = [(r["doc_id"], r["text"]) for r in read("documents")]
    first, sizes = components_by_hand(given, 4, 85)
    got = {r["doc_id"]: r for r in QUERIES["op7_jaccard_join"](spark, FOLDER).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (n, first[i]) for (i, _), n in zip(given, sizes)}


@pytest.mark.parametrize("name, parts, held", [("op8_language", 4, 2), ("op10_toxicity", 5, 0)])
def test_held_out_rows(spark, name, parts, held):
    rows = [r.asDict() for r in QUERIES[name](spark, FOLDER).collect()]
    assert {r["doc_id"]: r["held_out"] for r in rows} == {r["doc_id"]: crc(r["doc_id"]) % parts == held for r in read("documents")}
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows if "predicted" in r)


def test_warc_query(spark):
    pages = read("pages")
    last = {}
    for r in pages:
        last[r["html"] or ""] = max(r["page_id"], last.get(r["html"] or "", r["page_id"]))
    expected = []
    for r in pages:
        data, same = (r["html"] or "").encode(), last[r["html"] or ""]
        first = same == r["page_id"]
        expected.append((r["page_id"], len(data), warc.digest(data), "response" if first else "revisit", None if first else same))
    got = QUERIES["op9_warc"](spark, FOLDER).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(expected)
