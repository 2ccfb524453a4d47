"""Near duplicates against a comparison of all pairs that share a shingle."""

import random

import brute
import numpy as np

from lapsewise.llm import minhash
from lapsewise.llm.queries import QUERIES


def check(rows, documents):
    wanted = brute.near_components(documents)
    sizes = {i: len(brute.shingle_set(t)) for i, t in documents}
    assert len(rows) == len(documents)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], wanted[r.doc_id], r.doc_id == wanted[r.doc_id])


def test_query(spark, sf_dir, documents):
    check(QUERIES["op3_minhash_b_bit"](spark, sf_dir).collect(), documents)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_group_of_near_copies_in_blocks(spark, monkeypatch):
    """A group whose similarities lie on both sides of the threshold, with blocks of a few members."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 4000)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    documents = [(i, edited(rng, base, rng.randrange(1, 7))) for i in range(150)]
    documents += [(150 + i, edited(rng, documents[i][1].split(), 4)) for i in range(0, 100, 2)]
    documents += [(400 + i, " ".join(f"v{rng.randrange(999)}" for _ in range(60))) for i in range(30)] + [(500, documents[3][1].upper())]
    table = spark.createDataFrame(documents, "doc_id long, text string")
    check(minhash.near_duplicates(table).collect(), documents)


def test_estimate_follows_the_similarity(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)] + [edited(rng, base, n) for n in (2, 8, 20, 60)]
    shingle, n = minhash.shingle_sets(texts)
    _, _, packed = minhash.sketches(shingle, n)
    names = [f"{side}{s}" for side in "ab" for s in minhash.PACKED]
    rows = [[i, *packed[0].tolist(), *packed[i].tolist()] for i in range(len(texts))]
    table = spark.createDataFrame(rows, ", ".join(["i int", *(f"{c} long" for c in names)]))
    sets = [brute.shingle_set(t) for t in texts]
    for r in table.select("i", minhash.estimate("a", "b").alias("e")).collect():
        assert abs(r.e - len(sets[0] & sets[r.i]) / len(sets[0] | sets[r.i])) < 0.17


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r.node: r.label for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_odd_documents(spark, odd_documents, no_documents):
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(odd_documents).collect()}
    assert rows[None, 2] == rows[None, 0] == (None, True)
    assert rows[1, 0] == (1, True) and rows[2, 0] == (2, True)
    assert rows[3, 1] == (3, True) and rows[4, 1] == (3, False) and rows[5, 1] == (5, True) and rows[6, 1] == (6, True)
    assert minhash.near_duplicates(odd_documents).count() == odd_documents.count()
    assert minhash.near_duplicates(no_documents).collect() == []


def test_low_bits_are_those_of_the_minima():
    shingle, n = minhash.shingle_sets(["a b c d e f g", "", "x"])
    assert n.tolist() == [4, 0, 1]
    sums, bands, packed = minhash.sketches(shingle, n)
    assert sums.shape == (2, 2) and bands.shape == (2, minhash.BANDS) and packed.shape == (2, len(minhash.PACKED))
    assert len(np.unique(bands)) == 2 * minhash.BANDS


def test_texts_without_a_mark_are_left_out_before_the_shuffle(spark):
    docs = spark.range(-5, 3000).selectExpr("id AS doc_id", "concat('a b c d e ', id) AS text")
    wanted = docs.where("doc_id % 7 = 0").select("doc_id")
    assert minhash.marked(wanted, 1 << 20).count() == 32
    rows = minhash.sets_of(docs, wanted, 4)
    assert "bitmap_construct_agg" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["node"] for r in rows.collect()) == list(range(0, 3000, 7))


def test_marks_are_read_before_the_ids_are_joined(spark):
    """The join by doc_id, which may shuffle the texts, stands above the one that leaves unmarked texts out."""
    docs = spark.createDataFrame([(i, f"a b c d e {i % 3}") for i in [*range(20), 4, 4]], "doc_id long, text string")
    rows = minhash.sets_of(docs, spark.createDataFrame([(4,), (5,), (99,)], "doc_id long"), 4)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 2 and "doc_id" in joins[0] and "getbit" in joins[1] and "LeftSemi" not in plan
    assert sorted(r["node"] for r in rows.collect()) == [4, 4, 4, 5]


def test_no_plan_holds_a_shared_table_several_times(spark, monkeypatch):
    """What a step reads several times is stored, so that the plans, which the driver holds, stay short."""
    joins, own = {}, minhash.materialise

    def stored(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins[name] = max(joins.get(name, 0), sum("Join " in line for line in plan.splitlines()))
        return own(df, name)

    monkeypatch.setattr(minhash, "materialise", stored)
    found = minhash.components(spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long"))
    assert {r.label for r in found.collect()} == {0} and joins["edges"] == joins["large"] == 1
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    documents = [(i, edited(rng, base, rng.randrange(1, 7))) for i in range(150)]
    check(minhash.near_duplicates(spark.createDataFrame(documents, "doc_id long, text string")).collect(), documents)
    assert joins["links"] <= 4, joins
