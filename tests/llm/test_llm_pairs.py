"""Operators that compare documents with each other."""

import brute
import compare
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from linetally.llm import oracle, queries, simhash, substrings
from linetally.llm.components import components
from linetally.llm.covering import Covering

# op4


def expected_components(prints, ids):
    group = brute.groups(len(prints), lambda i, j: (int(prints[i]) ^ int(prints[j])).bit_count() <= 4)
    least = {}
    for doc_id, g in zip(ids, group, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [least.get(g) for g in group]


def test_simhash_query(spark, sf_dir):
    docs = brute.documents(spark, sf_dir)
    prints = [brute.simhash(text) for text in docs.text]
    want = zip(docs.doc_id.tolist(), [f"{p:016x}" for p in prints], expected_components(prints, docs.doc_id.tolist()), strict=True)
    assert brute.multiset(queries.op4_simhash(spark, sf_dir).collect()) == brute.multiset(want)


def test_simhash_awkward(spark):
    rows = brute.awkward(spark)
    given = rows.select("doc_id", "text").collect()
    prints = [brute.simhash(r.text) for r in given]
    comps = expected_components(prints, [r.doc_id for r in given])
    want = [(r.doc_id, f"{p:016x}", c) for r, p, c in zip(given, prints, comps, strict=True)]
    assert brute.multiset(simhash.simhash_components(rows).collect()) == brute.multiset(want)
    kept = simhash.one_of_each(rows)
    assert kept.columns == rows.columns
    group = brute.groups(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert kept.count() == len(set(group))
    assert simhash.simhash_components(brute.empty(spark)).count() == 0
    assert simhash.one_of_each(brute.empty(spark)).count() == 0


def test_near_dedup_goes_by_components_not_by_doc_ids(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    rows = [(1, text("a")), (5, text("b")), (5, text("c")), (5, text("a"))]  # two components only 5 is in, and a copy of 1
    rows += [(None, text("a")), (None, text("d")), (None, text("d").upper()), (None, text("e"))]
    rows += [(7, text("f")), (7, text("f")), (9, text("f")), (8, None), (None, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, h1 string")
    assert len({brute.simhash(text(name)) for name in "abcdef"}) == 6
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(r.doc_id, (r.text or "").lower()) for r in kept.collect()]
    want = [(1, "a"), (5, "b"), (5, "c"), (None, "d"), (None, "e"), (7, "f")]
    assert brute.multiset(got) == brute.multiset([*[(i, text(name)) for i, name in want], (8, "")])

    rows = brute.awkward(spark)
    given = rows.select("doc_id", "text").collect()
    prints = [brute.simhash(r.text) for r in given]
    group = brute.groups(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for r, g in zip(given, group, strict=True):
        least[g] = min(least.get(g, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    kept = corpus_pipeline.near_dedup(spark, rows, "")
    assert kept.columns == rows.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(least.values())


@pytest.fixture(scope="module")
def clusters():
    """Chains and clouds of fingerprints around a few centres."""
    rng = np.random.default_rng(0)
    prints = []
    for centre in rng.integers(0, 2**64, 25, dtype=np.uint64):
        for _ in range(12):
            value = int(centre)
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                value ^= 1 << int(bit)
            prints.append(value)
    return prints, expected_components(prints, list(range(len(prints))))


@pytest.mark.parametrize(
    ("parts", "cell_rows", "home_rows"), [(3, 8192, 8192), (3, 4, 100), (3, 4, 2), (2, 8192, 8192), (2, 16, 3), (5, 8, 8)]
)
def test_every_covering_finds_every_link(spark, clusters, parts, cell_rows, home_rows):
    prints, want = clusters
    signed = np.array(prints, np.uint64).astype(np.int64).tolist()
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, print long")
    found = simhash.print_components(rows, Covering(parts, 4), cell_rows, home_rows)
    got = {r.doc_id: r.component_id for r in rows.join(found, "print").collect()}
    assert [got[i] for i in range(len(prints))] == want


def test_covering_code_covers():
    words = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    for parts in (2, 3):
        places, _, homes = Covering(parts, 4).visits(words)
        assert (np.bincount(places[homes]) == parts).all()


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(4).permutation(300).tolist()
    links = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:])] + [(1000, 1001)], "a long, b long")
    got = {r.a: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 300)}, 1001: 1000}


def test_star_of_a_large_group_stays_small(spark):
    base = 0x0F0F0F0F0F0F0F0F
    values = [base] + [base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
    signed = np.array(values, np.uint64).astype(np.int64).tolist()
    rows = spark.createDataFrame([(v,) for v in signed], "print long")
    links = simhash.near_links(rows, Covering())
    assert links.count() < 40 * len(values)  # pairs: 2 million
    assert {r.root for r in components(links).collect()} == {min(signed)}


# op10


def test_substrings_match_sql(spark, sf_dir):
    sql = oracle.substring_sql()
    assert compare.assert_same(queries.op10_substring_dedup(spark, sf_dir), compare.connect(sf_dir), sql) == 1000


@pytest.mark.parametrize("per_group", [1, 3, 500])
def test_substrings_awkward(spark, per_group):
    rows = brute.awkward(spark)
    given = [(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]
    want = brute.removals(given)
    assert brute.multiset(substrings.removals(rows, per_group).collect()) == brute.multiset(want)
    cut = substrings.cut_repeats(rows, per_group)
    assert cut.columns == rows.columns
    words = [(r.doc_id, brute.sha(" ".join(brute.WORD.findall(r.text or "")))) for r in cut.collect()]
    assert brute.multiset(words) == brute.multiset((w[0], w[3]) for w in want)


def test_substrings_deal_one_doc_id_to_many_groups(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(None if i % 3 else 7, f"a{i} {passage} z{i}") for i in range(300)] + [(3, passage), (9, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def size(key, given, told):
        return pa.table({"n": [given.num_rows]})

    sizes = [r.n for r in substrings._removal_pass(docs, size, "n long", 10).collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 40
    got = substrings.removals(docs, 10).collect()
    assert brute.multiset(got) == brute.multiset(brute.removals(rows))


def test_substrings_of_all_alignments(spark):
    passage = [f"p{i}" for i in range(13)]
    rows = [(i, " ".join([f"d{i}x{j}" for j in range(i)] + passage + [f"e{i}"])) for i in range(20)]
    rows += [(100 + i, " ".join([f"f{i}x{j}" for j in range(i)] + passage[:12] + [f"g{i}"])) for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert brute.multiset(substrings.removals(frame, 4).collect()) == brute.multiset(brute.removals(rows))


def test_substrings_empty(spark):
    assert substrings.removals(brute.empty(spark)).count() == 0
    assert substrings.cut_repeats(brute.empty(spark)).count() == 0


def test_substrings_move_texts_once(spark, sf_dir):
    frame = substrings.removals(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2
