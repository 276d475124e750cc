"""Operators that judge, count, encode or fingerprint single documents."""

import base64
import random
import zlib

import brute
import compare
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from linetally.llm import byte_bpe, fingerprints, oracle, pretokens, quality, queries, token_counts, token_files
from linetally.llm.mph import PerfectHash
from linetally.llm.store import fresh_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def random_texts(n=3000):
    rng = random.Random(1)
    parts = ["a", "The", " ", " ", "  ", "\n", "\t", "▁", "é", "'s", "12", "½", "中", "😀", "́", " ", " "]
    parts += ["\x1c", "\x85", "\x00", "###", "<|endoftext|>", "</s>", "\r", "_", "​", "\ufdd0", "İ", "᠎", "word"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return brute.documents(spark, sf_dir).text.tolist() + random_texts()


def test_chunks_rejoin(texts):
    chunks = pretokens.all_chunks(pa.array(texts))
    assert chunks.join(chunks.distinct, 1) == [text.encode() for text in texts]
    assert chunks.sum([len(x) for x in chunks.distinct]).tolist() == [len(text.encode()) for text in texts]
    assert pretokens.plain_texts(pa.array(texts)).sum() > 1000
    assert pretokens.all_chunks(pa.array([], pa.string())).join([], 2) == []


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n if n % 7 else None for n in range(50)])})
    for size in (1, 40, 10_000):
        parts = list(pretokens.text_slices(batch, size))
        assert pa.Table.from_batches([p for p, _ in parts]).column("text").to_pylist() == batch.column("text").to_pylist()
        assert all(len(t) == 1 or sum(map(len, t.to_pylist())) <= size for _, t in parts)
        assert [x for _, t in parts for x in t.to_pylist()] == [x or "" for x in batch.column("text").to_pylist()]


def test_memo_is_bounded_and_keeps_fixed_and_early_entries():
    memo = pretokens.Memo(lambda new: [x.upper() for x in new], capacity=2, fixed={b"f": b"F"})
    for some in ([b"a", b"b"], [b"c"], [b"d", b"a"], []):
        assert memo.values_of(some) == [x.upper() for x in some]
    assert list(memo) == [b"f", b"a", b"d"] and memo[b"f"] == b"F"


# op1


def sql_over(rows, sql):
    """The oracle over rows instead of the test tables."""
    import duckdb

    con = duckdb.connect()
    con.register("given", rows.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    con.execute("create view documents as select * from given")
    return compare.duck_rows(con, sql)[1]


def test_quality_matches_sql(spark, sf_dir):
    sql = oracle.quality_sql()
    assert compare.assert_same(queries.op1_quality_rules(spark, sf_dir), compare.connect(sf_dir), sql) == 1000


def test_quality_awkward(spark):
    rows = brute.awkward(spark)
    fences = quality.Fences(prior=2)
    got = compare.spark_rows(quality.quality_verdicts(rows, fences))[1]
    assert got == sql_over(rows, oracle.quality_sql(fences))
    kept = quality.keep_good(rows, fences)
    assert kept.columns == rows.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    names = compare.spark_rows(quality.quality_verdicts(rows, fences))[0]
    place = {name: i for i, name in enumerate(names)}
    want = [r for r in got.elements() if r[place["kept"]]]
    assert ids == sorted((r[place["doc_id"]] is None, r[place["doc_id"]]) for r in want)


def test_quality_empty(spark):
    assert quality.quality_verdicts(brute.empty(spark)).count() == 0
    assert quality.keep_good(brute.empty(spark)).count() == 0


def test_quality_keeps_good_and_finds_junk(spark):
    verdicts = queries.op1_quality_rules(spark, "/root/testdata/sf0.1").where("not base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = {(r.quality, r.kept): r["count"] for r in verdicts.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) == 0
    assert found[(0, False)] > 30 * found.get((0, True), 0)


@pytest.mark.parametrize("n", [30, 150, 199, 200, 250])
def test_a_source_of_its_own_kind_is_judged_by_itself_at_any_size(spark, n):
    """A table with symbols everywhere among prose without any, and junk inside the prose."""
    rng = random.Random(n)

    def words(between=" "):
        return between.join(str(rng.choice(["plain", "words", "of", "a", "quiet", "text", "go", "on"])) + str(rng.randrange(99)) for _ in range(60))

    rows = [(i, words(), "en", f"s{i % 3}", 0) for i in range(900)]
    rows += [(1000 + i, words(" | "), "en", "tables", 0) for i in range(n)]
    rows += [(5000 + i, words(" ## "), "en", "s1", 0) for i in range(3)]
    verdicts = quality.quality_verdicts(spark.createDataFrame(rows, brute.SCHEMA))
    kept = {r.doc_id: r.kept for r in verdicts.where("not base_failed").collect()}
    assert len(kept) == len(rows)
    assert all(kept[i] == (i < 5000) for i in kept)


def test_registered_groups_have_fences_of_their_own(spark, sf_dir):
    measured = quality._small(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    groups = measured.where("not base_failed").select("lang", "source").distinct().count()
    fences = quality.adaptive_fences(measured)
    assert fences.count() == groups > 50
    assert fences.drop("of_source").distinct().count() > fences.select("of_lang").distinct().count()


def test_sketches_merge(spark, sf_dir):
    measured = quality._small(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    whole = quality.merge_sketches(quality.rate_sketches(measured), [])
    halves = [quality.merge_sketches(quality.rate_sketches(measured.where(f"doc_id % 2 = {i}")), []) for i in (0, 1)]
    assert brute.multiset(whole.collect()) == brute.multiset(quality.merge_sketches(halves[0].unionByName(halves[1]), []).collect())


# op2


@pytest.fixture
def uncoalesced(spark):
    """As many ranges as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_third_of_documents_without_doc_id_spreads_over_ranges(spark, uncoalesced):
    docs = spark.range(3_000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "concat(id * 7919 % 3001, ' some text.') as text")
    schema = "doc_id long, part int"

    def visit(rows, following):
        from pyspark import TaskContext

        here = TaskContext.get().partitionId()
        return pa.table({"doc_id": rows.column("doc_id"), "part": pa.array([here] * rows.num_rows, pa.int32())})

    found = fingerprints.with_next(docs, visit, schema, 100)
    sizes = [r["count"] for r in found.where("doc_id is null").groupBy("part").count().collect()]
    assert sum(sizes) == 1_000 and len(sizes) >= 3 and max(sizes) < 600


def versions(rows):
    """What op2 should return for (doc_id, text) in its order."""
    texts = [text or "" for _, text in rows]
    out = []
    for (doc_id, _), text, after in zip(rows, texts, texts[1:] + texts[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        cut = [fingerprints.PIECE.findall(x) for x in (text, changed, after)]
        out.append((doc_id, len(text), brute.sha(changed), brute.jaccard(cut[0], cut[1]), brute.jaccard(cut[0], cut[2])))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]


@pytest.mark.parametrize("per_bucket", [1, 37, 1000])
def test_fingerprints_recover_all_differences(spark, sf_dir, per_bucket, uncoalesced):
    docs = brute.documents(spark, sf_dir)
    got = fingerprints.version_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"), per_bucket).collect()
    rows = list(zip(docs.doc_id[::-1].tolist(), docs.text[::-1].tolist(), strict=True))
    assert brute.multiset([r[c] for c in COLUMNS] for r in got) == brute.multiset(versions(rows))
    by_id = {r.doc_id: r for r in got}
    prints = {text: by_id[i].fingerprint for i, text in rows}
    assert all(by_id[i].fingerprint == prints[text] for i, text in rows)
    assert len(set(prints.values())) == len(prints)


@pytest.mark.parametrize("per_bucket", [1, 5])
def test_fingerprints_awkward(spark, per_bucket, uncoalesced):
    rows = brute.awkward(spark)
    given = sorted(
        ((r.doc_id, r.text) for r in rows.collect()),
        key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()),
    )
    got = fingerprints.version_fingerprints(rows, per_bucket).collect()
    assert brute.multiset([r[c] for c in COLUMNS] for r in got) == brute.multiset(versions(given))
    assert fingerprints.version_fingerprints(brute.empty(spark)).count() == 0
    one = fingerprints.version_fingerprints(rows.where("doc_id = 5")).first()
    assert one.near_next == 1.0 and one.near_edited < 1.0


def test_sketch_retries_larger():
    rng = np.random.default_rng(5)
    shared, a, b = (rng.integers(0, 2**63, n).astype(str).tolist() for n in (50, 300, 200))
    texts = [". ".join(shared + a) + ".", ". ".join(shared + b) + "."]
    digests = fingerprints.Digests.of(texts)
    pair, found, signs = fingerprints.differences(digests, np.array([0]), np.array([1]))
    values = [set(digests.values[digests.owner == i].tolist()) for i in (0, 1)]
    assert set(found[signs > 0].tolist()) == values[0] - values[1]
    assert set(found[signs < 0].tolist()) == values[1] - values[0]
    small = fingerprints.Sketches.of(digests, 4)
    left, right = (fingerprints.Sketches.of(digests.pick(np.array([i])), 4) for i in (0, 1))
    assert not left.minus(right).peel()[3].any() and len(small.strings()) == 2


# op3


def test_token_counts_match_library(spark, sf_dir):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), brute.awkward(spark)):
        want = []
        for r in docs.select("doc_id", "text").collect():
            n = len(library.encode(r.text or ""))
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 4096))
        assert brute.multiset(token_counts.count_tokens(docs, MODEL).collect()) == brute.multiset(want)
        assert brute.multiset(token_counts.count_tokens(docs, MODEL, table_size=3).collect()) == brute.multiset(want)
    assert token_counts.count_tokens(brute.empty(spark), MODEL).count() == 0


def test_token_chunks_add_up(texts):
    odd = ["", " ", "  ", " \n ", "▁", " ▁a", "a▁ b", "a \n\n  b\t", "\n", "x" * 3000, " ▁ "]
    whole = [len(ids) for ids in token_counts._processor(MODEL).encode([*texts, *odd], num_threads=1)]
    chunks = token_counts._chunks(pa.array([*texts, *odd]))
    assert chunks.sum(token_counts.chunk_lengths(MODEL, chunks.distinct)).tolist() == whole


# op6


def test_byte_bpe_matches_library_and_round_trips(texts):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    for text, ids in zip(texts, codec.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_byte_bpe_every_token_round_trips():
    codec = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    every = np.arange(len(byte_bpe.read_ranks(RANKS)), dtype="<u4")
    assert codec.decode(every.tobytes()) == b"".join(byte_bpe.read_ranks(RANKS))


def test_byte_bpe_query(spark, sf_dir):
    codec = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), brute.awkward(spark), brute.empty(spark)):
        rows = docs.select("doc_id", "text").collect()
        ids = codec.encode(pa.array([r.text or "" for r in rows], pa.string()))
        want = [(r.doc_id, len(x) // 4, brute.sha(x), brute.sha(r.text or "")) for r, x in zip(rows, ids, strict=True)]
        got = byte_bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN)
        assert brute.multiset(got.collect()) == brute.multiset(want)


# op7


def test_library_encoder_matches_library(texts):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(JSON), token_files.LibraryEncoder(JSON)
    for text, ids, got in zip(texts, library.encode_batch(texts, add_special_tokens=False), encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == ids.ids, text
    other = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(other), token_files.LibraryEncoder(other)
    for text, ids, got in zip(texts, library.encode_batch(texts, add_special_tokens=False), encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == ids.ids, text


def test_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-(2**63), 2**63, n, dtype=np.int64))
        index = PerfectHash.build(keys)
        assert sorted(index.find(keys).tolist()) == list(range(len(keys)))
        foreign = np.setdiff1d(rng.integers(-(2**63), 2**63, 10_000, dtype=np.int64), keys)
        assert (index.find(foreign) >= 0).sum() <= 1
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1]))


def test_a_lookup_does_not_grow_with_the_keys():
    """Time of single lookups, best of many, at a thousand and at a million keys."""
    import time

    rng, best = np.random.default_rng(4), {}
    for n in (1_000, 1_000_000):
        keys = np.unique(rng.integers(-(2**63), 2**63, n, dtype=np.int64))
        row = token_files.block_row(0, 0, 0, keys.tolist(), [b"ab"] * len(keys), 2)
        block = token_files.Block(pa.RecordBatch.from_pylist([row]), 0)
        times = []
        for key in rng.choice(keys, 300):
            start = time.perf_counter()
            found = block.documents(np.array([key]))[1]
            assert block.ids(int(found[0])) == [25185]
            times.append(time.perf_counter() - start)
        best[n] = np.quantile(times, 0.2)
    assert best[1_000_000] < 3 * best[1_000]


def test_one_doc_id_spreads_over_shards(spark):
    rows = spark.range(4_000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 5L, id)) as doc_id", "concat(id * 7919 % 4001, ' text') as text")
    path = fresh_path(spark, "token-files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_files.write_token_files(rows, path, JSON, end_id=2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    blocks = token_files.read_blocks(spark, path)
    assert blocks.where("nulls > 0").select("shard").distinct().count() > 1
    assert blocks.where("low <= 5 and high >= 5").select("shard").distinct().count() > 1
    digests = token_files.document_digests(spark, path).collect()
    assert len(digests) == 4_000 and sorted(r.start for r in digests)[0] == 0
    found = token_files.lookup(spark, path, spark.createDataFrame([(5,), (8,)], "doc_id long")).collect()
    assert sorted(r.doc_id for r in found) == [5] * 1_334 + [8]


@pytest.mark.parametrize("block_ids", [500, token_files.BLOCK_IDS])
def test_token_files(spark, sf_dir, block_ids, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "BLOCK_IDS", block_ids)
    library = Tokenizer.from_file(JSON)
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), brute.awkward(spark), brute.empty(spark)):
        rows = docs.select("doc_id", "text").collect()
        rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id, r.text is not None, (r.text or "").encode()))
        want, ids_of, start = [], {}, 0
        for r, x in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False), strict=True):
            ids = [*x.ids, 2]
            want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            ids_of.setdefault(r.doc_id, []).append(ids)
            start += len(ids)
        path = fresh_path(spark, "token-files")
        token_files.write_token_files(docs, path, JSON, end_id=2)
        assert brute.multiset(token_files.document_digests(spark, path).collect()) == brute.multiset(want)
        asked = [k for k in ids_of if k is not None][::7]
        keys = spark.createDataFrame([(k,) for k in [*asked, 10**9, -4, None]], "doc_id long")
        found = token_files.lookup(spark, path, keys).collect()
        assert sorted((r.doc_id, r.ids) for r in found) == sorted((k, ids) for k in asked for ids in ids_of[k])


def test_token_files_query(spark, sf_dir):
    rows = queries.op7_token_files(spark, sf_dir).collect()
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert len(rows) == 1000 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
