"""Table operators on small inputs: WARC, token files, packing, joins, neighbours, rollups."""

import gzip
import io
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from plain import components, shingles
from pyspark.sql import functions as F
from riskmart.llm import common, jaccard, neighbours, packing, rollup, token_store, warc
from riskmart.llm.components import connected
from riskmart.llm.tokens import Encoder, default_vocabulary


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_vocabulary())


def test_ids_are_those_of_the_library(encoder):
    rng = random.Random(5)
    letters = "ab '\n\t\r 's'll12³é ñÀ<|endoftext|>.,!—€ \u0085漢字 K \x1c"
    for n in range(400):
        text = "".join(rng.choice(letters) for _ in range(n % 40))
        ids = encoder.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, repr(text)


TEXTS = [(3, "three three"), (1, "one"), (None, "none"), (2, None), (1, "one again"), (5, ""), (4, "word " * 3000), (6, "one"), (6, "one")]


def test_token_store(spark, documents, encoder):
    folder = common.shared_folder(spark, "store")
    token_store.write_store(documents(TEXTS, extra=("part", "ids")), folder, shard_ids=2000)
    rows = token_store.read_store(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 6]
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids)) and r.ids[-1] == 0
        at += r.n_tokens
    expected = sorted(np.frombuffer(encoder.encode(t or ""), "<u4").tolist() + [0] for _, t in TEXTS)
    assert sorted(list(r.ids) for r in rows) == expected
    checks = token_store.read_store(spark, folder, checksums=True).collect()
    assert sorted(r.ids_crc32 for r in checks) == sorted(zlib.crc32(np.array(i, "<u4").tobytes()) for i in expected)
    some = token_store.fetch(spark, folder, spark.createDataFrame([(4,), (6,), (77,)], "doc_id bigint")).collect()
    assert sorted(r.doc_id for r in some) == [4, 6, 6]
    assert token_store.round_trip(documents([])).count() == 0


def test_token_store_with_a_dictionary(spark, documents):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(900))) for i in range(1200)]
    folder = common.shared_folder(spark, "store")
    token_store.write_store(documents(texts), folder)
    assert len(next(iter(token_store._dictionaries(folder).values()))) > 1000
    assert token_store.read_store(spark, folder).count() == 1200


def check_packed(rows, texts, encoder, length):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
        places[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, t in texts:
        whole = encoder.encode(t or "") + bytes(4)
        own = sorted(pieces[i])
        assert b"".join(p for _, p, _ in own) == whole and {n for _, _, n in own} == {len(whole) // 4}
        assert [s for s, _, _ in own] == [sum(len(p) for _, p, _ in own[:k]) // 4 for k in range(len(own))]
    padding = 0
    for of in places.values():
        at = 0
        for offset, n in sorted(of):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / (padding + sum(n for of in places.values() for _, n in of))


def test_packing(spark, documents, encoder):
    rng = random.Random(2)
    texts = [(i, " ".join("word" for _ in range(rng.randint(0, 400)))) for i in range(400)] + [(1000, None), (1001, "w " * 5000)]
    texts += [(i, "the same text of a few words") for i in range(2000, 2300)]
    rows = packing.pack(documents(texts, extra=("rank", "at", "length")), length=64).collect()
    assert check_packed(rows, texts, encoder, 64) < 0.12
    sequences = packing.sequences(packing.pack(documents(texts), length=64), 64).collect()
    assert all(len(s.ids) == 4 * s.n_tokens for s in sequences)
    assert packing.pack(documents([])).count() == 0
    same = packing.pack(documents([(1, "a"), (1, "a"), (None, "b")])).collect()
    assert sorted((r.doc_id or 0, r.length) for r in same) == [(0, 2), (1, 2), (1, 2)]


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(0)
    for sample in (rng.integers(1, 1025, 4000), np.full(999, 700), np.array([3]), rng.integers(500, 530, 100)):
        sizes, counts = np.unique(sample, return_counts=True)
        histogram = dict(zip(sizes.tolist(), counts.tolist(), strict=True))
        ranks = defaultdict(list)
        for size, low, high, *_ in packing.plan(histogram):
            ranks[size] += range(low, high)
        assert {s: len(r) for s, r in ranks.items()} == histogram
        assert all(sorted(r) == list(range(len(r))) for r in ranks.values())


PAGES = [(3, "http://a/ b\n", "same"), (1, None, "same"), (2, "u", "same"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 70000 + "é\r\n\r\nWARC/1.1\r\n"),
         (None, "u", "alone"), (None, "u", "same"), (1, "u", "same")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id bigint, url string, html string, first int")
    rows = warc.round_trip(spark, pages, file_bytes=1000).collect()
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    firsts = {"same": 1, "": 4, PAGES[5][2]: 6, "alone": None}
    expected = []
    for i, _, h in PAGES:
        data, first = (h or "").encode(), firsts[h or ""]
        revisit = first is not None and i != first
        expected.append((str(i), len(data), warc.digest(data), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(expected, key=lambda r: (r[0], r[1], r[2], r[3])) or sorted(map(str, got)) == sorted(map(str, expected))
    assert warc.round_trip(spark, pages.limit(0)).count() == 0
    large = warc.round_trip(spark, pages, min_revisit=5).collect()
    assert {r.record_type for r in large} == {"response"}


def test_warc_normaliser_makes_members():
    records = [warc.page_record(i, f"http://x/{i}", b"p" * (i * 40000), 0, i == 2) for i in range(4)]
    for whole in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        out, index = io.BytesIO(), io.BytesIO()
        assert warc.normalise_file(io.BytesIO(whole), out, index) == 4
        entries = [json.loads(line) for line in index.getvalue().splitlines()]
        for e, r in zip(entries, records, strict=True):
            assert gzip.decompress(out.getvalue()[e["offset"] : e["offset"] + e["length"]]) == r
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.RecordStream(io.BytesIO(gzip.compress(records[3][:-100]))))


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_jaccard_against_all_pairs(spark, documents):
    rng = random.Random(4)
    pool = [f"v{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(60)]
    texts += near_copies(rng, rng.choices(pool, k=90), 60, 6) + near_copies(rng, rng.choices(pool, k=30), 40, 2)
    passage = " ".join(rng.choices(pool, k=50))
    texts += [f"{passage} {' '.join(rng.choices(pool, k=rng.randint(1, 12)))}" for _ in range(40)]
    texts += ["", None, " \t\n", "One", "one", "one two", "ONE\vtwo", *texts[:5], *texts[:5]]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    for size, num, den in ((4, 85, 100), (5, 4, 5), (1, 1, 2)):
        rows = jaccard.join(documents(docs, extra=("n", "token", "set_id")), size=size, num=num, den=den).collect()
        expected = components(dict(docs), size, num, den)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
        assert got == {i: (len(shingles(t, size)), expected[i]) for i, t in docs}


def test_jaccard_of_repeated_ids_and_empty_tables(spark, documents, prose):
    docs = documents([(1, prose), (1, "quite another text of several words"), (2, prose), (None, prose), (None, None), (7, "")])
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(docs).collect())
    n = len(shingles(prose, 5))
    assert rows == sorted([("1", n, "1"), ("1", 2, "1"), ("2", n, "1"), ("None", n, "1"), ("None", 0, "None"), ("7", 0, "7")])
    kept = jaccard.keep_one(docs)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "7", "None", "None"]
    assert jaccard.join(documents([])).count() == 0


def test_one_row_of_each_group_stays(spark, documents, prose):
    other = "quite another text of several words"
    rows = [(3, prose), (3, prose), (3, other), (None, prose), (None, None), (None, None), (7, ""), (8, other), (2, prose)]
    docs = documents(rows, extra=("row_key", "number"))
    kept = jaccard.keep_one_row(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in kept.select("doc_id", "text").collect() if r.text)
    assert got == sorted([("2", prose), ("3", other)])
    assert kept.filter("coalesce(text, '') = ''").count() == 3
    assert sorted(r.doc_id for r in jaccard.keep_one_row(documents([(5, prose), (5, prose), (6, other)])).collect()) == [5, 6]
    assert jaccard.keep_one_row(documents([])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 400)]
    rows = connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r.node: r.component for r in rows}
    assert len(got) == len(rows) and got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 400: 400, 500: 400}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_neighbours_are_exact_with_a_full_share(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(900, 8)).astype(np.float32)
    data[100:400] = data[100]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    odd = [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] + [1.0] * 7), (2003, [None] + [1.0] * 7), (2004, [1.0] * 3), (2005, []), (None, [1.0] * 8),
           (2006, [float("inf")] + [1.0] * 7)]
    schema = "vec_id bigint, embedding array<float>, place int, v int"
    vectors = spark.createDataFrame([(*r, 0, 0) for r in rows + odd], schema)
    hits = neighbours.search(vectors, F.col("vec_id") % 20 == 0, k=5, share=1e9).collect()
    wide, found = data.astype(np.float64), defaultdict(list)
    for h in sorted(hits, key=lambda h: h.rank):
        found[h.query_id].append((h.vec_id, h.score))
    assert sorted(found) == list(range(0, 900, 20))
    for q, of in found.items():
        scores = (wide * wide[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(900), -scores)) if i != q][:5]
        assert [i for i, _ in of] == order
        assert np.allclose([s for _, s in of], scores[order], atol=1e-9)


def test_neighbours_recall(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    ids, data = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found = defaultdict(set)
    for h in neighbours.search(vectors, F.col("vec_id") % 20 == 0).collect():
        found[h.query_id].add(h.vec_id)
    hit = [len(found[q] & set(ids[[i for i in np.argsort(-data @ data[k]) if i != k][:20]].tolist())) for k, q in enumerate(ids) if q % 20 == 0]
    assert np.mean(hit) / 20 >= 0.9


def test_neighbours_of_few_and_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [2.0, 0.0]), (20, [0.0, 1.0])], schema)
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(few, F.col("vec_id") % 20 == 0).collect())
    assert rows == [(0, 1, 1, 2.0), (0, 2, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 0, 0.0)]
    assert neighbours.search(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_rollup_batches(spark):
    schema = "doc_id bigint, text string, lang string, source string, tokens int"
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 0), (2, "a b", None, "s", 0), (3, None, "en", None, 0), (1, "a b c", "en", "s", 0)], schema)
    state = common.shared_folder(spark, "rollup")
    one = {"words-1": rollup.VERSIONS["words-1"]}
    total = lambda: {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals(spark, state).collect()}
    assert total() == {}
    assert rollup.insert(docs, state, "a", versions=one) and not rollup.insert(docs, state, "a", versions=one)
    assert total() == {("s", "en"): (2, 6), ("s", None): (1, 2), (None, "en"): (1, 0)}
    assert rollup.revise(rollup.counted(spark.createDataFrame([(2, "now five words in it", "en", "t", 0), (9, "unknown", "en", "t", 0)], schema), one), state, "b")
    assert total() == {("s", "en"): (2, 6), ("t", "en"): (1, 5), (None, "en"): (1, 0)}
    gone = spark.createDataFrame([(1,), (3,), (77,)], "doc_id bigint")
    assert rollup.delete(gone, state, "c") and rollup.delete(gone, state, "d")
    assert total() == {("t", "en"): (1, 5)}
    assert rollup.committed(spark, state) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="plain name"):
        rollup.commit(rollup.counted(docs), state, "x/y")


def test_rollup_by_vocabulary(spark, documents, encoder):
    rows = rollup.counted_by_vocabulary(documents([(1, "some words here"), (2, None)], extra=("n_ids",)), "bpe", default_vocabulary()).collect()
    assert {r.doc_id: r.tokens for r in rows} == {1: len(encoder.encode("some words here")) // 4, 2: 0}


def test_two_writers_of_one_batch(spark):
    """Both start at once; one is applied, the other learns that."""
    from concurrent.futures import ThreadPoolExecutor

    docs = spark.createDataFrame([(i, "a b c", "en", "s") for i in range(50)], "doc_id bigint, text string, lang string, source string")
    state = common.shared_folder(spark, "rollup")
    with ThreadPoolExecutor(3) as pool:
        applied = list(pool.map(lambda _: rollup.insert(docs, state, "a", versions={"w": rollup.VERSIONS["words-1"]}), range(3)))
    assert sorted(applied) == [False, False, True]
    assert [(r.n_docs, r.n_tokens) for r in rollup.totals(spark, state).collect()] == [(50, 150)]


def test_rollup_takes_over_from_a_dead_writer(spark):
    from riskmart.sources import claims

    docs = spark.createDataFrame([(1, "a b c", "en", "s")], "doc_id bigint, text string, lang string, source string")
    state = common.shared_folder(spark, "rollup")
    dead = claims.claim(spark, f"{state}/batches/batch=a/0")
    assert rollup.totals(spark, state).count() == 0
    assert rollup.commit(rollup.counted(docs), state, "a", lease=0.5)
    assert not dead.commit() and not rollup.commit(rollup.counted(docs), state, "a")
    assert {(r.tokenizer, r.n_tokens) for r in rollup.totals(spark, state).collect()} == {("words-1", 3), ("runs-1", 3)}


def test_rollup_looks_only_into_the_buckets_named(spark):
    docs = spark.createDataFrame([(i, "a b", "en", "s") for i in [*range(200), None, None]], "doc_id bigint, text string, lang string, source string")
    state = common.shared_folder(spark, "rollup")
    rollup.insert(docs, state, "a", versions={"w": rollup.VERSIONS["words-1"]})
    one = spark.createDataFrame([(7,)], "doc_id bigint")
    inputs = rollup.current(spark, state, one).inputFiles()
    assert 1 <= len({f.split("bucket=")[1].split("/")[0] for f in inputs}) <= rollup.BUCKETS
    assert "bucket" in rollup.current(spark, state, one)._jdf.queryExecution().toString().split("PartitionFilters")[1][:80]
    assert [r.doc_id for r in rollup.current(spark, state, one).collect()] == [7]
    none = spark.createDataFrame([(None,)], "doc_id bigint")
    assert [(r.doc_id, r.times) for r in rollup.current(spark, state, none).collect()] == [(None, 2)]


def test_only_documents_named_are_counted_again(spark):
    docs = spark.createDataFrame([(i, "a b " + "c" * i, "en", "s") for i in [*range(300)]] + [(None, "x", "en", "s"), (5, "x", "en", "s")],
                                 "doc_id bigint, text string, lang string, source string")
    ids = spark.createDataFrame([(5,), (5,), (9,), (None,), (1000,)], "doc_id bigint")
    seen = []

    def count(some):
        seen.append(some.count())
        return rollup.counted(some, {"w": rollup.VERSIONS["words-1"]})

    again = rollup.recounted(docs, ids, count)
    assert sorted((r.doc_id, r.tokens) for r in again.collect()) == [(5, 1), (5, 3), (9, 3)]
    assert seen[0] < 30


def test_token_rollup_over_all_documents(spark, sf_dir, encoder):
    """The query against plain Python: counts by the library, revisions, deletes."""
    import re

    from riskmart.llm import queries

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    poor = {r.doc_id for r in labels if r.quality == 0}
    toxic = {r.doc_id for r in labels if r.toxic == 1}
    want = defaultdict(lambda: [0, 0])
    for d in docs:
        if d.doc_id not in toxic:
            text = re.sub("[0-9]+", " ", d.text or "") if d.doc_id in poor else d.text or ""
            cell = want[d.source, d.lang, "byte_bpe_50k"]
            cell[0] += 1
            cell[1] += len(encoder.whole.encode(text, add_special_tokens=False).ids)
    got = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in queries.op9_token_rollup_bpe(spark, sf_dir).collect()}
    assert got == dict(want)


def test_a_dictionary_at_every_size(spark, documents):
    import zstandard

    rng = random.Random(3)
    ids = lambda n: np.array([rng.choice([5, 60, 700, 8000, 9]) for _ in range(n)], "<u2").tobytes()
    for n in (8, 60, 400, 5_000, 60_000, 400_000):
        samples = [ids(min(n, 1024)) for _ in range(max(1, n // 1024))]
        data = token_store.train(samples)
        assert 8 <= len(data) <= token_store.DICTIONARY_BYTES
        both = zstandard.ZstdCompressionDict(data)
        packed = zstandard.ZstdCompressor(dict_data=both).compress(samples[0])
        assert zstandard.ZstdDecompressor(dict_data=both).decompress(packed) == samples[0]
    assert token_store.train([]) == b""
    folder = common.shared_folder(spark, "store")
    token_store.write_store(documents([(1, "a few words only, and a few more"), (2, "a few words")]), folder)
    shard = token_store.manifest(spark, folder).first()
    assert shard.dictionary_bytes > 0 and list(token_store._dictionaries(folder)) == [shard.dictionary]
    assert [r.n_tokens > 1 for r in token_store.read_store(spark, folder).collect()] == [True, True]


def test_token_store_over_all_documents(spark, sf_dir, encoder):
    from riskmart.llm import queries

    at, want = 0, []
    for d in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda d: d.doc_id):
        ids = np.array([*encoder.whole.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((d.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = queries.op6_token_store(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == want


def test_the_plan_is_found_beside_other_libraries_threads(spark, encoder):
    """In one process with Spark, DuckDB and the tokenizer, within a time limit."""
    import threading

    import duckdb

    duckdb.sql("SELECT sum(i) FROM range(1000000) t(i)").fetchall()
    encoder.whole.encode_batch(["some text"] * 64, add_special_tokens=False)
    spark.range(1000).count()
    histogram, rows = {s: 5 + s * 7 % 900 for s in range(1, 1025)}, []
    run = threading.Thread(target=lambda: rows.extend(packing.plan(histogram)), daemon=True)
    run.start()
    run.join(120)
    assert rows and sum(hi - lo for _, lo, hi, *_ in rows) == sum(histogram.values())


def test_inverses():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 60):
        m = rng.integers(0, 4, (n, n)) + 5.0 * np.eye(n)[:, ::-1]
        assert np.abs((packing.inverted(m)[:, :, None] * m[None]).sum(axis=1) - np.eye(n)).max(initial=0) < 1e-8
