"""Runs, resampling and mixing against plain Python, on small inputs and whole small tables."""

import hashlib
import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from riskmart.llm import mixing, resampling, runs
from riskmart.llm.queries import CORPUS_QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    read = lambda t: duckdb.sql(f"SELECT * FROM '{sf_dir}/{t}.parquet'").fetchall()
    return {"documents": read("documents"), "benchmark": read("benchmark")}


def plain_runs(words, least=24, repeats=3):
    """Every period, every maximal stretch with it, unless a shorter one is its smallest."""
    found = set()
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, repeats * q):
                part = words[i : i + size]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found)


def test_runs_against_plain_python():
    rng = random.Random(4)
    for _ in range(1200):
        n, k = rng.randrange(110), rng.choice([1, 2, 3, 40])
        words = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.7:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            words = words[:a] + [words[a + i % p] for i in range(n - a)] + [rng.randrange(k) for _ in range(rng.randrange(20))]
        for least, repeats in ((24, 3), (6, 2)):
            assert runs.find_runs(np.array(words, np.int64), least, repeats) == plain_runs(words, least, repeats)


def test_ordered_positions_are_split_into_blocks():
    rng, own, held = random.Random(1), runs.Positions(5000), [5000]
    for x in rng.sample([i for i in range(20_000) if i != 5000], 9_000):
        k = bisect_left(held, x)
        assert own.add(x) == (held[k - 1] if k else -1, held[k] if k < len(held) else -1)
        held.insert(k, x)
    assert list(own) == held and own.size == 9_001 and len(own.blocks) > 2


def test_runs_of_odd_texts(spark, documents):
    ab = "a b " * 20
    long = "one two three four five six seven eight " * 40_000
    docs = documents([(1, ab), (1, ab), (None, ab), (2, None), (3, ""), (4, " \t\n"), (5, "a b c"), (6, long), (7, "x " * 23)], extra=("repetition", "runs"))
    found, name = runs.find(docs)
    assert name not in docs.columns and found.columns == [*docs.columns, name]
    got = defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append((r[name].n_words, [tuple(x) for x in r[name].runs], r[name].best, r[name].collapsed))
    assert got[1] == [(40, [(0, 40, 2)], 0, "a b")] * 2 and got[None] == got[1][:1]
    assert got[2] == got[3] == got[4] == [(0, [], None, "")]
    assert got[5] == [(2, [], None, "a b c")] and got[7][0][1] == []
    assert got[6] == [(320_000, [(0, 320_000, 8)], 0, "one two three four five six seven eight")]
    assert runs.find(documents([]))[0].count() == 0
    cut = {r.doc_id: r.text for r in runs.drop_repeats(docs).collect()}
    assert cut[1] == "a b" and cut[2] is None and cut[4] == " \t\n"
    assert runs.drop_repeats(docs).columns == docs.columns


def test_op11_against_plain_python(spark, sf_dir, tables):
    rows = CORPUS_QUERIES["op11_runs"](spark, sf_dir).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(got) == len(tables["documents"])
    some = 0
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for doc_id, text, *_ in tables["documents"]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        # Plain search is quadratic: where no 16 words in a row repeat there is no run.
        windows = Counter(zip(*[words[k:] for k in range(16)], strict=False))
        found = plain_runs(words) if any(c > 1 for c in windows.values()) else []
        some += len(found)
        gone = {i for s, size, q in found for i in range(s + q, s + size)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *expected)
        assert r.runs_sha256 == sha("".join(f"{a},{b},{c}\n" for a, b, c in found))
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
    assert some > 10


def test_interning_settles_equal_keys_by_bytes():
    grams = [f"w{i % 50}".encode() for i in range(400)]
    for hashed in (lambda g: 7, lambda g: len(g), resampling.xxhash.xxh64_intdigest):
        table = resampling.intern(grams, 1000, hashed)
        assert table.slot_of.max() < len(table.count) and int(table.count.sum()) == 400
        by_slot = defaultdict(set)
        for g, s in zip(grams, table.slot_of.tolist(), strict=True):
            by_slot[s].add(g)
            assert table.bucket[s] == zlib.crc32(g) % 1000 and table.count[s] == 8
        assert len(by_slot) == 50 and all(len(v) == 1 for v in by_slot.values())
    assert len(resampling.intern([]).slot_of) == 0


def plain_resampling(documents, benchmark, percent=25, least=20):
    lower = {c: c + 32 for c in range(0x41, 0x5B)}

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    raw, target = Counter(), Counter()
    own = [(i, *features(t)) for i, t in documents]
    for _, _, some in own:
        raw.update(map(bucket, some))
    for t in benchmark:
        target.update(map(bucket, features(t)[1]))
    s, t = sum(raw.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    out = []
    for i, words, some in own:
        weight = sum(gain[bucket(f)] for f in some) // len(some) if some else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words), len(some), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((-r[4], r[0] is None, r[0] or 0, k) for k, r in enumerate(out) if r[1] >= least)
    ranks = {k: n for n, (*_, k) in enumerate(able[: percent * len(able) // 100], 1)}
    return [(r[0], r[2], r[3], r[4], ranks.get(k)) for k, r in enumerate(out)]


def test_op12_against_plain_python(spark, sf_dir, tables):
    expected = plain_resampling([(r[0], r[1]) for r in tables["documents"]], [r[1] for r in tables["benchmark"]])
    rows = [tuple(r) for r in CORPUS_QUERIES["op12_resampling"](spark, sf_dir).collect()]
    assert sorted(rows) == sorted(expected) and sum(r[4] is not None for r in rows) > 20


def test_resampling_of_odd_texts(spark, documents):
    rng = random.Random(2)
    prose = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(18, 40))) for _ in range(60)]
    rows = [(i % 40, t) for i, t in enumerate(prose)] + [(3, prose[3]), (3, prose[3]), (None, prose[1]), (None, None), (90, ""), (91, "?!"), (92, "ä 漢字 É " * 9_000)]
    items = ["a bb ccc a bb", None, "", "?"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id int, text string")
    got = [tuple(r) for r in resampling.resample(documents(rows, extra=("score", "rank")), target).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(plain_resampling(rows, items), key=key)
    assert resampling.resample(documents([]), target).count() == 0
    assert {r["rank"] for r in resampling.resample(documents(rows), target.limit(0), percent=0).collect()} == {None}


def test_targets_stop_at_three_times_the_source():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert mixing.targets([10, 500, 500], [5, 2, 1]) == [30.0, 980 * 2 / 3, 980 / 3]
    assert mixing.targets([0, 8], [5, 2]) == [0.0, 8.0] and mixing.targets([], []) == [] and mixing.targets([0], [5]) == [0.0]


def test_permutations_and_shards():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        orders = [mixing.permuted(np.arange(n), n, key).tolist() for key in (1, 2)]
        assert all(sorted(o) == list(range(n)) for o in orders) and (n < 60 or orders[0] != orders[1])
    quotas = np.array([900, 0, 50, 7])
    counts = mixing.multinomial_shards(quotas, 11, 3)
    assert counts.sum(axis=0).tolist() == quotas.tolist() and np.ptp(counts.sum(axis=1)) <= 1
    assert len({tuple(c) for c in counts.tolist()}) > 3 and (counts == mixing.multinomial_shards(quotas, 11, 3)).all()


def check_mix(rows, docs, block=mixing.BLOCK):
    """Sizes and targets as defined; takings near the targets, and no document taken more than three times."""
    words = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in docs]
    sizes = Counter()
    for _, n, s in words:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r["size"], r.source_size) for r in rows), key=key) == sorted(((i, n, sizes[s]) for i, n, s in words), key=key)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    total = defaultdict(int)
    for r in rows:
        total[r.source_size, r.target] += r.taken
    want = defaultdict(lambda: [0.0, 0.0])
    for s in order:
        want[sizes[s], target[s]][0] += target[s]
        want[sizes[s], target[s]][1] += 4 * block
    for k, (t, slack) in want.items():
        assert abs(total[k] - t) <= slack, k


def test_op13_against_its_definition(spark, sf_dir, tables):
    rows = CORPUS_QUERIES["op13_mixing"](spark, sf_dir).collect()
    check_mix(rows, [(r[0], r[1], r[3]) for r in tables["documents"]])
    other = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)
    mixed, documents = mixing.mix(other)
    again = mixing.taken(mixed, documents).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_in_detail(spark):
    rng = random.Random(6)
    rows = [(i if i % 7 else 5, "w " * rng.choice([0, 1, 3, 70, 400]), rng.choice(["a", "a", "é", "z", None])) for i in range(150)]
    rows += [(1, None, "empty"), (1, "same text here", "a"), (1, "same text here", "a"), (9, "x " * 120_000, "big")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, number int")
    mixed, documents = mixing.mix(docs)
    out = mixing.taken(mixed, documents).collect()
    check_mix(out, rows)
    pieces = mixed.collect()
    # Slots are filled once and without gaps, blocks of a source evenly often.
    slots, uses = defaultdict(set), Counter()
    for p in pieces:
        slots[p.shard].add(p.slot)
        assert 0 <= p.at < mixing.BLOCK and p.length >= 1
    for held in slots.values():
        assert held == set(range(len(held)))
    for (number, place, start), n in Counter((p.number, p.place, p.start) for p in pieces).items():
        uses[number, n] += 1
    by_source = defaultdict(set)
    for number, n in uses:
        by_source[number].add(n)
    assert all(max(v) - min(v) <= 1 and max(v) <= 3 for v in by_source.values())
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    mixed, documents = mixing.mix(empty)
    assert mixed.count() == 0 and mixing.taken(mixed, documents).count() == 0
    mixed, documents = mixing.mix(spark.createDataFrame([(1, None, None)], empty.schema))
    assert [(r["size"], r.source_size, r.target, r.taken) for r in mixing.taken(mixed, documents).collect()] == [(0, 0, 0.0, 0)]
