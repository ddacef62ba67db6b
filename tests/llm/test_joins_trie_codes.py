"""N-gram join, prefix trie and vector codes against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import crawl, frame, same, words
from tidewatch.llm import ngram_join, prefix_trie, vector_codes
from tidewatch.llm.common import look_up

# ---- n-gram join ------------------------------------------------------------------------------------------


def joined(rows):
    """Brute force over sets of words: doc_id, n_shingles, component."""
    sets = []
    for _, text in rows:
        w = brute.WORD.findall(brute.low(text))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (doc_id, least.get(find(i))) if x is not None]
        least[find(i)] = min(known) if known else None
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def test_similar_sets_always_have_a_common_key():
    rng, numbers, similar = random.Random(5), np.random.default_rng(1), 0
    for _ in range(6000):
        n = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 17, 20, 27, 33, 50, 100, 200, 333])
        x = np.unique(numbers.integers(0, 2**64, n, dtype=np.uint64))
        kept = numbers.permutation(n)[rng.randint(0, n // 4):]
        y = np.unique(np.r_[x[kept], numbers.integers(0, 2**64, rng.randint(0, n // 4), dtype=np.uint64)])
        if ngram_join.similar(x, y):
            similar += 1
            assert set(ngram_join.join_keys(x)) & set(ngram_join.join_keys(y))
    assert similar > 2000


def test_few_segments_for_many_values_still_meet(monkeypatch):
    """Plans that nearly always run out of segments or use deletions everywhere."""
    numbers = np.random.default_rng(2)
    for wide in (0, 4):
        monkeypatch.setattr(ngram_join, "plan", lambda band: (4, wide))
        ngram_join._salts.cache_clear()
        for _ in range(1500):
            n = int(numbers.integers(1, 40))
            x = np.unique(numbers.integers(0, 2**64, n, dtype=np.uint64))
            y = np.unique(np.r_[x[numbers.integers(0, max(1, n // 9)):], numbers.integers(0, 2**64, n // 10, dtype=np.uint64)])
            if ngram_join.similar(x, y):
                assert set(ngram_join.join_keys(x)) & set(ngram_join.join_keys(y))
    monkeypatch.undo()
    ngram_join._salts.cache_clear()


def test_some_bands_use_deletions_and_all_reach_what_is_needed():
    plans = [ngram_join.plan(b) for b in range(34)]
    assert any(wide for _, wide in plans) and any(not wide for _, wide in plans)
    assert all(1 <= m and wide <= m for m, wide in plans)


def test_sketches_never_rule_out_a_link():
    numbers = np.random.default_rng(3)
    for n in (5, 40, 300, 40_000):
        x = np.unique(numbers.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.r_[x[n // 9:], numbers.integers(0, 2**64, n // 12, dtype=np.uint64)])
        n_x, n_y = np.array([len(x)]), np.array([len(y)])
        assert not ngram_join.similar(x, y) or ngram_join._may_be_similar(n_x, n_y, ngram_join.sketch(x)[None], ngram_join.sketch(y)[None])[0]


def test_sketches_rule_out_large_sets_well_below_the_threshold():
    """Counts in 128 parts left such pairs of large sets, so that their texts moved."""
    numbers = np.random.default_rng(4)
    for n in (1300, 9000):
        x = np.unique(numbers.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.r_[numbers.permutation(x)[n // 4:], numbers.integers(0, 2**64, n // 4, dtype=np.uint64)])  # similarity 0.6
        n_x, n_y = np.array([len(x)]), np.array([len(y)])
        assert not ngram_join._may_be_similar(n_x, n_y, ngram_join.sketch(x)[None], ngram_join.sketch(y)[None])[0]


def test_texts_of_wanted_rows_come_and_few_others(spark):
    docs = frame(spark, [(k, f"text {k}") for k in range(3000)] + [(5, "text 5"), (None, "text 7"), (None, None)])
    hashed = docs.select("doc_id", "text", ngram_join._row().alias("row"))
    wanted = hashed.where("doc_id % 100 = 5 OR doc_id IS NULL").select("row").cache()
    got = ngram_join._texts(docs, wanted).collect()
    expected = {tuple(r) for r in hashed.join(wanted, "row", "left_semi").select("row", "text").collect()}
    assert len(expected) == 32 and expected <= {tuple(r) for r in got} and len(got) < 40


def test_ngram_join_equals_brute_force(spark):
    rows = crawl()
    same(ngram_join.join_documents(frame(spark, rows)).collect(), joined(rows))


def test_ngram_join_without_ids_and_of_nothing(spark):
    rng = random.Random(8)
    w = words(rng, 200)
    rows = [(None, "a b c d e f"), (None, None), (7, "A b c d e f"), (None, "z"), (9, " ".join(w)), (None, " ".join(w[9:])),
            (4, " ".join(w[18:])), (4, "z")]
    same(ngram_join.join_documents(frame(spark, rows)).collect(), joined(rows))
    assert ngram_join.join_documents(frame(spark, [])).collect() == []


@pytest.mark.parametrize("few, block", [(64, 4096), (3, 4096), (2, 7)])
def test_links_between_members_unlike_their_hub(spark, monkeypatch, few, block):
    """Chains, and texts below the threshold with a common half, under keys settled as pairs and in one or many blocks."""
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 200 * block)
    rng = random.Random(1)
    w = words(rng, 400)
    rows = [(k, " ".join(w[10 * k:10 * k + 180])) for k in range(12)]
    rows += [(100 + k, " ".join(w[:90] + words(rng, 25) + w[115:170])) for k in range(40)]
    rows += [(200 + k, " ".join(w[:60] + words(rng, 8) + w[68:160])) for k in range(8)]
    want = joined(rows)
    assert 3 < len({r[2] for r in want}) < len(rows)
    same(ngram_join.join_documents(frame(spark, rows)).collect(), want)


def test_hub_of_many_members_is_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HUB_PART", 5)
    rng = random.Random(4)
    w = words(rng, 150)
    rows = []
    for k in range(60):
        one = list(w)
        one[rng.randrange(150)] = f"other{k}"
        rows.append((k, " ".join(one)))
    same(ngram_join.join_documents(frame(spark, rows)).collect(), joined(rows))


# ---- prefix trie ------------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"


def trie(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        below = [total[k] for k in kids[p]]
        total[p] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *total[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def talks(seed=7):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-130, -90), *range(95, 330), 500, 1000, 1001, 70_007]:
        n = rng.choice([1, 1, 2, 3, 5, 8, 9, 17])
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "bot"]) if rng.random() < .3 else "user", rng.choice(["hi", "hello", "é 🙂"])))
    rows += [(100, None, None, None), (100, 1, "user", "tie"), (100, 1, "bot", "tie"), (100, 1, "bot", "tie"), (None, 1, "user", "none"),
             (201, 3, None, "x" * 100_000), (202, 3, "", "x" * 100_000), (999, 0, "user", "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height, rounds, chunk", [(8, 32, 4096), (3, 32, 6), (1, 1000, 1), (2, 2, 5)])
def test_trie_equals_brute_force(spark, height, rounds, chunk):
    rows = talks()
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS key", "'y' AS depth", "'z' AS n_turns", "1 AS at")
    same(prefix_trie.prefix_nodes(df, height, rounds, chunk).collect(), trie(rows))


def test_trie_of_long_conversations_and_of_nothing(spark):
    rows = [(c, t, "user", "go on" if t < 150 + c else f"{c} {t}") for c in (0, 3, 5, 105) for t in range(200)]
    same(prefix_trie.prefix_nodes(spark.createDataFrame(rows, TURNS), chunk=40).collect(), trie(rows))
    assert prefix_trie.prefix_nodes(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.prefix_nodes(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []


def test_conversation_that_loses_all_turns_ends_in_the_root(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, 0, "user", "one"), (c, 1, "user", "two")]
    same(prefix_trie.prefix_nodes(spark.createDataFrame(rows, TURNS)).collect(),
         [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())])


def test_rows_of_heavy_keys_are_spread(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), "id")
    side = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    got = look_up(rows, side, ["k"], F.col("n"), 5000, F.col("id"))
    assert got.count() == 5000 and got.where("k = 0 AND last = 3999 AND n = 4000").count() == 4000
    assert got.where("k > 0 AND last = k AND n = 1").count() == 1000


# ---- vector codes -----------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def coded(rows, parts=8, entries=16, rounds=6):
    kept = []
    for vec_id, vector, label in rows:
        if vector is not None and all(v is not None and math.isfinite(v) for v in vector):
            kept.append((vec_id, [math.floor(4096 * float(np.float32(v))) for v in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    length = len(kept[0][1]) // parts
    cut = [[x[p * length:(p + 1) * length] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda x, book: min((far(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[place(c[p], books[p])[1]].append(c[p])
            for i, g in groups.items():
                books[p][i] = [sum(col) // len(g) for col in zip(*g)]
    out, sums = [], defaultdict(int)
    for (vec_id, _, label), c in zip(kept, cut):
        found = [place(c[p], books[p]) for p in range(parts)]
        out.append((vec_id, label, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
        sums[label] += out[-1][3]
    return [(*r, sums[r[1]]) for r in out], [x for book in books for e in book for x in e]


def vectors(n=150, dim=16, seed=3):
    rng = random.Random(seed)
    return [(i * 3, [rng.gauss(i % 4, 0.3) for _ in range(dim)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("dim", [8, 16, 40])
def test_vector_codes_equal_brute_force(spark, dim):
    rows = vectors(dim=dim)
    rows += [(1000, rows[0][1], 1), (1001, [0.25] * dim, 2), (1002, [-0.1] * dim, None)] * 2
    rows += [(-5, None, 1), (-4, [None] + [0.5] * (dim - 1), 1), (-3, [float("nan")] * dim, 1), (-2, [float("-inf")] + [1.0] * (dim - 1), 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5).selectExpr("*", "'a' AS code", "'b' AS x", "'c' AS n", "1 AS bare")
    got, books = vector_codes.compress(df)
    want, numbers = coded(rows)
    same(got.select("vec_id", "label", "code", "error", "label_error").collect(), want)
    assert vector_codes.codebook_text(books) == ",".join(map(str, numbers))


def test_vector_codes_of_few_odd_and_no_rows(spark):
    few = vectors(3, 8)
    got, books = vector_codes.compress(spark.createDataFrame(few, VECTORS))
    same(got.select("vec_id", "label", "code", "error", "label_error").collect(), coded(few)[0])
    assert books.shape == (8, 3, 1)
    odd = few + [(900, [1.0] * 7, 1), (901, [], 1), (902, [1e30] * 8, 1), (None, [2.0] * 8, 5), (-9, [1.0] * 9, 1)]
    got, _ = vector_codes.compress(spark.createDataFrame(odd, VECTORS))
    same(got.select("vec_id", "label", "code", "error", "label_error").collect(), coded(few + [odd[6]])[0])
    got, books = vector_codes.compress(spark.createDataFrame([], VECTORS))
    assert got.collect() == [] and vector_codes.codebook_text(books) == ""


def test_equal_average_search_finds_the_nearest_and_skips_entries():
    rng = np.random.default_rng(4)
    for spread in (1, 3, 1000):
        x, entries = rng.integers(-spread, spread + 1, (500, 4)), rng.integers(-spread, spread + 1, (64, 4))
        index, distance, computed = vector_codes.nearest(x, entries)
        whole = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()  # argmin takes the first of ties
        assert computed < 500 * 64 * 0.9


def test_greatest_components_do_not_overflow():
    for length in (1, 2, 4, 8, 64):
        top = vector_codes.greatest_component(length)
        x = np.full((1, length), top, dtype=np.int64)
        _, distance, _ = vector_codes.nearest(x, -x)
        assert int(distance[0]) == length * (2 * top) ** 2 and 8 * int(distance[0]) < 2**63
