"""Vector codes, centroid clustering and languages against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsframe.llm import centroids, languages, vector_codes
from opsframe.llm.vectors import Sums, floor_means

NAN, INF = float("nan"), float("inf")
CLASHES = "code string, error string, label_error string, cluster string, distance string, key string, was string, hash string"


def floors(vector, scale):
    return [max(-1 << 63, min((1 << 63) - 1, math.floor(scale * x))) for x in vector]


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def nearest_by_hand(v, entries):
    return min(range(len(entries)), key=lambda k: (squared(v, entries[k]), k))


def means(groups, before):
    return [[sum(c) // len(g) for c in zip(*g, strict=True)] if (g := groups.get(k)) else list(e) for k, e in enumerate(before)]


def odd_vectors(width, seed=3):
    """Ties, repeated rows and ids, null, empty, short and non-finite vectors, null ids and labels."""
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-0.5, 0.0, 0.01, 0.25, 1.0]) for _ in range(width)], rng.choice([1, 2, None])) for k in range(150)]
    rows += [(7, [0.25] * width, 1), (7, [0.25] * width, 1), (None, [0.5] * width, None), (-3, [-0.013] * width, 2)]
    rows += [(200, None, 1), (201, [], 1), (202, [0.5] * (width - 1), 1), (203, [NAN] + [0.0] * (width - 1), 2),
             (204, [INF] + [0.0] * (width - 1), 2), (205, [None] + [0.0] * (width - 1), None), (206, [0.5] * (2 * width), 1)]
    return rows


def vector_frame(spark, rows):
    clashing = ["x"] * len(CLASHES.split(", "))
    return spark.createDataFrame([(*r, *clashing) for r in rows], f"vec_id bigint, embedding array<double>, label int, {CLASHES}").repartition(3)


def whole(rows, width):
    kept = [r for r in rows if r[1] and len(r[1]) == width and all(x is not None and math.isfinite(x) for x in r[1])]
    return sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


# -- Walsh-Hadamard search --------------------------------------------------------------

def test_walsh_rows_are_orthogonal_and_in_sequency_order():
    for size in (1, 2, 4, 16):
        w = vector_codes.walsh(size)
        assert (w @ w.T == size * np.eye(size)).all()
        assert ((w[:, 1:] != w[:, :-1]).sum(1) == range(size)).all()


@pytest.mark.parametrize("width, top", [(1, 3), (3, 2), (4, 200), (6, 5), (4, 1 << 40), (5, (1 << 63) - 1)])
def test_search_is_exact_whatever_the_numbers(width, top):
    rng = random.Random(width)
    draw = lambda n: np.array([[rng.randint(-top, top) for _ in range(width)] for _ in range(n)], object)
    parts, entries = draw(80), draw(20)
    entries[7], parts[3] = entries[2], entries[7]
    found = vector_codes.nearest(parts, entries)
    assert found.entry.tolist() == [nearest_by_hand(p, entries) for p in parts]
    assert [int(d) for d in found.distance] == [squared(p, entries[e]) for p, e in zip(parts, found.entry, strict=True)]


def test_entries_are_left_out_early():
    """Smooth parts: the first coefficients rule most entries out, and no result changes."""
    rng = np.random.default_rng(4)
    level = rng.integers(-500, 500, (300, 1)) + rng.integers(-3, 4, (300, 16))
    found = vector_codes.nearest(level[64:], level[:64])
    assert found.steps < 0.3 * 236 * 64 * 16
    assert found.entry.tolist() == [nearest_by_hand(p, level[:64]) for p in level[64:]]


def codes_by_hand(rows, width, parts, entries, rounds, scale):
    kept = [(i, floors(v, scale), label) for i, v, label in whole(rows, width)]
    size = width // parts
    cut = lambda v, p: v[p * size:(p + 1) * size]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[nearest_by_hand(cut(v, p), books[p])].append(cut(v, p))
            books[p] = means(groups, books[p])
    out, by_label = [], Counter()
    for i, v, label in kept:
        at = [nearest_by_hand(cut(v, p), books[p]) for p in range(parts)]
        error = sum(squared(cut(v, p), books[p][e]) for p, e in enumerate(at))
        by_label[label] += error
        out.append((i, "".join(f"{e:02x}" for e in at), error, label))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((i, c, e, by_label[la]) for i, c, e, la in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("entries", [8, 64, 400])
def test_codes_of_odd_vectors(spark, rows, entries):
    data = odd_vectors(12)
    prepared, width = vector_codes.prepared(vector_frame(spark, data), "embedding", 4, 256)
    assert width == 12
    books = vector_codes.train(prepared, width, parts=4, entries=entries)
    coded = vector_codes.encode(prepared, books, width)
    found = rows(vector_codes.with_group_error(coded, "label"), "vec_id", "code", "error", "label_error")
    if entries == 400:  # more than two hex digits would be needed for more than 256 entries
        assert {e for _, _, e, _ in found} == {0}
        return
    expected, digest = codes_by_hand(data, 12, 4, entries, 2, 256)
    assert found == expected and books.sha256 == digest


def test_codes_of_no_vectors_and_of_huge_ones(spark):
    none = vector_frame(spark, odd_vectors(16)).where("embedding IS NULL OR size(embedding) < 16")
    prepared, width = vector_codes.prepared(none.where("vec_id <> 202"), "embedding", 16, 256)
    books = vector_codes.train(prepared, width)
    assert vector_codes.with_group_error(vector_codes.encode(prepared, books, width), "label").count() == 0
    huge = [(k, [(-1.0) ** k * 10.0 ** (k * 3)] * 16, 1) for k in range(80)]
    prepared, width = vector_codes.prepared(vector_frame(spark, huge), "embedding", 16, 256)
    coded = vector_codes.with_group_error(vector_codes.encode(prepared, vector_codes.train(prepared, width), width), "label")
    assert coded.count() == 80 and coded.where("vec_id < 64 AND error <> 0").count() == 0


def test_errors_of_a_hot_group_are_added_up_exactly(spark):
    many = spark.range(30_000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("g"),
                                      F.lit(1 << 62).alias("error"))
    out = vector_codes.with_group_error(many, "g", into="total")
    assert out.count() == 30_000 and out.where("g = 'hot' AND total IS NOT NULL").count() == 0
    assert out.where("g <> 'hot' AND total <> error").count() == 0 and out.where("g IS NULL").count() > 0


# -- centroids --------------------------------------------------------------------------

def clusters_by_hand(rows, width, k, rounds, scale):
    kept = [(i, floors(v, scale)) for i, v, _ in whole(rows, width)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    found = [v for _, v in order[:k]]
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest_by_hand(v, found)].append(v)
        found = means(groups, found)
    out = [(i, c := nearest_by_hand(v, found), squared(v, found[c])) for i, v in kept]
    return sorted(out, key=repr), found


def cluster(spark, data, width, k, rounds, scale=64):
    prepared = centroids.prepared(vector_frame(spark, data), width=width, scale=scale)
    return centroids.clustered(prepared, centroids.first_centroids(prepared, k), rounds)


@pytest.mark.parametrize("k, rounds", [(1, 2), (5, 4), (16, 3), (400, 1)])
def test_clusters_of_odd_vectors(spark, rows, k, rounds):
    data = odd_vectors(6)
    found = cluster(spark, data, 6, k, rounds)
    expected, by_hand = clusters_by_hand(data, 6, k, rounds, 64)
    assert [list(map(int, c)) for c in found.centroids] == by_hand
    assert rows(centroids.with_distances(found), "vec_id", "cluster", "distance") == expected
    sums = Counter()
    for _, c, d in expected:
        sums[c] += d
    assert found.inertia() == [sums[c] for c in range(len(by_hand))]


def test_few_vectors_are_scanned_again(spark, rows):
    """Groups far apart: after the first move the heaps hold nearly everything back."""
    rng = random.Random(9)
    data = [(k, [(k % 8 == j) * 20 + rng.gauss(0, 0.4) for j in range(8)], 1) for k in range(2000)]
    found = cluster(spark, data, 8, 8, 5, scale=256)
    expected, _ = clusters_by_hand(data, 8, 8, 5, 256)
    assert rows(centroids.with_distances(found), "vec_id", "cluster", "distance") == expected
    sizes = [level.count() for level in found.levels]
    assert sizes[0] == 2000 and sum(sizes[3:]) < 600


def test_popping_reads_the_expired_end_of_the_heaps(spark):
    found = cluster(spark, odd_vectors(6), 6, 4, 1)
    plan = found._in_heap(found.levels[0], [0] * 4, [5] * 4)._jdf.queryExecution().toString()
    assert "GreaterThan(" + found.key in plan and "LessThanOrEqual(" + found.key in plan
    for path in found.levels[0].inputFiles():
        part = spark.read.parquet(path).select(found.cluster, found.key).collect()
        assert part == sorted(part)


def test_centroids_of_none_and_of_huge_vectors(spark, rows):
    data = [(k, [(-1.0) ** (k % 3) * 10.0 ** (k % 25)] * 4, 1) for k in range(60)]
    found = cluster(spark, data, 4, 6, 3)
    expected, _ = clusters_by_hand(data, 4, 6, 3, 64)
    fits = [(i, c, d if d < 1 << 63 else None) for i, c, d in expected]
    assert rows(centroids.with_distances(found), "vec_id", "cluster", "distance") == fits
    assert sum(found.inertia()) == sum(d for _, _, d in expected)
    prepared = centroids.prepared(vector_frame(spark, odd_vectors(6)), width=64)
    assert prepared.count() == 0 and len(centroids.first_centroids(prepared, 16)) == 0


def test_sums_are_exact_beyond_64_bits(spark):
    sums = Sums(2, 2)
    sums.add(np.array([1, 1]), np.array([[1 << 62, -5], [1 << 62, 2]], object))
    total = Sums.collect(spark.createDataFrame([r for b in sums.batches() for r in b.to_pylist()] * 3, Sums.SCHEMA), 2, 2)
    assert total.sums[1].tolist() == [6 << 62, -9] and total.counts.tolist() == [0, 6]
    assert floor_means(total, np.zeros((2, 2), object)).tolist() == [[0, 0], [1 << 62, -2]]


# -- languages --------------------------------------------------------------------------

PIECES = sorted(["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "bb"])


def segmentations(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in PIECES or k == 1:
            for rest in segmentations(word[k:]):
                yield [word[:k], *rest]


def number(piece):
    return PIECES.index(piece) + 1 if piece in PIECES else 0


WORDS = ["▁" + "".join(w) for n in range(5) for w in product("abz", repeat=n)] + ["▁" + "abbaz" * 3]


def test_forward_sums_over_all_segmentations():
    rng = np.random.default_rng(5)
    p = rng.uniform(0.01, 1, (len(PIECES) + 1, 3))
    logs = languages.word_logs(WORDS, languages.Pieces(PIECES), np.log(p))
    by_hand = [sum(np.prod([p[number(x)] for x in ways], axis=0) for ways in segmentations(w)) for w in WORDS]
    assert np.allclose(logs, np.log(by_hand))


def test_expected_counts_over_all_segmentations():
    rng = np.random.default_rng(6)
    p = rng.uniform(0.01, 1, (len(PIECES) + 1, 2))
    side, times = np.arange(len(WORDS)) % 2, rng.integers(1, 9, len(WORDS)).astype(float)
    found = languages.piece_counts(WORDS, side, times, languages.Pieces(PIECES), np.log(p))
    by_hand = np.zeros_like(p)
    for w, la, n in zip(WORDS, side, times, strict=True):
        ways = [[number(x) for x in way] for way in segmentations(w)]
        weights = [np.prod(p[way, la]) for way in ways]
        for way, weight in zip(ways, weights, strict=True):
            np.add.at(by_hand[:, la], way, n * weight / sum(weights))
    assert np.allclose(found, by_hand)


def test_long_words_neither_overflow_nor_vanish():
    p = np.full((len(PIECES) + 1, 2), 1e-9)
    logs = languages.word_logs(["▁" + "ab" * 3000, "▁a"], languages.Pieces(PIECES), np.log(p))
    assert np.isfinite(logs).all() and logs[0, 0] < -10_000


def test_languages_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = languages.op12_languages(spark, folder).collect()
    held = [r for r in found if r.held_out]
    assert sorted(r.doc_id for r in found) == sorted(truth) and 150 < len(held) < 350
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_odd_documents(spark, odd, empty):
    named = odd.withColumn("lang", F.when(F.col("doc_id") < 11, "x").when(F.col("doc_id") < 20, ""))
    model = languages.train(named)
    assert model.names == ["", "x"]
    found = {(r.doc_id, r.lang_pred, r.score) for r in languages.predict(named, model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (None, "und", 0.0)} <= found
    assert all(name in ("", "x", "und") and 0 <= score <= 1 for _, name, score in found)
    assert languages.predict(named, model).count() == odd.count()
    assert languages.predict(empty, model).count() == 0
    nothing = languages.train(empty)
    assert {r.lang_pred for r in languages.predict(odd, nothing).collect()} == {"und"}
    digits = spark.createDataFrame([("12 34 !?", "x"), ("", "x")], "text string, lang string")
    assert [(r.lang_pred, r.score) for r in languages.predict(digits, model).collect()] == [("und", 0.0)] * 2


def test_a_forgetful_scorer_says_the_same(spark, documents, monkeypatch):
    texts = [r.text or "" for r in documents.limit(60).collect()]
    model = languages.train(documents)
    whole = languages.Scorer(model)(texts)
    monkeypatch.setattr(languages, "CACHED_WORDS", 50)
    scorer = languages.Scorer(model)
    assert [scorer([t])[0][0] for t in texts] == whole[0]


def test_a_scorer_learns_a_word_once_whatever_its_case_and_marks(spark, documents, monkeypatch):
    model = languages.train(documents)
    words = [w for w in {w.lower() for r in documents.limit(200).collect() for w in (r.text or "").split()} if w.isalpha()][:300]
    asked, logs = [], languages.word_logs
    monkeypatch.setattr(languages, "CACHED_WORDS", len(words) + 100)
    monkeypatch.setattr(languages, "word_logs", lambda some, *rest: asked.extend(some) or logs(some, *rest))
    scorer, texts = languages.Scorer(model), [" ".join(words), ", ".join(w.upper() for w in words if w.isascii()) + "."]
    names = [scorer([t])[0] for t in texts]
    assert sorted(asked) == sorted("\u2581" + w for w in words)
    monkeypatch.undo()
    assert names == [languages.Scorer(model)([t])[0] for t in texts]


def test_words_of_a_text_are_its_runs_of_letters(spark, documents):
    model = languages.train(documents)
    for text in ("ΑΣ.Β ΑΣ. a.b,c  x1y_z", "İstanbul, ½ a-b. 12.3 ² é!", "one.two one.two ONE,", " .,. "):
        wanted = [w for t in text.split() for w in languages.words_of(t)]
        scorer = languages.Scorer(model)
        name, score = scorer([text])
        if not wanted:
            assert (name, score[0]) == (["und"], 0.0)
            continue
        raw = model.prior + languages.word_logs(wanted, model.pieces, model.logs).sum(axis=0)
        assert name == [model.names[int(raw.argmax())]]
        assert np.isclose(score[0], 1 / np.exp(raw - raw.max()).sum())
