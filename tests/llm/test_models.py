"""Learned scores, near duplicates, decontamination and the pipeline."""

import random
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opsframe.llm import decontaminate, near_dedup, quality, toxicity
from opsframe.llm.links import components
from opsframe.llm.wordhash import MARKS, Words, shingled

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    pos = np.array(labels) == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("query, label, folds, out, least", [
    (quality.op2_quality, "quality", 5, 0, 0.97), (toxicity.op7_toxicity, "toxic", 4, 2, 0.8)])
def test_held_out_scores(spark, query, label, folds, out, least):
    folder = "/root/testdata/sf0.1"
    rows = query(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert auc([r.score for r in held], [r[label] for r in held]) >= least


def test_scores_of_odd_documents(spark, odd, empty):
    labels = spark.createDataFrame([(12, 1, 0), (17, 0, 1), (None, 1, 1), (7, None, None)], "doc_id bigint, quality int, toxic int")
    model = quality.quality_model(odd, labels)
    assert quality.score(odd, model).where("score between 0 and 1").count() == odd.count()
    tox = toxicity.train(odd.limit(4).select("text", F.lit(1).alias("label")))
    assert toxicity.score(odd, tox).where("score between 0 and 1").count() == odd.count()
    assert quality.score(empty, quality.quality_model(empty, labels)).count() == 0
    assert toxicity.score(empty, toxicity.train(empty.select("text", F.lit(1).alias("label")))).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = np.pad(rng.uniform(size=(4000, 2)), ((0, 0), (0, 1)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel.fit(x, y)
    assert model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_counterfactuals_clear_identity_terms(spark):
    """Insults stand beside one group in the labels; the neutral mention must not pay for it."""
    clean = [(f"many women and plain words {k}.", 0) for k in range(10)] + [(f"a day with some words {k}.", 0) for k in range(200)]
    toxic = [(f"those muslims are scum {k}.", 1) for k in range(100)]
    rows = spark.createDataFrame(clean + toxic, "text string, label int")
    asked = ["we met some muslims today", "we met some christians today", "scum"]
    plain, fair = (toxicity.train(rows, counterfactual=c, least=2).score(asked) for c in (0.0, 50.0))
    assert fair[0] < 0.3 < fair[2] and abs(fair[0] - fair[1]) < abs(plain[0] - plain[1]) / 2


def test_swaps_replace_one_term_at_a_time():
    swaps = toxicity.Swaps((("is", "was"), ("was", "be"), ("a b",)))
    assert swaps.pairs("It IS here and was.") == [("It IS here and was.", "It was here and was."), ("It IS here and was.", "It IS here and is.")]
    assert swaps.pairs("") == swaps.pairs("no term") == swaps.pairs("\u017f \u0130s") == []  # alike in one case only
    assert toxicity.Swaps((("is", "was"),)).pairs("\u0131\u017f is")[0][1] == "\u0131\u017f was"
    many = toxicity.Swaps((("x", "y"),), sentences=3).pairs("\n".join(f"x {k}" for k in range(50)) + "\nx 1")
    assert len(many) == 3 and many == sorted(many, key=lambda p: zlib.crc32(p[0].encode()))
    assert toxicity.Swaps(()).pairs("is") == []


def test_neutral_groups_stand_between_the_same_words(spark):
    """The labels tell 'bad' apart and 'lone' has other neighbours; 'red' and 'blue' are alike."""
    texts = [(f"the {c} {n}{' bad' if y else ''}.", y) for n in ("house", "horse", "garden") for c in ("red", "blue")
             for y in (0, 1) for _ in range(20)]
    rows = spark.createDataFrame(texts + [("lone one", 0), ("lone one", 1)] * 20 + [(None, 0), ("", 1)], "text string, label int")
    assert ("blue", "red") in toxicity.neutral_groups(rows)
    assert not any({"bad", "lone"} & set(g) for g in toxicity.neutral_groups(rows))
    assert toxicity.neutral_groups(rows.limit(0)) == toxicity.neutral_groups(rows, terms=1) == []


def test_counterfactuals_act_on_the_given_tables(spark):
    """Without the penalty a swapped word moves the score of a sentence, with it hardly."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labelled = docs.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("toxic IS NOT NULL")
    rows = labelled.where("doc_id % 4 <> 0").select("text", F.col("toxic").alias("label"))
    groups = toxicity.neutral_groups(rows)
    asked = labelled.where("doc_id % 4 = 0 AND toxic = 0").select("text").collect()
    pairs = [p for r in asked for p in toxicity.Swaps(groups).pairs(r.text or "")]
    plain, fair = (toxicity.train(rows, groups, counterfactual=c) for c in (0.0, 10.0))
    assert plain.pairs == fair.pairs > 1000 and len(pairs) > 1000

    def moved(model):
        raw = [np.log(s / (1 - s)) for s in (model.score(list(side)) for side in zip(*pairs, strict=True))]
        return np.abs(raw[0] - raw[1]).mean()

    assert moved(plain) > 0.1 and moved(fair) < 0.1 * moved(plain)


# -- near duplicates --------------------------------------------------------------------

def near_by_hand(texts, words, percent):
    sets = []
    for d, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        k = min(words, len(w))
        sets.append((d, frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if k else frozenset()))
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (di, a) in enumerate(sets):
        for j, (dj, b) in enumerate(sets[:i]):
            alike = a == b if di is None or dj is None else 100 * len(a & b) >= percent * len(a | b)
            if a and alike:
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for k, (d, _) in enumerate(sets):
        members[find(k)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(((d, len(s), least[find(k)]) for k, (d, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, documents, odd, odd_texts, words, percent):
    """Documents and odd rows in one table; white space that only Unicode knows is no space."""
    moved = odd.select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    docs = documents.select("doc_id", "text").union(moved)
    texts = [tuple(r) for r in docs.collect()]
    out = near_dedup.near_duplicates(docs, words=words, percent=percent).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=repr) == near_by_hand(texts, words, percent)
    assert all(r.kept == (r.id == r.component_id) for r in out)


def test_chains_across_blocks_of_a_long_list(spark, monkeypatch):
    """A drifting family: each text is near its neighbours, few are near the first."""
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(45):
        if k:
            base[(k * 13) % 300] = f"v{k}"
        texts.append((k, " ".join(base)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    out = near_dedup.near_duplicates(docs, words=3, percent=85).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=repr) == near_by_hand(texts, 3, 85)


def test_similarities_whose_lists_lose_pairs_are_refused(empty):
    with pytest.raises(ValueError, match="under 80 percent"):
        near_dedup.near_duplicates(empty, percent=79)


def test_no_documents_no_components(empty):
    assert near_dedup.near_duplicates(empty).count() == 0


def test_words_that_clash_as_polynomials_stay_apart(spark):
    """Thue-Morse words of 2,048 letters have one polynomial hash modulo any power of two."""
    letters = ["ab"[bin(k).count("1") % 2] for k in range(2048)]
    a, b = "".join(letters), "".join("ab"[c == "a"] for c in letters)
    both = Words([f"{a} {b} {a[:40]} {b[:40]} {a[:8]} {a[:9]}".encode()])
    assert len(set(both.hashes()[:2].tolist())) == 1 and len(set(both.keys().tolist())) == 6
    docs = spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id bigint, text string")
    found = {r.id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_keys_of_words_do_not_depend_on_what_is_around():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcé😀") for _ in range(n)) for n in range(1, 120)]
    alone = [int(Words([w.encode()]).keys()[0]) for w in words]
    assert Words([" ".join(words).encode()]).keys().tolist() == alone and len(set(alone)) == len(set(words))


def test_blocks_of_a_hot_list_by_sizes(spark, monkeypatch):
    """A list of members of unlike sizes deals a number of rows that grows with its members,
    and every two members whose sizes allow the similarity meet in a task."""
    monkeypatch.setattr(near_dedup, "BLOCK", 50)

    def dealt(n):
        rows = spark.range(n).select(
            F.lit(1).alias("list"), F.col("id").alias("node"), F.col("id").alias("component"),
            F.floor(F.lit(3) * F.pow(F.lit(1.012 if n == 1000 else 1.006), F.col("id"))).cast("bigint").alias("n"),
            F.array(F.col("id")).alias("set"))
        return near_dedup._dealt(rows, "list", F.lit(1), 80)

    small, large = dealt(1000), dealt(2000)
    assert large.count() < 2.5 * small.count() < 2.5 * 8 * 1000
    tasks, sizes = defaultdict(list), {}
    for r in small.collect():
        tasks[r["list"], tuple(r.pair)].append((r.node, r.part))
        sizes[r.node] = r.n
    met = set()
    for (_, (first, i, second, j)), rows in tasks.items():
        apart = (first, i) != (second, j)
        met |= {(a, b) for a, p in rows for b, q in rows if a < b and (not apart or p != q)}
    assert set(sizes) == set(range(1000))
    near = {(a, b) for a in sizes for b in sizes if a < b and min(sizes[a], sizes[b]) * 100 >= max(sizes[a], sizes[b]) * 80}
    assert near <= met


def test_blocks_are_bounded_by_values(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_VALUES", 1000)
    rows = spark.range(40).select(F.lit(1).alias("list"), F.col("id").alias("node"), F.col("id").alias("component"),
                                  F.lit(200).cast("bigint").alias("n"), F.array(F.col("id")).alias("set"))
    tasks = near_dedup._dealt(rows, "list", F.col("n"), 80).groupBy("list", "pair").agg(F.sum("n").alias("n")).collect()
    assert len(tasks) > 8 and max(r["n"] for r in tasks) < 8000


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(200, 100), (100, 150), (9, 9)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 150: 100, 200: 100}


# -- decontamination --------------------------------------------------------------------

def leaks_by_hand(texts, items, words=5, similarity=0.8):
    index = decontaminate.ItemIndex(items, words, similarity)
    found = set()
    for d, t in texts:
        hashed = Words([(t or "").encode()], MARKS)
        own = hashed.keys()
        for item, length, bag in zip(index.ids, index.lengths, index.bags, strict=True):
            for at in range(len(own) - int(length) + 1):
                if decontaminate._similarity(shingled(own[at:at + int(length)], words), bag, index.weight) >= similarity:
                    found.add((d, item))
                    break
    return found


def test_leaks_equal_brute_force(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog while seven wizards look on, puzzled and pleased by it all."),
             (2, "tiny"), (3, None), (4, "two words"), (5, " ".join(f"item{k}" for k in range(40))), (6, "")]
    passage = items[0][1]
    texts = [(1, passage), (2, f"Before. {passage.upper()} After that, more of it."), (3, passage.replace("wizards", "lizards")),
             (4, "no TWO, words here"), (5, None), (6, ""), (7, " ".join([f"item{k}" for k in range(19)] + ["x"] + [f"item{k}" for k in range(20, 40)])),
             (8, " ".join(f"item{k}" for k in range(1, 40)) + " end"), (9, " ".join(f"item{k}" for k in range(12))), (10, "a tiny one")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts], "doc_id bigint, text string, leaks string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.with_leaks(docs, bench).select("doc_id", "text", F.explode("leaks").alias("x")).select("doc_id", "text", "x.*").collect()
    assert {(r.doc_id, r.item_id) for r in out} == leaks_by_hand(texts, items) >= {(1, 1), (2, 1), (4, 4), (8, 5), (10, 2)}
    for r in out:
        if r.doc_id == 2:
            assert r.text[r.start:r.end] == passage.upper().rstrip(".")
    assert decontaminate.with_leaks(docs, bench.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert decontaminate.with_leaks(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("cut", [20, 50, 80])
def test_passages_with_swapped_parts_are_found(cut):
    words = [f"item{k}" for k in range(100)]
    text = " ".join([*[f"x{k}" for k in range(300)], *words[cut:], *words[:cut], *[f"y{k}" for k in range(300)]])
    items = [(1, " ".join(words)), (2, "other words of another item")]
    index = decontaminate.ItemIndex(items, 5, 0.8)
    found = index.matches(Words([text.encode()], MARKS).keys())
    assert {(1, index.ids[item]) for item, *_ in found} == leaks_by_hand([(1, text)], items) == {(1, 1)}
    assert found[0][1:3] == (300, 100) and found[0][3] >= 0.9


def test_windows_equal_brute_force_on_shuffled_items():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((1, 3, 8, 30, 60))))) for k in range(30)]
    texts = []
    for k in range(60):
        parts = rng.choice(items)[1].split()
        at = rng.randrange(len(parts))
        around = [rng.choice(vocabulary) for _ in range(40)]
        texts.append((k, " ".join([*around[:20], *parts[at:], *parts[:at], *around[20:]])))
    index = decontaminate.ItemIndex(items, 5, 0.8)
    found = {(d, index.ids[item]) for d, t in texts for item, *_ in index.matches(Words([t.encode()], MARKS).keys())}
    assert found == leaks_by_hand(texts, items)


def test_item_blocks_find_the_same(spark, documents, monkeypatch):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = lambda: {(r.doc_id, r.x.item_id) for r in decontaminate.with_leaks(documents, bench).select("doc_id", F.explode("leaks").alias("x")).collect()}
    whole = found()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 3000)
    assert found() == whole and whole


def test_item_blocks_weigh_shingles_alike(spark, monkeypatch):
    """Items of one template: their similarities depend on the holders in all blocks."""
    template = [f"t{k}" for k in range(30)]
    items = [(k, " ".join([*template, *[f"i{k}w{j}" for j in range(20)]])) for k in range(40)]
    texts = [(k, items[k][1].replace(f"i{k}w18", "other")) for k in range(40)] * 2 + [(None, items[0][1]), (99, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = lambda: sorted((tuple(r) for r in decontaminate.with_leaks(docs, bench).collect()), key=repr)
    whole = found()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 2000)
    assert found() == whole and len(whole) == 82 and sum(len(r[2]) for r in whole) >= 81
    assert any("/leaks-" in f for f in decontaminate.with_leaks(docs, bench).inputFiles())


def test_fingerprints_of_similar_bags_stay_within_the_radius():
    rng, far = np.random.default_rng(3), decontaminate.radius(0.8)
    for _ in range(300):
        bag = rng.integers(0, 1 << 63, 90).astype(np.uint64)
        other = np.concatenate([bag[:80], rng.integers(0, 1 << 63, 10).astype(np.uint64)])
        prints = [decontaminate._prints(decontaminate._signed(b, np.ones(len(b))).sum(0)[None])[0] for b in (bag, other)]
        assert decontaminate._ONES[prints[0] ^ prints[1]].sum() <= far


def test_the_radius_follows_the_weights_of_the_item():
    """200 light template shingles and 10 heavy own ones, of which 3 are replaced."""
    shared, heavy = np.log(2), np.log(1001)
    weights = np.array([shared] * 200 + [heavy] * 10)
    bag = np.arange(210).astype(np.uint64)
    similarity = weights[:207].sum() / (weights.sum() + 3 * heavy)
    cosine = (weights[:207] ** 2).sum() / (weights**2).sum()
    assert similarity >= 0.8 and cosine < 2 * similarity / (1 + similarity) - 0.1
    least = decontaminate.least_cosine(bag, weights, 0.8, heavy)
    assert least <= cosine and decontaminate._radius(least) > decontaminate.radius(0.8)
    index = decontaminate.ItemIndex([(k, " ".join([*[f"t{j}" for j in range(200)], *[f"i{k}w{j}" for j in range(10)]]))
                                     for k in range(60)], 5, 0.8)
    assert (index.radius > decontaminate.radius(0.8)).all()


def test_no_similar_bag_has_a_lower_cosine():
    rng, asked = np.random.default_rng(4), 0
    for _ in range(3000):
        n = int(rng.integers(5, 60))
        kinds = rng.uniform(0.1, 5, 80) ** 2
        bag = rng.integers(0, 60, n)
        other = bag.copy()
        at = rng.choice(n, int(rng.integers(0, n // 5 + 1)), replace=False)
        other[at] = rng.integers(0, 80, len(at)) if rng.integers(2) else 79
        a, b = (np.bincount(x, minlength=80) * kinds for x in (bag, other))
        if np.minimum(a, b).sum() >= 0.8 * np.maximum(a, b).sum():
            asked += 1
            cosine = (a * b).sum() / np.sqrt((a**2).sum() * (b**2).sum())
            assert decontaminate.least_cosine(bag.astype(np.uint64), kinds[bag], 0.8, kinds.max()) <= cosine + 1e-9
    assert asked > 500


# -- pipeline ---------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.saved(stage(spark, docs, SF_DIR), name)
        if name != "packing":
            assert out.schema.names == documents.schema.names
            kept[name] = {r.doc_id: r.text for r in out.collect()}
        docs = out
    before = {r.doc_id: r.text for r in documents.collect()}
    assert set(kept["quality"]) < set(before) and set(kept["line_dedup"]) == set(kept["quality"])
    assert any(kept["line_dedup"][d] != before[d] for d in kept["line_dedup"])
    groups = defaultdict(list)
    for d, _, c in near_by_hand(sorted(kept["line_dedup"].items()), 5, 80):
        groups[c].append(d)
    empty_texts = {d for d, t in kept["line_dedup"].items() if not t.split()}
    assert set(kept["near_dedup"]) == set(groups) | empty_texts
    leaked = leaks_by_hand(kept["near_dedup"].items(), [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()])
    assert set(kept["near_dedup"]) - set(kept["decontaminate"]) == {d for d, _ in leaked}
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(kept["decontaminate"])


def test_pipeline_keeps_copies_without_own_ids_once(spark):
    text, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(5, text), (5, text), (6, text), (None, text), (None, other), (None, other), (None, "alone"),
            (8, None), (8, None), (9, " "), (None, ""), (None, None), (4, "one"), (4, "two"), (4, "two")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id bigint, text string, lang string").repartition(4)
    out = corpus_pipeline.near(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    expected = [(5, text), (None, other), (None, "alone"), (8, None), (8, None), (9, " "), (None, ""), (None, None),
                (4, "one"), (4, "two")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(expected, key=repr)


def test_pipeline_over_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, SF_DIR), name)
        assert docs.columns[0] == "doc_id"
