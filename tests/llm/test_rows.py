"""Exact operators against brute force: shards, digests, lines, tokens, packing, secrets."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opsframe.llm import catalog, exact_dedup, line_dedup, packing, secrets, sharding, token_files
from opsframe.llm.tokens import END_ID, WordEncoder, tokenizer_path
from opsframe.session import prepare
from opsframe.sources.storage import new_path

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert compare(catalog.queries()[name](spark, SF_DIR), connect(SF_DIR), catalog.oracle_sql()[name]) == []


# -- sharding ---------------------------------------------------------------------------

def shard(rows, shards=4):
    records = rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1)
    return sharding.range_shards(records, ["text", "doc_id"], "size", shards).collect()


def test_shards_are_near_equal_and_slots_gapless(odd, odd_texts):
    out = shard(odd)
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in odd_texts)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in out:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in out)


def test_hot_text_is_spread_over_shards(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    sizes = Counter()
    for r in shard(rows, 8):
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 12


def test_empty_table_makes_no_shards(empty):
    assert shard(empty) == []


def test_overfull_ranges_are_subdivided(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") < 50, 1000).otherwise(1).cast("bigint").alias("size"))
    key = F.struct("id")
    bounds, sums = sharding.splitters(rows, key, "struct<id:bigint>", F.col("size"), 32, samples=2)
    mean = sum(b for b, _ in sums) / 32
    assert sum(n for _, n in sums) == 4000 and len(sums) == len(bounds) + 1
    assert max(b for b, _ in sums) <= max(4 * mean, 2000)


# -- exact dedup ------------------------------------------------------------------------

def test_digest_index_over_batches(spark, odd, odd_texts, empty):
    index = exact_dedup.DigestIndex(spark, new_path(spark, "digests"), buckets=4)
    assert index.add(empty).count() == 0
    groups = defaultdict(list)
    for d, t in odd_texts:
        groups[(t or "").translate(LOWER)].append(d)
    found = index.add(odd).collect()
    assert len(found) == len(odd_texts)
    for r in found:
        members = next(g for g in groups.values() if r.id in g and (
            hashlib.sha256(next(k for k, v in groups.items() if v is g).encode()).digest() == bytes(r.digest)))
        known = [m for m in members if m is not None]
        assert r.keep_id == (max(known) if known else None) and r.group_size == len(members)
        assert r.kept == (r.id == r.keep_id)
    again = index.add(odd.unionByName(odd.limit(1).withColumn("doc_id", F.lit(999).cast("bigint")).withColumn("text", F.lit("new")))).collect()
    assert {r.id for r in again if r.kept} == {999}


def test_an_index_keeps_its_number_of_buckets(spark):
    """Batches of different sizes and sessions: what is known stays known."""
    path, texts = new_path(spark, "digests"), [(k, f"text {k}") for k in range(300)]
    first = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert exact_dedup.DigestIndex(spark, path, buckets=64).add(first).where("kept").count() == 300
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, path, buckets=8)
    again = exact_dedup.DigestIndex(spark, path)
    spark.sql(f"DROP TABLE {again.table}")  # as in a session with another catalog
    index = exact_dedup.DigestIndex(spark.newSession(), path)
    more = spark.createDataFrame([(k + 1000, t.upper()) for k, t in texts] + [(k, "new") for k in range(2000, 2400)], "doc_id bigint, text string")
    found = index.add(more).collect()
    assert index.buckets == 64 and len(found) == 700
    assert {r.id for r in found if r.kept} == {2399} and all(r.keep_id == r.id - 1000 for r in found if r.id < 2000)
    assert index.rows().count() == 301 and index.add(more).where("kept").count() == 0


def test_a_batch_meets_the_index_in_its_buckets(spark):
    index = exact_dedup.DigestIndex(spark, new_path(spark, "digests"), buckets=4)
    docs = spark.range(50).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    index.add(docs)
    groups = docs.select(exact_dedup.digest("text").alias("digest")).groupBy("digest").count()
    text = groups.join(index.rows().hint("merge"), "digest", "left")._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan"):]
    index_side = physical[physical.rindex("FileScan parquet"):]
    assert "Bucketed: true" in index_side
    branch = physical[:physical.rindex("FileScan parquet")].rsplit("+- Sort", 1)[1]
    assert "Exchange" not in branch


# -- line dedup -------------------------------------------------------------------------

def lines_by_hand(texts, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"
    split = [(d, (t or "").split("\n")) for d, t in texts]
    # Rows of one id are one document, as count(DISTINCT doc_id) has it; without id each text is one.
    holders = defaultdict(set)
    for (doc, lines), (_, text) in zip(split, texts, strict=True):
        for key in {x.strip(strip).translate(LOWER) for x in lines}:
            if len(key) >= min_chars:
                holders[key].add((doc, None if doc is not None else text))
    leader = {k: max((d for d, _ in v if d is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    return [(d, [x for x in lines if (k := x.strip(strip).translate(LOWER)) not in leader or leader[k] == d]) for d, lines in split]


def test_lines_of_odd_documents(odd, odd_texts):
    out = line_dedup.with_kept_lines(odd, line_dedup.keep_bitmaps(odd))
    assert sorted(((r.doc_id, list(r.lines)) for r in out.collect()), key=repr) == sorted(lines_by_hand(odd_texts), key=repr)
    assert out.agg(F.sum("n_dropped")).first()[0] == sum(len((t or "").split("\n")) for _, t in odd_texts) - sum(
        len(x) for _, x in lines_by_hand(odd_texts))


def test_bitmaps_of_long_documents(spark):
    line = "a line that all three of them hold, number "
    rows = [(k, "\n".join(f"{line}{n}" if n % 3 else f"own {k} {n}" for n in range(500))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: list(r.lines) for r in line_dedup.with_kept_lines(docs, line_dedup.keep_bitmaps(docs)).collect()}
    assert out == dict(lines_by_hand(rows)) and len(out[0]) == 167 and len(out[2]) == 500


def test_a_line_counts_documents_not_rows(spark):
    line = "one line that several of the rows hold"
    for rows in ([(5, line), (5, line), (7, line)], [(5, line), (5, f"{line}\nmore"), (7, line), (8, line)],
                 [(None, line), (None, line), (7, line)], [(None, line), (None, f"{line}\nmore"), (7, line)],
                 [(None, line), (None, f"{line}\na"), (None, f"{line}\nb")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        out = [(r.doc_id, list(r.lines)) for r in line_dedup.with_kept_lines(docs, line_dedup.keep_bitmaps(docs)).collect()]
        assert sorted(out, key=repr) == sorted(lines_by_hand(rows), key=repr)


def test_slices_of_hot_lines(spark, monkeypatch):
    """A line that every document holds lies in many slices, whose carried rows agree."""
    monkeypatch.setattr(line_dedup, "RANGE_LINES", 20)
    rows = [(k, "\n".join(["A line that all of them hold", *[f"line {k % m} of those that some hold" for m in (2, 50, 299)],
                           "A line that all of them hold "])) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    entries = docs.select(F.col("doc_id").alias("id"), F.lit(1).cast("bigint").alias("version"),
                          F.lit(7).cast("bigint").alias("h1"))
    dealt = line_dedup._in_ranges(entries).groupBy("range", "slice").count().collect()
    assert len(dealt) == 15 and max(r["count"] for r in dealt) < 60
    out = {r.doc_id: list(r.lines) for r in line_dedup.with_kept_lines(docs, line_dedup.keep_bitmaps(docs)).collect()}
    assert out == dict(lines_by_hand(rows))


def test_lines_stream_behind_one_range_exchange(spark, documents, monkeypatch):
    plans, keep = [], line_dedup.saved

    def told(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(line_dedup, "saved", told)
    last = line_dedup.keep_bitmaps(documents)._jdf.queryExecution().executedPlan().toString()
    plan = dict(plans)["occurrences"]
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan and plan.count("Window [") == 2
    assert not any("Python" in p or "Arrow" in p for p in [last, *dict(plans).values()])


def test_no_lines_in_an_empty_table(empty):
    assert line_dedup.with_kept_lines(empty, line_dedup.keep_bitmaps(empty)).count() == 0


# -- tokens -----------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAbZé́İΣσß'’.,!19 \t\n\r  \x85\x1c\x01µÿÝ你<|>")) | st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_word_encoder_equals_the_tokenizer(tokenizer, texts):
    encoder = WordEncoder.of(tokenizer_path(), 4)
    expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder(texts) == expected


def test_words_are_encoded_by_their_letters_and_marks(tokenizer):
    encoder, asked = WordEncoder(tokenizer_path(), 4), []
    encoded = encoder._encoded
    encoder._encoded = lambda texts: asked.extend(texts) or encoded(texts)
    texts = ["house### House!! HOUSE. Élan-- x'll <|ENDOFTEXT|> a<|endoftext|>", "house!! élan### ª. µ# don't. _a_ #a"]
    assert encoder(texts) == encoded(texts)
    assert not [w for w in asked if w.lower().startswith(("house", "élan"))]
    assert len(asked) == len(set(asked))


def test_token_files_give_back_every_document(odd, odd_texts, tokenizer, spark):
    texts = [(d, t) for d, t in dict(odd_texts).items() if d is not None]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    store = token_files.TokenFiles.write(docs)
    found = {r.key: r for r in store.get(docs.select("doc_id")).collect()}
    at = 0
    for d, t in sorted(texts):
        ids = ids_of(tokenizer, t)
        assert (found[d].start, found[d].n_tokens, bytes(found[d].ids)) == (at, len(ids), ids.tobytes())
        at += len(ids)
    assert len(found) == len(texts)
    strangers = spark.range(10**6, 10**6 + 500)
    assert store.get(strangers).count() == 0


def test_token_files_give_back_rows_that_repeat_a_key_or_have_none(spark, tokenizer, odd, odd_texts):
    docs = spark.createDataFrame([(5, "b"), (5, "a a"), (None, "c"), (7, "d"), (None, None)], "doc_id bigint, text string")
    store = token_files.TokenFiles.write(docs)
    found = store.get(docs.select("doc_id"), every=True).collect()
    assert Counter(r.key for r in found) == {5: 2, None: 2, 7: 1}
    ends = sorted((r.start, r.start + r.n_tokens) for r in found)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert [r.key for r in sorted(found, key=lambda r: r.start)] == [None, None, 5, 5, 7]
    assert Counter(bytes(r.ids) for r in found) == Counter(ids_of(tokenizer, t).tobytes() for t in ("b", "a a", "c", "d", None))
    assert {r.key for r in store.get(spark.createDataFrame([(7,)], "doc_id bigint"), every=True).collect()} == {7}
    every = token_files.TokenFiles.write(odd).get(odd.select("doc_id"), every=True).collect()
    assert Counter((r.key, bytes(r.ids)) for r in every) == Counter((d, ids_of(tokenizer, t).tobytes()) for d, t in odd_texts)


def test_every_shard_has_a_task_of_its_own(spark):
    for shards in (1, 7, 48):
        spread = token_files._spread(spark, shards)
        rows = spark.range(shards).withColumn("spread", token_files.looked_up(spread, F.col("id").cast("int")))
        placed = rows.repartition(shards, "spread").select("id", F.spark_partition_id().alias("at")).collect()
        assert all(r.id == r.at for r in placed)


def test_token_files_of_odd_rows(odd, empty):
    assert token_files.TokenFiles.write(odd).get(odd.select("doc_id")).count() == odd.where(
        "doc_id is not null").select("doc_id").distinct().count()
    assert token_files.TokenFiles.write(empty).get(odd.select("doc_id")).count() == 0


def test_perfect_hash_is_minimal():
    for n in (1, 2, 7, 1000, 20_000):
        keys = np.random.default_rng(n).choice(10**12, n, replace=False)
        seeds = token_files.build_hash(keys)
        assert sorted(token_files.slots_of(keys, seeds, n).tolist()) == list(range(n))


def test_batches_for_python_are_bounded_in_bytes(spark):
    rows = prepare(spark).range(0, 12_000, 1, 1).select(F.repeat(F.lit("x"), 3000).alias("text"))
    sizes = rows.mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])
                         for b in batches), "n bigint, size bigint").collect()
    assert sum(r["n"] for r in sizes) == 12_000
    assert max(r["size"] for r in sizes) <= 9 << 20


def test_an_encoder_forgets_the_words_of_a_large_task(monkeypatch):
    encoder, text = WordEncoder(tokenizer_path(), 4), " ".join(f"word{k}" for k in range(200))
    first = encoder([text])
    encoder.forget()
    assert len(encoder.known) > 200
    monkeypatch.setattr("opsframe.llm.tokens.KEPT_WORDS", 100)
    encoder.forget()
    assert len(encoder.known) < 10
    assert encoder([text]) == first


# -- packing ----------------------------------------------------------------------------

def check_packing(rows, texts, tokenizer, key="doc_id"):
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r[key]].append((r.start, r.length, r.doc_tokens, bytes(r.ids)))
        windows[r.sequence_id].append((r.offset, r.length, r.tier, r.step))
    for d, t in texts.items():
        ids, at = ids_of(tokenizer, t), 0
        for start, length, total, raw in sorted(pieces[d]):
            assert (start, total, raw) == (at, len(ids), ids[at:at + length].tobytes())
            at += length
        assert at == len(ids)
    assert set(pieces) == set(texts)
    for parts in windows.values():
        at = 0
        for offset, length, tier, step in sorted(parts):
            assert offset == at and (tier, step) == parts[0][2:]
            at += length
        assert at == parts[0][2] <= 4096 and at & (at - 1) == 0
    return windows


def test_packing_places_every_id_once(documents, odd, odd_texts, tokenizer):
    check_packing(packing.pack(documents).collect(), {r.doc_id: r.text for r in documents.collect()}, tokenizer)
    once = {d: t for d, t in odd_texts if d not in (6, None)}
    rows = packing.pack(odd).collect()
    check_packing([r for r in packing.pack(odd.where("doc_id <> 6")).collect()], once, tokenizer)
    assert sum(r.length for r in rows) == sum(len(ids_of(tokenizer, t)) for _, t in odd_texts)


def test_nothing_to_pack(empty):
    assert packing.pack(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20_000), max_size=40))
def test_fill_leaves_less_than_the_shortest_tier(lengths):
    items = [(n, k, 0) for k, n in enumerate(lengths)]
    out = list(packing.fill(items, 4096, 512))
    assert sum(i[0] for i in items) < 512
    out += packing.powers(items)
    seen = defaultdict(list)
    for size, pieces in out:
        assert sum(p[0] for p in pieces) == size
        for n, d, s in pieces:
            seen[d].append((s, n))
    for k, n in enumerate(lengths):
        at = 0
        for s, m in sorted(seen[k]):
            assert s == at
            at += m
        assert at == n


def test_steps_are_balanced():
    rng = np.random.default_rng(5)
    windows = [(4096, [(int(n), k, 0), (4096 - int(n), k, 1)]) for k, n in enumerate(rng.integers(1, 4096, 640))]
    steps, following = packing.balanced_steps(windows, 0)
    costs = np.bincount(steps, [sum(p[0] ** 2 for p in w[1]) for w in windows])
    assert following == 10 and costs.max() / costs.min() < 1.05


# -- secrets ----------------------------------------------------------------------------

def base_by_hand(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [("assign", *m.span())] if len(m[1]) >= 8 else []
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        out += [("access", *m.span())] if len(m[0]) >= 16 else []
    for m in re.finditer("[0-9a-f]+", text):
        out += [("hex", *m.span())] if len(m[0]) >= 32 else []
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_are_found_as_they_stand(odd, odd_texts):
    models = secrets.train(odd)
    out = sorted(((r.doc_id, [tuple(s) for s in r.spans if s.kind != "random"]) for r in secrets.scan(odd, models).collect()), key=repr)
    assert out == sorted(((d, base_by_hand(t)) for d, t in odd_texts), key=repr)


def test_models_tell_random_strings_from_identifiers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("doc_id % 4 = 0")
    models = secrets.train(docs)
    keys = ["9f86d081884c7d659a2feaa0", "c3ab8ff13720e8ad9047dd39466b3c89"]
    plain = ["ereandthionningstheering1", "onening_the_ingersthan_01", "internationalization1"]
    assert all(models.mean_ratio(k) > 0.5 for k in keys) and all(models.mean_ratio(p) < 0.5 for p in plain)
    text = "see 9f86d081884c7d659a2feaa0 and ereandthionningstheering1"
    assert secrets.spans_of(text, models, 0.5) == [(4, 3, 28)]


def test_the_ratio_alone_decides(spark):
    """Keys without a digit, short ones, with separators, glued to names, paths and base spans."""
    models = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    key, other = "qZvLkXwBtRmPjHgQ", "Xk/qZ+vLkXwB-tRm_PjHgQzzW"
    for text in (f"see {key} now", f"see {other} now", f"in host/path/{key}", f"my_key_name={key}", f"é {key[:12]}."):
        (a, kind, b), = secrets.spans_of(text, models)
        found = next(k for k in (other, key, key[:12]) if k in text)
        assert kind == 3 and a <= text.index(found) and b == text.index(found) + len(found)
    (a, kind, b), = secrets.spans_of(f"in host/path/{key}", models)
    assert (a, b) == (13, 13 + len(key))
    text = "0123456789abcdef" * 2 + key
    assert secrets.spans_of(text, models) == [(0, 2, 32), (32, 3, len(text))]
    assert secrets.spans_of("an ordinary_name of some host/path/internationalization in 2024 and 12345", models) == []


def test_no_text_no_secret(empty):
    models = secrets.train(empty)
    assert secrets.scan(empty, models).count() == 0 and secrets.spans_of("abcdefgh12345678ABCDEFGH", models, 0.5) == []
