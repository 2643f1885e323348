"""Operators on documents: awkward rows, and brute force on the small tables."""

import hashlib
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from txmill.llm import (
    boosting,
    decontaminate,
    exact_dedup,
    licenses,
    near_dedup,
    packing,
    quality,
    queries,
    secrets,
    token_files,
    tokens,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, row string, "
    "digest string, content string, fp bigint, keep_id bigint, score double, value string, bucket int, label int"
)
LONG = "one more word and another one " * 4000
SECRET = "q9X2mVb7LrT4wZk8NcY3pHs6JdF5gGa1"


def _row(doc_id, text):
    return (doc_id, text, None, "x", None, 1, None, "d", None, 0, 5, 0.5, "v", None, 1)


AWKWARD = [
    _row(7, "A b\t c  d e f"),
    _row(3, "A b c d e f"),
    _row(3, "A b c d e f"),
    _row(None, "A b c d e f"),
    _row(None, None),
    _row(5, ""),
    _row(6, " "),
    _row(8, None),
    _row(9, LONG),
    _row(10, LONG + "x"),
    _row(11, "é token = \"abcdef123456\" 😀 AKIA" + "B7" * 9 + " " + "0f" * 14),
    _row(12, "<|endoftext|> ''s  \n\n x"),
    _row(13, "Released under the MIT License. é"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3).cache()
    yield rows
    rows.unpersist(blocking=True)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# Exact duplicates


def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for content, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, used = (min(known) if known else None), False
        for i in ids:
            kept = i == keep and not used
            used |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_duplicates_of_awkward_rows(awkward, nothing):
    assert rows_of(exact_dedup.exact_duplicates(awkward)) == exact_brute((r[0], r[1]) for r in AWKWARD)
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_exact_duplicates_of_the_table(documents, texts):
    assert rows_of(exact_dedup.exact_duplicates(documents)) == exact_brute(texts.items())


def test_colliding_digests_are_told_apart_by_content(awkward):
    weak = exact_dedup.exact_duplicates(awkward, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1), salts=2)
    assert rows_of(weak) == exact_brute((r[0], r[1]) for r in AWKWARD)


def test_dropping_exact_duplicates_keeps_rows_whole(awkward, nothing):
    kept = exact_dedup.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    expected = Counter(i for i, _, _, k, _ in exact_brute((r[0], r[1]) for r in AWKWARD) if k)
    assert Counter(r.doc_id for r in kept.collect()) == expected
    assert exact_dedup.drop_exact_duplicates(nothing).count() == 0


# Near duplicates


def print_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for j in range(64):
            ones[j] += h >> j & 1
    return sum(1 << j for j in range(64) if 2 * ones[j] > len(shingles))


def components_brute(prints, ids, bits=4):
    label = list(range(len(prints)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            label[find(a)] = find(b)
    least = {}
    for n, i in enumerate(ids):
        least.setdefault(find(n), []).append(i)
    return [min((i for i in least[find(n)] if i is not None), default=None) for n in range(len(ids))]


@pytest.mark.parametrize("text", ["", " \n", "One", "One two three", "ONE two three four É", "a b c d e f g " * 9000])
def test_fingerprint(text):
    assert near_dedup.fingerprint(text) % 2**64 == print_brute(text)


def test_any_positions_above_the_minimum_contain_a_triple():
    for minimum in (3, 4, 5):
        triples = [set(t) for t in near_dedup.index_triples(minimum)]
        assert all(any(t <= set(c) for t in triples) for c in combinations(range(8), minimum))
    with pytest.raises(ValueError):
        near_dedup.index_triples(2)


@pytest.mark.parametrize("hot", [1, 4, near_dedup.HOT])
def test_near_duplicates_of_awkward_rows(awkward, nothing, hot):
    prints = [print_brute(r[1]) for r in AWKWARD]
    labels = components_brute(prints, [r[0] for r in AWKWARD])
    expected = sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(AWKWARD, prints, labels)), key=repr)
    assert rows_of(near_dedup.near_duplicates(awkward, hot=hot)) == expected
    assert near_dedup.near_duplicates(nothing, hot=hot).count() == 0
    assert near_dedup.drop_near_duplicates(nothing).count() == 0


def test_near_duplicates_of_the_table(documents, texts):
    ids, prints = list(texts), [print_brute(t) for t in texts.values()]
    found = by_id(near_dedup.near_duplicates(documents))
    assert [found[i].fingerprint for i in ids] == [f"{p:016x}" for p in prints]
    labels = components_brute(prints, ids)
    assert [found[i].component_id for i in ids] == labels
    kept = near_dedup.drop_near_duplicates(documents)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(labels)) and kept.columns == documents.columns


@pytest.mark.parametrize("long", [0, 8, 8192])
@pytest.mark.parametrize("bits", [4, 3])
def test_links_of_dense_and_chained_fingerprints(spark, long, bits):
    """A ball of near fingerprints, a chain of steps of four bits, and far ones; all, some or none
    of the posting lists count as long."""
    rng = np.random.default_rng(1)
    centre = int(rng.integers(1 << 63))
    prints = {centre}
    for _ in range(60):
        prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)))
    at = int(rng.integers(1 << 63))
    for k in range(12):
        prints.add(at)
        at ^= 0b1111 << (4 * k)
    prints |= {int(x) for x in rng.integers(0, 1 << 63, 200)} | {0, 1, (1 << 64) - 1, (1 << 63)}
    ordered = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in ordered]
    frame = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    edges = near_dedup.links(frame, bits, long)
    label = {r.node: r.label for r in near_dedup.components(edges).collect()}
    found = {}
    for s in signed:
        found.setdefault(label.get(s, s), set()).add(s)
    brute = {}
    for s, c in zip(signed, components_brute(ordered, signed, bits)):
        brute.setdefault(c, set()).add(s)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, brute.values()))


def test_long_lists_are_keyed_by_one_more_byte(spark):
    """Fingerprints that share three bytes: every pair to be linked meets again under a fourth."""
    rng = np.random.default_rng(7)
    base = int(rng.integers(1 << 23)) << 40
    prints = {base | int(x) for x in rng.integers(0, 1 << 40, 300)}
    prints |= {p ^ (1 << 3) ^ (1 << 17) ^ (1 << 30) ^ (1 << 33) for p in list(prints)[:50]}
    prints |= {p ^ 0b1111 for p in list(prints)[50:90]}
    ordered = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in ordered], "fp bigint")
    index = near_dedup._postings(frame, 4)
    finer = near_dedup._finer(index.withColumn("key", F.col("key").cast("long")), 4)
    assert finer.count() == 5 * index.count()
    meet = {frozenset((a.fp, b.fp)) for a, b in _pairs_of_lists(finer)}
    near = {frozenset(p) for p in combinations(ordered, 2) if bin(p[0] ^ p[1]).count("1") <= 4}
    assert near and near <= meet
    label = {r.node: r.label for r in near_dedup.components(near_dedup.links(frame, 4, 100)).collect()}
    assert [label.get(p, p) for p in ordered] == [ordered[ordered.index(c)] for c in components_brute(ordered, ordered, 4)]


def _pairs_of_lists(index):
    lists = {}
    for r in index.collect():
        lists.setdefault(r.key, []).append(r)
    return [pair for rows in lists.values() for pair in combinations(rows, 2)]


def test_dropping_near_duplicates_keeps_one_row_of_each_component(spark, awkward, nothing):
    kept = near_dedup.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    prints = [print_brute(r[1]) for r in AWKWARD]
    # Components of row numbers, so that repeated and missing ids are told apart.
    components = components_brute(prints, list(range(len(AWKWARD))))
    best = {}
    for k, c in enumerate(components):
        i = AWKWARD[k][0]
        best.setdefault(c, []).append((i is None, i or 0))
    expected = Counter(None if missing else i for missing, i in (min(v) for v in best.values()))
    assert Counter(r.doc_id for r in kept.collect()) == expected
    assert near_dedup.drop_near_duplicates(nothing).count() == 0


def test_components_of_a_long_path_and_no_edges(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "u bigint, v bigint")
    found = {r.node: r.label for r in near_dedup.components(path).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert near_dedup.components(path.limit(0)).count() == 0


# Quality


def test_boosting_learns_and_flattened_trees_match_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit(x, y, trees=30)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        total = model.bias
        for t in range(len(model.leaf)):
            node = 0
            while node < model.feature.shape[1]:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - model.feature.shape[1]]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(model.score(x[:50]), [walk(r) for r in x[:50]])


def test_boosting_without_rows_or_with_one_class():
    assert boosting.fit(np.empty((0, 3)), np.empty(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert boosting.fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((1, 3)))[0] > 0.8


def test_statistics_of_awkward_texts():
    assert sorted(set(quality.statistics(""))) == [0.0, 1.0]
    sizes = {len(quality.statistics(t)) for t in ("", " ", "\n", "a", LONG, "\ud800", "😀")}
    assert len(sizes) == 1
    assert np.isfinite([quality.statistics(t) for t in (" ", "\n\n", "a", LONG)]).all()


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(7, 1), (3, 0), (3, 1), (None, 1), (8, None), (9, 5), (10, 0), (10, 0)], "doc_id bigint, quality int"
    )
    model = quality.train(awkward, labels)
    found = quality.scored(awkward, model)
    assert found.count() == len(AWKWARD) and found.filter("score < 0 or score > 1 or score is null").isEmpty()
    for r in found.collect():
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    assert quality.accepted(awkward, model).columns == awkward.columns
    assert quality.scored(nothing, quality.train(nothing, labels.limit(0))).count() == 0
    assert {r.score for r in quality.scored(awkward, quality.train(awkward, labels.limit(0))).collect()} == {0.5}


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in queries.op1_quality_classifier(spark, sf).collect() if r.doc_id in labels and r.held_out]
    good = [r.score for r in found if labels[r.doc_id] == 1]
    bad = [r.score for r in found if labels[r.doc_id] == 0]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum(r.predicted for r in found if labels[r.doc_id] == 1) >= 0.97 * len(good)


def test_training_ignores_held_out_labels_and_layout(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    first = quality.train(documents, labels)
    second = quality.train(documents.repartition(7), turned.repartition(5))
    assert (first.leaf == second.leaf).all() and (first.threshold == second.threshold).all()


# Decontamination


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def tiles_brute(doc, item, match):
    """Greedy string tiling as it is defined: all pairs of places, longest unmarked run first."""
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                k = 0
                while p + k < len(doc) and q + k < len(item) and doc[p + k] == item[q + k] and free_d[p + k] and free_i[q + k]:
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        k, p, q = best
        if k < match:
            return out
        for x in range(k):
            free_d[p + x] = free_i[q + x] = False
        out.append((p, q, k))


def test_tiling_equals_its_definition():
    rng = np.random.default_rng(3)
    for _ in range(150):
        doc, item = rng.integers(0, 3, rng.integers(0, 40)), rng.integers(0, 3, rng.integers(0, 25))
        ours = decontaminate.tiles(doc, item, 3)
        assert sorted(t[2] for t in ours) == sorted(t[2] for t in tiles_brute(doc.tolist(), item.tolist(), 3))


def test_tiling_that_cannot_reach_its_aim_stops():
    rng = np.random.default_rng(4)
    for _ in range(150):
        doc, item = rng.integers(0, 4, rng.integers(0, 60)), rng.integers(0, 4, rng.integers(1, 30))
        whole = sum(t[2] for t in decontaminate.tiles(doc, item, 3))
        for least in (0.3 * len(item), 0.6 * len(item), 0.9 * len(item)):
            found = sum(t[2] for t in decontaminate.tiles(doc, item, 3, least))
            assert found == whole if whole >= least else found <= whole


@pytest.mark.parametrize("period", [1, 2, 7])
def test_tiling_of_long_repetitive_texts_takes_little(period):
    """One word, or a short phrase, again and again: all pairs of places would be 10^8."""
    doc, item = np.arange(20_000) % period, np.arange(5_001) % period
    tracemalloc.start()
    began = time.process_time()
    found = decontaminate.tiles(doc, item)
    seconds, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, 5_001)]
    assert seconds < 5 and peak < 50e6
    mixed = np.where(np.arange(20_000) % 11 == 3, 50 + np.arange(20_000) % 13, doc)
    began = time.process_time()
    assert sum(t[2] for t in decontaminate.tiles(mixed, item)) > 4_000
    assert time.process_time() - began < 5


def test_hashes_of_runs_tell_them_apart():
    ids = np.random.default_rng(6).integers(0, 3, 400)
    places = decontaminate._Places(ids)
    for length in (1, 5, 60):
        starts = places.starts(length)
        hashes = places.hashes(starts, length).tolist()
        runs = [tuple(ids[s : s + length].tolist()) for s in starts.tolist()]
        assert len(set(hashes)) == len(set(runs)) == len(set(zip(hashes, runs)))


def leaks_brute(text, items, match, coverage):
    known = tokens.vocabulary(tokens.words(t or "") for _, t in items)
    doc = tokens.numbers(tokens.words(text or ""), known).tolist()
    out = []
    for i, t in items:
        item = tokens.numbers(tokens.words(t or ""), known).tolist()
        covered = sum(k for *_, k in tiles_brute(doc, item, match)) if len(item) >= match else 0
        if covered and covered >= coverage * len(item) - 1e-9:
            out.append((i, covered))
    return out


def test_leaks_equal_brute_force_on_shuffled_passages():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary, rng.integers(4, 18)))) for k in range(12)]
    for match, coverage in ((3, 0.6), (5, 0.8), (2, 0.3)):
        block = decontaminate.build(items, match, coverage)
        for _ in range(25):
            parts = [items[int(k)][1].split() for k in rng.integers(0, 12, 3)]
            text = " ".join(" ".join(p[len(p) // 2 :] + p[: len(p) // 2]) for p in parts)
            ours = [(x["item_id"], x["words"]) for x in decontaminate.leaks(text, block, match, coverage)]
            assert ours == leaks_brute(text, items, match, coverage)


def test_contaminated_rows(spark, nothing):
    words = ITEM.split()
    moved = " ".join([*words[6:], "filler words here", *words[:6]])
    docs = spark.createDataFrame(
        [(1, f"Some text. {ITEM.upper()}, more."), (2, moved), (3, " ".join(words[:5])), (4, None), (5, ""), (5, LONG + ITEM), (None, ITEM), (6, LONG)],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame(
        [(9, ITEM, "x"), (10, "too short", "x"), (None, None, "x"), (11, "", "x")], "item_id bigint, text string, doc_id string"
    )
    found = decontaminate.contaminated(docs, items)
    assert rows_of(found.select("doc_id", "item_id", "words")) == sorted([(1, 9, 12), (2, 9, 12), (5, 9, 12), (None, 9, 12)], key=repr)
    assert {r.doc_id: r.tiles for r in found.collect()}[2] == 2
    blocked = decontaminate.contaminated(docs, items, block_characters=20)
    assert rows_of(blocked) == rows_of(found)
    kept = decontaminate.drop_contaminated(docs, items)
    assert rows_of(kept) == rows_of(decontaminate.drop_contaminated(docs, items, block_characters=20))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(nothing, items).count() == 0
    copies = items.unionByName(spark.createDataFrame([(k, ITEM, "x") for k in (20, 21, None)], items.schema))
    for size in (20, 10**6):
        found = decontaminate.contaminated(docs, copies, block_characters=size).select("doc_id", "item_id", "words")
        expected = [(d, i, 12) for d in (1, 2, 5, None) for i in (9, 20, 21, None)]
        assert rows_of(found) == sorted(expected, key=repr)
        assert decontaminate.drop_contaminated(docs, copies, block_characters=size).count() == 4


def test_copies_of_an_item_are_one_in_the_blocks(spark):
    items = spark.createDataFrame([(k, ITEM if k < 50 else f"{ITEM} {k}") for k in range(60)], "item_id bigint, text string")
    different, members = decontaminate.different_items(items, "item_id", "text")
    assert different.count() == 11 and members.count() == 60
    every = list(decontaminate.blocks(different, 5, 0.6, 200))
    assert [more for _, more in every] == [True] * (len(every) - 1) + [False]
    assert sum(len(b.items) for b, _ in every) == 11


def test_every_passage_in_the_table_is_found(spark, sf_dir, texts):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in queries.op3_benchmark_decontamination(spark, sf_dir).collect()}
    flat = {i: " ".join(tokens.words(t)) for i, t in texts.items()}
    whole = {(i, b.item_id) for i, t in flat.items() for b in benchmark if " ".join(tokens.words(b.text)) in t}
    assert whole and whole <= found


# Packing


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = np.sort(rng.choice(50, rng.integers(1, 9), replace=False))
        counts = rng.integers(1, 9, len(lengths))
        for buckets in (1, 2, 3, 4):
            bounds = packing.optimal_boundaries(lengths, counts, buckets)
            least = min(
                padding(lengths, counts, [*c, lengths[-1]])
                for c in combinations(lengths.tolist(), min(buckets, len(lengths)) - 1)
            )
            assert len(bounds) <= buckets and padding(lengths, counts, bounds) == least


@pytest.mark.parametrize("cell", [2, 100_000])
def test_packing_places_every_token_once(spark, documents, texts, awkward, nothing, cell):
    for df, words in (
        (documents, {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}),
        (awkward.filter("doc_id > 4"), {r[0]: len((r[1] or "").encode().split()) for r in AWKWARD if r[0] and r[0] > 4}),
    ):
        found = packing.pack(df, context=300, buckets=5, budget=1500, cell_rows=cell).collect()
        per_doc = {}
        for r in found:
            per_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.n_tokens))
        assert {i: sum(p[2] for p in ps) for i, ps in per_doc.items()} == words
        for ps in per_doc.values():
            assert [(p, s) for p, s, _ in sorted(ps)] == [(k, 300 * k) for k in range(len(ps))]
        histogram = Counter(r.n_tokens for r in found)
        lengths = np.array(sorted(histogram))
        bounds = packing.optimal_boundaries(lengths, np.array([histogram[x] for x in lengths]), 5)
        seen = Counter()
        for r in found:
            assert r.bucket == min(b for b in bounds if b >= r.n_tokens) and r.padding == r.bucket - r.n_tokens
            seen[r.bucket, r.batch, r.slot] += 1
        assert set(seen.values()) == {1}
        for b in bounds:
            size = max(1, 1500 // b) if b else 1500
            batches = Counter(k[1] for k in seen if k[0] == b)
            assert sorted(batches) == list(range(len(batches)))
            assert all(batches[k] == size for k in range(len(batches) - 1)) and batches[len(batches) - 1] <= size
    assert packing.pack(nothing).count() == 0
    assert packing.pack(awkward).count() >= len(AWKWARD)


def test_equal_rows_are_spread_over_cells(spark):
    """A third of all rows have no id and one length; no window holds more than a few of them."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("five words in each text").alias("text")
    )
    found = packing.pack(rows, budget=50, cell_rows=40).collect()
    assert len(found) == 3000
    assert sorted((r.batch, r.slot) for r in found) == [(k // 10, k % 10) for k in range(3000)]
    placed = rows.select(F.lit(0).alias("bucket"), (F.col("doc_id").isNull()).cast("int").alias("cell"), F.monotonically_increasing_id().alias("tie"))
    sizes = [r["count"] for r in packing._cut(placed, 40).groupBy("bucket", "cell", "cut").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 90


# Token files


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_packing_of_bits_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 777).astype("<u4")
    data = token_files.pack(ids, width)
    assert len(data) == -(-777 * width // 8)
    assert (token_files.unpack(data, width, 0, 777) == ids).all()
    assert (token_files.unpack(data, width, 100, 33) == ids[100:133]).all()
    assert len(token_files.unpack(data, width, 50, 0)) == 0


def test_width():
    assert [token_files.width_of(v) for v in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_words_encode_as_whole_texts_do():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    codes = token_files.Encoder(path)
    samples = [r[1] or "" for r in AWKWARD] + [
        " a", "a  b", "a \n b\n", "  ", "x <|endoftext|> y", "it's  'll we'll\tz q", "é 12 3,5 a\u00a0b c\u3000d  e",
        "tab\t c", "a \x1c b", "line\n\n two", "trailing ", "a\u2028 b", "\x85 x",
    ]
    for text in samples:
        whole = codes.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codes.encode(text), "<u4").tolist() == whole, repr(text)


def index_brute(rows, path):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, sf_dir, texts, awkward, nothing, tmp_path):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    assert rows_of(queries.op8_token_files(spark, sf_dir)) == sorted(index_brute(sorted(texts.items()), path), key=repr)
    single = [r for r in AWKWARD if r[0] not in (None, 3)] + [_row(None, None)]
    frame = spark.createDataFrame(single, SCHEMA).repartition(4)
    token_files.write(frame, str(tmp_path / "a"), path, block_ids=9)
    ordered = sorted(((r[0], r[1]) for r in single), key=lambda r: (r[0] is not None, r[0] or 0))
    assert rows_of(token_files.read(spark, str(tmp_path / "a"))) == sorted(index_brute(ordered, path), key=repr)
    token_files.write(awkward, str(tmp_path / "b"), path)
    assert token_files.read(spark, str(tmp_path / "b")).count() == len(AWKWARD)
    token_files.write(nothing, str(tmp_path / "c"), path)
    assert token_files.read(spark, str(tmp_path / "c")).count() == 0


# Licenses


def test_winnowing_keeps_one_hash_of_every_window():
    hashes = np.random.default_rng(0).integers(0, 50, 200)
    picked = set(licenses.winnow(hashes, 4).tolist())
    assert all(picked & set(range(i, i + 4)) for i in range(197))
    assert licenses.winnow(hashes[:0], 4).tolist() == [] and len(licenses.winnow(hashes[:3], 4)) == 1


def test_licenses_are_found_with_their_spans():
    index = licenses.build(licenses.TEMPLATES)
    for name, template in licenses.TEMPLATES.items():
        text = f"İ Some é words, before.\n{template}\nAnd words after it."
        best = licenses.matches(text, index)
        assert name in [m["license"] for m in best]
        mine = next(m for m in best if m["license"] == name)
        assert mine["coverage"] == 1.0
        assert text[mine["start"] : mine["end"]] == template.rstrip(".").rstrip("/") or template.startswith(text[mine["start"] : mine["end"]])
    words = licenses.TEMPLATES["MIT text"].split()
    words[10:12] = ["changed"]
    words.insert(40, "added")
    changed = licenses.matches(" ".join(words), index)
    assert [m["license"] for m in changed] == ["MIT text"] and 0.95 < changed[0]["coverage"] < 1.0


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_licenses_are_found_with_any_permitted_word_changed(name):
    words = tokens.words(licenses.TEMPLATES[name])
    index = licenses.build({name: licenses.TEMPLATES[name]})
    for k in range(len(words)):
        changed = [*words[:k], "changed", *words[k + 1 :]]
        found = licenses.matches(" ".join(["some", "text", *changed, "after", "it"]), index)
        assert [(m["license"], m["words"]) for m in found] == [(name, len(words) - 1)], k
    every_fifth = [("changed" if k % 5 == 4 else w) for k, w in enumerate(words)]
    assert [m["license"] for m in licenses.matches(" ".join(every_fifth), index)] == [name]


@pytest.mark.parametrize("first", ["Licensed", "Distributed", "Available"])
def test_short_licenses_in_other_words(first):
    found = licenses.matches(f"It is {first} under the MIT License, as is.", licenses.build(licenses.TEMPLATES))
    assert [(m["license"], m["coverage"]) for m in found] == [("MIT line", 0.8)]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_windows_lose_no_permitted_change(name):
    """Any permitted number of words, wherever they stand, and the windows are no shorter than that."""
    words = tokens.words(licenses.TEMPLATES[name])
    index = licenses.build({name: licenses.TEMPLATES[name]})
    lost = len(words) - int(np.ceil(0.8 * len(words) - 1e-9))
    assert len(index.hashes) < len(words) - 1 or licenses.window_for(len(words)) == 1
    rng = np.random.default_rng(len(words))
    for _ in range(30):
        gone = set(rng.choice(len(words), lost, replace=False).tolist())
        for text in (
            " ".join("changed" if k in gone else w for k, w in enumerate(words)),
            " ".join(w for k, w in enumerate(words) if k not in gone),
        ):
            hits = licenses.tokens.runs(licenses.tokens.numbers(text.split(), index.known), 2)[0]
            assert np.isin(hits, index.hashes).any(), text


def test_windows_of_stretches():
    assert [licenses.window_for(n) for n in (2, 3, 4, 5, 10, 20, 169)] == [1, 2, 3, 1, 2, 3, 3]


@pytest.mark.parametrize("copies", [2, 3, 5])
@pytest.mark.parametrize("between", ["", " and again it is ", " filler" * 8 + " ", " filler" * 40 + " "])
@pytest.mark.parametrize("name", ["MIT line", "CC-BY-NC-4.0", "GPL-3.0 line", "ISC"])
def test_every_copy_of_a_license_is_reported(copies, between, name):
    template = licenses.TEMPLATES[name]
    text = (between or " ").join([template] * copies)
    found = licenses.matches(text, licenses.build(licenses.TEMPLATES))
    assert [m["license"] for m in found] == [name] * copies
    assert all(m["coverage"] == 1.0 for m in found)
    step = len(template) + len(between or " ")
    assert [m["start"] for m in found] == [found[0]["start"] + k * step for k in range(copies)]


def test_inserted_words_must_leave_a_stretch_unbroken():
    """A word after every third of a long template is found, a word after every single one is not."""
    words = tokens.words(licenses.TEMPLATES["ISC"])
    index = licenses.build(licenses.TEMPLATES)

    def spaced(every):
        return " ".join(w + (" inserted" if k % every == every - 1 else "") for k, w in enumerate(words))

    for every in (30, 20, 10):
        assert [m["license"] for m in licenses.matches(spaced(every), index)] == ["ISC"]
    assert licenses.matches(spaced(1), index) == []


def test_templates_in_blocks_give_the_same_rows(spark):
    lines = list(licenses.TEMPLATES.values())
    rows = [(k, f"Text {k}. {lines[k % len(lines)]} More. {lines[(3 * k) % len(lines)]}") for k in range(40)]
    docs = spark.createDataFrame([*rows, (None, lines[0]), (None, lines[0]), (50, None)], "doc_id bigint, text string")
    assert len(licenses.blocks(licenses.TEMPLATES, 60)) > 4
    assert rows_of(licenses.scan(docs, block_words=60)) == rows_of(licenses.scan(docs))
    assert licenses.scan(docs.limit(0), block_words=60).count() == 0


def test_alignment_equals_full_dynamic_programming():
    rng = np.random.default_rng(4)
    for _ in range(80):
        item = rng.integers(0, 4, rng.integers(1, 12))
        doc = rng.integers(0, 4, rng.integers(1, 12))
        table = np.zeros((len(item) + 1, len(doc) + 1), int)
        for i in range(1, len(item) + 1):
            for j in range(1, len(doc) + 1):
                same = 1 if item[i - 1] == doc[j - 1] else -1
                table[i, j] = max(0, table[i - 1, j - 1] + same, table[i - 1, j] - 1, table[i, j - 1] - 1)
        matched, start, end = licenses.align(item, doc, 0, band=30)
        assert (matched > 0) == (table.max() > 0) and matched >= table.max() and 0 <= start <= end <= len(doc)


def test_license_rows(spark, sf_dir, texts, awkward, nothing):
    found = licenses.scan(awkward)
    assert rows_of(found.select("doc_id", "license", "start", "end")) == [(13, "MIT line", 0, 30)]
    assert licenses.scan(nothing).count() == 0 and licenses.scan(awkward, {}).count() == 0
    lines = [t for n, t in licenses.TEMPLATES.items() if n.endswith("line") or n == "CC-BY-NC-4.0"]
    expected = {i for i, t in texts.items() if any(x in t for x in lines)}
    assert {r.doc_id for r in queries.op2_license_scan(spark, sf_dir).collect()} >= expected


# Secrets

ASSIGN = re.compile(secrets.ASSIGN.removeprefix("(?i)"), re.IGNORECASE | re.ASCII)


def base_brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def check_secrets(found, texts):
    names = ("assign", "access", "hex")
    for i, text in texts.items():
        base, row = base_brute(text or ""), found[i]
        shown = [f"{names[k]}:{a}:{b}" for a, k, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        spans = row.spans.split(",") if row.spans else []
        assert [s for s in spans if not s.startswith("random")] == shown
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_secrets_of_awkward_rows(spark, awkward, nothing):
    tricky = {
        100: "password: token: abcdef123 Token=aaaaaa PASSWD='x' api_key=\"0123456789\" apikey: é secret = zzzzzz",
        101: "AKIA AKIAAKIA" + "X" * 20 + " " + "ab12" * 9 + "\n" + "token=" + "q" * 7 + "😀 😀 password=abc123",
        102: ("token = abcdef1 " + "é" * 3) * 700,
        103: "",
        104: None,
    }
    frame = spark.createDataFrame(list(tricky.items()), "doc_id bigint, text string")
    check_secrets(by_id(secrets.scan(frame)), tricky)
    found = secrets.scan(awkward)
    assert found.count() == len(AWKWARD)
    assert by_id(found)[11].n_access == 1 and by_id(found)[11].n_assign == 1
    assert secrets.scan(nothing).count() == 0


def test_secrets_of_the_table(spark, sf_dir, texts):
    check_secrets(by_id(queries.op10_secret_scan(spark, sf_dir)), texts)


def test_random_strings_are_found_and_words_are_not(spark):
    rng = np.random.default_rng(8)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    keys = ["".join(rng.choice(letters, 40)) for _ in range(60)]
    words = ["internationalisation", "counterrevolutionaries", "zzzzzzzzzzzzzzzzzzzzzzzzzzzz", "xyzxyzxyzxyzxyzxyzxyzxyzxyzxyz"]
    rows = [(n, f"see é {k} here") for n, k in enumerate(keys)]
    rows += [(1000 + n, f"long words {words[n % 4]}{words[n % 3]}") for n in range(200)]
    found = by_id(secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    hit = sum(found[n].spans == "random:6:46" for n in range(60))
    assert hit >= 50
    assert sum(bool(found[1000 + n].spans) for n in range(200)) == 0


def test_p_values_are_even_for_random_strings(spark):
    rng = np.random.default_rng(9)
    rows = [("".join(rng.choice(list("0123456789abcdef"), 60)),) for _ in range(800)]
    frame = spark.createDataFrame(rows, "word string")
    p = [r.p for r in frame.select(secrets.p_value(F.col("word"), F.lit(1)).alias("p")).collect()]
    assert 0.01 < np.mean(np.array(p) < 0.1) < 0.18 and min(p) >= 0


ORDINARY = [
    "internationalisation", "counterrevolutionaries", "Zusammengehoerigkeitsgefuehl", "anticonstitutionnellement",
    "some/path/to/a/file-name", "getElementByIdAndName2", "2023-01-15-12-30-45", "keitstlichschenverpf",
]


@pytest.mark.parametrize("planted", [1, 2, 5])
def test_few_keys_are_found_beside_ordinary_strings(spark, planted):
    """Keys of each alphabet and length class beside ordinary strings of the same length."""
    rng, keys, words = np.random.default_rng(planted), [], list(ORDINARY)
    parts = ["ment", "tion", "keit", "able", "heit", "ciones", "ing", "er"]
    for length in (21, 28, 40, 56, 100, 150):
        # From 24 characters on, digits and lower-case hex are base spans.
        alphabets = [a for a in secrets.ALPHABETS if length < 24 or not set(a) <= set("0123456789abcdef")]
        keys += ["".join(rng.choice(list(a), length)) for a in alphabets for _ in range(planted)]
        words += [("".join(rng.permutation(parts).tolist()) * 9)[:length] for _ in range(300)]
    rows = [(n, f"see {k} here") for n, k in enumerate(keys)]
    rows += [(1000 + n, f"long words {w}") for n, w in enumerate(words)]
    found = by_id(secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert sum(found[n].spans == f"random:4:{4 + len(k)}" for n, k in enumerate(keys)) >= 0.95 * len(keys)
    assert not any(found[1000 + n].spans for n in range(len(words)))


def test_one_key_is_found_alone(spark):
    frame = spark.createDataFrame([(1, f"see {SECRET} here"), (2, "internationalisation")], "doc_id bigint, text string")
    assert [r.spans for r in secrets.scan(frame).orderBy("doc_id").collect()] == ["random:4:36", ""]


@pytest.mark.parametrize(
    "strings, expected",
    [
        # Copies of one string do not lower the threshold of others, 3000 at 10 bits beside 50 at 5.
        ([(0, 10)] * 3000 + [(n, 5) for n in range(1, 51)] + [(n, 0) for n in range(100, 200)], {}),
        # Nor do copies of an ordinary one raise it.
        ([(0, 0)] * 5000 + [(1, 6)], {1: 6}),
    ],
)
def test_copies_of_a_string_count_once(spark, strings, expected):
    frame = spark.createDataFrame([(1, *s) for s in strings], "class int, digest bigint, bin int")
    assert secrets.thresholds(frame) == expected


def test_copies_of_an_ordinary_string_hide_no_key(spark):
    rows = [(n, f"see {ORDINARY[n % 2]} here") for n in range(3000)] + [(5000, f"see {SECRET} here")]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("spans <> ''").collect()
    assert [(r.doc_id, r.spans) for r in found] == [(5000, "random:4:36")]


# The pipeline


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir, documents, texts):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(documents, labels)
    left = {i: t for i, t in texts.items() if model.score(np.array([quality.statistics(t)]))[0] >= 0.3}
    left = {i: left[i] for i, _, _, kept, _ in exact_brute(left.items()) if kept}
    ids = list(left)
    components = components_brute([print_brute(left[i]) for i in ids], ids)
    left = {i: left[i] for i, c in zip(ids, components) if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    flat = [(i, " ".join(tokens.words(t))) for i, t in items]
    left = {i: t for i, t in left.items() if not any(x in " ".join(tokens.words(t)) for _, x in flat)}
    found = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in found.select("doc_id").collect()} == set(left)


def test_stages_keep_columns_and_take_empty_tables(spark, sf_dir, awkward, nothing):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "packing",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, awkward, sf_dir).columns == awkward.columns
        assert stage(spark, nothing, sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, sf_dir).count() == 0
