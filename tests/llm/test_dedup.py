import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import queries as Q
from strandlake.llm._components import connected_components
from strandlake.llm._runtime import few_tasks
from strandlake.llm._text import column_bytes, span_hashes, word_hashes
from strandlake.llm import embedding_dedup
from strandlake.llm.embedding_dedup import link_embeddings
from strandlake.llm.exact_dedup import FuseFilter, exact_dedup
from strandlake.llm.minhash_dedup import least_matches, near_duplicates
from strandlake.llm.substring_dedup import chunk_ends, remove_passages, repeated_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 4000, 60_000])
def test_fuse_filter_has_no_false_negative(n):
    rnd = np.random.default_rng(n)
    keys = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
    made = FuseFilter.build(np.concatenate([keys, keys]))
    assert made.holds(keys).all()
    other = rnd.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64)
    assert made.holds(other).mean() < 0.02
    assert n < 4000 or len(made.table) < 1.5 * n


def test_exact_groups(odd):
    old = F.coalesce(F.col("doc_id") <= 1, F.lit(False))
    got = exact_dedup(odd.where(old), odd.where(~old), bucket_keys=2).collect()
    assert len(got) == odd.count()
    by = {r.row_id: r for r in got if r.row_id is not None}
    assert (by[2].keep_id, by[2].group_size, by[2].kept) == (1, 3, False)
    assert (by[4].keep_id, by[4].group_size) == (3, 3)  # 3, 4 and the row without id; 5 is one space
    assert by[5].group_size == 1 and by[5].kept
    assert exact_dedup(odd.limit(0), odd.limit(0)).count() == 0


def test_exact_groups_of_large_missing_and_string_ids(spark):
    big = (1 << 53) + 1
    old, new = spark.createDataFrame([(1, "x")], "doc_id long, text string"), spark.createDataFrame([(big, "x"), (None, "other")], "doc_id long, text string")
    assert sorted((r.row_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup(old, new).collect()) == [(0, None, 1, True), (1, 1, 2, True), (big, 1, 2, False)]
    old, new = spark.createDataFrame([("b", "x y"), (None, "z")], "doc_id string, text string"), spark.createDataFrame([("a", "x  y"), (None, "z"), (None, "z")], "doc_id string, text string")
    got = sorted((r.row_id or "", r.keep_id or "", r.group_size, r.kept) for r in exact_dedup(old, new).collect())
    assert got == [("", "", 3, True), ("", "", 3, True), ("", "", 3, True), ("a", "a", 2, True), ("b", "a", 2, False)]


def test_a_batch_without_a_snapshot_is_dealt_out(spark, monkeypatch):
    import strandlake.llm.exact_dedup as E

    seen, screen = [], E.screen
    monkeypatch.setattr(E, "screen", lambda new, filters, buckets: seen.append(buckets) or screen(new, filters, buckets))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 20).cast("string").alias("text"))
    got = exact_dedup(docs.limit(0), docs, bucket_keys=5).collect()
    assert seen == [4] and {r.row_id for r in got if r.kept} == set(range(20))


def test_words_and_hashes_do_not_depend_on_blocks():
    import pyarrow as pa

    texts = ["a b", "", "  été b\x0bc", None, "b" * 5000, "word " * 700_000]
    data, offsets = column_bytes(pa.array(texts))
    hashes, doc = word_hashes(data, offsets)
    assert np.bincount(doc, minlength=6).tolist() == [2, 0, 3, 0, 1, 700_000]
    assert hashes[1] == hashes[3] and len(set(hashes[doc == 5].tolist())) == 1
    small = np.frombuffer(b"xxabcxxabc", np.uint8)
    one, two = span_hashes(small, np.array([2, 7]), np.array([5, 10]))
    assert one == two


def brute(docs, words, percent):
    """doc_id -> (set size, least reachable id), by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in docs:
        w = WORD.findall((text or "").translate(lower))
        sets[i] = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    name = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            least = min(name[a], name[b])
            if (name[a], name[b]) != (least, least):
                name[a] = name[b] = least
                changed = True
    return {i: (len(sets[i]), name[i]) for i in sets}


def variants(n, seed):
    """n documents in families with edits of all degrees."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        if i % 6 == 0:
            base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 8, 60, 120]))]
        words = list(base)
        for _ in range(rnd.randint(0, max(1, len(words) // 12))):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary).upper()
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, words):
    rows = [*variants(150, words), (900, None), (901, ""), (902, " \t "), (903, "solo"), (904, "SOLO")]
    got = {r.row_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=words).collect()}
    want = brute(rows, words, 80)
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in want.items()}
    wrong = [i for i in want if got[i][1] != want[i][1]]
    assert len(wrong) <= 3  # pairs near the threshold may share no band, with the stated chance
    assert all(got[i][1] >= want[i][1] for i in wrong)  # nothing is linked that should not be


def test_large_group_stays_in_one_component_and_blocks_agree(spark, monkeypatch):
    import strandlake.llm.minhash_dedup as M

    rows = variants(90, 3) + [(1000 + i, " ".join([*(f"k{j}" for j in range(60)), f"end{i}"])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    answers = lambda: sorted((r.row_id, r.component_id) for r in near_duplicates(docs, shingle_words=2).collect())
    joined = answers()
    monkeypatch.setattr(M, "JOINED_GROUP", 1)
    monkeypatch.setattr(M, "BLOCK_NODES", 8)
    assert answers() == joined
    assert {c for i, c in joined if i >= 1000} == {1000}


def test_only_texts_with_candidates_are_moved(spark):
    import strandlake.llm.minhash_dedup as M

    rows = [*((i, f"text number {i}") for i in range(2000)), (None, "text number 7"), (8, None)]
    texts = M._texts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    held = texts.where("row_id % 200 = 8 or row_id is null").selectExpr("row_id as held_id", "raw as held_raw")
    got = M._maybe_among(texts, held)
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()  # of the texts; held is a table of its own
    found = sorted((r.row_id is None, r.row_id or 0, r.text or "") for r in got.collect())
    want = sorted([(False, i, t or "") for i, t in rows if i is not None and i % 200 == 8] + [(True, 0, "text number 7")])
    assert [x for x in want if x not in found] == [] and len(found) < len(want) + 20


def test_odd_rows_near(odd):
    got = near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r.row_id: r for r in got}
    assert by[3].n_shingles == 0 and by[3].component_id == 3
    assert by[2].component_id == 1 and by[7].component_id == 6
    assert near_duplicates(odd.limit(0)).count() == 0


def test_near_links_of_rows_without_an_id_or_with_a_shared_one(spark):
    text = lambda name, end: " ".join([*(f"{name}{i}" for i in range(60)), end])
    rows = [(5, text("a", "x")), (None, text("a", "y")), (None, text("a", "y"))]
    for k in range(8):  # one id for two texts, each with a near copy
        rows += [(100 + k, text(f"b{k}_", "x")), (100 + k, text(f"c{k}_", "x")), (200 + k, text(f"b{k}_", "y")), (300 + k, text(f"c{k}_", "y"))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    want = [(i, 5 if i in (5, None) else 100 + i % 100) for i, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.row_id, r.component_id) for r in got), key=key) == sorted(want, key=key)


def test_posterior_bounds_keep_similar_pairs():
    steps = least_matches(168, 24, 0.8, 1e-4)
    rnd = np.random.default_rng(2)
    alive = sum(all((draw := np.cumsum(rnd.random(168) < 0.8))[n - 1] >= m for n, m in steps) for _ in range(2000))
    assert alive >= 1980


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(60)] + [(300, i) for i in range(301, 400)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_chunks_resist_shifts():
    rnd = np.random.default_rng(1)
    text = rnd.integers(97, 123, 20_000).astype(np.uint8)
    moved = np.concatenate([rnd.integers(97, 123, 37).astype(np.uint8), text])
    one, two = set(chunk_ends(text).tolist()), {e - 37 for e in chunk_ends(moved).tolist()}
    assert len(one & two) >= len(one) - 3
    sizes = np.diff(np.append(0, chunk_ends(np.full(5000, 65, np.uint8))))
    assert sizes.max() <= 256 and sizes.sum() == 5000
    assert (chunk_ends(text) == chunk_ends(text, block=700)).all()  # long texts: the boundaries of one piece


def words(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def passages_by_brute_force(texts, least):
    """(doc, word) of every word in a run of `least` words that occurs at another place too."""
    split = {i: t.split() for i, t in texts.items()}
    places = {}
    for i, w in split.items():
        for j in range(len(w) - least + 1):
            places.setdefault(tuple(w[j : j + least]), []).append((i, j))
    return {(i, j + k) for found in places.values() if len(found) > 1 for i, j in found for k in range(least)}


def check_passages(spark, texts):
    """Every repeated run of 50 words is found to its ends, and stays in exactly its first place."""
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = repeated_passages(docs).collect()
    want, got = passages_by_brute_force(texts, 50), set()
    for r in found:
        before = texts[r.doc_id].encode()[: r.start].decode()
        first = len(before.split()) - (not before.endswith(" ") and r.start > 0)
        got |= {(r.doc_id, first + k) for k in range(r.n_words + 1) if first + k < len(texts[r.doc_id].split())}
    assert len(want - got) <= 0.02 * len(want) and want
    outside = {i for i, _ in got} - {i for i, _ in want}
    assert not outside
    cut = {r.doc_id: r.text for r in remove_passages(docs, repeated_passages(docs)).collect()}
    assert set(cut) == set(texts)
    left = passages_by_brute_force(cut, 50)
    assert len(left) <= 0.02 * len(want)
    kept = " | ".join(cut.values())
    for i, j in want:  # no word sequence is lost: each stands somewhere still
        assert (" ".join(texts[i].split()[j : j + 2])) in kept or (i, j + 1) not in want
    return found, cut


def test_a_passage_stays_in_one_place(spark):
    p1, p2 = words(60, 1), words(60, 2)
    texts = {1: f"{p1} {words(80, 3)}", 2: f"{p1} {p2} {words(80, 4)}", 3: f"{words(80, 5)} {p2}", 4: f"{p1} {p2} {words(70, 6)}"}
    _, cut = check_passages(spark, texts)
    assert [sum(p in t for t in cut.values()) for p in (p1, p2)] == [1, 1]
    assert [len(cut[i].split()) for i in (1, 3, 4)] == [140, 80, 70]


def test_a_passage_twice_in_one_document(spark):
    q = words(55, 7)
    found, cut = check_passages(spark, {5: f"{words(30, 8)} {q} {words(30, 9)} {q} {words(10, 10)}"})
    assert cut[5].count(q) == 1 and [r.n_places for r in found] == [2, 2] and len(cut[5].split()) == 125


def test_passages_equal_brute_force(spark):
    rnd = random.Random(4)
    shared = [words(rnd.randint(51, 120), 100 + k) for k in range(12)]
    texts = {i: " ".join([words(rnd.randint(0, 60), 1000 + i), *(f"{rnd.choice(shared)} {words(rnd.randint(1, 40), 2000 + 7 * i + k)}" for k in range(rnd.randint(0, 3)))]) for i in range(60)}
    check_passages(spark, texts)


def test_passages_of_odd_rows(spark, odd):
    assert repeated_passages(odd.limit(0)).count() == 0
    found = repeated_passages(odd)
    assert {r.doc_id for r in found.collect()} == {6, 7}
    cut = remove_passages(odd, found)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    by = {r.doc_id: r.text for r in cut.collect()}
    assert by[3] is None and by[4] == "" and by[5] == "   \n" and by[7].strip() == "more"
    assert {f"word{i}" for i in range(977)} == set(by[6].split()) and len(by[6].split()) < 1000  # its words repeat within it
    assert remove_passages(odd, found.limit(0)).exceptAll(odd).count() == 0
    p = words(60, 11)
    rows = [(None, f"{p} x"), (None, f"{p} x"), (None, f"y {p}"), (1, f"é{words(20, 12)} {p} ü"), (1, "clean"), (1, f"z {p}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = sorted(r.text for r in remove_passages(docs, repeated_passages(docs)).collect())
    assert sum(p in t for t in cut) == 1 and "clean" in cut and len(cut) == 6
    long = words(260_000, 13)  # over one block
    docs = spark.createDataFrame([(1, f"{words(30, 14)} {long}"), (2, f"{long} {words(40, 15)}")], "doc_id long, text string")
    cut = {r.doc_id: r.text for r in remove_passages(docs, repeated_passages(docs)).collect()}
    assert len(long) > 1 << 20 and len(cut[1].split()) == 260_030 and 40 <= len(cut[2].split()) <= 42


def test_embedding_links_equal_all_pairs(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(40, 16))
    vectors = np.repeat(centres, 6, axis=0) + rnd.normal(size=(240, 16)) * 0.12
    rows = [(i, [float(x) for x in v.astype(np.float32)], int(i % 2) if i % 11 else None) for i, v in enumerate(vectors)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [float("inf")] + [1.0] * 15, 1), (304, [None] + [1.0] * 15, 1), (305, rows[1][1], rows[1][2]), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.row_id: (r.n_links, r.component_id) for r in link_embeddings(table).collect()}
    fit = {i: np.array(v, float) for i, v, l in rows if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: l for i, _, l in rows}
    near = lambda a, b: label[a] == label[b] and len(fit[a]) == len(fit[b]) and fit[a] @ fit[b] / np.sqrt(fit[a] @ fit[a] * (fit[b] @ fit[b])) >= 0.93
    links = {i: {j for j in fit if j != i and near(i, j)} if i in fit else set() for i, *_ in rows}
    total = sum(map(len, links.values()))
    assert set(got) == set(links) and total > 200
    assert sum(n for n, _ in got.values()) >= 0.9 * total and all(got[i][0] <= len(links[i]) for i in links)
    assert got[305][0] == got[1][0] and got[307] == (1, 306) and got[301] == (0, 301)
    assert link_embeddings(table.limit(0)).count() == 0


def test_embedding_links_of_a_dense_group(spark):
    rnd = np.random.default_rng(8)
    unit = lambda x: x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    dense = unit(rnd.normal(size=(1, 16))) + 0.2 * unit(rnd.normal(size=(500, 16)))
    vectors = rnd.permutation(np.concatenate([dense, rnd.normal(size=(1000, 16))]))
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    cosines = unit(vectors) @ unit(vectors).T
    want = (cosines >= 0.93).sum(axis=1) - 1
    got = {r.row_id: r.n_links for r in link_embeddings(table).collect()}
    assert want.sum() > 100_000 and all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.99 * want.sum()


@pytest.mark.parametrize("dim", [64, 256])
def test_planted_pairs_at_the_threshold_are_found(spark, dim):
    rnd = np.random.default_rng(dim)
    unit = lambda x: x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    base = unit(rnd.normal(size=(5000, dim)))
    ends = unit(rnd.normal(size=(1000, dim)))
    ends = unit(ends - (ends * base[:1000]).sum(axis=1, keepdims=True) * base[:1000])
    cosine = rnd.uniform(0.9301, 0.95, (1000, 1))
    near = cosine * base[:1000] + np.sqrt(1 - cosine**2) * ends
    vectors = np.concatenate([base, near])
    table = spark.createDataFrame([(i, v.tolist(), i % 1000 % 2) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    got = {r.row_id: (r.n_links, r.component_id) for r in link_embeddings(table).collect()}
    found = sum(got[5000 + i] == (1, i) for i in range(1000))
    assert found >= 950 and sum(n for n, _ in got.values()) == 2 * found


@pytest.mark.parametrize(("dim", "mean"), [(64, 0.75), (256, 0.75)])
def test_vectors_that_point_much_the_same_way(spark, dim, mean):
    """A common direction must not leave a handful of pivots, nor cost links."""
    rnd = np.random.default_rng(dim)
    unit = lambda x: x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    base = unit(np.sqrt(mean) * np.eye(dim)[0] + np.sqrt(1 - mean) * unit(rnd.normal(size=(2500, dim))))
    ends = base[500:1000] - base[:500]
    ends = unit(ends - (ends * base[:500]).sum(axis=1, keepdims=True) * base[:500])
    cosine = rnd.uniform(0.9301, 0.95, (500, 1))
    vectors = np.concatenate([base, cosine * base[:500] + np.sqrt(1 - cosine**2) * ends])
    index = embedding_dedup._fitted(vectors, 256, 0.93)
    assert index.named and len(index.pivots) == 256 and index.recall >= embedding_dedup.RECALL
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    want = (vectors @ vectors.T >= 0.93).sum(axis=1) - 1
    got = {r.row_id: r.n_links for r in link_embeddings(table).collect()}
    assert all(got[i] <= n for i, n in enumerate(want)) and sum(got.values()) >= 0.95 * want.sum() >= 900


def test_vectors_nearly_all_linked_are_compared_with_all(spark):
    rnd = np.random.default_rng(3)
    vectors = np.eye(16)[0] + 0.08 * rnd.normal(size=(600, 16))
    vectors /= np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    assert not embedding_dedup._fitted(vectors, 256, 0.93).named
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    want = (vectors @ vectors.T >= 0.93).sum(axis=1) - 1
    assert {r.row_id: r.n_links for r in link_embeddings(table).collect()} == dict(enumerate(want))


def test_embedding_rows_with_shared_ids_and_odd_columns(spark):
    v, w = [1.0, 0.0, 0.2], [0.0, 1.0, 0.1]
    rows = [(1, v, 1, "x", 2, 3), (1, w, 1, "x", 2, 3), (2, [2.0, 0.0, 0.4], 1, "x", 2, 3), (3, [0.0, 3.0, 0.3], 1, "x", 2, 3), (3, [-0.0, 3.0, 0.3], 1, "x", 2, 3), (None, v, 1, "x", 2, 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string, same int, n int")
    got = sorted(((r.row_id, r.n_links, r.component_id) for r in link_embeddings(table).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (3, 2, 1), (None, 0, None)], key=str)
    many = spark.createDataFrame([(i, [float(i % 7 + 1)] * (i % 40 + 1), 1) for i in range(120)], "vec_id long, embedding array<double>, label int")
    assert {(r.n_links, r.component_id) for r in link_embeddings(many).collect()} == {(2, i) for i in range(40)}  # more lengths than get pivots


def test_queries_on_the_smallest_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op8_minhash_dedup(spark, data).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs], 2, 80)


def test_few_links_are_written_by_few_tasks(spark):
    """Small tables of many steps take as long as there are shuffle partitions, unless few tasks write them."""
    sc, names = spark.sparkContext, ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(x) for x in names]
    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 2 == 0], "a long, b long")
    got, ran = {}, {}
    try:
        spark.conf.set(names[0], "24")
        spark.conf.set(names[1], "false")
        for tasks in (None, few_tasks(links, 20), few_tasks(links, 19)):
            sc.setJobGroup(f"links-{tasks}", "")
            got[tasks] = {r.node: r.component for r in connected_components(links, tasks=tasks).collect()}
            stages = {s for j in sc.statusTracker().getJobIdsForGroup(f"links-{tasks}") for s in sc.statusTracker().getJobInfo(j).stageIds}
            ran[tasks] = sum(i.numCompletedTasks for s in stages if (i := sc.statusTracker().getStageInfo(s)))
    finally:
        sc._jsc.sc().clearJobGroup()
        for x, value in zip(names, before):
            spark.conf.set(x, value)
    few = 2 * sc.defaultParallelism
    assert set(got) == {None, few} and got[few] == got[None] == {i: i // 2 * 2 for i in range(40)}
    assert ran[few] < 0.7 * ran[None], ran
