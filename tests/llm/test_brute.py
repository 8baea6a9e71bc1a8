"""Queries that SQL can't express, against plain Python over the smallest tables."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from strandlake.llm import oracles
from strandlake.llm import pipeline as corpus_pipeline
from strandlake.llm import queries as Q
from strandlake.llm.quality import FIT_ROWS, NAMES, PAIRS
from strandlake.llm.sharding import OVERFULL, RANGES
from tests.llm.test_dedup import brute

SPACE = b" \t\n\x0b\x0c\r"


def documents(spark, folder):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


# ------------------------------------------------------------- language ID


def bins(text):
    x = bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode())
    return [((x[i] * 0x9E3779B1 + x[i + 1] * 0x85EBCA77 + x[i + 2] * 0xC2B2AE3D) & 0xFFFFFFFF) >> 19 for i in range(len(x) - 2) if 97 <= x[i + 1] <= 122 or x[i + 1] >= 128]


def languages_by_brute_force(known, docs, pages):
    """(lang, posterior, kept) for each of docs; the model is that of `known`."""
    counts = {}
    for d in known:
        if d["lang"] is not None:
            counts.setdefault(d["lang"], Counter()).update(bins(d["text"]))
    names = sorted(counts)
    table = {n: {b: math.log(np.float64(c + 0.5) / (sum(counts[n].values()) + 0.5 * 8192)) for b, c in counts[n].items()} for n in names}
    rest = {n: math.log(0.5 / (sum(counts[n].values()) + 0.5 * 8192)) for n in names}
    address = {}
    for p in sorted(pages, key=lambda p: -p["page_id"]):
        if found := re.match(r"[a-zA-Z]+://([^/?#:]+)[^/?#]*/(?:[^?#]*/)?(\d{1,18})(?:\.[a-z]+)?/?(?:[?#]|$)", p["url"] or ""):
            declared = re.search(r"<html[^>]*\blang=[\"']?([A-Za-z-]+)", p["html"] or "")
            suffix = re.search(r"\.([A-Za-z]+)$", found[1])
            address[int(found[2])] = (declared and declared[1].lower(), found[1].lower(), suffix and suffix[1].lower())
    rows = []
    for d in docs:
        grams = bins(d["text"])
        sums = [sum(table[n].get(b, rest[n]) for b in grams) * (min(len(grams), 60.0) / max(len(grams), 1)) for n in names]
        declared, host, suffix = address.get(d["doc_id"], (None, None, None))
        rows.append((len(grams), [s - max(sums) for s in sums], declared, host or (d["source"] and d["source"].lower()), suffix))
    k = len(names)
    told = [(r, int(np.argmax(r[1]))) for r in rows if r[0]]
    whole = [sum(1 for _, i in told if i == j) for j in range(k)]
    smooth = lambda n, above: [(n[j] + 20.0 * above[j]) / (sum(n) + 20.0) for j in range(k)]
    corpus = smooth(whole, [1 / k] * k)

    def tally(key):
        out = {}
        for r, i in told:
            if (at := key(r)) is not None:
                out.setdefault(at, [0] * k)[i] += 1
        return out

    suffixes = {s: smooth(n, corpus) for s, n in tally(lambda r: r[4]).items()}
    hosts = {h: smooth(n, suffixes.get(h[1], corpus)) for h, n in tally(lambda r: r[3] and (r[3], r[4])).items()}
    says = {d: [math.log((n[j] + 1 / k) / (whole[j] + 1.0)) for j in range(k)] for d, n in tally(lambda r: r[2]).items()}
    out = []
    for grams, sums, declared, host, suffix in rows:
        prior = hosts.get((host, suffix)) or suffixes.get(suffix) or corpus
        log = [s + math.log(p) + d for s, p, d in zip(sums, prior, says.get(declared, [0.0] * k))]
        posterior = 1 / sum(math.exp(x - max(log)) for x in log)
        out.append((names[int(np.argmax(log))], posterior, grams > 0 and posterior >= 0.5))
    return out


def test_languages_equal_brute_force(spark, data):
    docs, pages = documents(spark, data), [r.asDict() for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    want = dict(zip((d["doc_id"] for d in docs), languages_by_brute_force(docs, docs, pages)))
    got = {r.doc_id: r for r in Q.op2_language_id(spark, data).collect()}
    assert set(got) == set(want)
    for i, (lang, posterior, kept) in want.items():
        assert abs(got[i].posterior - posterior) < 1e-3 and got[i].kept == kept
        assert got[i].lang == lang or abs(posterior - 0.5) < 1e-3


# ---------------------------------------------------------------- sharding


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_shards_equal_brute_force(spark, folder):
    """Shards are runs of documents in key order, with slots as they come, cut near equal shares of bytes."""
    if not os.path.isdir(folder):
        pytest.skip("needs the driver's tables")
    rows = {}
    for d in documents(spark, folder):
        text = (d["text"] or "").encode()
        salt = xxhash.xxh64_intdigest(b"id", 42)
        key = (signed(xxhash.xxh64_intdigest(text, 42)), signed(xxhash.xxh64_intdigest(d["doc_id"].to_bytes(8, "little", signed=True), salt)))
        rows[d["doc_id"]] = (key, len(text) + 1, zlib.crc32(text))
    got = {r.doc_id: r for r in Q.op3_sharding(spark, folder).collect()}
    assert set(got) == set(rows) and {r.law for r in got.values()} == {"bytes"} and {r.grown_shard for r in got.values()} == {None}
    assert all((got[i]["size"], got[i].text_crc32) == rows[i][1:] for i in rows)
    order = sorted(rows, key=lambda i: rows[i][0])
    shard, slot, bytes_of = -1, 0, Counter()
    for i in order:
        if got[i].shard != shard:
            assert got[i].shard > shard
            shard, slot = got[i].shard, 0
        assert got[i].slot == slot
        slot += 1
        bytes_of[shard] += rows[i][1]
    total = sum(r[1] for r in rows.values())
    room = max(max(r[1] for r in rows.values()), OVERFULL * total / RANGES)
    groups = Counter(r[0][0] for r in rows.values())
    assert all(abs(bytes_of[k] - total / 16) <= 2 * room for k in range(16)), (bytes_of, groups.most_common(1))


# ----------------------------------------------------------------- quality


CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "bang": b"!?", "marks": b"#$%&*@^~+=<>{}[]\\_", "bar": b"|",
    "stops": b".", "commas": b",;:", "breaks": b"\n", "spaces": b" \t", "quotes": b"\"'()-/", "high": range(128, 256),
}


def features(text):
    x = (text or "").encode()
    words = x.split()
    n, some = max(len(x), 1), max(len(words), 1)
    shares = [sum(b in c for b in x) / n for c in (set(v) for v in CLASSES.values())]
    return [*shares, math.log1p(len(words)), len(x) / some / 10 * bool(words), len(set(words)) / some, sum(a == b for a, b in zip(words, words[1:])) / some]


def test_quality_equals_brute_force(spark, data):
    docs = documents(spark, data)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    x = {d["doc_id"]: features(d["text"]) for d in docs}
    learn = [i for i in sorted(labels) if labels[i] in (0, 1) and i in x and not held(i)]
    assert list(CLASSES) == NAMES[:12] and len(learn) <= FIT_ROWS
    table = np.array([x[i] for i in learn])
    good, bad = (np.array([k for k, i in enumerate(learn) if labels[i] == q]) for q in (1, 0))
    mean, spread = table.mean(axis=0), table.std(axis=0) + 1e-9
    z = (table - mean) / spread
    drawn = np.random.default_rng(11).integers(0, len(bad), (len(good), PAIRS))
    pairs = np.concatenate([z[g] - z[bad[d]] for g, d in zip(good, drawn)])
    w, speed = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for _ in range(30_000):  # plain descent with momentum
        slope = -(pairs / (1 + np.exp(pairs @ w))[:, None]).mean(axis=0) + 1e-3 * w
        speed = 0.95 * speed - 0.02 * slope
        w = w + speed
    ranked = sorted(z @ w)
    at = len(bad) / len(learn) * (len(ranked) - 1)
    threshold = ranked[int(at)] + (at - int(at)) * (ranked[min(int(at) + 1, len(ranked) - 1)] - ranked[int(at)])
    for r in Q.op6_quality(spark, data).collect():
        score = 1 / (1 + math.exp(-((np.array(x[r.doc_id]) - mean) / spread @ w - threshold)))
        assert r.held_out == held(r.doc_id) and abs(r.score - score) < 0.01
        assert r.predicted == (r.score >= 0.5)


# ---------------------------------------------------------------- pipeline


@pytest.mark.skipif(not os.path.exists(Q.vocabulary_path()), reason="needs the vocabulary file")
def test_pipeline_equals_brute_force(spark, data):
    """Every stage in plain Python, the mix by its SQL, the tokens by the library."""
    from tokenizers import Tokenizer

    docs, pages = documents(spark, data), [r.asDict() for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    told = languages_by_brute_force(docs, docs, pages)
    assert all(abs(p - 0.5) > 1e-3 for _, p, _ in told)
    docs = [d for d, (_, _, kept) in zip(docs, told) if kept]
    first = {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", d["text"] or ""), d["doc_id"])
    docs = [d for d in docs if d["doc_id"] in set(first.values())]
    names = brute([(d["doc_id"], d["text"]) for d in docs], 5, 80)
    docs = [d for d in docs if names[d["doc_id"]][1] == d["doc_id"]]
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", [tuple(d.values()) for d in docs])
    taken = {i: t // s for i, s, t in con.sql(f"select doc_id, size, taken from ({oracles.SQL['op1_source_mix']})").fetchall() if s}
    library = Tokenizer.from_file(Q.vocabulary_path())
    want = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want += [(d["doc_id"], d["lang"], d["source"], len(ids), *digests)] * taken.get(d["doc_id"], 0)
    got = corpus_pipeline.run(spark, data).select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and want
