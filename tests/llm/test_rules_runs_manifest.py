"""Quality rules under risk control, runs of words, and the Merkle manifest, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.llm import merkle, quality_rules, queries, run_detection

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(repeated)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    rows = ["", None, "  \n\t ", "one", "a b c d e", "a b c d e f", "a b c d e a b c d e", "x " * 400, "l1 w\nl1 w\n\nl1 w \nother", "é#ü |<> $$ %\x0b&", "q w e r t y\n" * 30]
    for _ in range(150):
        rows.append("".join(draw.choice(["a", "bb", "c", "dé", "#", "e|"]) + draw.choice([" ", "  ", "\n", "\t"]) for _ in range(draw.randrange(60))))
    return rows


def test_counts_equal_plain_python(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["row_id"]: r for r in quality_rules.text_counts(docs, stratum_col=None).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, lines, dups, repeated = counts_of(t)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_lines"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, dups, repeated), t
        assert r["base_failed"] == (n < 10 or 100 * repeated > 20 * n)


def test_binomial_tail_is_exact(spark):
    cases = [(0, 1, 0.05), (0, 59, 0.05), (3, 100, 0.05), (100, 100, 0.05), (40, 973, 0.05), (7, 7, 0.5), (480, 10_000, 0.05), (0, 100_000, 0.01)]
    for k, n, p in cases:
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
        assert got == pytest.approx(exact, rel=1e-9), (k, n, p)
    facts = [r[0] for r in spark.range(12).select(quality_rules.log_factorial(F.col("id"))).collect()]
    assert facts == pytest.approx([math.lgamma(n + 1) for n in range(12)], abs=1e-12)


def _corpus(spark, draw, good, bad, share_of_symbols, langs=("en", "de")):
    rows, labels = [], []
    for i in range(good + bad):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(60)]
        lang = langs[i % len(langs)]
        if i >= good or draw.random() < share_of_symbols.get(lang, 0):
            words = [w + "#" * draw.randrange(2, 4) for w in words]
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(i < good)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_are_certified_where_labels_suffice(spark):
    draw = random.Random(9)
    docs, labels = _corpus(spark, draw, 1200, 200, {})
    judged = quality_rules.apply_quality_rules(docs, labels).collect()
    assert all(not r["kept"] and "symbols" in r["failed"] for r in judged if r["row_id"] >= 1200)
    assert sum(r["kept"] for r in judged if r["row_id"] < 1200) > 0.97 * 1200


def test_a_stratum_keeps_its_good_texts(spark):
    """German good texts carry symbols, every second one: there symbols reject nothing, elsewhere they do."""
    docs, labels = _corpus(spark, random.Random(10), 1200, 200, {"de": 0.5})
    judged = quality_rules.apply_quality_rules(docs, labels).collect()
    lost = {s: [r for r in judged if r["stratum"] == s and r["row_id"] < 1200 and not r["kept"]] for s in ("en", "de")}
    assert len(lost["de"]) < 0.05 * 600 and len(lost["en"]) < 0.05 * 600
    assert all("symbols" in r["failed"] for r in judged if r["stratum"] == "en" and r["row_id"] >= 1200)


def test_few_labels_certify_nothing(spark):
    docs, labels = _corpus(spark, random.Random(11), 80, 20, {}, langs=("en",))
    cutoffs = quality_rules.certified_cutoffs(quality_rules.text_counts(docs), labels).collect()
    assert [r["level"] for r in cutoffs] == [-1] and cutoffs[0]["cutoffs"] is None
    assert all(r["kept"] for r in quality_rules.apply_quality_rules(docs, labels).collect())


def test_holdout_fails_when_parts_differ(spark):
    """Levels go on only while the holdout bears them: the tail at each level decides, the first failure ends."""
    docs, labels = _corpus(spark, random.Random(12), 1500, 10, {"en": 0.004, "de": 0.3})
    for r in quality_rules.certified_cutoffs(quality_rules.text_counts(docs), labels).collect():
        passed = [t <= quality_rules.MISS / 2 for t in r["tails"]]
        assert r["level"] == (passed.index(False) if False in passed else len(passed)) - 1
        assert r["rejected"] == sorted(r["rejected"])


def test_rules_bear_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    judged = quality_rules.apply_quality_rules(odd, labels)
    assert judged.count() == odd.count()
    assert judged.where("row_id is null").count() == 2
    empty = odd.limit(0)
    assert quality_rules.apply_quality_rules(empty, labels).count() == 0
    assert quality_rules.apply_quality_rules(odd, labels.limit(0)).where("kept and not base_failed").count() == judged.where("not base_failed").count()


def brute_runs(s):
    out, n = set(), len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and s[j] == s[j + q]:
                j += 1
            a, b = i, j + q
            if j > i and b - a >= max(12, 2 * q) and not any(all(s[k] == s[k + p] for k in range(a, b - p)) for p in range(1, q)):
                out.add((a, b, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(5)
    for _ in range(800):
        n, k = draw.randrange(90), draw.choice([1, 2, 2, 3, 5, 30])
        s = [draw.randrange(k) for _ in range(n)]
        if n and draw.random() < 0.6:
            a, p = draw.randrange(n), draw.randrange(1, 15)
            s = [s[i] if i < a else s[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(n)]
        want = brute_runs(s)
        assert sorted(run_detection.runs_of(s), key=lambda r: (r[0], r[2])) == want
        assert run_detection.word_runs([b"%d" % x for x in s]) == want


def test_square_that_no_window_crosses():
    left = [b"%d" % i for i in range(6)]
    assert run_detection.word_runs([b"x", *left, *left, b"y"]) == [(1, 13, 6)]


def test_very_long_runs_are_quick():
    assert run_detection.word_runs([b"a"] * 60_000) == [(0, 60_000, 1)]
    assert run_detection.word_runs([b"%d" % (i % 9_001) for i in range(60_000)]) == [(0, 60_000, 9_001)]


def test_op12_equals_brute_force(spark, data):
    got = {r["doc_id"]: r for r in queries.op12_run_detection(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for d in docs:
        words = WORD.findall(d["text"] or "")
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        top = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
        gone = {i for a, b, q in runs for i in range(a + q, b)}
        r = got[d["doc_id"]]
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4)
        assert r["runs_sha256"] == sha("".join(f"{a},{b - a},{q}\n" for a, b, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_runs_bear_odd_rows(spark, odd):
    rows = run_detection.detect_runs(odd).collect()
    assert len(rows) == odd.count() and sum(r["row_id"] is None for r in rows) == 2
    assert all(r["n_runs"] == len(r["runs"]) for r in rows)
    long = next(r for r in rows if r["row_id"] == 7)
    assert (long["start"], long["length"], long["period"]) == (0, 60_000, 977)
    assert long["collapsed"].split()[-1] == "more" and len(long["collapsed"].split()) == 978
    assert next(r for r in rows if r["row_id"] == 3)["collapsed"] == ""
    assert run_detection.detect_runs(odd.limit(0)).count() == 0
    planted = run_detection.with_planted_runs(odd)
    assert planted.columns == odd.columns and planted.where("text is null").count() == odd.where("text is null").count()


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_manifest(rows):
    """{(source, place): (doc_id, leaf, subroot, root, siblings, fold)} of rows (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def climb(nodes):
        proofs, at, ways = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(ways) > 1:
            for i in range(len(nodes)):
                first = at[i] - at[i] % 16
                proofs[i].append((ways[first : at[i]], ways[at[i] + 1 : first + 16]))
            ways = [sha("".join(ways[i : i + 16])) for i in range(0, len(ways), 16)]
            at = [a // 16 for a in at]
        return ways[0], proofs

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == s) for s in sources}
    under = {s: climb([x[2] for x in g]) for s, g in groups.items()}
    root, upper = climb([under[s][0] for s in sources])
    out = []
    for s, up in zip(sources, upper):
        for x, proof in zip(groups[s], under[s][1]):
            out.append((x[3][0], x[2], under[s][0], root, sha("".join("".join(b + a) for b, a in proof + up))))
    return out


def _manifest(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    told = merkle.merkle_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"])
    digest = merkle.proof_digest(F.col("before"), F.col("after"))
    rows = told.select("row_id", "leaf", "subroot", "root", digest, merkle.folded(F.col("leaf"), F.col("before"), F.col("after"))).collect()
    assert all(r[5] == r[3] for r in rows)
    return [tuple(r)[:5] for r in rows], docs, told


@pytest.mark.parametrize("sizes", [[1], [16, 17, 1], [5000, 40], [1] * 40])
def test_manifest_equals_plain_python(spark, sizes):
    rows = [(n * 10_000 + i, None if n == 1 else f"s{n}", "en", i, f"text {i} É\n") for n, size in enumerate(sizes) for i in range(size)]
    random.Random(1).shuffle(rows)
    got, _, _ = _manifest(spark, rows)
    assert sorted(got) == sorted(plain_manifest(rows))


def test_manifest_finds_what_changed(spark):
    rows = [(i, f"s{i % 3}", None, i, f"Text {i}") for i in range(100)]
    _, docs, told = _manifest(spark, rows)
    changed = docs.where("doc_id <> 9").withColumn("text", F.when(F.col("doc_id") == 5, "text 5").otherwise(F.col("text")))
    checked = merkle.verify_rows(changed, told, ["doc_id", "source", "lang", "n_chars", "text"])
    assert sorted(r[0] for r in checked.where("not verified").select("row_id").collect()) == [5, 9]


def test_manifest_bears_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    told = merkle.merkle_manifest(odd, ["doc_id", "source", "lang", "n_chars", "text"])
    got = told.select("row_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("before"), F.col("after"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain_manifest(rows), key=key)
    assert merkle.merkle_manifest(odd.limit(0), ["doc_id", "text"]).count() == 0
