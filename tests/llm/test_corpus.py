import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import oracles
from strandlake.llm import pipeline as corpus_pipeline
from strandlake.llm import queries as Q
from strandlake.llm.bpe import WordBpe, bpe_decode, bpe_encode, read_vocabulary, token_digests
from strandlake.llm.chat_format import escape, format_chats, locate, read_back, turn_template, unescape
from strandlake.llm.language_id import identify_languages, page_evidence, train_languages
from strandlake.llm.quality import score_quality
from strandlake.llm.sharding import shard_documents
from strandlake.llm.source_mix import mix_sources, mixed_documents

needs_vocabulary = pytest.mark.skipif(not os.path.exists(Q.vocabulary_path()), reason="needs the vocabulary file")


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    for table in os.listdir(data):
        con.sql(f"create view {table.split('.')[0]} as select * from '{data}/{table}'")
    got, want = Q.queries()[name](spark, data).toPandas(), con.sql(oracles.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda t: sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in t[sorted(t.columns)].itertuples(index=False))
    assert rows(got) == rows(want)


def test_mix_of_odd_rows(odd):
    got = mix_sources(odd)
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in rows)
    assert sum({(r.source, r.target) for r in rows}, ()) and abs(sum(t for _, t in {(r.source, r.target) for r in rows}) - sum(r.size for r in rows)) < 1e-6
    assert sum(r.taken // r.size for r in rows if r.size) == mixed_documents(odd).count()
    clash = odd.withColumns({c: F.lit("mine") for c in ("words_", "_mix_source", "pass_", "passes_", "h_")})
    assert mixed_documents(clash).columns == clash.columns and mixed_documents(clash).where("words_ = 'mine' and pass_ = 'mine' and _mix_source = 'mine'").count() == mixed_documents(odd).count()
    some = mix_sources(odd, odd.sparkSession.createDataFrame([("a", 1.0), ("b", 2.0)], "source string, weight double")).collect()
    named = [r for r in some if r.source in ("a", "b")]
    assert not any(r.taken or r.target for r in some if r.source not in ("a", "b"))
    assert abs(sum(t for _, t in {(r.source, r.target) for r in named}) - sum(r.size for r in named)) < 1e-6
    assert mixed_documents(odd).columns == odd.columns
    assert mix_sources(odd.limit(0)).count() == 0


def test_mix_of_a_hot_source_comes_near_its_targets(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("source"), F.repeat(F.lit("w "), (F.pmod(F.hash("id"), F.lit(40)) + 1).cast("int")).alias("text"))
    weights = spark.createDataFrame([(f"s{i}", float(i + 1)) for i in range(7)], "source string, weight double")
    by = mix_sources(docs, weights).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    assert not [r for r in by if abs(r.taken - r.target) > 20]  # half of the largest document
    assert all(r.target <= 3 * r["size"] + 1e-6 for r in by)


def test_shards_are_even_and_gapless(spark, odd):
    hot = "a text that very many documents share"
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(hot)).when(F.col("id") % 50 == 1, None).otherwise(F.repeat(F.md5(F.col("id").cast("string")), (F.pmod(F.hash("id"), F.lit(9)) + 1).cast("int"))).alias("text"))
    rows = shard_documents(docs).toPandas()
    sizes = rows.groupby("shard")["size"].sum()
    assert len(rows) == 5000 and len(sizes) == 16 and sizes.max() - sizes.min() < 0.05 * sizes.mean()
    assert all(sorted(s) == list(range(len(s))) for _, s in rows.groupby("shard")["slot"])
    odd_rows = shard_documents(odd, shards=4).collect()
    assert len(odd_rows) == odd.count() and all(r.law == "bytes" and r.grown_shard is None for r in odd_rows)
    assert {r["size"] for r in odd_rows if r.row_id == 3} == {1}
    assert shard_documents(odd.limit(0)).count() == 0


@needs_vocabulary
def test_bpe_equals_the_library(spark, odd):
    from tokenizers import Tokenizer

    path = Q.vocabulary_path()
    library, own = Tokenizer.from_file(path), WordBpe(read_vocabulary(path))
    rnd = random.Random(5)
    letters = list("abcdeXYZ'sdtlrve 0189éΣİñ  \t\n<|>\U0001f600中कनि!?._-\x1c\x85́")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 90))) for _ in range(1500)]
    texts += ["", " ", "<|endoftext|>a b<|startoftext|><|endoftext|>", "ΣΑΣ Σ", "it's WE'LL", "internationalization" * 40, "a" * 3000]
    texts += ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(1, 30))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(ids, "<i4").tolist()
        assert got == want and own.decode(got) == library.decode(want, skip_special_tokens=False)
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    for form in ("{}", "a{}b É{}"):
        many = [form.format(c, c) for c in points]
        want = [e.ids for e in library.encode_batch(many, add_special_tokens=False)]
        got = [np.frombuffer(x, "<i4").tolist() for at in range(0, len(many), 5000) for x in own.encode([t.encode() for t in many[at : at + 5000]])]
        assert got == want
    for _ in range(3000):
        text = "".join(rnd.choice(points) if rnd.random() < 0.5 else rnd.choice("aE 'ś\u0308\u0323\n1") for _ in range(rnd.randint(1, 20)))
        assert np.frombuffer(own.encode([text.encode()])[0], "<i4").tolist() == library.encode(text, add_special_tokens=False).ids
    encoded = bpe_encode(odd, path, decoded_col="decoded").collect()
    assert len(encoded) == odd.count()
    for r in encoded:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert bpe_encode(odd.withColumn("ids", F.lit(1)), path).columns[-1] == "ids_"
    clash = token_digests(bpe_encode(odd.withColumn("N_TOKENS", F.lit(7)), path, decoded_col="decoded"), "ids", "decoded")
    assert clash.columns[-4:] == ["N_TOKENS", "n_tokens_", "ids_sha256", "decoded_sha256"]
    assert [r.decoded for r in bpe_decode(bpe_encode(odd, path), path).orderBy("n_chars").collect()] == [r.decoded for r in sorted(encoded, key=lambda r: (r.n_chars is not None, r.n_chars or 0))]
    assert bpe_encode(odd.limit(0), path).count() == 0


def test_languages_are_told(spark, data, odd):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    languages, model = train_languages(docs.where("doc_id % 2 = 0"))
    told = identify_languages(docs.where("doc_id % 2 = 1"), languages, model, host_col="source")
    both = told.join(docs.select("doc_id", F.col("lang").alias("truth")), F.col("row_id") == F.col("doc_id"))
    assert both.where("lang = truth").count() >= 0.97 * both.count()
    assert told.where("not kept").count() <= 0.02 * told.count()
    rows = identify_languages(odd, languages, model, declared_col="lang", host_col="source").collect()
    assert len(rows) == odd.count()
    assert not any(r.kept for r in rows if r.row_id in (3, 4, 5)) and all(0 <= r.posterior <= 1 for r in rows)
    assert identify_languages(odd.limit(0), languages, model).count() == 0
    assert identify_languages(odd, [], model).where("kept").count() == 0


def test_markup_and_host_decide_where_text_does_not(spark):
    train = spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze")] * 20, "lang string, text string")
    languages, model = train_languages(train)
    rows = [(i, "der hund und die katze", "de", "h1.de", "de") for i in range(30)] + [(i, "the cat and the dog", "en", "h2.com", "com") for i in range(30, 60)] + [(90, "a", None, "h1.de", "de"), (91, "a", None, "h2.com", "com"), (92, "a", "de-AT", None, None)]
    told = identify_languages(spark.createDataFrame(rows, "doc_id long, text string, d string, host string, tld string"), languages, model, declared_col="d", host_col="host", suffix_col="tld")
    by = {r.row_id: r.lang for r in told.collect()}
    assert (by[90], by[91], by[92]) == ("de", "en", "de")


def test_page_evidence(spark):
    pages = [(1, "https://www.a.example.de/de/55.html?x=1", '<!DOCTYPE html><html lang="de">'), (2, "http://b.org/en/77#t", "<html>"), (3, None, None), (4, "nonsense", "")]
    got = {r.doc_id: (r.declared, r.host, r.suffix) for r in page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {55: ("de", "www.a.example.de", "de"), 77: (None, "b.org", "org")}


def test_quality_of_held_out_documents(spark, odd):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("needs the driver's tables")
    scores = Q.op6_quality(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = scores.join(labels, "doc_id").where("held_out").toPandas()
    assert (held.predicted == held.quality).mean() > 0.9
    rows = score_quality(odd, labels.limit(0)).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.5}
    assert score_quality(odd.limit(0), labels).count() == 0


def test_escaping_is_reversible():
    for text in ("", "\\", "<", "\\<", "</turn>", "\\\\<\n</turn>\\", "\\### Assistant: </turn> ok"):
        assert unescape(escape(text)) == text and "</turn>" not in escape(text).replace("\\<", "")


def test_templates_that_rewrite_are_noticed():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert locate(turns, turn_template)[2] == 0
    assert locate(turns, lambda t: turn_template(t[-2:]))[2] == 1
    assert locate(turns, lambda t: f"{len(t)} turns\n" + turn_template(t))[2] == 2


def test_sentinels_and_rewrites(spark):
    turns = [("us\ue000er", "h\ue001i"), ("assistant", "\ue000")]
    out, spans, rewritten = locate(turns, turn_template)
    assert not rewritten and [unescape(out[c:d]) for _, _, c, d in spans] == [t for _, t in turns]
    big = (1 << 53) + 1
    chats = spark.createDataFrame([(big, 0, "us\ue000er", "a"), (big, 1, "assistant", "b"), (None, 0, "assistant", "c")], "conv_id long, turn long, role string, text string").coalesce(1)
    back = {r.conv_id: r for r in read_back(format_chats(chats)).collect()}
    assert set(back) == {big, None} and [(t.role, t.text) for t in back[big].turns] == [("us\ue000er", "a"), ("assistant", "b")]
    last = format_chats(chats, template=lambda t: turn_template(t[-1:])).where("rewritten > 0").collect()
    assert [r.conv_id for r in last] == [big] and all(s.loss is None for s in last[0].spans)
    clash = chats.withColumns({c: F.lit("mine") for c in ("formatted", "spans", "turns")})
    assert format_chats(clash).columns == ["conv_id", "formatted", "spans", "rewritten"] and format_chats(clash).count() == 2
    long = spark.createDataFrame([(1, 0, "user", "<\\" * 400_000), (1, 1, "assistant", "x" * 900_000)], chats.schema)
    row = read_back(format_chats(long)).first()
    assert row.turns[0].text == "<\\" * 400_000 and row.loss_texts == ["x" * 900_000]


def test_chats_are_read_back(spark):
    rows = [(1, 1, "assistant", "<turn>user\nx</turn>"), (1, 0, "user", None), (1, 2, None, "\\"), (2, 0, "a<b\nc", "t"), (None, 0, "assistant", ""), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), (4, None, "assistant", "\n")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in read_back(format_chats(chats)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user", ""), ("assistant", "<turn>user\nx</turn>"), ("", "\\")]
    assert back[1].loss_texts == ["<turn>user\nx</turn>"] and back[2].turns[0].role == "a<b\nc"
    assert back[3].loss_texts == ["x", "x"] and back[4].loss_texts == ["\n"] and back[None].loss_texts == [""]
    assert format_chats(chats.limit(0)).count() == 0


@needs_vocabulary
def test_stages_bear_odd_rows(spark, data, odd):
    columns = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, columns.limit(0), data).count() == 0
        assert stage(spark, columns, data).count() <= 3 * columns.count()


def test_stages_decide_row_by_row(spark, data):
    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        got = stage(spark, docs, data)
        assert got.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in got.collect()), key=str)

    known = spark.read.parquet(f"{data}/documents.parquet")
    sure = Q.languages_of(spark, known, data).where("kept and posterior > 0.999").join(known.select(F.col("doc_id").alias("row_id"), "text"), "row_id")
    i, good = sure.orderBy(F.length("text").desc(), "row_id").select("row_id", "text").first()
    assert left(corpus_pipeline.keep_identified, [(i, good), (i, "12 34"), (None, "12 34"), (None, good)]) == sorted([(i, good), (None, good)], key=str)

    rows = [(None, "t one"), (None, "t one"), (3, "t  one"), (4, "u"), (4, "u"), (4, "v"), (9, "v"), (None, "w"), (None, "w")]
    assert left(corpus_pipeline.drop_copies, rows) == sorted([(3, "t  one"), (4, "u"), (4, "v"), (None, "w")], key=str)

    text = lambda name, end: " ".join([*(f"{name}{j}" for j in range(60)), end])
    rows = [(None, text("a", "y")), (None, text("a", "x")), (7, text("a", "x")), (8, text("b", "x")), (8, text("c", "x")), (9, text("b", "y")), (8, text("b", "x")), (None, text("d", "x")), (None, text("d", "x"))]
    assert left(corpus_pipeline.drop_near_copies, rows) == sorted([(7, text("a", "x")), (8, text("b", "x")), (8, text("c", "x")), (None, text("d", "x"))], key=str)


@needs_vocabulary
def test_a_bpe_worker_remembers_a_bounded_number_of_words():
    own, letters = WordBpe(read_vocabulary(Q.vocabulary_path())), "bcdfghjklmnpqrst"
    for k in range(40):
        own.encode([" ".join("".join(letters[n >> s & 15] for s in (0, 4, 8, 12, 16)) for n in range(5000 * k, 5000 * k + 5000)).encode()])
    assert sum(map(len, (own.chunks, own.old_chunks, own.words, own.old_words))) <= 200_000
