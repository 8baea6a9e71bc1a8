"""Passages that documents share, by content-defined chunks.

A gear hash rolls over the bytes of a text: h = 2 h + G[byte], in 16 bits, so it
depends on the last 16 bytes only. A chunk ends where the hash is larger than at
all places within WINDOW bytes before and after. Where chunks end thus depends on
nearby bytes alone, and an insertion shifts no boundary beyond its neighbourhood.
Chunks are compared by digest. Neighbouring chunks that each occur at another place
too are joined to passages, and a passage is then carried on byte by byte, on either
end, as far as it agrees with the other place of its outermost chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm._runtime import BROADCAST_ROWS, fresh, small_batches, text_of, written
from strandlake.llm._text import BLOCK, IS_SPACE, blocks, column_bytes, span_hashes, word_spans

#: A boundary's hash is the largest within so many bytes on either side: chunks of WINDOW + 1 bytes at least, about twice that on average.
WINDOW = 24
#: Bytes that a gear hash remembers.
MEMORY = 16
#: A chunk without such a place (a run of one letter) is cut here.
MAX_CHUNK = 256
#: Words that a passage has at least.
MIN_WORDS = 50
#: How far a passage may go on beyond its chunks: a chunk that differs, and the bytes that a boundary depends on.
REACH = MAX_CHUNK + WINDOW + MEMORY

_GEAR = np.random.default_rng(5).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of G[byte i back] << i over the last MEMORY bytes, by doubling."""
    h, width = _GEAR[data], 1
    while width < MEMORY:
        moved = h.copy()
        moved[width:] += h[:-width] << np.uint16(width) if len(h) > width else 0
        h, width = moved, width * 2
    return h


def _natural_ends(data: np.ndarray, window: int) -> np.ndarray:
    """Places after which the hash is the single largest of its neighbourhood."""
    n = len(data)
    h = gear_hashes(data).astype(np.int32)
    padded = np.full(n + 2 * window, -1, np.int32)
    padded[window : window + n] = h
    top, width = padded, 1  # top[i]: the largest of padded[i : i + width]
    while width * 2 <= window:
        top, width = np.maximum(top[: len(top) - width], top[width:]), width * 2
    before = np.maximum(top[:n], top[window - width : window - width + n])
    after = np.maximum(top[window + 1 : window + 1 + n], top[2 * window - width + 1 : 2 * window - width + 1 + n])
    return np.flatnonzero((h > before) & (h > after)) + 1


def chunk_ends(data: np.ndarray, window: int = WINDOW, most: int = MAX_CHUNK, block: int = BLOCK) -> np.ndarray:
    """The end of each chunk of one text, in order; the last is len(data).

    A long text is worked block by block, with the bytes around that its boundaries depend on,
    so they are those of the whole text.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    found = []
    for at in range(0, n, block):
        low, high = max(0, at - window - MEMORY), min(n, at + block + window)
        ends = _natural_ends(data[low:high], window) + low
        found.append(ends[(ends > at) & (ends <= at + block)])
    ends = np.concatenate(found)
    ends = np.append(ends[ends < n], n)
    gaps = np.diff(np.append(0, ends))
    if (gaps > most).any():
        ends = np.concatenate([np.append(np.arange(e - g + most, e, most), e) if g > most else [e] for e, g in zip(ends, gaps)])
    return ends.astype(np.int64)


def _measured(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words that start in each chunk, and its 128-bit digest in two halves; worked in parts of about a block."""
    starts = np.append(0, ends[:-1])
    words, one, two = [], [], []
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BLOCK, side="right")))
        low, high = starts[first], ends[last - 1]
        part, a, b = text[low:high], starts[first:last] - low, ends[first:last] - low
        begins = word_spans(part, np.array([0, len(part)]))[0]
        if low and not IS_SPACE[text[low - 1]]:
            begins = begins[begins > 0]  # a word that goes on from the part before
        words.append(np.searchsorted(begins, b) - np.searchsorted(begins, a))
        one.append(span_hashes(part, a, b))
        two.append(span_hashes(part ^ np.uint8(0xA5), a, b))
        first = last
    return np.concatenate(words), np.concatenate(one), np.concatenate(two)


def _shared_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """shared_id: the ids (null too) that stand for different texts; None if they are too many to be sent to every task."""
    hashes = docs.select(F.col(id_col).alias("shared_id"), F.xxhash64(text_of(F.col(text_col))).alias("h"))
    found = written(hashes.groupBy("shared_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a != b").select("shared_id"))
    return F.broadcast(found) if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else None


def _keyed(docs: DataFrame, id_col: str, text_col: str, shared: DataFrame | None) -> DataFrame:
    """doc_id, h, text: a document is told by its id and, where that stands for different texts, the hash of its text (else 0)."""
    text = text_of(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    if shared is None:
        return rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    met = rows.join(shared.withColumn("again", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("shared_id")), "left")
    return met.select("doc_id", F.when(F.col("again"), F.xxhash64("text")).otherwise(0).cast("long").alias("h"), "text")


def chunks(docs: DataFrame, id_col: str, text_col: str, shared: DataFrame | None = None) -> DataFrame:
    """doc_id, h, seq, start, stop (bytes), words, d1, d2: one row for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for first, last in blocks(offsets):
                ends = [chunk_ends(data[offsets[i] : offsets[i + 1]]) for i in range(first, last)]
                counts = np.array([len(e) for e in ends])
                if not counts.sum():
                    continue
                if last - first == 1:
                    words, one, two = _measured(data[offsets[first] : offsets[last]], ends[0])
                else:  # short texts, laid end to end
                    part = data[offsets[first] : offsets[last]]
                    base = np.repeat(offsets[first:last] - offsets[first], counts)
                    b = np.concatenate(ends) + base
                    a = np.concatenate([np.append(0, e[:-1]) for e in ends if len(e)]) + base
                    begins = word_spans(part, offsets[first : last + 1] - offsets[first])[0]
                    words = np.searchsorted(begins, b) - np.searchsorted(begins, a)
                    one, two = span_hashes(part, a, b), span_hashes(part ^ np.uint8(0xA5), a, b)
                stops = np.concatenate(ends)
                starts = np.concatenate([np.append(0, e[:-1]) for e in ends if len(e)])
                seq = np.concatenate([np.arange(c) for c in counts])
                rows = pa.array(np.repeat(np.arange(first, last), counts))
                arrays = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(seq, pa.int32()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(words, pa.int32()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "h", "seq", "start", "stop", "words", "d1", "d2"])

    kind = dict(docs.dtypes)[id_col]
    return _keyed(docs, id_col, text_col, shared).mapInArrow(run, f"doc_id {kind}, h long, seq int, start long, stop long, words int, d1 long, d2 long")


def _surroundings(keyed: DataFrame, kind: str, passages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stands around passages: (passages with lo, ro, last) and (doc_id, h, at, left, bytes) at their other places.

    lo and ro are up to REACH bytes before and after a passage, last is the byte at its end; bytes
    are those before (left) or after the outermost chunk's other place. The texts are read once:
    each document meets the list of its own passages and of the places that others ask for.
    """
    own = passages.select("doc_id", "h", F.struct(*passages.columns[2:]).alias("own"), F.lit(None).cast("struct<at:bigint,left:boolean>").alias("place"))
    asked = [passages.select(F.col(f"{s}_doc").alias("doc_id"), F.col(f"{s}_h").alias("h"), F.struct(F.col(f"{s}_at").alias("at"), F.lit(s == "l").alias("left")).alias("place")) for s in "lr"]
    places = asked[0].union(asked[1]).distinct().select("doc_id", "h", F.lit(None).cast(own.schema["own"].dataType).alias("own"), "place")
    lists = own.union(places).groupBy(F.col("doc_id").alias("_doc"), F.col("h").alias("_h")).agg(F.collect_list("own").alias("owns"), F.collect_list("place").alias("places"))
    rows = keyed.join(lists, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h"))).select("doc_id", "h", "text", "owns", "places")

    kind_of_own = own.schema["own"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            before, after = (lambda i, at: data[max(offsets[i], offsets[i] + at - REACH) : offsets[i] + at].tobytes()), (lambda i, at: data[offsets[i] + at : min(offsets[i + 1], offsets[i] + at + REACH)].tobytes())
            for column, owned in ((3, True), (4, False)):
                flat, of = batch.column(column).flatten(), np.repeat(np.arange(len(batch)), batch.column(column).value_lengths().to_numpy(zero_copy_only=False))
                for at in range(0, len(flat), 4096):
                    part, doc = flat.slice(at, 4096), of[at : at + 4096]
                    place = lambda name: part.field(name).to_pylist()  # noqa: B023, E731
                    null = lambda t: pa.nulls(len(doc), t)  # noqa: B023, E731
                    if owned:
                        ends = list(zip(doc, place("start"), place("stop")))
                        made = [part, null(pa.int64()), null(pa.bool_()), [before(i, a) for i, a, _ in ends], [after(i, b) for i, _, b in ends], [before(i, b)[-1:] for i, _, b in ends]]
                    else:
                        made = [null(batch.column(3).type.value_type), part.field("at"), part.field("left"), [before(i, a) if left else after(i, a) for i, a, left in zip(doc, place("at"), place("left"))], null(pa.binary()), null(pa.binary())]
                    rows = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *[pa.array(x, pa.binary()) if isinstance(x, list) else x for x in made]], ["doc_id", "h", "own", "at", "left", "one", "two", "last"])

    found = written(rows.mapInArrow(run, f"doc_id {kind}, h long, own {kind_of_own}, at long, left boolean, one binary, two binary, last binary"))
    # repeated rows of one document give the same answer again
    mine = found.where("own is not null").select("doc_id", "h", "own.*", F.col("one").alias("lo"), F.col("two").alias("ro"), "last").dropDuplicates(["doc_id", "h", "passage"])
    return mine, found.where("at is not null").select("doc_id", "h", "at", "left", "one").dropDuplicates(["doc_id", "h", "at", "left"])


def _common(a: bytes, b: bytes) -> int:
    """The length of the common start."""
    n = min(len(a), len(b))
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x)) if x.any() else n


def _carried_on(edges: DataFrame, kind: str) -> DataFrame:
    """doc_id, h, passage, start, stop, words, left, left_words, right, right_words: bytes that a passage goes on by, and the words that start there."""

    def starts(text: bytes, first: int) -> int:
        """Words that start in text[first:]; the byte before tells whether one goes on."""
        inside = ~IS_SPACE[np.frombuffer(text, np.uint8)]
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        return int(new[first:].sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select([6, 7, 8, 9, 10, 11]).to_pydict()
            out = []
            for lo, lp, ro, rp, room, last in zip(*rows.values()):
                left = min(_common(lo[::-1], lp[::-1]), room)
                right = _common(ro, rp)
                # the byte before the extension, where there is one, tells whether its first word starts there
                from_ = max(0, len(lo) - left - 1)
                out.append((left, starts(lo[from_:], len(lo) - left - from_) if left else 0, right, starts((last or b" ") + ro[:right], 1) if right else 0))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], *[pa.array(c, pa.int64()) for c in cols]], ["doc_id", "h", "passage", "start", "stop", "words", "left", "left_words", "right", "right_words"])

    return edges.mapInArrow(run, f"doc_id {kind}, h long, passage long, start long, stop long, words long, left long, left_words long, right long, right_words long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, passage, start, stop, n_words, passage_words, n_places, first_doc_id, removed: the repeated passages.

    A passage is a run of chunks that each occur at two or more places (in other documents, or
    elsewhere in this one), carried on at both ends over the bytes that still agree with the
    other place of its outermost chunk, and of min_words words or more (those that start in
    it, `passage_words`). Each chunk stays at its first place, by id (null last), hash of the
    text and position, and is removed at all others; a passage has one row for each stretch of
    chunks that are all kept or all removed, so whatever is removed here is kept in an earlier
    place. start and stop are bytes of the UTF-8 text, n_places the least number of rows among
    the places of the stretch's chunks, first_doc_id the document of the first place of its first chunk. text_hash
    is 0 but for ids that stand for several texts (where there are very many of these, for all ids).

    Rows of equal id (or without one) and equal text are one document. Null and empty texts have
    no chunks; documents without such a passage, and an empty table, give no row. A text of
    any length is read whole, with the boundaries it would have in one piece. A passage must
    hold one whole chunk: boundaries need WINDOW + MEMORY bytes of it before and WINDOW after.
    """
    small_batches(docs.sparkSession)
    kind, shared = dict(docs.dtypes)[id_col], _shared_ids(docs, id_col, text_col)
    pieces = written(chunks(docs, id_col, text_col, shared))
    # half of the digest is enough to set most chunks aside
    counted = written(pieces.groupBy("d1").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("d1"))
    marked = written(pieces.join(counted, "d1"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "start")
    places = marked.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")).where("first != last")
    hits = marked.join(written(places), ["d1", "d2"]).withColumn("kept", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "start").eqNullSafe(F.col("first")))
    other = F.when(F.col("kept"), F.col("last")).otherwise(F.col("first"))
    hits = hits.select("doc_id", "h", "seq", "start", "stop", "words", "n", "kept", F.struct(other["doc_id"].alias("doc_id"), other["h"].alias("h"), other["start"].alias("start")).alias("other"))
    in_doc = Window.partitionBy("doc_id", "h").orderBy("seq")
    # a document that was given twice has each chunk twice: one of each is enough
    hits = hits.withColumn("again", F.coalesce(F.lag("seq").over(in_doc) == F.col("seq"), F.lit(False))).where("not again")
    gap = F.coalesce(F.col("seq") - F.lag("seq").over(in_doc) != 1, F.lit(True))
    turn = gap | F.coalesce(F.col("kept") != F.lag("kept").over(in_doc), F.lit(True))
    runs = hits.withColumns({"gap": gap.cast("long"), "turn": turn.cast("long")}).withColumns({"passage": F.sum("gap").over(in_doc), "part": F.sum("turn").over(in_doc)})
    parts = runs.groupBy("doc_id", "h", "passage", "part").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").cast("long").alias("n_words"), F.min("n").cast("long").alias("n_places"), F.first("kept").alias("kept"),
        F.min_by("other", "seq").alias("l"), F.max_by(F.struct("other", (F.col("stop") - F.col("start")).alias("size")), "seq").alias("r"),
    )
    parts = written(parts)
    whole = parts.groupBy("doc_id", "h", "passage").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n_words").alias("words"), F.min_by("l", "part").alias("l"), F.max_by("r", "part").alias("r"))
    before = Window.partitionBy("doc_id", "h").orderBy("passage")
    room = F.col("start") - F.coalesce(F.lag("stop").over(before), F.lit(0))
    whole = whole.select("doc_id", "h", "passage", "start", "stop", "words", room.alias("room"), F.col("l.doc_id").alias("l_doc"), F.col("l.h").alias("l_h"), F.col("l.start").alias("l_at"), F.col("r.other.doc_id").alias("r_doc"), F.col("r.other.h").alias("r_h"), (F.col("r.other.start") + F.col("r.size")).alias("r_at"))
    edges, around = _surroundings(_keyed(docs, id_col, text_col, shared), kind, written(whole))
    for side, name in (("l", "lp"), ("r", "rp")):
        near = around.where(F.col("left") == (side == "l")).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.col("at").alias("_a"), F.col("one").alias(name))
        edges = edges.join(near, F.col(f"{side}_doc").eqNullSafe(F.col("_d")) & (F.col(f"{side}_h") == F.col("_h")) & (F.col(f"{side}_at") == F.col("_a"))).drop("_d", "_h", "_a")
    more = _carried_on(edges.select("doc_id", "h", "passage", "start", "stop", "words", "lo", "lp", "ro", "rp", "room", "last"), kind)
    more = written(more.withColumn("passage_words", F.col("words") + F.col("left_words") + F.col("right_words")).where(F.col("passage_words") >= min_words))
    ends = more.withColumnsRenamed({c: f"w_{c}" for c in ("doc_id", "h", "passage", "start", "stop")})
    out = parts.join(ends, F.col("w_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("w_h") == F.col("h")) & (F.col("w_passage") == F.col("passage")))
    on_left, on_right = F.col("start") == F.col("w_start"), F.col("stop") == F.col("w_stop")
    extra = lambda on, c: F.when(on, F.col(c)).otherwise(0)
    return out.select(
        "doc_id", F.col("h").alias("text_hash"), "passage", (F.col("start") - extra(on_left, "left")).alias("start"), (F.col("stop") + extra(on_right, "right")).alias("stop"),
        (F.col("n_words") + extra(on_left, "left_words") + extra(on_right, "right_words")).alias("n_words"), "passage_words", "n_places", F.when(F.col("kept"), F.col("doc_id")).otherwise(F.col("l.doc_id")).alias("first_doc_id"), (~F.col("kept")).alias("removed"),
    )


def _without(text: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    """The text without the whole words within the spans, which may overlap."""
    out, at, n = [], 0, len(text)
    for start, stop in spans:
        # inwards to where a word starts, and to where one ends
        while 0 < start < min(stop, n) and not IS_SPACE[text[start - 1]]:
            start += 1
        while start < stop < n and not IS_SPACE[text[stop]]:
            stop -= 1
        if stop > max(start, at):
            out.append(text[at : max(start, at)].tobytes())
            at = stop
    return b"".join([*out, text[at:].tobytes()])


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the removed passages cut out of text_col, word by whole word; all rows and the other columns stay.

    A row's passages are those of its id and text, so rows that repeat an id are each cut by their
    own, and a null id is like any other. Null and empty texts stay as they are; an empty table of
    either kind changes nothing. Columns of docs may have any names.
    """
    names = {c: fresh(docs, c) for c in ("spans_", "doc_", "hash_")}
    spans = passages.where("removed").groupBy(F.col("doc_id").alias(names["doc_"]), F.col("text_hash").alias(names["hash_"])).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias(names["spans_"]))
    of_text = spans[names["hash_"]]
    mine = docs[id_col].eqNullSafe(spans[names["doc_"]]) & ((of_text == 0) | (F.xxhash64(text_of(docs[text_col])) == of_text))
    joined = docs.join(spans, mine, "left").select(*[docs[c] for c in docs.columns], spans[names["spans_"]])
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(where))
            kept = [_without(data[offsets[i] : offsets[i + 1]], [(s["start"], s["stop"]) for s in spans]).decode() if spans else text.as_py() for i, (spans, text) in enumerate(zip(batch.column(batch.num_columns - 1).to_pylist(), batch.column(where)))]
            columns = list(batch.columns[:-1])
            columns[where] = pa.array(kept, batch.schema.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
