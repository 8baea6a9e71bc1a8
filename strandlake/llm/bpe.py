"""BPE encoding and decoding by a walk over the trie of distinct words.

In byte pair encoding the tokens of a prefix determine those of a longer one up
to its last token: t1..tk encodes a string exactly if each t(i), t(i+1) is how
their joint string is encoded. So the state of a trie node is the last token of
its prefix, which leads back to the state at that token's start. Walking the
distinct words of a block in sorted order is walking their trie depth first;
the states of the common prefix with the word before are kept, the rest is
computed once. Nothing is shuffled: words repeat within every part of a corpus,
and a join on all occurrences would move far more than it saves.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.llm._runtime import fresh, small_batches
from strandlake.llm._text import IS_SPACE, blocks, column_bytes

#: The vocabulary file is sent to the executors whole; a larger one is refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Distinct words, and distinct token pairs, that a task remembers before it starts anew.
MEMO = 40_000
BLOCK = 1 << 20

_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split pattern of the vocabulary file, with its white space spelled out, and the line feed that parts chunks here.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _WHITE + r"\p{L}\p{N}]+|\n")


def _uncertain() -> re.Pattern:
    """The code points on which Unicode versions differ: those this Python doesn't know, and younger ones that normalisation moves.

    The library's data may be older or newer; what Unicode 3.2 knew of normalisation is the same in
    all. The planes from U+30000 on, nearly empty, count as unknown altogether.
    """
    old, ranges = unicodedata.ucd_3_2_0, []
    for point in range(0x80, 0x30000):
        c = chr(point)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co") or ((unicodedata.combining(c) or unicodedata.decomposition(c)) and old.category(c) == "Cn"):
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    ranges.append([0x30000, sys.maxunicode])
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]")


_UNCERTAIN = _uncertain()


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class WordBpe:
    """A byte-level BPE vocabulary with word ends, from the JSON text of a tokenizer file."""

    def __init__(self, text: str) -> None:
        self.text, self.library = text, None
        spec = json.loads(text)
        model, self.end = spec["model"], spec["model"]["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = [""] * (1 + max([*self.ids.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        self._special = re.compile(b"(" + b"|".join(re.escape(t.encode()) for t in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None
        self._letters = {i: c for i, c in enumerate(byte_letters()) if i not in (9, 10)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(merges)}
        # each token as letters, a word end being one letter more; those that their own merges don't reach are left out
        self.spelled: dict[str, int] = {}
        self.parts: dict[int, list[int]] = {}
        for token, i in self.ids.items():
            ends = token.endswith(self.end) and len(token) > len(self.end)
            body = token[: -len(self.end)] if ends else token
            symbols = [*body[:-1], body[-1] + self.end] if ends else list(body)
            if all(s in self.ids for s in symbols):
                parts = [self.ids[s] for s in symbols]
                if len(parts) == 1 or self.merge(parts) == [i]:
                    self.parts[i] = parts
                    self.spelled[body + "\n" if ends else body] = i
        # how far back a token can start that ends in these two letters
        self.reach: dict[str, int] = {}
        for letters in self.spelled:
            self.reach[letters[-2:]] = max(len(letters), self.reach.get(letters[-2:], 0))
        self.pairs: dict[int, bool] = {}
        self.words, self.old_words = {}, {}
        self.chunks, self.old_chunks = {}, {}

    def merge(self, symbols: list[int]) -> list[int]:
        """The plain rule: merge the pair of lowest rank, leftmost first, until none is left."""
        out = list(symbols)
        while len(out) > 1:
            found = [(self.merges[p][0], at) for at, p in enumerate(zip(out, out[1:])) if p in self.merges]
            if not found:
                break
            at = min(found)[1]
            out[at : at + 2] = [self.merges[out[at], out[at + 1]][1]]
        return out

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are how their joint string is encoded."""
        if len(self.pairs) > 4 * MEMO:
            self.pairs.clear()
        known = self.pairs[left << 20 | right] = self.merge(self.parts[left] + self.parts[right]) == [left, right]
        return known

    def walk(self, words: list[str]) -> Iterator[list[int]]:
        """The token ids of each word, in byte letters, sorted and ended by a line feed: the trie depth first.

        A prefix's state is worked out when a token that starts at its end is tried, and kept
        for the words that share the prefix; prefixes at which no token starts cost nothing.
        """
        spelled, pairs, fit, reach = self.spelled.get, self.pairs, self.fit, self.reach.get
        last: list[int] = [-1] * 4096  # last[d]: the last token of the prefix of d letters, -1 if not worked out
        start: list[int] = [0] * 4096  # start[d]: where that token starts

        def state(end: int) -> int:
            at = end - reach(word[end - 2 : end] if end > 1 else word[:end], 1)
            if at < 0:
                at = 0
            while True:
                token = spelled(word[at:end])
                if token is not None:
                    if not at:
                        break
                    left = last[at]
                    if left < 0:
                        left = state(at) if at < 400 else deep(at)
                    known = pairs.get(left << 20 | token)
                    if known or (known is None and fit(left, token)):
                        break
                at += 1
            last[end] = token
            start[end] = at
            return token

        def deep(end: int) -> int:
            """The same for long words, whose states are worked out from the front: no deep recursion."""
            for d in range(1, end + 1):
                if last[d] < 0:
                    state(d)
            return last[end]

        before = "\n"
        for word in words:
            # the last letter and the word end are one symbol: the prefix before them ends the shared path
            size, shared = len(word), 0
            most = min(size, len(before)) - 2
            while shared < most and word[shared] == before[shared]:
                shared += 1
            if size >= len(last):
                last.extend([-1] * size)
                start.extend([0] * size)
            reset = max(size, len(before)) - shared
            last[shared + 1 : shared + 1 + reset] = [-1] * reset
            # between the last letter and the word end no token starts: no token is a word end alone
            ids = [state(size)]
            at = start[size]
            while at:
                ids.append(last[at])
                at = start[at]
            ids.reverse()
            before = word
            yield ids

    def split(self, chunks: list[bytes]) -> list[list[str]]:
        """Runs without ASCII white space as lists of words, each in byte letters and ended by a line feed."""
        text = b"\n".join(chunks).decode("utf-8", "replace")
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        found = "\t".join(_WORD.findall(text.lower()))
        if not found.isascii() or not found.isprintable():
            found = found.encode().decode("latin-1").translate(self._letters)
        return [[w + "\n" for w in line.split("\t") if w] for line in found.split("\n")]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, as little-endian int32."""
        split = [t.split() for t in texts]  # bytes split at 0x20 and 0x09 to 0x0D
        known, old = self.chunks, self.old_chunks
        if len(known) > MEMO:
            known, old = self.chunks, self.old_chunks = {}, known
        new = []
        for c in {c for chunks in split for c in chunks}:
            if c not in known:
                if c in old:
                    known[c] = old[c]
                else:
                    new.append(c)
        if new:
            special = [c for c in new if b"<|" in c and self._special and self._special.search(c)]
            if special:
                hidden = set(special)
                new = [c for c in new if c not in hidden]
            self._learn(new)
            for c in special:
                parts = [p for p in self._special.split(c) if p]
                plain = [p for p in parts if p.decode("utf-8", "replace") not in self.special and p not in known]
                self._learn(plain)
                known[c] = b"".join(array("i", [self.special[t]]).tobytes() if (t := p.decode("utf-8", "replace")) in self.special else known[p] for p in parts)
        get = known.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]

    def _learn(self, chunks: list[bytes]) -> None:
        """Remember the ids of chunks that hold no special token."""
        # how such code points are split, folded and composed is left to the library itself
        unknown = [c for c in chunks if not c.isascii() and _UNCERTAIN.search(c.decode("utf-8", "replace"))]
        if unknown:
            hidden = set(unknown)
            chunks = [c for c in chunks if c not in hidden]
            self.chunks |= zip(unknown, self._by_library(unknown))
        if not chunks:
            return
        if len(self.words) > MEMO:
            self.words, self.old_words = {}, self.words
        words, old = self.words, self.old_words
        parts = self.split(chunks)
        new = []
        for w in {w for p in parts for w in p}:
            if w not in words:
                if w in old:
                    words[w] = old[w]
                else:
                    new.append(w)
        new.sort()
        for word, ids in zip(new, self.walk(new)):
            words[word] = array("i", ids).tobytes()
        get, known = words.__getitem__, self.chunks
        for c, p in zip(chunks, parts):
            known[c] = get(p[0]) if len(p) == 1 else b"".join(map(get, p))

    def _by_library(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks from the tokenizers library, with the same vocabulary."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.text)
            self.library.no_padding()
            self.library.no_truncation()
        return [array("i", e.ids).tobytes() for e in self.library.encode_batch([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        """The tokens with a space between them: this vocabulary file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


_loaded: dict[str, WordBpe] = {}


def _vocabulary(text: str) -> WordBpe:
    """One vocabulary a worker process, kept with its memory of words."""
    key = f"{len(text)}:{hash(text)}"
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordBpe(text)
    return _loaded[key]


def _pieces(data: bytes) -> list[bytes]:
    """The text cut at white space into pieces of about a block, so that a very long one is encoded in parts."""
    out, at = [], 0
    while len(data) - at > 4 * BLOCK:
        end = at + 4 * BLOCK
        while end < len(data) and not IS_SPACE[data[end]]:
            end += 1
        out.append(data[at:end])
        at = end
    return [*out, data[at:]]


def read_vocabulary(path: str) -> str:
    text = Path(path).read_text(encoding="utf-8")
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return text


def bpe_encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """Add ids_col, an array of the token ids of the whole text, and with decoded_col the text they decode to.

    vocabulary: the path of a tokenizer file on the driver. Null and empty texts have no ids and
    decode to an empty text. Words with code points on which Unicode versions
    differ are encoded by the tokenizers library, whose data may be of another version. Special tokens are recognised where their strings stand in a text;
    none is added. Rows are kept as they are, repeated ones too. Where the table has a column of a
    new one's name (in any case), the new one's gets an underscore. An empty table stays empty.
    """
    small_batches(docs.sparkSession)
    ids_col = fresh(docs, ids_col)
    decoded_col = decoded_col and fresh(docs, decoded_col)
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    if decoded_col:
        schema = schema.add(decoded_col, T.StringType())
    with_text = decoded_col is not None

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(sent.value)
        for batch in batches:
            data, offsets = column_bytes(batch.column(text_col))
            for first, last in blocks(offsets, BLOCK):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(first, last)]
                if len(texts) == 1:
                    ids = [b"".join(bpe.encode([p])[0] for p in _pieces(texts[0]))]
                else:
                    ids = bpe.encode(texts)
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                new = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]
                if with_text:
                    new.append(pa.array([bpe.decode(np.frombuffer(x, "<i4").tolist()) for x in ids], pa.string()))
                kept = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*batch.schema.names, ids_col, *([decoded_col] if with_text else [])])

    return docs.mapInArrow(encode, schema)


def bpe_decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add text_col, the text that the ids of each row decode to; null and empty ids decode to an empty text.

    Every row keeps its place, repeated rows too, and an empty table has no rows. A column named
    text_col already stays, and the new one's name gets an underscore. An id beyond the vocabulary fails the task.
    """
    text_col = fresh(encoded, text_col)
    sent = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(sent.value)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                texts = [bpe.decode(x or []) for x in batch.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_col])

    return encoded.mapInArrow(decode, schema)


def token_digests(encoded: DataFrame, ids_col: str, decoded_col: str) -> DataFrame:
    """Replace the ids and the decoded text by n_tokens, ids_sha256 and decoded_sha256.

    A column that has one of these names (in any case) stays; the new one's then gets an underscore.
    Null ids have a null count and digest, null texts a null digest; rows are told from no
    other row, so repeated ones stay.
    """
    joined = F.array_join(F.col(ids_col).cast("array<string>"), " ")
    made = {"n_tokens": F.size(ids_col).cast("long"), "ids_sha256": F.sha2(joined, 256), "decoded_sha256": F.sha2(F.col(decoded_col), 256)}
    return encoded.withColumns({fresh(encoded, name): c for name, c in made.items()}).drop(ids_col, decoded_col)
