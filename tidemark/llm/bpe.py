"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A vocabulary of byte ranks becomes a `tokenizers` BPE model: each byte is shown as one printable character, so that the
library, which works on text, merges bytes.  Each match of the splitting pattern is encoded separately.  Offsets come
from the byte lengths of the ids and a byte-to-character map of the text; decoding reverses the byte table and copes with
characters that an id boundary splits.
"""

from __future__ import annotations

import base64
import codecs
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, byte_slices, column, slices

#: Words that a worker remembers before it forgets all but those of its last batch.
MEMORY_WORDS = 400_000

#: A letter before a mark: splitting patterns that tell letters from marks cut there, so words can be cut there too.
LETTER_MARK = r"(\pL)([.,;:!?])"


class WordMemory:
    """Ids of the words seen so far, in flat arrays; only new words are encoded, each different word of a batch once."""

    def __init__(self, encode, dtype: str, limit: int = MEMORY_WORDS):
        self.encode, self.dtype, self.limit = encode, np.dtype(dtype), limit
        self.words, self.flat, self.size = pa.array([], pa.string()), np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, starts, sizes) of different words."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        ids, sizes = [], []
        encode, extend, add = self.encode, ids.extend, sizes.append
        for word in new.to_pylist():
            got = encode(word)
            extend(got)
            add(len(got))
        place = at.to_numpy(zero_copy_only=False)
        unseen = np.isnan(place) if place.dtype.kind == "f" else np.zeros(len(place), bool)
        index = np.where(unseen, 0, place).astype(np.int64)
        index[unseen] = len(self.words) + np.arange(int(unseen.sum()))
        flat, size = np.concatenate([self.flat, np.array(ids, self.dtype)]), np.concatenate([self.size, np.array(sizes, np.int64)])
        start = np.cumsum(size) - size
        out = flat, start[index], size[index]
        if len(size) <= self.limit:
            self.words, self.flat, self.size = pa.concat_arrays([self.words, new]), flat, size
        else:
            self.words, self.flat, self.size = words, gather(*out), out[2]
        return out


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of `size` from `start` on, put together."""
    ends = np.cumsum(size)
    source = np.repeat(start - (ends - size), size)
    source += np.arange(len(source))
    return flat[source]


def encode_words(words: pa.ListArray, memory: WordMemory, whole: dict[int, list[int]], last: int | None = None) -> pa.Array:
    """Ids of documents given as lists of words, as a binary array of little-endian integers.

    `whole` has the ids of documents that were encoded otherwise (their lists are empty); the id `last` closes each document.
    """
    coded = words.values.dictionary_encode()
    flat, start, size = memory.look_up(coded.dictionary)
    index, bounds = coded.indices.to_numpy(), words.offsets.to_numpy().astype(np.int64)
    groups = [(np.array(list(whole), np.int64), list(whole.values()), False)]
    if last is not None:
        groups.append((np.arange(len(words)), [[last]], True))
    for docs, ids, same in groups:
        if len(docs):  # one more word, at the end of the documents
            index = np.insert(index, bounds[docs + 1], len(size) + (np.zeros(len(docs), np.int64) if same else np.arange(len(docs))))
            bounds = bounds + np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=len(words)))])
            more = np.array([len(x) for x in ids], np.int64)
            start = np.concatenate([start, len(flat) + np.cumsum(more) - more])
            flat, size = np.concatenate([flat, np.array([i for x in ids for i in x], flat.dtype)]), np.concatenate([size, more])
    ends = np.concatenate([[0], np.cumsum(size[index])])[bounds] * flat.dtype.itemsize
    if ends[-1] >= 2**31:
        raise ValueError("a batch of documents has more than 2 GB of ids")
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(gather(flat, start[index], size[index]))])


#: The splitting pattern for which spaces are known to begin pieces.
GPT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: the byte's own where Latin-1 shows one, else the next from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class ByteBPE:
    """One vocabulary file of lines `base64(bytes) rank`, and the pattern whose matches are encoded separately."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, models

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        show = byte_characters()
        self.table = {b: show[b] for b in range(256)}
        name = lambda token: "".join(show[b] for b in token)
        # Every way to cut a token in two known tokens is a merge, in the order of the ranks of what it makes.
        merges = [(name(t[:i]), name(t[i:])) for t in sorted(ranks, key=ranks.get) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.model = Tokenizer(models.BPE(vocab={name(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.find = regex.compile(pattern).findall
        self.model.model._resize_cache(0)  # words are remembered here
        self.merge = self.model.model.tokenize
        self.token = {r: t for t, r in ranks.items()}
        # Pieces begin at a space that stands alone or ends white space, so words can be cut there if no two spaces meet.
        self.spaced = pattern == GPT_PATTERN
        self.memory = WordMemory(self._ids, "<u4")

    def _ids(self, text: str) -> list[int]:
        merge = self.merge
        word = text[1:] if text[:1] == " " else text
        if word.isalpha():
            if word.isascii():  # letters stand for themselves
                return [t.id for t in merge(word if word is text else self.table[32] + word)]
            return [t.id for t in merge(text.encode().decode("latin-1").translate(self.table))]
        table = self.table
        return [t.id for p in self.find(text) for t in merge(p.encode().decode("latin-1").translate(table))]

    def encode_array(self, texts: list[str]) -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers, as a binary array."""
        cut = [self.spaced and "  " not in t and "\x1f" not in t for t in texts]
        whole = {i: [t.id for p in self.find(t) for t in self.merge(p.encode().decode("latin-1").translate(self.table))] for i, (t, c) in enumerate(zip(texts, cut)) if not c}
        marked = pc.replace_substring(pa.array([t if c else None for t, c in zip(texts, cut)], pa.string()), " ", "\x1f ")
        words = pc.split_pattern(pc.replace_substring_regex(marked, LETTER_MARK, "\\1\x1f\\2"), "\x1f")
        return encode_words(pa.ListArray.from_arrays(words.offsets, words.values), self.memory, whole)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(texts).to_pylist()

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for; an id outside the vocabulary raises KeyError."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_pieces(self, runs):
        """Text of successive runs of ids; a character that a run boundary splits comes out whole with the later run."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in runs:
            yield reader.decode(self.decode(ids))
        if tail := reader.decode(b"", True):
            yield tail

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of each id; ids that share a split character share its offset."""
        sizes = np.array([len(self.token[i]) for i in np.frombuffer(ids, "<u4").tolist()], np.int64)
        ends = np.cumsum(sizes)
        char = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
        return (char[ends - sizes].astype(np.int32), (char[ends - 1] + 1).astype(np.int32)) if len(ends) else (np.zeros(0, np.int32),) * 2


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def load(path: str, pattern: str) -> ByteBPE:
    """One vocabulary per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, offsets: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit), and if asked for the decoded bytes and character offsets.

    Null and empty texts have no ids.  Each row is encoded by itself: repeated and null doc_ids pass through.
    """
    extra = [("decoded", "binary", pa.binary())] * decoded + [(n, "array<int>", pa.list_(pa.int32())) for n in ("char_start", "char_end")] * offsets
    kind = {c.name: c.dataType for c in docs.schema}[id_col].simpleString()

    def run(batches):
        bpe = load(path, pattern)
        for batch in byte_slices(batches, "text"):
            got = [t or "" for t in column(batch, "text").to_pylist()]
            coded = bpe.encode_array(got)
            ids = coded.to_pylist() if decoded or offsets else []
            cols = [column(batch, "doc_id"), pc.cast(pc.divide(pc.binary_length(coded), 4), pa.int64()), coded]
            if decoded:
                cols.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
            if offsets:
                cols += [pa.array(c, pa.list_(pa.int32())) for c in zip(*(bpe.offsets(t, x) for t, x in zip(got, ids)))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids", *(e[0] for e in extra)])

    schema = ", ".join([f"doc_id {kind}", "n_tokens long", "ids binary", *(f"{n} {k}" for n, k, _ in extra)])
    return arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes, text from doc_id, ids (binary); bytes that are no UTF-8 show as U+FFFD in the text.  Null ids give null."""
    kind = {c.name: c.dataType for c in encoded.schema}["doc_id"].simpleString()

    def run(batches):
        bpe = load(path, pattern)
        for batch in slices(batches, 256):
            raw = [None if x is None else bpe.decode(x) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(raw, pa.binary()), pa.array([None if x is None else x.decode("utf-8", "replace") for x in raw], pa.string())], names=["doc_id", "bytes", "text"])

    return arrow(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, bytes binary, text string")


def digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes decoded from them, one row per document."""
    return encode(docs, path, pattern, id_col=id_col, text_col=text_col, decoded=True).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
