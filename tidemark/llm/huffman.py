"""Token-id files: canonical length-limited Huffman coding with independent blocks and bit-offset checkpoints.

Format.  A data set is a folder with two Parquet tables, so that Spark's commit protocol makes writes whole and any store
that Spark knows can hold them.  `codebook` has (id, bits): code lengths; the canonical codes follow from them.  `blocks`
has one row per block: `part` and `block` give the order, `first` the ids before it in its part, then `doc_ids`, `n_tokens`
per document, `points` (bit offsets of the checkpoints: the start of each document, which is byte-aligned, and every
`every` ids within it) and `payload`, the code bits.  A block can be decoded without any other, and any run between two
checkpoints without the rest of its block.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import LETTER_MARK, WordMemory, byte_characters, encode_words
from .common import arrow, byte_slices, column, drop, new_path, slices

#: The longest code (longer ones only where a vocabulary needs them); ids between two checkpoints; ids from which a block is full.
MAX_BITS, EVERY, BLOCK_IDS = 16, 256, 1 << 20


class WordBPE:
    """A `tokenizers` file.  If it is known how the file cuts words, words of plain texts are encoded once by the library's merge model and remembered; other texts go whole through the library."""

    #: Characters that NFC leaves alone, that every Unicode version classes and lower-cases alike, and no odd white space.
    OTHER = re.compile("[^\t\n\r\x20-\x7e¡-įı-ɏ‐-‧€]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        normal = [(s["type"], s.get("pattern"), s.get("content")) for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        cut, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.plain = (
            normal == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
            and (cut.get("type"), cut.get("behavior"), cut.get("invert")) == ("Split", "Removed", True)
            and cut["pattern"]["Regex"] == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # no match holds white space
            and [(r["type"], r.get("add_prefix_space"), r.get("use_regex")) for r in rest] == [("ByteLevel", False, False)]
        )
        # Names of added tokens in a text are for the library to find, so such texts go whole through it.
        added = "|".join(re.escape(t["content"]) for t in spec.get("added_tokens") or [] if t["content"])
        self.other = re.compile(f"{self.OTHER.pattern}|(?i:{added})" if added else self.OTHER)
        self.find = regex.compile(cut["pattern"]["Regex"]).findall if self.plain else None
        self.lib.model._resize_cache(0)  # words are remembered here
        self.merge, self.table = self.lib.model.tokenize, dict(enumerate(byte_characters()))
        self.dtype = np.dtype("<u2" if self.lib.get_vocab_size() <= 65536 else "<u4")
        self.memory = WordMemory(self._ids, self.dtype)

    def size(self, end_id: int | None) -> int:
        """One more than the largest id."""
        return max(self.lib.get_vocab_size(), (end_id or 0) + 1)

    def _ids(self, word: str) -> list[int]:
        merge = self.merge
        if word.isascii() and word.isalpha():  # letters stand for themselves
            return [t.id for t in merge(word)]
        table = self.table
        return [t.id for p in self.find(word) for t in merge(p.encode().decode("latin-1").translate(table))]

    def encode_array(self, texts: list[str], end_id: int | None = None) -> pa.Array:
        """Ids of each text, and `end_id` after them, as a binary array."""
        plain = [self.plain and not self.other.search(t) for t in texts]
        whole = {i: self.lib.encode(t, add_special_tokens=False).ids for i, (t, p) in enumerate(zip(texts, plain)) if not p}
        lower = pa.array([t.lower() if p else None for t, p in zip(texts, plain)], pa.string())
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, LETTER_MARK, r"\1 \2"))
        return encode_words(pa.ListArray.from_arrays(words.offsets, words.values), self.memory, whole, end_id)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(texts).to_pylist()


_LOADED: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    if path not in _LOADED:
        _LOADED[path] = WordBPE(path)
    return _LOADED[path]


def token_ids(docs: DataFrame, path: str, *, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """doc_id, ids (binary: little-endian, 2 bytes an id if the vocabulary allows, else 4); `end_id` closes each document.

    Null and empty texts have the end id alone.  With `counts`, each task adds rows without ids whose column `counts`
    (binary, little-endian 64-bit, one per id) has what it has seen.
    """

    def run(batches):
        bpe = load(path)
        names = ["doc_id", "ids"] + ["counts"] * counts
        seen = np.zeros(bpe.size(end_id), np.int64)
        for batch in byte_slices(batches, "text"):
            ids = bpe.encode_array([t or "" for t in column(batch, "text").to_pylist()], end_id)
            if counts:
                seen += np.bincount(np.frombuffer(ids.buffers()[2], bpe.dtype), minlength=len(seen))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), ids] + [pa.nulls(len(ids), pa.binary())] * counts, names=names)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([seen.astype("<i8").tobytes()], pa.binary())], names=names)

    return arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, ids binary" + ", counts binary" * counts)


def sum_counts(counted: DataFrame, size: int) -> np.ndarray:
    """Counts per id over the rows of the column `counts`; partial sums per task, then one number per id for the driver."""

    def add(batches):
        total = np.zeros(size, np.int64)
        for batch in slices(batches):
            for x in column(batch, "counts").to_pylist():
                total += np.frombuffer(x, "<i8")
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["id", "n"])

    counts = np.zeros(size, np.int64)
    for row in arrow(counted.select("counts").where("counts is not null"), add, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["id"]] = row["n"]
    return counts


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `max_bits` for symbols with these counts (0: no code), by package-merge."""
    used = np.nonzero(counts)[0]
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols don't fit in codes of {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(max_bits):
        items = np.concatenate([leaves, packages])
        by = np.argsort(items, kind="stable")
        levels.append(by < len(leaves))
        items = items[by]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, found = 2 * len(order) - 2, np.zeros(len(order), int)
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        found[:own] += 1
        take = 2 * (take - own)
    lengths[order] = found
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The canonical code of each symbol: by length, then by symbol, counting up."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for s in order[lengths[order] > 0].tolist():
        code <<= int(lengths[s]) - last
        last = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


def pack(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray, every: int = EVERY) -> tuple[list[bytes], list[np.ndarray]]:
    """Code bits of each document, starting on a byte, and the bit offsets of its checkpoints; `ids` holds all documents in turn."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    bits = lengths[ids].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(bits)])
    doc_bits = total[ends] - total[starts]
    doc_bytes = (doc_bits + 7) // 8
    base = np.cumsum(doc_bytes) - doc_bytes
    at = total[:-1] + np.repeat(base * 8 - total[starts], sizes)  # bit offset of each id
    # A code lies in the two 32-bit words from word `at` on; codes of one word follow each other and don't overlap.
    words = np.zeros(int(doc_bytes.sum()) // 4 + 3, np.uint32)
    if len(at):
        word = at >> 5
        value = codes[ids].astype(np.uint64) << (64 - (at & 31) - bits).astype(np.uint64)
        first = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
        both = np.bitwise_or.reduceat(value, first)
        words[word[first]] = (both >> np.uint64(32)).astype(np.uint32)
        words[word[first] + 1] |= both.astype(np.uint32)
    raw = words.astype(">u4").tobytes()
    local = at - np.repeat(base * 8, sizes)
    return [raw[b : b + n] for b, n in zip(base.tolist(), doc_bytes.tolist())], [local[s:e:every].astype(np.uint32) for s, e in zip(starts.tolist(), ends.tolist())]


class Decoder:
    """Table-driven: the next bits, as many as the longest code has, name an id and its length.  All runs between checkpoints advance together."""

    def __init__(self, lengths: np.ndarray):
        self.max_bits = max_bits = max(1, int(lengths.max(initial=0)))
        if max_bits > 25:
            raise ValueError("a window of four bytes holds codes of 25 bits")
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = 1 << (max_bits - lengths[order].astype(int))
        fill = (1 << max_bits) - int(span.sum())
        self.symbol = np.concatenate([np.repeat(order, span), np.zeros(fill, int)]).astype(np.uint32)
        self.bits = np.concatenate([np.repeat(lengths[order], span), np.ones(fill, np.uint8)]).astype(np.int64)

    def decode(self, payload: bytes, points: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """The ids of runs of `runs` ids that start at the bit offsets `points`, in turn."""
        raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window, wide = raw[:-3] << 16 | raw[1:-2] << 8 | raw[2:-1], 24
        if self.max_bits > 17:
            window, wide = window << 8 | raw[3:], 32
        order = np.argsort(-runs, kind="stable")
        p, out = points[order].astype(np.int64), np.empty(int(runs.sum()), np.uint32)
        to = (np.cumsum(runs) - runs)[order]
        left = np.searchsorted(-runs[order], -np.arange(int(runs.max(initial=0))), "left")  # runs with more than k ids
        for k, n in enumerate(left.tolist()):
            q = p[:n]
            v = window[q >> 3] >> (wide - self.max_bits - (q & 7)).astype(np.uint32) & np.uint32((1 << self.max_bits) - 1)
            out[to[:n] + k] = self.symbol[v]
            p[:n] = q + self.bits[v]
        return out


def write(docs: DataFrame, path: str, vocabulary: str, *, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, every: int = EVERY, block_ids: int = BLOCK_IDS) -> None:
    """Encode the texts and write them as token-id files in ascending doc_id order (null ids first, equal ids by content).

    Only the counts per id, which the vocabulary bounds, reach the driver.  An empty table gives a data set without blocks.
    """
    spark = docs.sparkSession
    kept = new_path(spark, "token-ids")
    token_ids(docs, vocabulary, end_id=end_id, id_col=id_col, text_col=text_col, counts=True).write.option("compression", "zstd").parquet(kept)
    table = spark.read.schema("doc_id long, ids binary, counts binary").parquet(kept)
    ids, bpe = table.where("ids is not null").select("doc_id", "ids"), load(vocabulary)
    dtype, counts = bpe.dtype, sum_counts(table, bpe.size(end_id))
    lengths = code_lengths(counts, max(max_bits, int(np.count_nonzero(counts)).bit_length()))
    coded = [(int(i), int(lengths[i])) for i in np.nonzero(lengths)[0]]
    spark.createDataFrame(coded, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    codes = canonical(lengths)

    def code(batches):
        for batch in slices(batches, 256):
            raw = column(batch, "ids").to_pylist()
            sizes = np.array([len(x) // dtype.itemsize for x in raw], np.int64)
            payloads, points = pack(np.frombuffer(b"".join(raw), dtype), sizes, lengths, codes, every)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(payloads, pa.binary()), pa.array([x.tobytes() for x in points], pa.binary())], names=["doc_id", "n", "bits", "points"])

    def block(batches):
        part, number, first = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def close():
            doc_ids, n, bits, points = (pa.chunked_array([c for t in held for c in t.column(k).chunks]) for k in ("doc_id", "n", "bits", "points"))
            n, payloads = n.to_numpy(), bits.to_pylist()
            offset = 8 * np.concatenate([[0], np.cumsum([len(x) for x in payloads])])
            at = b"".join((np.frombuffer(x, np.uint32) + np.uint64(o)).astype("<u8").tobytes() for x, o in zip(points.to_pylist(), offset.tolist()))
            names = ["part", "block", "first", "doc_ids", "n_tokens", "points", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())), pa.array([at], pa.binary()), pa.array([b"".join(payloads)], pa.binary())], names=names)

        for batch in slices(batches, 64):
            held.append(pa.Table.from_batches([batch]))
            size += int(np.sum(column(batch, "n").to_numpy()))
            if size >= block_ids:
                yield close()
                number, first, held, size = number + 1, first + size, [], 0
        if held:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded_docs = arrow(ids, code, "doc_id long, n long, bits binary, points binary").withColumn("tie", F.xxhash64("bits"))
    ordered = coded_docs.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    arrow(ordered, block, "part int, block int, first long, doc_ids array<long>, n_tokens array<long>, points binary, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")
    drop(spark, kept)


def read(spark: SparkSession, path: str, *, every: int = EVERY, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and the ids (binary, little-endian unsigned 32-bit) or their crc32."""
    lengths = np.zeros(1, np.uint8)
    for row in spark.read.schema("id int, bits int").parquet(f"{path}/codebook").toLocalIterator():
        if row["id"] >= len(lengths):
            lengths = np.concatenate([lengths, np.zeros(max(len(lengths), row["id"] + 1 - len(lengths)), np.uint8)])
        lengths[row["id"]] = row["bits"]
    blocks = spark.read.schema("part int, block int, first long, doc_ids array<long>, n_tokens array<long>, points binary, payload binary").parquet(f"{path}/blocks")
    # One row per written partition: what comes before each is a running sum over these few rows.
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = sizes.select("part", (F.expr("sum(n) over (order by part)") - F.col("n")).alias("before"))
    kind = "ids_crc32 long" if digest else "ids binary"

    def run(batches):
        decoder = Decoder(lengths)
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            n = np.array(row["n_tokens"], np.int64)
            runs = np.concatenate([np.full((x + every - 1) // every, every, np.int64) for x in n.tolist()])
            last = np.cumsum((n + every - 1) // every) - 1
            runs[last[n > 0]] = (n[n > 0] - 1) % every + 1
            ids = decoder.decode(row["payload"], np.frombuffer(row["points"], "<u8"), runs).astype("<u4").tobytes()
            ends = np.cumsum(n)
            cut = [ids[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist())]
            out = pa.array([zlib.crc32(x) for x in cut], pa.int64()) if digest else pa.array(cut, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(ends - n + row["first"] + row["before"], pa.int64()), pa.array(n, pa.int64()), out], names=["doc_id", "start", "n_tokens", kind.split()[0]])

    joined = blocks.join(F.broadcast(before), "part").select("first", "before", "doc_ids", "n_tokens", "points", "payload")
    return arrow(joined, run, f"doc_id long, start long, n_tokens long, {kind}")
