import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, huffman
from tidemark.llm.common import new_path

MULTI, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
TEXTS = [
    "", "  a   b \n\n c\t\td  ", "x\n y", " \nb", "a  b", "ÄÖ naïve 中文 test　x", "don't  can't I'LL we've", "a\x1cb \x85c\xa0d", "İstanbul ΣΑΣ ς ǅ", "1234 ５６ ²½", "😀 👍🏽x", "é x",
    "<|endoftext|> <|startoftext|>", "hello <|startoftext|> world<|endoftext|>!", "<|STARTOFTEXT|> <| startoftext |>", "<|startoftext|", "a   b", "\n", " a", "a ", "a \n", "the, the. the! THE?", "x" * 3000, "word, " * 2000, " x y", "“quoted” — ‘it’s’",
]


@pytest.fixture(scope="module")
def oracle():
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)  # as it is: names of special tokens in a text become these tokens


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("ab ,.'\n\t é1", max_size=60) | st.lists(st.sampled_from(["<|startoftext|>", "<|endoftext|>", "<|", " ", "a,", "|>"]), max_size=8).map("".join))
def test_any_text_encodes_like_the_libraries(text):
    b, w = bpe.load(MULTI, P.PATTERN), huffman.load(WORDS)
    (ids,) = b.encode([text])
    with open(MULTI, "rb") as f:
        ranks = _RANKS or _RANKS.update({base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}) or _RANKS
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}) if not _ENC else _ENC[0]
    _ENC or _ENC.append(own)
    assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text) and b.decode(ids) == text.encode()
    assert np.frombuffer(w.encode([text])[0], w.dtype).tolist() == _LIB[0].encode(text, add_special_tokens=False).ids


_LIB = [Tokenizer.from_file(WORDS)]
_RANKS: dict = {}
_ENC: list = []


def test_offsets_and_split_characters():
    b = bpe.load(MULTI, P.PATTERN)
    for text in TEXTS:
        (ids,) = b.encode([text])
        start, end = b.offsets(text, ids)
        parts = [b.token[i] for i in np.frombuffer(ids, "<u4").tolist()]
        assert all(text[s:e].encode().find(p) >= 0 for s, e, p in zip(start.tolist(), end.tolist(), parts))
        one = [ids[i : i + 4] for i in range(0, len(ids), 4)]
        assert "".join(b.decode_pieces(one)) == text
    (ids,) = b.encode(["😀"])
    assert "�" in b.decode(ids[:4]).decode("utf-8", "replace") or len(ids) == 4


def test_memory_forgets_but_stays_right(library):
    own = lambda w: library.encode(w, add_special_tokens=False).ids
    memory = bpe.WordMemory(own, "<u4", limit=4)
    for words in (["a", "b", "c", "dog"], ["a", "elephant"], ["f", "", "h"], ["a", "unhappily"], []):
        flat, start, size = memory.look_up(pa.array(words, pa.string()))
        assert [flat[s : s + n].tolist() for s, n in zip(start, size)] == [own(w) for w in words]
        assert len(memory.words) <= 6


def test_digests(make, oracle):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, "again")]
    got = bpe.digests(make(rows), MULTI, P.PATTERN).collect()
    want = []
    for i, t in rows:
        ids = oracle.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(make([]), MULTI, P.PATTERN).count() == 0
    coded = bpe.encode(make(rows), MULTI, P.PATTERN, offsets=True)
    assert sorted(r["text"] for r in bpe.decode(coded, MULTI, P.PATTERN).collect()) == sorted(t or "" for _, t in rows)


def test_token_files(spark, make, library):
    rows = [(1000 - 7 * i, t) for i, t in enumerate(TEXTS)] + [(2000, None), (2001, "again and again " * 5000)]
    path = new_path(spark, "files")
    huffman.write(make(rows), path, WORDS, block_ids=3000)
    got = sorted(map(tuple, huffman.read(spark, path, digest=True).collect()))
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    whole = {r["doc_id"]: r["ids"] for r in huffman.read(spark, path).collect()}
    assert np.frombuffer(whole[2000], "<u4").tolist() == [1]


def test_token_files_of_nothing_and_of_repeats(spark, make):
    path = new_path(spark, "files")
    huffman.write(make([]), path, WORDS)
    assert huffman.read(spark, path, digest=True).count() == 0
    path = new_path(spark, "files")
    huffman.write(make([(1, "a"), (1, "a"), (1, "b c"), (None, "d")]), path, WORDS)
    got = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in huffman.read(spark, path).collect())
    assert len(got) == 4 and got[0][2] is None and all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=300), st.integers(9, 16))
def test_code_lengths_are_complete_and_optimal(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and (len(counts) == 1 or sum(2.0 ** -int(x) for x in lengths) == 1.0)
    if len(counts) > 1:
        import heapq

        heap, free = sorted(counts), 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            free += a + b
            heapq.heappush(heap, a + b)
        cost = int((np.array(counts) * lengths).sum())
        assert cost >= free and (lengths.max() == limit or cost == free)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=700), max_size=6), st.sampled_from([1, 7, 256]))
def test_codec_round_trip_from_any_checkpoint(docs, every):
    ids = np.array([x for d in docs for x in d], np.uint16)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=41) if len(ids) else np.zeros(41, int))
    sizes = np.array([len(d) for d in docs], np.int64)
    payloads, points = huffman.pack(ids, sizes, lengths, huffman.canonical(lengths), every)
    decoder = huffman.Decoder(lengths)
    for d, payload, at in zip(docs, payloads, points):
        runs = np.array([min(every, len(d) - k) for k in range(0, len(d), every)], np.int64)
        assert decoder.decode(payload, at, runs).tolist() == d
        if len(at) > 1:  # the last run alone
            assert decoder.decode(payload, at[-1:], runs[-1:]).tolist() == d[every * (len(at) - 1) :]


def test_too_many_symbols():
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


def test_special_tokens_are_the_librarys(library):
    w = huffman.load(WORDS)
    ids = np.frombuffer(w.encode(["hello <|startoftext|> world"])[0], w.dtype).tolist()
    assert ids == library.encode("hello <|startoftext|> world", add_special_tokens=False).ids and 49406 in ids


def test_codes_longer_than_a_small_window():
    """Over 2^16 symbols, and a skew that asks for long codes."""
    r = np.random.default_rng(3)
    counts = np.concatenate([np.ones(70_000, np.int64), (1 << np.arange(30)).astype(np.int64)])
    lengths = huffman.code_lengths(counts, int(np.count_nonzero(counts)).bit_length())
    assert lengths.max() > 16 and abs(np.sum(2.0 ** -lengths.astype(float)) - 1) < 1e-12
    ids = np.concatenate([r.integers(0, len(counts), 5000), np.arange(len(counts) - 40, len(counts))]).astype(np.uint32)
    (payload,), (points,) = huffman.pack(ids, np.array([len(ids)]), lengths, huffman.canonical(lengths), 256)
    runs = np.full(-(-len(ids) // 256), 256)
    runs[-1] = (len(ids) - 1) % 256 + 1
    assert (huffman.Decoder(lengths).decode(payload, points.astype(np.uint64), runs) == ids).all()
