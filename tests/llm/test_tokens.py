import random
import tracemalloc
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer, models, pre_tokenizers  # noqa: E402

from stockwise.llm import bpe, textbytes, unigram  # noqa: E402
from stockwise.llm.binary import PieceMemory, TextEncoder, documents_ids, id_counts, read_documents, token_lengths, write_ids  # noqa: E402
from stockwise.llm.textbytes import slices  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [chr(c) for c in (0x1C, 0x85, 0xA0, 0x301, 0x130, 0x212B, 0x3A3, 0x3C2, 0x2026, 0xFEFF, 0xFB01, 0x6771, 0x1F44D, 0x663, 0x2581, 0xE000, 0xAC00)]


def random_texts(n, extra, seed):
    r = random.Random(seed)
    letters = list("  aabbtheinorsLLEE\n\t'.,!-09éßñÄ") + ODD + extra
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(n)]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_pair_index_equals_the_library():
    own = bpe.encoder(PATH)
    special = ["<|endoftext|>", "<|startoftext|>", "'s", "'ve"]
    for text in random_texts(4000, special, 1) + ["a" * 5000, "ab" * 3000, " ".join(["aaa", "aaaa", "aaaaa"])]:
        assert own.encode(text) == library_ids(text)


def test_all_words_at_once_equal_one_by_one():
    own = bpe.encoder(PATH)
    words = list(dict.fromkeys(w for t in random_texts(500, [], 2) for w in own.words(t)))
    together = [x.tolist() for x in own.encode_words(words)]
    assert together == [next(iter(own.encode_words([w]))).tolist() for w in words]


def test_round_trip(docs_of, odd_rows):
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(docs_of(odd_rows), PATH).collect()}
    expected = set()
    for row in odd_rows:
        ids = library_ids(row[1])
        shown = LIBRARY.decode(ids, skip_special_tokens=False)
        expected.add((row[0], len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(shown.encode()).hexdigest()))
    assert found == expected
    plain = bpe.round_trip(docs_of(odd_rows[:2]), PATH).collect()
    assert [r.ids for r in plain] == [" ".join(map(str, library_ids(r[1]))) for r in odd_rows[:2]]
    assert bpe.round_trip(docs_of([]), PATH).collect() == []


def test_word_memory_forgets_long_words_and_stays_bounded():
    memory = bpe.WordMemory(lambda words: [w.upper() for w in words], limit=3, longest=4)
    assert memory.look_up([["ab", "a-long-word"], ["cd"]])["a-long-word"] == "A-LONG-WORD"
    known = memory.look_up([["ab", "ef", "gh"]])
    assert known["gh"] == "GH" and "a-long-word" not in known
    memory.look_up([["xy"]])
    assert len(memory.look_up([[]])) <= 4


@pytest.fixture(scope="module")
def unigram_library():
    vocabulary = unigram.zipf_vocabulary(PIECES)
    library = Tokenizer(models.Unigram(vocabulary, 0, False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.BLANK, prepend_scheme="always", split=True)
    return library, unigram.UnigramCounter(vocabulary)


def test_unigram_counts_equal_the_library(unigram_library):
    library, counter = unigram_library
    for text in random_texts(4000, ["<unk>", "the "], 3) + ["x" * 3000, "ab" * 2000]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_unigram_ties():
    """Equal scores: the longest last piece wins; neighbouring unknown characters are one token."""
    b = unigram.BLANK
    vocabulary = [("<unk>", 0.0), (b, -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), (b + "a", -2.0), ("abb", -3.0)]
    library = Tokenizer(models.Unigram(vocabulary, 0, False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=b, prepend_scheme="always", split=True)
    counter = unigram.UnigramCounter(vocabulary)
    for text in ("ab", "abb", "aabb", "abab", "xyab", "axxyb", "zz zz", "a" * 20, " ab  b"):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_counts(docs_of, odd_rows, unigram_library):
    library, _ = unigram_library
    found = sorted(((r.doc_id, r.n_tokens) for r in unigram.token_counts(docs_of(odd_rows), PIECES).collect()), key=repr)
    assert found == sorted(((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows), key=repr)
    assert unigram.token_counts(docs_of([]), PIECES).collect() == []


def test_files_hold_all_ids_in_order(docs_of, odd_rows):
    manifest = write_ids(docs_of(odd_rows).repartition(5), PATH, end_id=1)
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for r in rows:
        ids = library_ids(r[1]) + [1]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = sorted(map(tuple, read_documents(manifest).collect()), key=lambda r: r[1])
    assert found == expected
    lists = sorted(((r.doc_id, r.ids) for r in documents_ids(manifest).collect()), key=repr)
    assert lists == sorted(((r[0], library_ids(r[1]) + [1]) for r in rows), key=repr)


def test_files_of_an_empty_table(docs_of):
    assert read_documents(write_ids(docs_of([]), PATH, end_id=1)).collect() == []


@pytest.mark.parametrize("limit", [64 << 20, 4000, 0])
def test_pieces_equal_the_library(limit):
    """Cut, numbered, remembered and put together again, over many slices."""
    own = TextEncoder(PATH)
    own.memory = PieceMemory(own.kind, limit)
    texts = random_texts(3000, ["<|endoftext|>", "<|startoftext|>", "'s", "<|", "the", "river", "\x1c", "\x85"], 6) + ["", " ", "a" * 5000, "the river " * 300]
    for part in slices(pa.array([*texts, None]), 20_000):
        ids, bounds = own.rows(part)
        for k in range(part.rows):
            want = library_ids(([*texts, ""])[part.first + k])
            assert ids[bounds[k] : bounds[k + 1]].tolist() == want
    assert own.memory.text.nbytes + own.memory.ids.nbytes <= max(limit, 40_000)


def test_the_library_sees_a_short_piece_once():
    """Also one that occurs once in each of many slices; long pieces are remembered when they come twice in one."""
    own, seen = TextEncoder(PATH), []
    encode = own.encode_words
    own.encode_words = lambda words, plain: seen.extend(words) or encode(words, plain)
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(400)) + " " + "y" * 40] * 5
    counts = np.concatenate([np.diff(own.bounds(part)) for part in slices(pa.array(texts), 10)])
    assert counts.tolist() == [len(library_ids(t)) for t in texts]
    assert len([w for w in seen if len(w) < 32]) == 400 and len(seen) == 405


def test_token_lengths(docs_of, odd_rows):
    found = sorted(map(tuple, token_lengths(docs_of(odd_rows), PATH).collect()), key=repr)
    assert found == sorted(((r[0], len(library_ids(r[1])) + 1) for r in odd_rows), key=repr)
    assert token_lengths(docs_of([]), PATH).collect() == []


def test_counting_ids_takes_little_memory(monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(r.choices(words, k=350)) for _ in range(4000)]
    own = TextEncoder(PATH)
    monkeypatch.setattr(textbytes, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    tracemalloc.start()
    counts = id_counts(own, pa.array(texts)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts[::100] == [len(library_ids(t)) + 1 for t in texts[::100]] and len(counts) == len(texts)
    assert peak < 80 << 20
