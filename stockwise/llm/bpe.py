"""BPE encoding by a pair occurrence index, and decoding.

Every distinct word (pre-token) of a block of rows is encoded once.  All of them lie in one symbol array with
links to their neighbours.  An index maps each merge rank to the positions where its pair stands; the
smallest active rank is applied to all its positions at once, and the pairs that this creates join the lists of their ranks.
For a vocabulary in which every merge comes after the merges that make its parts (checked on load) this gives
the result of merging word by word.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockwise.llm.workers import map_batches

BLOCK_BYTES = 16 << 20
#: Encoded words a Python worker remembers between blocks.
KNOWN_WORDS = 200_000

# Code points below this are unchanged by NFC, and their case and class are the same in every version of Unicode.
PLAIN_END = 0x250
_PLAIN = re.compile(f"[\x00-\x1b\x20-{chr(PLAIN_END - 1)}]*")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies (fixed values)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return [table[b] for b in range(256)]


def plain_class(kinds: str) -> str:
    """The inside of a character class: the plain code points of these Unicode categories."""
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END) if unicodedata.category(chr(c))[0] in kinds)


class PairTable:
    """(left id, right id) -> merge rank and merged id: an open hash table that whole arrays are looked up in."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(len(keys) * 4 + 1))))
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.int64).max, dtype=np.int64)
        self.ranks = np.full(1 << bits, -1, dtype=np.int32)
        self.merged = merged
        self.longest = 1
        todo, step = np.arange(len(keys)), 0
        home = self._home(keys)
        while len(todo):
            slot = (home[todo] + step) & self.mask
            free = self.ranks[slot] < 0
            slot, first = np.unique(np.where(free, slot, -1), return_index=True)
            first, slot = first[slot >= 0], slot[slot >= 0]
            self.keys[slot], self.ranks[slot] = keys[todo[first]], ranks[todo[first]]
            todo, step = np.delete(todo, first), step + 1
        self.longest = step

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks, -1 where the pair has none."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._home(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], -1)
        for step in range(1, self.longest):
            rest = np.flatnonzero((out < 0) & (self.ranks[(slot + step - 1) & self.mask] >= 0))
            if not len(rest):
                break
            at = (slot[rest] + step) & self.mask
            hit = self.keys[at] == keys[rest]
            out[rest[hit]] = self.ranks[at[hit]]
        return out


class WordBpe:
    """Encoder of a tokenizer file: BPE over byte symbols with word ends, split by a pattern, special strings first."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        # The file's pattern with its Unicode classes spelled out for plain code points, which is much faster.
        pattern = steps[0]["pattern"]["Regex"].replace(r"\p{L}", plain_class("L")).replace(r"\p{N}", plain_class("N"))
        self.pattern = re.compile(pattern.replace(r"\s", r"\t-\r \x85\xa0"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"\b\B")
        self.marks = {s[0] for s in self.special}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for table in (self.vocab, self.special):
            for token, i in table.items():
                self.tokens[i] = token

        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right, merged = (
            np.array([self.vocab[x] for x in side], dtype=np.int64)
            for side in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])
        )
        order = np.arange(len(pairs))
        made = np.full(size, -1, dtype=np.int64)
        made[merged] = order
        if len(np.unique(merged)) < len(merged) or (np.maximum(made[left], made[right]) >= order).any():
            raise ValueError("merges must follow the merges that make their parts")
        self.table = PairTable((left << 32) | right, order.astype(np.int32), merged.astype(np.int32))
        symbols = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in symbols], dtype=np.int32)
        self.final = np.array([self.vocab[s + self.suffix] for s in symbols], dtype=np.int32)

    def words(self, text: str) -> list[str | int]:
        """The words of a text; special tokens as ids."""
        if any(c in text for c in self.marks) and self.special_split.search(text):
            out: list[str | int] = []
            last = 0
            for m in self.special_split.finditer(text):
                out += self.words_of_plain(text[last : m.start()])
                out.append(self.special[m[0]])
                last = m.end()
            return out + self.words_of_plain(text[last:])
        return self.words_of_plain(text)

    def words_of_plain(self, text: str) -> list[str]:
        if text.isascii() and not any(c in text for c in _ODD_ASCII) or _PLAIN.fullmatch(text):
            return self.pattern.findall(text.lower())
        out = []
        for piece in ascii_pieces(text):
            if _PLAIN.fullmatch(piece):
                out += self.pattern.findall(piece.lower())
            else:  # rarer characters: the library's own normaliser and splitter decide
                piece = self.library.normalizer.normalize_str(piece)
                shown = self.library.pre_tokenizer.pre_tokenize_str(piece)
                out += [bytes(_BYTE_OF[c] for c in w).decode() for w, _ in shown]
        return out

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the bounds of each word."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        bounds = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(lengths, out=bounds[1:])
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(data)
        ids = self.inner[data]
        last = bounds[1:] - 1
        ids[last] = self.final[data[last]]
        follows, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        follows[last] = n
        before[bounds[:-1]] = -1
        alive = np.ones(n, dtype=bool)
        if n:
            self._apply(ids, follows, before, alive)
        kept = np.flatnonzero(alive)
        return ids[kept], np.searchsorted(kept, bounds)

    def _apply(self, ids: np.ndarray, follows: np.ndarray, before: np.ndarray, alive: np.ndarray) -> None:
        n = len(ids)
        index: dict[int, list[np.ndarray]] = {}  # rank -> positions of the left parts of its pair
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.table.rank(ids[at], ids[follows[at]])
            found = rank >= 0
            at, rank = at[found], rank[found]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(active, r)

        add(np.flatnonzero(follows < n))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            merged = self.table.merged[rank]
            # A position counts only while its pair still stands there.
            nxt = follows[at]
            ok = alive[at] & (nxt < n)
            at, nxt = at[ok], nxt[ok]
            ok = self.table.rank(ids[at], ids[nxt]) == rank
            at, nxt = at[ok], nxt[ok]
            if not len(at):
                continue
            if len(at) > 1 and ids[at[0]] == ids[nxt[0]]:
                at, nxt = self._leftmost(at, nxt)
            ids[at] = merged
            alive[nxt] = False
            after = follows[nxt]
            follows[at] = after
            inside = after < n
            before[after[inside]] = at[inside]
            previous = before[at]
            add(np.concatenate((previous[previous >= 0], at[inside])))

    @staticmethod
    def _leftmost(at: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of equal symbols in a row, pairs are taken from the left without overlap."""
        chained = np.zeros(len(at), dtype=bool)
        chained[1:] = at[1:] == nxt[:-1]
        place = np.arange(len(at))
        start = np.maximum.accumulate(np.where(chained, 0, place))
        take = (place - start) % 2 == 0
        return at[take], nxt[take]

    def encode_words(self, words: list[str | int]) -> Iterator[np.ndarray]:
        """Ids of each word."""
        plain = [w for w in words if isinstance(w, str)]
        ids, bounds = self.merge_all([w.encode() for w in plain])
        bounds, k = bounds.tolist(), 0
        for w in words:
            if isinstance(w, str):
                yield ids[bounds[k] : bounds[k + 1]]
                k += 1
            else:
                yield np.array([w], np.int32)

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return [int(i) for ids in self.encode_words(self.words(text)) for i in ids]

    def shown_words(self, words: list[str | int]) -> Iterator[tuple[int, str, str]]:
        """Of each word the number of ids, "1 2 3" and "a b"."""
        tokens = self.tokens
        for ids in self.encode_words(words):
            ids = ids.tolist()
            yield len(ids), " ".join(map(str, ids)), " ".join([tokens[i] for i in ids])


_BYTE_OF = {s: b for b, s in enumerate(byte_symbols())}
_ENCODERS: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The encoder of a file, made once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
    return _ENCODERS[path]


def blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about ``limit`` bytes at a time; null counts as empty.  Two columns: id, text."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= limit:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


class WordMemory:
    """What ``encode`` gives for each word; short words, which come back often, are remembered between blocks."""

    def __init__(self, encode: Callable[[list], Iterable], limit: int = KNOWN_WORDS, longest: int = 8):
        self.encode, self.limit, self.longest, self.known = encode, limit, longest, {}
        self.passing: list = []

    def look_up(self, texts: list[list]) -> dict:
        """A dictionary that holds every word of these texts, until the next call."""
        known = self.known
        for word in self.passing:
            del known[word]
        wanted = set()
        for words in texts:
            wanted.update(words)
        missing = [w for w in wanted if w not in known]
        full = len(known) >= self.limit
        self.passing = [w for w in missing if full or (isinstance(w, str) and len(w) > self.longest)]
        known.update(zip(missing, self.encode(missing), strict=True))
        return known


_MEMORIES: dict[str, WordMemory] = {}


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: ``doc_id, n_tokens, ids, decoded`` (ids and tokens joined by blanks).

    path: a tokenizer file with byte-level symbols, word ends and white space dropped; the decoded text is the library's
    for a file without a decoder, token strings joined by blanks.

    Defined cases: a null text counts as empty (no ids, empty decoded text); special strings inside a text become
    their ids, as in the library.  Rows that repeat are encoded each; null ids are passed on.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, _tripper(path, digests=False), "doc_id long, n_tokens long, ids string, decoded string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`round_trip` with SHA-256 digests in place of the ids and the decoded text."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, _tripper(path, digests=True), schema)


def _tripper(path: str, digests: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        memory = _MEMORIES.get(path) or _MEMORIES.setdefault(path, WordMemory(bpe.shown_words))
        finish = (lambda s: sha256(s.encode()).hexdigest()) if digests else str
        names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
        for keys, texts in blocks(batches):
            split = [bpe.words(t) for t in texts]
            known = memory.look_up(split)
            counts, ids, decoded = [], [], []
            for words in split:
                rows = [known[w] for w in words]
                counts.append(sum([r[0] for r in rows]))
                ids.append(finish(" ".join([r[1] for r in rows])))
                decoded.append(finish(" ".join([r[2] for r in rows])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=names,
            )

    return run


def ascii_pieces(text: str) -> list[str]:
    """The pieces between ASCII blanks."""
    odd = any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD_BLANK.search(text)
    return _BLANKS.sub(" ", text).split(" ") if odd else text.split()


_ODD_ASCII = [chr(c) for c in range(0x1C, 0x20)]
# str.split() also cuts at these, which the vocabulary's pattern may treat in its own way (fixed values).
_ODD = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_ODD_BLANK = re.compile("[" + "".join(map(chr, _ODD)) + "]")
_BLANKS = re.compile(r"[ \t\n\r\x0b\x0c]+")
