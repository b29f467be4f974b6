"""Token ids in flat binary files.

A data set is a folder in the shared file system with one pair of files per partition of ascending ids:

- ``*.bin``: the ids of all its documents, one after the other, unsigned little-endian, 16 bits wide if the
  vocabulary allows, else 32;
- ``*.idx``: 64-bit little-endian numbers: the number of documents n, n + 1 offsets into the .bin file counted in ids,
  n document ids (the lowest 64-bit number stands for null).

A task names its files by itself and hands the names to a manifest, which Spark commits once per partition; files of lost
or repeated attempts are in no manifest.  ``base`` in the manifest, the ids in all partitions before, is a prefix sum
over one row per partition.  Readers map the files into memory where the file system is a mounted one.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from stockwise.llm.bpe import encoder
from stockwise.llm.textbytes import LOWER, SPACE, Slice, gathered, slices, span_numbers, spans_of
from stockwise.llm.workers import map_batches
from stockwise.session import staged, work_path

NULL_ID = np.iinfo(np.int64).min


#: Bytes of pieces, ids and their tables that a Python worker remembers between blocks.
KNOWN_BYTES = 64 << 20
#: Pieces of so many bytes are remembered at once, longer ones when they occur twice in a block.
SHORT = 32
#: Text that is encoded at once.
BLOCK = 4 << 20


class PieceMemory:
    """Ids of pieces by their bytes, in sorted arrays of bounded size."""

    def __init__(self, kind: np.dtype, limit: int = KNOWN_BYTES):
        self.kind, self.limit = kind, limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.text, self.ids = np.zeros(0, np.uint8), np.zeros(0, self.kind)
        # Start and length in ``text``, start and length in ``ids``.
        self.places = np.zeros((0, 4), np.int64)

    def find(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pieces are known, and their rows; a piece counts as known only if its bytes are the same."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        known = np.zeros(len(hashes), bool)
        if len(self.hashes):
            hit = np.flatnonzero((self.hashes[at] == hashes) & (self.places[at, 1] == lengths))
            own = gathered(data, starts[hit], lengths[hit])
            other = gathered(self.text, self.places[at[hit], 0], lengths[hit])
            wrong = np.concatenate(([0], np.cumsum(own != other)))
            ends = np.cumsum(lengths[hit])
            known[hit] = wrong[ends] == wrong[ends - lengths[hit]]
        return known, at

    def add(self, hashes: np.ndarray, text: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        if self.text.nbytes + self.ids.nbytes + 40 * len(self.hashes) + text.nbytes + ids.nbytes + 40 * len(hashes) > self.limit:
            self.clear()
        rows = np.stack(
            (np.cumsum(lengths) - lengths + len(self.text), lengths, np.cumsum(counts) - counts + len(self.ids), counts), axis=1
        )
        self.text, self.ids = np.concatenate((self.text, text)), np.concatenate((self.ids, ids))
        hashes, rows = np.concatenate((self.hashes, hashes)), np.concatenate((self.places, rows))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], rows[order]


# Classes of bytes inside a piece (fixed values): letters, digits, other printable ASCII, and what the library itself has to split.
LETTER, DIGIT, SIGN, ODD = 1, 2, 3, 4
_CLASS = np.full(256, ODD, np.uint8)
_CLASS[0x21:0x7F] = SIGN
_CLASS[ord("0") : ord("9") + 1] = DIGIT
for _first, _last in ("AZ", "az"):
    _CLASS[ord(_first) : ord(_last) + 1] = LETTER
_CLASS[ord("'")] = ODD


class TextEncoder:
    """Encodes texts with the tokenizers library, each distinct word of a block once.

    The file's splitter never looks across white space.  Pieces of ASCII and Latin-1 letters, digits and signs without an apostrophe
    are split here as it splits them: runs of letters, single digits, runs of signs; all other pieces stay whole.  The library gets
    many new words, joined by blanks, as one text, and a token that ends a word shows where the next begins.  Words are cut, numbered and put
    together again as arrays; short pieces, and long ones that occur twice in a block, are remembered for the next.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        words = encoder(path)
        self.ends = np.array([t.endswith(words.suffix) for t in words.tokens])
        self.marks = {(t.encode() + b" ")[:2] for t in words.special}
        self.memory = PieceMemory(self.kind)

    def encode_words(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the number of each; plain: each is one word to the splitter."""
        lists, counts = [], []
        for i in range(0, len(words), 1000):
            group = words[i : i + 1000]
            last = ()
            if plain:
                ids = np.array(self.library.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, np.int64)
                last = np.flatnonzero(self.ends[ids]) if len(ids) else ()
            if len(last) != len(group):
                parts = [np.array(e.ids, np.int64) for e in self.library.encode_batch_fast(group, add_special_tokens=False)]
                ids, last = np.concatenate(parts), np.cumsum([len(x) for x in parts]) - 1
            lists.append(ids.astype(self.kind))
            counts.append(np.diff(last, prepend=-1))
        return np.concatenate([np.zeros(0, self.kind), *lists]), np.concatenate([np.zeros(0, np.int64), *counts])

    def split(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, starts and ends of the words, and which of them are whole odd pieces."""
        data = part.data
        starts, ends = spans_of(~SPACE[data], part.offsets)
        kinds, low = _CLASS[data], LOWER[data]
        # Two-byte letters of Latin-1; the signs of multiplication and division are none.
        lead = np.flatnonzero(data[:-1] == 0xC3)
        second = data[lead + 1]
        lead = lead[(second != 0x97) & (second != 0xB7)]
        kinds[lead] = kinds[lead + 1] = LETTER
        upper = lead[data[lead + 1] <= 0x9E] + 1
        low[upper] += 0x20
        # What may hold a special token is left to the library.
        for mark in self.marks:
            kinds[:-1][(data[:-1] == mark[0]) & (data[1:] == mark[1])] = ODD
        odd_bytes = np.concatenate(([0], np.cumsum(kinds == ODD)))
        odd = odd_bytes[ends] > odd_bytes[starts]
        whole = np.zeros(len(data) + 1, np.int8)
        np.add.at(whole, starts[odd], 1)
        np.add.at(whole, ends[odd], -1)
        whole = np.cumsum(whole[:-1], dtype=np.int8) > 0
        low[whole] = data[whole]
        cut = np.zeros(len(data), bool)
        cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        cut &= ~whole & ~SPACE[data]
        cut[starts] = True
        words = np.flatnonzero(cut)
        piece = np.searchsorted(starts, words, side="right") - 1
        stops = np.minimum(np.append(words[1:], len(data)), ends[piece])
        return low, words, stops, odd[piece]

    def rows(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, one after the other, and the rows' bounds."""
        pool, begin, size, bounds = self.pieces(part)
        return gathered(pool, begin, size), bounds

    def bounds(self, part: Slice) -> np.ndarray:
        """The rows' bounds alone."""
        return self.pieces(part)[3]

    def pieces(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, start and length in it of every piece of a slice, and the rows' bounds."""
        data, words, stops, odd = self.split(part)
        numbers, first, hashes = span_numbers(data, words, stops)
        starts, lengths = words[first], (stops - words)[first]
        known, at = self.memory.find(hashes, data, starts, lengths)
        raw, odd = data.tobytes(), odd[first]
        pools, filled = [self.memory.ids], len(self.memory.ids)
        begin, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        begin[known], size[known] = self.memory.places[at[known], 2], self.memory.places[at[known], 3]
        for plain in (True, False):
            new = np.flatnonzero(~known & (odd != plain))
            spelled = [raw[a:b].decode() for a, b in zip(starts[new].tolist(), (starts + lengths)[new].tolist(), strict=True)]
            fresh, counts = self.encode_words(spelled, plain)
            begin[new], size[new] = np.cumsum(counts) - counts + filled, counts
            pools.append(fresh)
            filled += len(fresh)
        pool = np.concatenate(pools)
        sizes = size[numbers]
        row_bounds = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(words, part.offsets)]
        keep = np.flatnonzero(~known & ((lengths <= SHORT) | (np.bincount(numbers, minlength=len(first)) > 1)))
        if len(keep):
            self.memory.add(
                hashes[keep], gathered(data, starts[keep], lengths[keep]), lengths[keep], gathered(pool, begin[keep], size[keep]), size[keep]
            )
        return pool, begin[numbers], sizes, row_bounds


_ENCODERS: dict[str, TextEncoder] = {}


def write_ids(
    docs: DataFrame, path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes the ids of all texts in ascending order of the document id and returns the manifest.

    Manifest: ``part, name, docs, tokens, base, wide``; folder: a path that all executors reach (by default
    a new one in the shared folder).  Every document ends with ``end_id``.

    Defined cases: a null text counts as empty (only the end id); null ids come first; rows that repeat an id are
    written each, ordered by text.  An empty table gives an empty manifest.  Other columns are not read.
    """
    folder = folder or work_path(docs.sparkSession, "token-ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ENCODERS.get(path) or _ENCODERS.setdefault(path, TextEncoder(path))
        width = ids_of.kind.itemsize
        fs, root = FileSystem.from_uri(folder)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        ids, lengths, out = [], [], None
        for batch in batches:
            keys = batch.column(0).fill_null(NULL_ID).to_numpy()
            for part in slices(batch.column(1), BLOCK):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.bin")
                flat, bounds = ids_of.rows(part)
                counts = np.diff(bounds) + 1
                # Every row's ids, then the end id.
                last = np.cumsum(counts) - 1
                whole = np.full(len(flat) + part.rows, end_id, ids_of.kind)
                inner = np.ones(len(whole), bool)
                inner[last] = False
                whole[inner] = flat
                out.write(whole.tobytes())
                ids.append(keys[part.first : part.first + part.rows])
                lengths.append(counts)
        if out is None:
            return
        out.close()
        ids, offsets = np.concatenate(ids), np.concatenate(([0], np.cumsum(np.concatenate(lengths))))
        with fs.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(np.concatenate(([len(ids)], offsets, ids)).astype("<i8").tobytes())
        row = {"part": [TaskContext.get().partitionId()], "name": [name], "docs": [len(ids)], "tokens": [int(offsets[-1])], "wide": [width]}
        yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("wide", pa.int32())]))

    ordered = (
        docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    parts = staged(map_batches(ordered, run, "part int, name string, docs long, tokens long, wide int"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return parts.select(
        "part", F.lit(folder).alias("folder"), "name", "docs", "tokens", "wide",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
    )


def id_counts(ids_of: TextEncoder, column: pa.Array) -> pa.Array:
    """The number of ids of each text and its end id.

    Nothing but counts leaves a slice, so slices are the short ones: the arrays made from one take some forty times its bytes.
    """
    counts = [np.diff(ids_of.bounds(part)) + 1 for part in slices(column)]
    return pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64())


def token_lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` of every row as :func:`write_ids` counts them, the end id included, without writing any.

    Defined cases: null and empty texts have the end id only; null ids are passed on, rows that repeat are counted each.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ENCODERS.get(path) or _ENCODERS.setdefault(path, TextEncoder(path))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), id_counts(ids_of, batch.column(1))], names=["doc_id", "n_tokens"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long")


def opened(fs: FileSystem, path: str, kind: np.dtype) -> np.ndarray:
    """The numbers of a file: memory-mapped on a mounted file system, else read."""
    if isinstance(fs, LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=kind)


def one_task_each(manifest: DataFrame) -> DataFrame:
    """As many partitions as files, so that adaptive execution does not gather the few small rows in one task."""
    return manifest.repartition(max(1, manifest.count()))


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ids_crc32: the unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, root = FileSystem.from_uri(r["folder"])
                ids = opened(fs, f"{root}/{r['name']}.bin", np.dtype(f"<u{r['wide']}"))
                index = opened(fs, f"{root}/{r['name']}.idx", np.dtype("<i8"))
                n = int(index[0])
                offsets, keys = np.array(index[1 : n + 2]), np.array(index[n + 2 :])
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                columns = [
                    pa.array(keys, pa.int64(), mask=keys == NULL_ID),
                    pa.array(r["base"] + offsets[:-1], pa.int64()),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
    return map_batches(one_task_each(manifest), run, schema)


def documents_ids(manifest: DataFrame) -> DataFrame:
    """The documents read back: ``doc_id, ids`` (arrays of numbers)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, root = FileSystem.from_uri(r["folder"])
                ids = opened(fs, f"{root}/{r['name']}.bin", np.dtype(f"<u{r['wide']}"))
                index = opened(fs, f"{root}/{r['name']}.idx", np.dtype("<i8"))
                n = int(index[0])
                offsets, keys = np.array(index[1 : n + 2]), np.array(index[n + 2 :])
                for k in range(0, n, 256):
                    cut = offsets[k : k + 257]
                    lists = pa.ListArray.from_arrays(
                        pa.array(cut - cut[0], pa.int32()), pa.array(ids[cut[0] : cut[-1]].astype(np.int64))
                    )
                    own = keys[k : k + 256]
                    yield pa.RecordBatch.from_arrays([pa.array(own, mask=own == NULL_ID), lists], names=["doc_id", "ids"])

    return map_batches(one_task_each(manifest), run, "doc_id long, ids array<long>")
