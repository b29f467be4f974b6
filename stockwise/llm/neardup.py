"""Near-duplicate documents: fast similarity sketches, banding, verification on full shingle sets, components.

The sketch has one coordinate per bin.  Round i throws every shingle into a hashed bin, a second sequence of rounds
visits the bins one after the other, and each bin keeps its first (and smallest) visitor; so every bin is filled after
at most twice as many rounds as there are bins, most texts need very few, and coordinates agree with the
probability of the Jaccard similarity, with concentration as for independent ones.

Candidates share all coordinates of a band.  Documents with equal sets are one class from the start.  Classes that
buckets connect form a cluster; inside a cluster full sets are compared through an inverted index in a
task's memory, block by block, so that no pair of documents is ever a row: first inside the blocks, then every block with the
first one, and only what is not connected by then with all blocks.  So a group of near copies of any size costs two looks
at each text and about one link, however many blocks it fills.  Where the buckets of a cluster are cheaper to compare one by
one than the whole cluster, they are.
A pair at the threshold misses all bands with probability (1 - 0.75 ** rows) ** bands, 2e-6 by default.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockwise.llm.skew import HOT_SHARE, looked_up
from stockwise.llm.textbytes import Slice, mixed, slices, word_hashes
from stockwise.llm.workers import map_batches
from stockwise.session import staged

WORDS = 5
BANDS, ROWS = 48, 5
PERCENT = 75

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(part: Slice, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row, ascending, and the rows' bounds.

    A row with fewer words than a shingle has its whole sequence as the only one; a row without words has none.
    """
    hashes, bounds = word_hashes(part)
    rolled = np.zeros(len(hashes), np.uint64)
    n = len(hashes)
    # rolled[i] covers words i .. i + words - 1; combining from the last word on keeps the order of words.
    for k in range(words - 1, -1, -1):
        shifted = np.zeros(n, np.uint64)
        shifted[: max(0, n - k)] = hashes[k:]
        rolled = mixed(rolled * _GOLDEN + shifted)
    out, sizes = [], np.zeros(part.rows, np.int64)
    for row in range(part.rows):
        a, b = bounds[row], bounds[row + 1]
        if b - a >= words:
            own = np.unique(rolled[a : b - words + 1])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                short = mixed(short * _GOLDEN + h)
            own = short
        else:
            continue
        out.append(own)
        sizes[row] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def sketches(sets: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """(row, bin) coordinates; rows without elements stay at the highest number."""
    rows = len(bounds) - 1
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(rows * bins, empty)
    low = np.uint64(0xFFFFFFFF)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    elements, open_rows = sets, np.flatnonzero(np.diff(bounds) > 0)
    for i in range(2 * bins):
        if not len(open_rows):
            break
        h = mixed(elements ^ mixed(np.uint64([i + 1]) * _GOLDEN))
        bin_of = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, owner * bins + bin_of, (np.uint64(i) << np.uint64(32)) | (h & low))
        full = (out.reshape(rows, bins)[open_rows] != empty).all(axis=1)
        if full.any():
            keep = np.zeros(rows, bool)
            keep[open_rows[~full]] = True
            open_rows = open_rows[~full]
            mask = keep[owner]
            owner, elements = owner[mask], elements[mask]
    return out.reshape(rows, bins)


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(mixed(np.arange(1, bands + 1, dtype=np.uint64))[None, :], len(coordinates), axis=0)
    cells = coordinates.reshape(len(coordinates), bands, rows)
    for k in range(rows):
        keys = mixed(keys * _GOLDEN + cells[:, :, k])
    return keys


def sketched(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """``doc_id, mark, n_shingles, low, high, keys``: a hash of the text, set size, a 128-bit digest of the set, and its band keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                sets, bounds = shingle_hashes(part)
                keys = band_keys(sketches(sets, bounds, bands * rows), bands, rows).view(np.int64)
                digests = []
                for salt in (1, 2):
                    sums = np.zeros(len(sets) + 1, np.uint64)
                    np.cumsum(mixed(sets + np.uint64(salt)), out=sums[1:])
                    digests.append(mixed(sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
                lists = pa.ListArray.from_arrays(np.arange(part.rows + 1, dtype=np.int32) * bands, pa.array(keys.ravel()))
                own = [batch.column(k)[part.first : part.first + part.rows] for k in range(2)]
                columns = [*own, pa.array(np.diff(bounds)), *map(pa.array, digests), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n_shingles", "low", "high", "keys"])

    text = docs[text_col]
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    return map_batches(texts, run, "doc_id long, mark long, n_shingles long, low long, high long, keys array<long>")


def in_bitmap(id_col: Column, ids: DataFrame, docs: DataFrame, bits: int = 22) -> DataFrame:
    """The rows of ``docs`` whose hashed id may be among ``ids``: a bit map of fixed size is broadcast, so that a join after it
    moves few other rows.  The bit map has ``2 ** (bits - 6)`` numbers at most, whatever the data."""

    def word(c: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(c), 70 - bits)

    def bit(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(64)).cast("int")

    one = F.expr("shiftleft(1L, __bit)")
    words = (
        ids.select(word(F.col("doc_id")).alias("__word"), bit(F.col("doc_id")).alias("__bit"))
        .groupBy("__word")
        .agg(F.bit_or(one).alias("__bits"))
    )
    marked = docs.withColumns({"__word": word(id_col), "__bit": bit(id_col)}).join(F.broadcast(words), "__word")
    return marked.filter(F.col("__bits").bitwiseAND(one) != 0).drop("__word", "__bit", "__bits")


class Forest:
    """Sets of numbers that are joined; the smallest number stands for its set."""

    def __init__(self, names: Iterable[int]):
        self.parent = {int(x): int(x) for x in names}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart."""
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def joined_sets(names: np.ndarray, sets: np.ndarray, bounds: np.ndarray, percent: int, sides: np.ndarray | None = None) -> tuple[Forest, list[tuple[int, int]]]:
    """Joins the names of linked rows; gives the forest and the links (name, name) that joined something, fewer than there are names.

    A row is compared with all others at once, by counting the owners of its elements in an inverted index.  With ``sides`` (0 or 1 per
    row) only rows of different sides are compared.  Rows in the set of the first row that asked need not ask themselves: a row they
    are linked with is in that set too, or it asks.  The search ends when all are one.
    """
    rows, sizes = len(bounds) - 1, np.diff(bounds)
    forest, found = Forest(names.tolist()), []
    apart = len(forest.parent)
    if apart < 2:
        return forest, found
    _, group, counts = np.unique(sets, return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(rows), sizes)[np.argsort(group, kind="stable")]
    first = np.cumsum(counts) - counts
    listed = names.tolist()
    held, many = np.unique(names, return_counts=True)
    pivot = int(np.flatnonzero(names == held[np.argmax(many)])[0])
    for row in [pivot, *range(rows)]:
        if row != pivot and forest.root(listed[row]) == forest.root(listed[pivot]):
            continue
        own = group[bounds[row] : bounds[row + 1]]
        lengths = counts[own]
        at = np.repeat(first[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(owners[at], minlength=rows)
        near = 100 * common >= percent * (sizes[row] + sizes - common)
        for other in np.flatnonzero(near if sides is None else near & (sides != sides[row])).tolist():
            if forest.join(listed[row], listed[other]):
                found.append((listed[row], listed[other]))
                apart -= 1
        if apart == 1:
            break
    return forest, found


def by_group(rows: DataFrame, width: int, numbers: int, finish, schema: str) -> DataFrame:
    """``finish(key, numbers, sets, bounds)`` for the rows of every group, together in one task; it gives columns.

    rows: ``width`` columns that name a group, ``numbers`` columns of whole numbers, and a text.
    """
    names = rows.columns[: width + numbers]
    ordered = rows.repartition(*names[:width]).sortWithinPartitions(*names)
    out_names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        now = None

        def finished() -> pa.RecordBatch:
            sizes = np.concatenate([h[2] for h in held])
            columns = finish(now, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate(([0], np.cumsum(sizes))))
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], names=out_names)

        for batch in batches:
            table = np.stack([batch.column(k).to_numpy() for k in range(width + numbers)], axis=1)
            cuts = np.flatnonzero((table[1:, :width] != table[:-1, :width]).any(axis=1)) + 1
            for x, y in zip([0, *cuts], [*cuts, len(table)], strict=True):
                if x == y:
                    continue
                if now is not None and tuple(table[x, :width]) != now:
                    yield finished()
                    held = []
                now = tuple(table[x, :width])
                for part in slices(batch.column(width + numbers).slice(x, y - x)):
                    sets, bounds = shingle_hashes(part)
                    held.append((table[x + part.first : x + part.first + part.rows, width:], sets, np.diff(bounds)))
        if held:
            yield finished()

    return map_batches(ordered, run, schema)


def cluster_links(units: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (``a, b``) that connect the members of units of comparison (``unit, rep, blocks``) as all their links would.

    Members are hashed into the blocks of their unit.  1. Every block is compared inside; its members get a local root.  2. Every
    block is compared with block 0; roots that meet the largest root of block 0 are settled.  3. The members of roots that are
    not settled are hashed into blocks of their own, each of which is compared with all blocks, its own and the settled ones.  A comparison
    gives at most one link for two roots, so copies give about one link per text and block.
    """

    def inside(key, numbers, sets, bounds):
        forest, _ = joined_sets(numbers[:, 0], sets, bounds, percent)
        reps = np.unique(numbers[:, 0])
        return [np.full(len(reps), key[0]), np.full(len(reps), key[1]), np.full(len(reps), key[2]), reps, [forest.root(x) for x in reps.tolist()]]

    placed = units.select("unit", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"), "blocks", "rep")
    whole = placed.join(texts, placed.rep == texts.doc_id).select("unit", "block", "blocks", "rep", "text")
    rooted = staged(by_group(whole, 3, 1, inside, "unit long, block long, blocks long, rep long, root long"), "rooted")
    links = rooted.filter("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b"))

    # Block 0 goes to every other block of its unit.
    wide = rooted.filter("blocks > 1")
    others = F.when(F.col("block") == 0, F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    star = wide.select("unit", F.explode(others).alias("other"), (F.col("block") > 0).cast("long").alias("side"), "root", "rep")
    star = star.join(texts, star.rep == texts.doc_id).select("unit", "other", "side", "root", "rep", "text")

    def with_first(key, numbers, sets, bounds):
        """Links, and under kind 1 the settled roots."""
        side, roots = numbers[:, 0], numbers[:, 1]
        forest, found = joined_sets(roots, sets, bounds, percent, side)
        found = np.array(found, np.int64).reshape(-1, 2)
        if not (side == 0).any():
            return [np.zeros(0)] * 4
        held, many = np.unique(roots[side == 0], return_counts=True)
        main = int(held[np.argmax(many)])
        settled = [x for x in np.unique(roots).tolist() if forest.root(x) == forest.root(main)]
        kinds = np.repeat([0, 1], [len(found), len(settled)])
        return [kinds, np.full(len(kinds), key[0]), np.concatenate((found[:, 0], settled)), np.concatenate((found[:, 1], settled))]

    met = staged(by_group(star, 2, 3, with_first, "kind long, unit long, a long, b long"), "met")
    links = links.unionByName(met.filter("kind = 0").select("a", "b"))
    settled = met.filter("kind = 1").select("unit", F.col("a").alias("root"), F.lit(True).alias("settled")).distinct()
    marked = staged(wide.join(settled, ["unit", "root"], "left").withColumn("settled", F.coalesce("settled", F.lit(False))), "marked")

    # Unsettled members in blocks of their own (kind 0 below), against settled blocks (kind 1) and each other (kind 0).
    left = marked.filter("NOT settled")
    open_units = left.groupBy("unit").agg(F.count(F.lit(1)).alias("open"), F.max("blocks").alias("blocks"), F.max("blocks").alias("_b"))
    members = marked.groupBy("unit").agg(F.count(F.lit(1)).alias("members"))
    open_units = open_units.join(members, "unit").select(
        "unit", F.ceil(F.col("open") * F.col("_b") / F.col("members")).alias("open_blocks")
    )
    left = left.join(open_units, "unit").withColumn("mine", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("open_blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    mutual = F.sequence(F.lit(0).cast("long"), F.col("open_blocks") - 1)
    to_settled = left.select("unit", "mine", F.lit(1).cast("long").alias("kind"), F.explode(every).alias("other"), F.lit(0).cast("long").alias("side"), "root", "rep")
    pair = left.withColumn("other", F.explode(mutual))
    mutually = pair.select(
        "unit", F.least("mine", "other").alias("mine"), F.lit(0).cast("long").alias("kind"), F.greatest("mine", "other").alias("other"),
        (F.col("mine") > F.col("other")).cast("long").alias("side"), "root", "rep",
    )
    rest = marked.filter("settled").join(open_units, "unit")
    asked = rest.withColumn("mine", F.explode(mutual)).select(
        "unit", "mine", F.lit(1).cast("long").alias("kind"), F.col("block").alias("other"), F.lit(1).cast("long").alias("side"), "root", "rep"
    )
    grid = to_settled.unionByName(mutually).unionByName(asked)
    grid = grid.join(texts, grid.rep == texts.doc_id).select("unit", "mine", "kind", "other", "side", "root", "rep", "text")

    def rest_links(key, numbers, sets, bounds):
        # A block of unsettled members alone is compared inside, all others across.
        across = key[2] == 1 or key[1] != key[3]
        _, found = joined_sets(numbers[:, 1], sets, bounds, percent, numbers[:, 0] if across else None)
        return np.array(found, np.int64).reshape(-1, 2).T

    return links.unionByName(by_group(grid, 4, 3, rest_links, "a long, b long"))


def comparison_units(buckets: DataFrame, clusters: DataFrame, texts: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """``unit, rep, blocks``: clusters, or the buckets of a cluster where these move fewer rows.

    buckets: ``key, rep``; clusters: ``node, component``.  A unit has a block per ``block`` members, and as many more as its texts need
    to stay below ``block_bytes`` each.
    """
    sizes = texts.groupBy(F.col("doc_id").alias("rep")).agg(F.sum(F.octet_length("text")).alias("bytes"))
    members = staged(clusters.select(F.col("node").alias("rep"), "component").join(sizes, "rep"), "members")
    by_key = buckets.join(members, "rep")

    def blocks(members: Column, total: Column) -> Column:
        return F.greatest(F.ceil(members / block), F.ceil(total / block_bytes))

    n, total = F.count(F.lit(1)), F.sum("bytes")
    whole = members.groupBy("component").agg(n.alias("n"), blocks(n, total).alias("blocks"))
    keys = staged(by_key.groupBy("component", "key").agg(n.alias("n"), blocks(n, total).alias("blocks")), "keys")
    single = keys.groupBy("component").agg(F.sum(F.col("n") * F.col("blocks")).alias("cost"), n.alias("keys"))
    chosen = staged(whole.join(single, "component").withColumn("together", F.col("n") * F.col("blocks") <= F.col("cost")), "chosen")
    # At most twice as many components as the share says.
    hot = chosen.filter(F.greatest("n", "keys") >= max(1, max(keys.count(), members.count()) // HOT_SHARE))
    one = looked_up(members, chosen, ["component"], hot).filter("together").select(F.col("component").alias("unit"), "rep", "blocks")
    apart = looked_up(keys.select("component", "key", F.col("blocks").alias("own")), chosen, ["component"], hot)
    apart = apart.filter("NOT together").select("key", F.col("own").alias("blocks"))
    many = buckets.join(apart, "key").select(F.xxhash64("key", F.lit("bucket")).alias("unit"), "rep", "blocks")
    return one.unionByName(many)


def bucket_edges(buckets: DataFrame) -> DataFrame:
    """Edges (``a, b``) that connect the members of all buckets: each with its smallest lead, and this with the other leads.

    buckets: ``key, rep, lead``.  Near copies share their leads, so their edges between leads fall together.
    """
    own = buckets.groupBy("rep").agg(F.min("lead").alias("a"), F.collect_set("lead").alias("leads"))
    member = own.filter("rep != a").select("a", F.col("rep").alias("b"))
    between = own.select("a", F.explode("leads").alias("b")).filter("a != b")
    return member.unionByName(between).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of ``edges`` (``a, b``): the smallest node that can be reached.

    Labels spread along the edges and then jump to the label of their label, until nothing changes; every
    round's labels are written to the shared folder, which also cuts the lineage.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = staged(both.toDF("node", "other"), "edges")
    labels = staged(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("near")), "other")
        best = seen.groupBy("node").agg(F.min("near").alias("near"))
        spread = labels.join(best, "node").select("node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("far"))
        moved = spread.join(jump, "low").select("node", F.least("low", "far").alias("next"), "component")
        moved = staged(moved.select("node", F.col("next").alias("component"), (F.col("next") != F.col("component")).alias("changed")), "labels")
        labels = moved.select("node", "component")
        if moved.filter("changed").isEmpty():
            return labels


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = 128,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Words are runs without ASCII white space after lower-casing A-Z; sets hold the distinct 5-word shingles, as 64-bit
    hashes.  Two rows are linked if 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest id that can be
    reached, and the row with that id is kept.

    Defined cases: a text without words (or null) has an empty set and is linked with nothing; a text of fewer than
    five words has its whole sequence as its only shingle.  Rows that repeat an id with the same set are all in its component
    and share its ``kept``; an id that repeats with other texts links them, and each of its texts is compared.  A row with a null id is linked with
    nothing, has a null component and is kept.  An empty table gives no rows.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marks = staged(sketched(docs, id_col, text_col, bands, rows), "sketches")
    usable = marks.filter("n_shingles > 0 AND doc_id IS NOT NULL")

    # Equal sets: one class, named by its smallest id and, of that id, one text.  Keys of equal sets are equal.
    by_set = ["n_shingles", "low", "high"]
    classes = usable.groupBy(*by_set).agg(
        F.min(F.struct("doc_id", "mark")).alias("first"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("copies")
    )
    classes = staged(classes.select(*by_set, F.col("first.doc_id").alias("rep"), F.col("first.mark").alias("mark"), "keys", "copies"), "classes")

    keyed = classes.select("rep", F.explode("keys").alias("key"))
    leads = keyed.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).filter("lead < last")
    buckets = staged(keyed.join(leads.drop("last"), "key"), "buckets")
    clusters = components(bucket_edges(buckets))
    # An id that repeats may stand for several classes: all their texts are compared.
    wanted = classes.select(F.col("rep").alias("doc_id"), "mark").join(clusters.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    wanted = staged(wanted, "wanted")
    near = in_bitmap(F.col("doc_id"), wanted, texts).withColumn("mark", F.xxhash64("text"))
    near = near.join(wanted, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    near = staged(near.select("doc_id", "text"), "texts")
    units = staged(comparison_units(buckets.select("key", "rep").distinct(), clusters, near, block, block_bytes), "units")
    links = staged(cluster_links(units, near, percent).filter("a != b").distinct(), "links")
    # An id that repeats with other texts is in several classes and links them.
    repeated = usable.groupBy("doc_id").agg(F.min("low").alias("low"), F.max("low").alias("high")).filter("low < high").select("doc_id")
    several = usable.join(repeated, "doc_id", "left_semi").select("doc_id", *by_set).distinct()
    several = several.join(classes.select(*by_set, "rep"), by_set).select("doc_id", "rep")
    shared = several.groupBy("doc_id").agg(F.min("rep").alias("a"))
    twice = staged(several.join(shared, "doc_id").filter("rep != a").select("a", F.col("rep").alias("b")).distinct(), "links")
    labels = components(links.union(twice))

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = staged(named.select(*by_set, F.coalesce("component", "rep").alias("component_id"), "copies"), "named")
    hot = named.filter(F.col("copies") >= max(2, marks.count() // HOT_SHARE)).drop("copies")
    found = looked_up(usable.select("doc_id", *by_set), named.drop("copies"), by_set, hot).select("doc_id", "n_shingles", "component_id")
    alone = marks.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` whose id leads its component, with all their columns.

    Defined cases as in :func:`near_components`: texts without words and rows with a null id stay; rows that repeat a kept id stay, with
    whatever text; an empty table gives no rows; columns of any name are passed on.
    """
    kept = near_components(docs, id_col, text_col, **options).filter("kept")
    keys = kept.select(F.col("doc_id").alias("__kept_id"))
    return docs.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col("__kept_id")), "left_semi")
