"""Line dedup on an index of lines that documents can be added to and taken from again.

The index keeps, in the shared folder,

- ``postings``: for every row and every distinct long line in it the line's digest, the row's id and a hash of its text, with the step
  that added it; ``removed``: ids that a later step took away;
- ``counts``: the exact reference count of every digest and the largest id that holds it;
- ``filters``: one cuckoo filter per shard of digests over the lines that are frequent now.  A line that becomes frequent is inserted, one
  that a removal makes rare again is deleted; a filter that would be too full is rebuilt from the counts.

To deduplicate, the lines of a table go to the shards, where the filters pass the few that may be frequent; only these are joined
with the exact counts.  The handful of lines that hold a thousandth of all postings or more meet a broadcast list first, so no
shard and no join key is hot.  Each step writes new tables and records them last, so that a step that fails leaves the index as it was.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockwise.llm.cuckoo import CuckooFilter
from stockwise.llm.dedup import folded
from stockwise.llm.textbytes import LOWER
from stockwise.llm.workers import map_batches
from stockwise.session import remove_at_exit, staged, work_path

BLANK = " \t\n\x0b\x0c\r"
LEAST_DOCS = 3
LEAST_LENGTH = 20
#: Lines with this share of all postings or more are looked up in a broadcast list, which has at most as many rows.
HOT_SHARE = 1000
#: Postings that one task sends through a filter.
TASK_ROWS = 1 << 20

_LOWER = bytes(LOWER)
COUNTS = "digest binary, n long, was long, newest long"
FILTERS = "shard int, capacity long, filter binary"


def code() -> Column:
    return F.xxhash64("digest")


def line_postings(docs: DataFrame, id_col: str, text_col: str, least_length: int) -> DataFrame:
    """``digest, doc_id, mark``: the distinct long lines of every row; ``mark`` is a hash of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)))
    keys = F.filter(keys, lambda key: F.char_length(key) >= least_length)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), keys.alias("keys"))
    lines = rows.select("doc_id", "mark", F.explode(F.array_distinct(F.transform("keys", folded))).alias("key"))
    return lines.select(F.unhex(F.sha2("key", 256)).alias("digest"), "doc_id", "mark")


def _by_shard(rows: DataFrame, run, schema: str) -> DataFrame:
    """Runs ``run(key, batches of one shard's rows)`` for every (shard, salt); rows: ``shard, salt, kind, ...``, small kinds first.

    ``run`` is a generator that is sent batches, and None at the end of the shard.
    """
    ordered = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, task = None, None
        for batch in batches:
            names = np.stack([batch.column(k).to_numpy() for k in range(2)], axis=1)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)], strict=True):
                if x == y:
                    continue
                if tuple(names[x]) != now:
                    if task is not None:
                        yield from task.send(None)
                    now, task = tuple(names[x]), run(int(names[x][0]))
                    next(task)
                yield from task.send(batch.slice(x, y - x))
        if task is not None:
            yield from task.send(None)

    return map_batches(ordered, whole, schema)


def _updated(shard: int):
    """Takes a filter, or the room for a new one, and codes to insert (sign 1) and delete (-1); gives the filter."""
    own, out = None, []
    while (batch := (yield out)) is not None:
        kinds = batch.column(2).to_numpy()
        for k in np.flatnonzero(kinds == 0).tolist():
            raw = batch.column(5)[k].as_py()
            own = CuckooFilter(CuckooFilter.buckets_for(batch.column(4)[k].as_py())) if raw is None else CuckooFilter.from_bytes(raw)
        codes = batch.column(3).to_numpy(zero_copy_only=False)
        for kind, apply in ((1, own.delete), (2, own.insert)):
            chosen = codes[kinds == kind]
            if len(chosen):
                apply(chosen.astype(np.int64).view(np.uint64))
        out = []
    columns = [pa.array([shard], pa.int32()), pa.array([own.capacity], pa.int64()), pa.array([own.to_bytes()], pa.binary())]
    yield [pa.RecordBatch.from_arrays(columns, names=["shard", "capacity", "filter"])]


def _passing(shard: int):
    """Takes a filter and postings, gives the postings that it may hold."""
    own, out = None, []
    while (batch := (yield out)) is not None:
        kinds = batch.column(2).to_numpy()
        for k in np.flatnonzero(kinds == 0).tolist():
            own = CuckooFilter.from_bytes(batch.column(4)[k].as_py())
        codes = batch.column(3).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(kinds == 1)
        out = []
        if own is not None and len(rest):
            hits = rest[own.contains(codes[rest].astype(np.int64).view(np.uint64))]
            names = ["digest", "doc_id", "mark"]
            out = [pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(hits)) for k in (5, 6, 7)], names=names)]
    yield []


class LineIndex:
    """An index of long lines; see the module.

    folder: where its tables are, by default a new folder under the shared one; an index that is there already is opened.  A line
    is frequent if at least ``least_docs`` rows hold it; lines of fewer than ``least_length`` code points (blanks at both ends
    stripped) are not indexed.  Lines are equal when identical after stripping and lower-casing A-Z.

    Defined cases: a null text counts as empty; an empty text is one empty line.  Every row is a document of its own, also where ids repeat;
    a null id is smaller than any other, and if only null ids hold a line, all of them keep it.  Rows that repeat an id and hold its line keep
    it together.  Empty tables change nothing.  Other columns are not read.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, shards: int = 64, least_docs: int = LEAST_DOCS, least_length: int = LEAST_LENGTH):
        self.spark = spark
        self.folder = folder or work_path(spark, "lines")
        if folder is None:
            remove_at_exit(spark, self.folder)
        self.shards, self.least_docs, self.least_length = shards, least_docs, least_length
        self.step = 0
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/steps")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            last = spark.read.parquet(f"{self.folder}/steps").orderBy(F.desc("step")).first()
            self.step, self.shards, self.least_docs, self.least_length = last["step"], last["shards"], last["least_docs"], last["least_length"]

    # -- tables -------------------------------------------------------------------------------------------------

    def _table(self, name: str, schema: str, step: int) -> DataFrame:
        if not step:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}-{step}")

    def _recorded(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/steps")

    def counts(self) -> DataFrame:
        """``digest, n, newest``: exact reference counts of all lines."""
        return self._table("counts", COUNTS, self.step).filter("n > 0").select("digest", "n", "newest")

    def filters(self) -> DataFrame:
        return self._table("filters", FILTERS, self.step)

    def _steps(self, kind: str) -> list[int]:
        if not self.step:
            return []
        return [r["step"] for r in self._recorded().filter((F.col("kind") == kind) & (F.col("step") <= self.step)).collect()]

    def postings(self) -> DataFrame:
        """``digest, doc_id, mark, step`` of all rows that are in the index now."""
        rows = self.spark.createDataFrame([], "digest binary, doc_id long, mark long, step int")
        for step in self._steps("insert"):
            rows = rows.unionByName(self._table("postings", "digest binary, doc_id long, mark long", step).withColumn("step", F.lit(step)))
        gone = self.spark.createDataFrame([], "gone_id long, until int")
        for step in self._steps("delete"):
            gone = gone.unionByName(self._table("removed", "gone_id long", step).withColumn("until", F.lit(step)))
        on = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("step") < F.col("until"))
        return rows.join(gone.groupBy("gone_id").agg(F.max("until").alias("until")), on, "left_anti")

    def _write(self, rows: DataFrame, name: str, step: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}-{step}")

    def _finish(self, step: int, kind: str) -> None:
        """Filters of the new counts; then the step is recorded, and with that it counts."""
        counts = self._table("counts", COUNTS, step).withColumn("shard", F.pmod(code(), F.lit(self.shards)).cast("int"))
        frequent = F.col("n") >= self.least_docs
        # One number per shard.
        heavy = {r["shard"]: r["n"] for r in counts.filter(frequent).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        old = self.filters()
        room = {r["shard"]: r["capacity"] for r in old.select("shard", "capacity").collect()}
        fresh = [s for s, n in heavy.items() if n > room.get(s, 0)]
        rooms = self.spark.createDataFrame([(s, 2 * heavy[s]) for s in fresh], "shard int, room long")
        kept = old.join(F.broadcast(rooms), "shard", "left_anti")
        salt = F.lit(0).alias("salt")
        heads = kept.select("shard", salt, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("code"), F.lit(0).cast("long").alias("room"), "filter")
        heads = heads.unionByName(
            rooms.select("shard", salt, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("code"), "room", F.lit(None).cast("binary").alias("filter"))
        )
        was = F.coalesce("was", F.lit(0)) >= self.least_docs
        marked = counts.join(F.broadcast(rooms), "shard", "left")
        # Deletions before insertions: kind 1 and 2.
        kind_of = F.when(F.col("room").isNotNull(), F.when(frequent, 2)).when(frequent & ~was, 2).when(~frequent & was, 1)
        changes = marked.withColumn("kind", kind_of).filter("kind IS NOT NULL").select(
            "shard", salt, "kind", code().alias("code"), F.lit(0).cast("long").alias("room"), F.lit(None).cast("binary").alias("filter")
        )
        self._write(_by_shard(heads.unionByName(changes), _updated, FILTERS), "filters", step)
        row = (step, kind, self.shards, self.least_docs, self.least_length)
        record = self.spark.createDataFrame([row], "step int, kind string, shards int, least_docs int, least_length int")
        record.write.mode("append").parquet(f"{self.folder}/steps")
        self.step = step

    # -- changes ------------------------------------------------------------------------------------------------

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Adds all rows of ``docs``; returns their postings."""
        step = self.step + 1
        self._write(line_postings(docs, id_col, text_col, self.least_length), "postings", step)
        added = self._table("postings", "digest binary, doc_id long, mark long", step)
        new = added.groupBy("digest").agg(F.count(F.lit(1)).alias("m"), F.max("doc_id").alias("late"))
        merged = self.counts().join(new, "digest", "full").select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"),
            F.coalesce("n", F.lit(0)).alias("was"),
            F.greatest("newest", "late").alias("newest"),
        )
        self._write(merged, "counts", step)
        self._finish(step, "insert")
        return added

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Takes all rows with these ids out again; ids that are not there change nothing."""
        step = self.step + 1
        self._write(ids.select(F.col(id_col).cast("long").alias("gone_id")).distinct(), "removed", step)
        wanted = self._table("removed", "gone_id long", step)
        there = self.postings()
        on = F.col("doc_id").eqNullSafe(F.col("gone_id"))
        lost = there.join(wanted, on, "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("m"), F.max("doc_id").alias("late"))
        reduced = staged(
            self.counts().join(lost, "digest", "left").select(
                "digest", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n"), F.col("n").alias("was"), "newest",
                (F.col("m").isNotNull() & F.col("late").eqNullSafe(F.col("newest"))).alias("open"),
            ),
            "reduced",
        )
        # Only lines that lost their largest id look for the next one.
        rest = there.join(wanted, on, "left_anti").join(reduced.filter("open AND n > 0").select("digest"), "digest", "left_semi")
        largest = rest.groupBy("digest").agg(F.max("doc_id").alias("late"))
        changed = reduced.join(largest, "digest", "left").select(
            "digest", "n", "was", F.when(F.col("open"), F.col("late")).otherwise(F.col("newest")).alias("newest")
        )
        self._write(changed, "counts", step)
        self._finish(step, "delete")

    # -- use ----------------------------------------------------------------------------------------------------

    def dropped_lines(self, postings: DataFrame) -> DataFrame:
        """The postings whose line is frequent and held by a larger id."""
        counts = self._table("counts", COUNTS, self.step).filter(F.col("n") >= self.least_docs).select("digest", "n", "newest")
        total = self._table("counts", COUNTS, self.step).agg(F.sum("n")).first()[0] or 0
        hot = F.broadcast(counts.filter(F.col("n") >= max(1, total // HOT_SHARE)).select("digest", F.col("newest").alias("hot_newest"), F.lit(True).alias("hot")))
        marked = postings.select("digest", "doc_id", "mark").join(hot, "digest", "left")
        lost = ["digest", "doc_id", "mark"]
        at_once = marked.filter(F.col("hot") & ~F.col("doc_id").eqNullSafe(F.col("hot_newest")) & F.col("hot_newest").isNotNull()).select(*lost)

        # Others go to their shard; as many tasks share a shard as its postings need.
        salts = max(1, -(-total // (self.shards * TASK_ROWS)))
        cold = marked.filter("hot IS NULL").select(
            F.pmod(code(), F.lit(self.shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("mark"), F.lit(salts)).cast("int").alias("salt"),
            F.lit(1).alias("kind"), code().alias("code"), F.lit(None).cast("binary").alias("filter"), *lost,
        )
        heads = self.filters().select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("code"), "filter",
            *(F.lit(None).cast(t).alias(c) for c, t in zip(lost, ("binary", "long", "long"), strict=True)),
        )
        maybe = _by_shard(heads.unionByName(cold), _passing, "digest binary, doc_id long, mark long")
        later = maybe.join(counts, "digest").filter("newest IS NOT NULL AND NOT doc_id <=> newest").select(*lost)
        return at_once.unionByName(later)

    def deduplicated(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", postings: DataFrame | None = None) -> DataFrame:
        """One row per row of ``docs``: ``doc_id, text, n_lines, n_dropped``; frequent lines stay only with the largest id in the index.

        postings: those of ``docs`` if they are at hand.
        """
        postings = line_postings(docs, id_col, text_col, self.least_length) if postings is None else postings
        drops = self.dropped_lines(postings).groupBy("doc_id", "mark").agg(F.collect_set("digest").alias("drops"))
        drops = drops.select(F.col("doc_id").alias("drop_id"), F.col("mark").alias("drop_mark"), "drops")
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        on = F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.xxhash64("text") == F.col("drop_mark"))
        joined = rows.join(drops, on, "left").select("doc_id", "text", "drops")
        return map_batches(joined, _without_lines, "doc_id long, text string, n_lines long, n_dropped long")


def _without_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, dropped = [], [], []
        marked = batch.column(2).is_valid().to_pylist()
        for k, text in enumerate(batch.column(1)):
            text = text.as_py()
            lines = text.count("\n") + 1
            lost = 0
            if marked[k]:
                drops = set(batch.column(2)[k].as_py())
                kept = [x for x in text.split("\n") if sha256(x.strip(BLANK).encode().translate(_LOWER)).digest() not in drops]
                lost, text = lines - len(kept), "\n".join(kept)
            texts.append(text)
            counts.append(lines)
            dropped.append(lost)
        columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_lines", "n_dropped"])
