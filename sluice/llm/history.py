"""New deliveries against everything accepted so far, exact and near copies.

Content-defined chunking: the normalized lines of a file are cut where a rolling hash
over the last eight bytes says so, and at line ends, since nearness is defined on lines.
Equal lines give equal chunks wherever they stand. Accepted files are kept in a
``ChunkStore``: a chunk-to-record table and one record per content. A batch is chunked
once, a few of its rarest chunks are looked up in the table, and the shared byte totals
of what is found decide: a file as near as the threshold shares at least so many bytes,
so coverage loses nothing; what it lets through is confirmed on lines. In the end the
accepted files of the batch are appended. The content of earlier batches is never read.

If at least ``t`` of ``n`` lines must be shared, any ``n - t + 2`` lines hold two shared ones;
the lines with the rarest chunks are taken, so files that meet in one line only are no
candidates, and lines found everywhere are not expanded (where two lines would need one of
those, one line less is taken).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.batches import slices
from sluice.session import cut, forget, lookup_join, shared_folder, small_enough, spread_join, stored_copy

#: Bytes the rolling hash looks at, and the longest chunk.
WINDOW, MAX_CHUNK = 8, 1024
#: A boundary is where these bits of the rolling hash are 0: one in 32 bytes.
MASK = np.uint64(0x1F0)
#: The low bits of a chunk's key hold its length, the one above them whether it ends its line.
LENGTH_BITS = 11
_LENGTHS, _ENDS_LINE = (1 << LENGTH_BITS) - 1, 1 << LENGTH_BITS
#: Most frequent chunks told to every task; a chunk is frequent from (all chunks / this) on, so there can't be more.
FREQUENT_CAP = 200_000
#: Earliest undecided files of a chunk that all others with it are compared with in one round.
LEADERS = 4
#: Candidate pairs, and deliveries, up to which the order of acceptance is settled by one task.
SETTLED_PAIRS, SETTLED_UNITS = 5_000_000, 500_000
_GEAR = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64)
RECORD = "class binary, n int, least bigint, keys array<bigint>, lines array<bigint>"


def normalized_lines(content: str | None) -> list[str]:
    """Distinct lines in lower case without any white space; empty lines are dropped."""
    if not content:
        return []
    return list(dict.fromkeys(x for line in content.lower().split("\n") if (x := "".join(line.split()))))


def chunk_ends(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ends of all chunks of lines that lie one behind the other; ``starts`` are the lines' starts.

    A boundary depends on the eight bytes before it, all of its own line, or on the
    distance from the line's start (each ``MAX_CHUNK``), so it moves with its line.
    """
    gear, rolling = _GEAR[flat], np.zeros(len(flat), dtype=np.uint64)
    for j in range(min(WINDOW, len(flat))):
        rolling[j:] += gear[: len(flat) - j] << np.uint64(j)
    ends = np.append(starts[1:], len(flat))
    offset = np.arange(1, len(flat) + 1) - np.repeat(starts, ends - starts)
    marks = ((rolling & MASK) == 0) & (offset >= WINDOW) | (offset % MAX_CHUNK == 0)
    marks[ends - 1] = True
    return np.flatnonzero(marks) + 1


def chunk_lines(lines: list[bytes]) -> np.ndarray:
    """Keys of all chunks of all lines in order: hash, end of line, length."""
    flat = b"".join(lines)
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    line_ends = np.cumsum(sizes)
    ends = chunk_ends(np.frombuffer(flat, dtype=np.uint8), line_ends - sizes)
    at = [0, *ends.tolist()]
    digest, low = xxhash.xxh64_intdigest, np.uint64(2 * _ENDS_LINE - 1)
    hashes = np.fromiter((digest(flat[a:b]) for a, b in zip(at, at[1:], strict=False)), dtype=np.uint64, count=len(ends))
    last = np.zeros(len(ends), dtype=np.uint64)
    last[np.searchsorted(ends, line_ends)] = _ENDS_LINE
    return ((hashes & ~low) | last | np.diff(ends, prepend=0).astype(np.uint64)).view(np.int64)


def _line_numbers(keys: np.ndarray) -> np.ndarray:
    """For each chunk the number of the line it belongs to."""
    ends = (keys & _ENDS_LINE) != 0
    return np.cumsum(ends) - ends


def _lengths(keys: np.ndarray) -> np.ndarray:
    return keys & _LENGTHS


def least_shared(n, threshold: float):
    """Lines of a set of n that any partner with at least this Jaccard similarity must hold."""
    return np.ceil(n * threshold - 1e-9)


def chunked(files: DataFrame, path: str, content: str, threshold: float = 0.8) -> DataFrame:
    """(path, class, n, least, keys, lines) of every file with at least one line.

    ``class`` identifies the set of lines (128 bits), ``n`` counts them, ``keys`` are the chunks
    line by line, ``lines`` the hashes of the lines. ``least`` are the bytes of distinct chunks
    that a file as near as the threshold shares: all but those of as many lines as may
    differ, the longest taken. Null and blank contents give no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            texts = [[x.encode("utf-8", "surrogatepass") for x in normalized_lines(t)] for t in b.column(1).to_pylist()]
            at = [k for k, lines in enumerate(texts) if lines]
            if not at:
                continue
            every = [x for k in at for x in texts[k]]
            keys = chunk_lines(every)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, every), dtype=np.uint64, count=len(every)).view(np.int64)
            sizes = np.fromiter(map(len, every), dtype=np.int64, count=len(every))
            line_of_file = np.append(0, np.cumsum([len(texts[k]) for k in at]))
            chunk_of_file = np.searchsorted(_line_numbers(keys), line_of_file)
            n, least = np.diff(line_of_file), []
            for i, count in enumerate(n):
                own = np.unique(keys[chunk_of_file[i] : chunk_of_file[i + 1]])
                same = int(least_shared(count, threshold))
                longest = np.sort(sizes[line_of_file[i] : line_of_file[i + 1]])[same:]
                least.append(int(_lengths(own).sum() - longest.sum()))
            classes = [xxhash.xxh3_128_digest(b"\n".join(sorted(texts[k]))) for k in at]
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64())) for ends, values in ((chunk_of_file, keys), (line_of_file, hashes))]
            columns = [b.column(0).take(pa.array(at)), pa.array(classes, pa.binary()), pa.array(n, pa.int32()), pa.array(least, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["path", "class", "n", "least", "keys", "lines"])

    return files.select(path, content).mapInArrow(run, f"path string, {RECORD}")


def _cid(c: str = "class") -> Column:
    """A short id of a class for joins; whatever it brings together is confirmed by content."""
    return F.xxhash64(c)


def chunk_table(records: DataFrame) -> DataFrame:
    """One row per distinct chunk and record, with the record's number of lines."""
    return records.select(F.explode(F.array_distinct("keys")).alias("h"), F.col("n").alias("o_n"), _cid().alias("other"))


def frequent_chunks(table: DataFrame) -> DataFrame:
    """(h, df) of the chunks held by more than one in ``FREQUENT_CAP`` of all rows: fewer than that cap.

    Counts runs of equal chunks in each partition; a chunk met once inside a partition of
    a sorted table is met nowhere else, so only repeated ones and those at the ends are
    shuffled. All rows of a chunk must lie together, as in the parts of a sorted table.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, n, total = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
        first = True
        for b in batches:
            got = b.column(0).to_numpy()
            if not len(got):
                continue
            total += len(got)
            starts = np.flatnonzero(np.append(True, got[1:] != got[:-1]))
            h, n = np.append(h, got[starts]), np.append(n, np.diff(np.append(starts, len(got))))
            joined = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            h, n = h[joined], np.add.reduceat(n, joined)
            out = (n > 1) & (np.arange(len(h)) < len(h) - 1)
            out[0] |= first and len(h) > 1
            first = first and len(h) == 1
            yield pa.RecordBatch.from_arrays([pa.array(h[out]), pa.array(n[out]), pa.array(np.zeros(int(out.sum()), dtype=np.int64))], ["h", "df", "total"])
            h, n = h[-1:], n[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n), pa.array(np.full(len(h), total, dtype=np.int64))], ["h", "df", "total"])

    counted = cut(table.select("h").mapInArrow(runs, "h bigint, df bigint, total bigint").groupBy("h").agg(F.sum("df").alias("df"), F.sum("total").alias("total")))
    total = counted.agg(F.sum("total").alias("n")).first().n or 0
    return counted.filter(F.col("df") > max(2, -(-total // FREQUENT_CAP))).select("h", "df")


def most_frequent(frequent: DataFrame) -> DataFrame:
    """(h, df), at most ``FREQUENT_CAP`` rows of 16 bytes whatever the table's size; counts left out change the order only."""
    return frequent.groupBy("h").agg(F.sum("df").alias("df")).orderBy(F.desc("df"), "h").limit(FREQUENT_CAP)


def picked_chunks(records: DataFrame, frequent: DataFrame, threshold: float) -> DataFrame:
    """(cid, n, keys, lines, need): the chunks each record is looked up by, for how many lines each stands, and how many lines a near record shares of them.

    Of each line its rarest chunk, of these the rarest ``n - t + need``, where ``need`` is two if
    that reaches no frequent chunk, else one: a file of a header and a row is looked up by its
    row. Chunks are ordered by their count in ``frequent`` (0 where missing), then by their key,
    so two records picked with the same counts that share ``t`` lines have keys for as many
    lines in common as both need.
    """
    got = most_frequent(frequent).toArrow()
    h = got.column("h").to_numpy()
    order = np.argsort(h)
    told = records.sparkSession.sparkContext.broadcast((h[order], got.column("df").to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = told.value
        for b in batches:
            if not b.num_rows:
                continue
            ends = b.column(2).offsets.to_numpy()
            keys = b.column(2).flatten().to_numpy()
            line_of = _line_numbers(keys)
            df = np.zeros(len(keys), dtype=np.int64)
            if len(known):
                slot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                df = np.where(known[slot] == keys, counts[slot], 0)
            order = np.lexsort((keys, df, line_of))
            first = order[np.append(True, np.diff(line_of[order]) > 0)]
            row_of = np.repeat(np.arange(b.num_rows), np.diff(ends))[first]
            order = first[np.lexsort((keys[first], df[first], row_of))]
            n = b.column(1).to_numpy()
            rank = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
            least = least_shared(n, threshold)
            base = (n - least + 1).astype(np.int64)
            extra = rank == base[row_of]
            rare = np.zeros(b.num_rows, dtype=bool)
            rare[row_of[extra]] = df[order[extra]] == 0
            need = np.where(rare & (least >= 2), 2, 1)
            chosen = rank < (base + need - 1)[row_of]
            out = [np.unique(x, return_counts=True) for x in np.split(keys[order[chosen]], np.searchsorted(row_of[chosen], np.arange(1, b.num_rows)))]
            lists = [pa.array([x[0] for x in out], pa.list_(pa.int64())), pa.array([x[1] for x in out], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists, pa.array(need, pa.int32())], ["cid", "n", "keys", "lines", "need"])

    return records.select(_cid().alias("cid"), "n", "keys").mapInArrow(run, "cid bigint, n int, keys array<bigint>, lines array<int>, need int")


def confirmed(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """The pairs (cid, other) that are near: by shared byte totals, then by lines. Records of one class are no pair.

    Few pairs are brought to the records, so only records in pairs are shuffled; many meet
    them in joins that spread hot records.
    """
    side = lambda df, name, at: df.select(_cid().alias(name), *[F.col(c).alias(f"{c}_{at}") for c in ("class", "least", "keys", "lines")])
    a, b, pairs = side(left, "cid", "a"), side(right, "other", "b"), cut(pairs)
    if small_enough(pairs, 16):
        met = b.join(F.broadcast(pairs), "other")
        j = a.join(F.broadcast(pairs.select("cid").distinct()), "cid", "left_semi").join(met, "cid")
    else:
        j = spread_join(spread_join(pairs, a, ["cid"]), b, ["other"], counted=pairs)
    shared = F.aggregate(F.array_intersect("keys_a", "keys_b"), F.lit(0).cast("bigint"), lambda acc, h: acc + h.bitwiseAND(F.lit(_LENGTHS).cast("bigint")))
    covered = shared >= F.greatest("least_a", "least_b")
    both = F.size(F.array_intersect("lines_a", "lines_b"))
    exact = both >= F.lit(threshold - 1e-9) * (F.size("lines_a") + F.size("lines_b") - both)
    return j.filter((F.col("class_a") != F.col("class_b")) & covered & exact).select("cid", "other")


def _asked(picked: DataFrame) -> DataFrame:
    """One row per record and chunk it is looked up by."""
    return picked.select("cid", "n", "need", F.explode(F.arrays_zip(F.col("keys").alias("h"), F.col("lines").alias("m"))).alias("k")).select("cid", "n", "need", "k.h", "k.m")


def _size_near(a: Column, b: Column, threshold: float) -> Column:
    return (a >= F.lit(threshold - 1e-9) * b) & (b >= F.lit(threshold - 1e-9) * a)


def _candidates(met: DataFrame, threshold: float) -> DataFrame:
    """(cid, other) of looked-up rows that met: of near size, with as many lines in common as needed."""
    near = met.filter(_size_near(F.col("n"), F.col("o_n"), threshold))
    if "o_need" in near.columns:
        near = near.withColumn("need", F.least("need", "o_need"))
    return near.groupBy("cid", "other", "need").agg(F.sum("m").alias("m")).filter(F.col("m") >= F.col("need")).select("cid", "other")


class ChunkStore:
    """Accepted files on disk: per batch a chunk-to-record table, the records, and the frequent chunks.

    A batch exists once its records are complete, which are written last; what a failed
    attempt left is written over by the next one under the same name. Chunk tables are
    sorted by chunk, so that a lookup skips row groups.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float = 0.8, hidden: tuple[str, ...] = ()):
        self.spark, self.path, self.threshold, self.hidden = spark, path.rstrip("/"), threshold, hidden

    def without(self, *batches: str) -> ChunkStore:
        """The store as if these batches weren't there: what a run that is repeated must see."""
        return ChunkStore(self.spark, self.path, self.threshold, (*self.hidden, *batches))

    def batches(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/records")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = lambda s: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        return sorted({s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(path) if done(s)} - set(self.hidden))

    def append(self, batch: str, records: DataFrame) -> None:
        """Adds the records (columns of ``RECORD``, one per class) of one batch."""
        one = records.select("class", "n", "least", "keys", "lines")
        chunk_table(one).repartitionByRange("h").sortWithinPartitions("h").write.mode("overwrite").parquet(f"{self.path}/chunks/batch={batch}")
        written = self.spark.read.parquet(f"{self.path}/chunks/batch={batch}")
        frequent_chunks(written).write.mode("overwrite").parquet(f"{self.path}/frequent/batch={batch}")
        one.write.mode("overwrite").parquet(f"{self.path}/records/batch={batch}")

    def _read(self, kind: str, schema: str) -> DataFrame:
        got = self.batches()
        if not got:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.path}/{kind}").filter(F.col("batch").isin(got)).drop("batch")

    def records(self) -> DataFrame:
        return self._read("records", RECORD)

    def chunks(self) -> DataFrame:
        return self._read("chunks", "h bigint, o_n int, other bigint")

    def frequent(self) -> DataFrame:
        return self._read("frequent", "h bigint, df bigint")

    def near(self, records: DataFrame, picked: DataFrame) -> DataFrame:
        """``cid`` of the records that are near to a stored one of other content.

        Chunks that many stored records hold are first tried with one representative of
        each size class, so that a family of near files meets a family in linear time; only
        records that aren't near to it are compared with all.
        """
        table, stored = self.chunks(), self.records()
        frequent = most_frequent(self.frequent()).select("h")
        size = F.floor(F.log(F.col("o_n").cast("double")) / F.log(F.lit(1 / self.threshold))).alias("size")
        leading = table.join(F.broadcast(frequent), "h", "left_semi").groupBy("h", size).agg(F.min(F.struct("other", "o_n")).alias("r")).select("h", "r.other", "r.o_n")
        asked = cut(_asked(picked))

        def found_in(asked: DataFrame, table: DataFrame, need: Column) -> DataFrame:
            met = table.join(F.broadcast(asked), "h") if small_enough(asked, 32) else spread_join(asked, table, ["h"])
            pairs = _candidates(met.withColumn("need", need), self.threshold)
            return cut(confirmed(pairs, records, stored, self.threshold).select("cid").distinct())

        near_leading = found_in(asked, leading, F.lit(1))
        return near_leading.unionByName(found_in(cut(asked.join(near_leading, "cid", "left_anti")), table, F.col("need")))


def repeated_deliveries(deliveries: DataFrame, accepted: DataFrame, samples: DataFrame, threshold: float = 0.8, store: ChunkStore | None = None, batch: str = "deliveries") -> DataFrame:
    """(id, match_kind) of deliveries that repeat an accepted file, ``exact`` or ``near``.

    ``deliveries`` has id, ts (orders with id; null first), checksum, path; ``accepted`` has checksum and
    path of files accepted before; ``samples`` path and content. ``store`` keeps the chunks of accepted files
    from batch to batch; what it holds counts as accepted, the contents of ``accepted`` are added to it
    as batch ``<batch>-before``, those accepted here as ``<batch>``. Unset, a new one beside the
    checkpoints is used. A delivery that is no case is accepted itself and counts for later
    ones; a run that is repeated gives what it gave. Null checksums equal nothing; deliveries without content can only repeat
    exactly, contents without lines are near to nothing. Repeated rows of one delivery
    give one row.

    Deliveries of equal checksum and content are one case after their first, so only the
    first of each such group is decided: against the store, then among each other.
    Copies are never paired.
    """
    spark = samples.sparkSession
    store = store or ChunkStore(spark, shared_folder(spark, "chunks"), threshold)
    at_hand = shared_folder(spark, "files")
    files = stored_copy(chunked(samples, "path", "content", threshold).withColumn("row", F.monotonically_increasing_id()), at_hand)
    named = files.groupBy("path").agg(F.min("class").alias("class"))  # a path that comes twice has one content
    at = F.struct(F.coalesce("ts", F.lit(-(2**63))).alias("ts"), F.col("id").alias("id"))
    parties = deliveries.select("id", at.alias("at"), "checksum", "path", F.lit(False).alias("old")).unionByName(accepted.select("checksum", "path", F.lit(True).alias("old")), allowMissingColumns=True)
    parties = cut(parties.join(named, "path", "left").drop("path"))
    old, new = parties.filter("old").select("checksum", "class"), parties.filter("NOT old").drop("old")

    old_sums = old.filter(F.col("checksum").isNotNull()).select("checksum").distinct()
    before = f"{batch}-before"
    earlier = store.without(batch, before).records().select("class").withColumn("state", F.lit(2))
    states = old.select("class", F.lit(1).alias("state")).unionByName(new.select("class", F.lit(0).alias("state"))).unionByName(earlier).filter(F.col("class").isNotNull())
    state = states.groupBy("class").agg(F.max("state").alias("state"))
    # one row of the files stands for each class, known by its number, so contents are not shuffled to find copies
    rows = cut(files.groupBy("class").agg(F.min("row").alias("row")).join(state, "class").select("row", "state"))
    contents = lookup_join(files.drop("path"), rows, ["row"], "inner", row_bytes=16).drop("row")
    store.append(before, contents.filter("state = 1").drop("state"))

    store = store.without(batch)
    stored = store.records().select("class")
    probe = cut(contents.filter("state = 0").drop("state"))
    forget(spark, at_hand)  # all that is needed later lies in the store and the checkpoints
    frequent = frequent_chunks(chunk_table(probe).repartition("h").sortWithinPartitions("h")).unionByName(store.frequent())
    picked = cut(picked_chunks(probe, frequent, threshold))
    near_old = cut(_by_class(probe.withColumn("cid", _cid()), store.near(probe, picked), "cid", "left_semi").select("class"))
    hit = cut(near_old.unionByName(stored))

    firsts = new.filter(F.col("checksum").isNotNull() | F.col("class").isNotNull()).groupBy("checksum", "class").agg(F.min("at").alias("at"))
    open_ = firsts.join(old_sums, "checksum", "left_anti").join(hit, "class", "left_anti").withColumn("cid", F.when(F.col("class").isNotNull(), _cid()))
    rest = _by_class(probe, near_old, "class", "left_anti")
    taken, around = _accept_in_order(cut(open_), rest, picked.join(rest.select(_cid().alias("cid")), "cid", "left_semi"), threshold)
    store.append(batch, _by_class(rest, cut(taken.filter(F.col("class").isNotNull()).select("class").distinct()), "class", "left_semi"))

    by_sum = taken.filter(F.col("checksum").isNotNull()).groupBy("checksum").agg(F.min("at").alias("sum_at"))
    own = taken.filter(F.col("cid").isNotNull()).select("cid", "at")
    by_class = own.unionByName(around).groupBy("cid").agg(F.min("at").alias("class_at")).join(rest.select(_cid().alias("cid"), "class"), "cid").select("class", "class_at")
    sums = old_sums.withColumn("old_sum", F.lit(True)).join(by_sum, "checksum", "full")
    classes = hit.withColumn("old_class", F.lit(True)).join(by_class, "class", "full")
    out = new.filter(F.col("checksum").isNotNull() | F.col("class").isNotNull())
    out = lookup_join(out, sums, ["checksum"], "left", row_bytes=160)
    out = lookup_join(out, classes, ["class"], "left", row_bytes=128)
    exact = F.coalesce(F.col("old_sum"), F.lit(False)) | F.coalesce(F.col("sum_at") < F.col("at"), F.lit(False))
    near = F.coalesce(F.col("old_class"), F.lit(False)) | F.coalesce(F.col("class_at") < F.col("at"), F.lit(False))
    return out.filter(exact | near).select("id", F.when(exact, "exact").otherwise("near").alias("match_kind")).distinct()


def _by_class(records: DataFrame, classes: DataFrame, on: str, how: str) -> DataFrame:
    """Records with, or without, one of these classes: filtered where they lie if the classes are few, else shuffled and cut."""
    few = small_enough(classes)
    out = records.join(F.broadcast(classes) if few else classes, on, how)
    return out if few else cut(out)


def _accept_in_order(open_: DataFrame, records: DataFrame, picked: DataFrame, threshold: float, most_pairs: int = SETTLED_PAIRS, most_units: int = SETTLED_UNITS) -> tuple[DataFrame, DataFrame]:
    """(accepted first deliveries, (cid, at) of the accepted ones each record is near to).

    A delivery is accepted if none accepted before it has its checksum, its content or a
    near content. While the undecided ones share chunks in more pairs than one task may
    settle, rounds of ``_leaders`` decide the earliest of every chunk and all that repeat
    them: a family of mutually near files is gone after its first member was compared
    with each. What is left goes through ``_settled`` in one pass; deliveries entangled
    with no other are accepted without it.
    """
    taken, around = [], []
    picked = cut(picked)
    while not open_.isEmpty():
        live = cut(picked.join(open_.select("cid").distinct(), "cid", "left_semi"))
        shared = live.select(F.explode("keys").alias("h")).groupBy("h").agg(F.count(F.lit(1)).cast("double").alias("k"))
        n_pairs = shared.agg(F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("n")).first().n or 0
        if n_pairs <= most_pairs:
            now, near, bounded = _settled(open_, records, live, threshold, most_units)
            if bounded:
                taken.append(now)
                around.append(near)
                break
        now, near, open_ = _leaders(open_, records, live, threshold)
        taken.append(now)
        around.append(near)
    nothing = open_.select("checksum", "class", "cid", "at").limit(0)
    every = lambda frames, empty: cut(_union(frames or [empty]))
    return every(taken, nothing), every(around, nothing.select("cid", "at"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _leaders(open_: DataFrame, records: DataFrame, live: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: (accepted now, (cid, at) near to them, still undecided).

    Every record is compared with the first ``LEADERS`` undecided of each of its chunks.
    One that is among these in all its chunks has met every earlier one it could be near
    to; if it is near to none it is accepted, once its checksum and content are free too.
    The earliest undecided delivery always is.
    """
    first_class = open_.filter(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("at").alias("c_at"))
    each = cut(live.join(first_class, "cid").select("cid", "n", "c_at", F.explode("keys").alias("h")))
    rank = F.row_number().over(Window.partitionBy("h").orderBy("c_at", "cid"))
    lead = cut(each.withColumn("rank", rank).filter(F.col("rank") <= LEADERS).select("h", F.col("cid").alias("other"), F.col("c_at").alias("o_at"), F.col("n").alias("o_n")))
    clear = lead.groupBy(F.col("other").alias("cid")).agg(F.count(F.lit(1)).alias("k")).join(live.select("cid", F.size("keys").alias("all")), "cid").filter(F.col("k") == F.col("all")).select("cid")
    met = spread_join(each.select("cid", "n", "c_at", "h"), lead, ["h"]).filter(((F.col("o_at") < F.col("c_at")) | ((F.col("o_at") == F.col("c_at")) & (F.col("other") < F.col("cid")))) & _size_near(F.col("n"), F.col("o_n"), threshold))
    links = cut(confirmed(met.select("cid", "other").distinct(), records, records, threshold))
    free = clear.join(links.select("cid").distinct(), "cid", "left_anti").withColumn("free", F.lit(True))
    first_sum = open_.filter(F.col("checksum").isNotNull()).groupBy("checksum").agg(F.min("at").alias("s_at"))
    state = open_.join(first_sum, "checksum", "left").join(first_class, "cid", "left").join(free, "cid", "left")
    ready = (F.col("checksum").isNull() | (F.col("s_at") == F.col("at"))) & (F.col("cid").isNull() | ((F.col("c_at") == F.col("at")) & F.coalesce("free", F.lit(False))))
    now = cut(state.filter(ready).select("checksum", "class", "cid", "at"))
    own = now.filter(F.col("cid").isNotNull()).select(F.col("cid").alias("other"), "at")
    near = cut(links.join(own, "other").groupBy("cid").agg(F.min("at").alias("at")))
    gone = own.select(F.col("other").alias("cid")).unionByName(near.select("cid")).distinct()
    sums = now.filter(F.col("checksum").isNotNull()).select("checksum").distinct()
    return now, near, cut(open_.join(sums, "checksum", "left_anti").join(gone, "cid", "left_anti"))


def _settled(open_: DataFrame, records: DataFrame, live: DataFrame, threshold: float, most_units: int) -> tuple[DataFrame, DataFrame, bool]:
    """(accepted, (cid, at) near to them, whether few enough deliveries were entangled to decide them here)."""
    each = cut(_asked(live))
    other = each.select("h", F.col("cid").alias("other"), F.col("n").alias("o_n"), F.col("need").alias("o_need"))
    met = _candidates(each.join(other, "h").filter(F.col("cid") < F.col("other")), threshold)
    links = confirmed(met, records, records, threshold)
    links = cut(links.select(F.explode(F.array(F.struct("cid", "other"), F.struct(F.col("other").alias("cid"), F.col("cid").alias("other")))).alias("e")).select("e.*"))
    same = lambda c: open_.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(f"n_{c}"))
    linked = links.groupBy("cid").agg(F.collect_list("other").alias("others"))
    state = cut(open_.join(same("checksum"), "checksum", "left").join(same("cid"), "cid", "left").join(linked, "cid", "left"))
    entangled = (F.coalesce("n_checksum", F.lit(0)) > 1) | (F.coalesce("n_cid", F.lit(0)) > 1) | F.col("others").isNotNull()
    columns = ["checksum", "class", "cid", "at"]
    if state.filter(entangled).limit(most_units + 1).count() > most_units:
        return open_.limit(0), open_.limit(0), False

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cids = set(), set()
        for b in batches:
            keep = []
            for s, c, others in zip(*(b.column(i).to_pylist() for i in (0, 2, 4)), strict=True):
                ok = s not in sums and c not in cids and cids.isdisjoint(others or ())
                keep.append(ok)
                if ok:
                    sums.update(() if s is None else (s,))
                    cids.update(() if c is None else (c,))
            yield pa.table([b.column(i) for i in range(4)], names=columns).filter(pa.array(keep)).combine_chunks().to_batches()[0] if any(keep) else pa.RecordBatch.from_arrays([b.column(i).slice(0, 0) for i in range(4)], columns)

    in_order = state.filter(entangled).select(*columns, "others").repartition(1).sortWithinPartitions("at")
    decided = in_order.mapInArrow(settle, open_.select(*columns).schema)
    now = cut(state.filter(~entangled).select(*columns).unionByName(decided))
    near = links.join(now.filter(F.col("cid").isNotNull()).select(F.col("cid").alias("other"), "at"), "other").groupBy("cid").agg(F.min("at").alias("at"))
    return now, cut(near), True
