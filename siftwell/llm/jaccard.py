"""Exact self-join of documents on the Jaccard similarity of their word n-gram sets, and its components.

Sets are sorted arrays of 64-bit hashes of lower-cased 5-word shingles.

1. Equal sets.  Rows are grouped by a 128-bit hash of their set; the smallest id
   of each group stands for it from here on, so a group of k copies makes k - 1
   links and no pairs.
2. Tiles.  Sets that link share one of the first n - ceil(t n) + 1 shingles in any
   common order.  The order puts shingles of crowded hash bins last (counted over
   all documents in BINS bins), so a passage that many documents share is no key
   for them.  A tile is what shares a key; tiles of one document vanish.
3. Pivots.  Each tile's pivot is the document whose shingles are the most crowded,
   as those of the middle of a group of near copies are.  Every document is
   intersected exactly with one pivot, the one of most of its tiles.
4. Crowds.  Documents of tiles of more than CROWD that are not in one component yet
   are tiled anew, in the order of the exact numbers of these documents that hold a
   shingle; shingles of one document alone come first and fill the places of keys,
   so a document that differs too much has no key left.  Pivots are chosen again.
5. Rest.  What is still in several components is joined within size bands, but only
   documents outside a tile's largest component look for partners, and only in the
   bands that the place of their key leaves possible.  The pairs that pass the
   bound by both places and the bitmap bound are intersected exactly.

No link between components is lost, and links within one change nothing.

The bitmap of a set has a bit for the parity of each hash value modulo a power of
two, at least half its size.  Bits that differ between two bitmaps count differences of the sets
from below, hence bound their overlap from above.

Documents without words have empty sets and no links; null ids are never linked.  Ids
may be of any type with an order; rows of one id are one document of all their links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.shared import Tables, components, only, without
from siftwell.llm.words import Words, mix, rolling, slices

BIN_BITS, BIN_CHUNK = 21, 1 << 12
#: Documents of a tile that are joined in the order of the bins.
CROWD = 32
#: Size bands within the ratio of two sizes that can link.
BANDS = 4


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words make one shingle."""
    hashes = words.hashes()
    windows = rolling(hashes, width)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(windows[a : b - width + 1])
        elif b > a:
            yield mix(rolling(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def bitmap(values: np.ndarray) -> np.ndarray:
    """Parities of the values modulo a power of two of 64-bit words, as many as the size asks for."""
    bits = max(64, 1 << max(0, len(values)).bit_length() >> 1)
    counts = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1 != 0, bitorder="little").view(np.int64)


def _overlap_bound(n: Column, m: Column, a: Column, b: Column) -> Column:
    """The most that two sets of n and m values can have in common, given their bitmaps; sizes differ by half at most."""

    def folded(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))

    a, b = F.when(F.size(a) > F.size(b), folded(a)).otherwise(a), F.when(F.size(b) > F.size(a), folded(b)).otherwise(b)
    differ = F.aggregate(F.zip_with(a, b, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda acc, c: acc + c)
    return F.floor((n + m - differ) / 2)


def _crowding(rows: DataFrame, width: int) -> np.ndarray:
    """For each hash bin, a step of the logarithm of its count of shingles over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BIN_BITS, np.int64)
        for part in slices(batches, "text"):
            for values in shingle_sets(Words(part.column("text"), lower=True), width):
                np.add.at(total, (values >> np.uint64(64 - BIN_BITS)).astype(np.int64), 1)
        for k in range(0, len(total), BIN_CHUNK):
            chunk = total[k : k + BIN_CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array([k // BIN_CHUNK], pa.int32()), pa.array([chunk.astype(np.uint16 if chunk.max() < 2**16 else np.int64).tobytes()])], names=["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        counts = [np.frombuffer(x, np.uint16 if len(x) == 2 * BIN_CHUNK else np.int64).astype(np.int64) for x in table.column("counts").to_pylist()]
        return pa.table([table.column("chunk").slice(0, 1), pa.array([np.sum(counts, axis=0).tobytes()])], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    found = rows.select("text").mapInArrow(count, schema).groupBy("chunk").applyInArrow(add, schema).collect()  # 16 MB, whatever the input
    total = np.zeros(1 << BIN_BITS, np.int64)
    for row in found:
        total[row["chunk"] * BIN_CHUNK : (row["chunk"] + 1) * BIN_CHUNK] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(255, 16 * np.log2(1 + total / max(1.0, total.mean()))).astype(np.uint8)


def _described(rows: DataFrame, width: int, percent: int, kind: str) -> DataFrame:
    """(id, n, same, bitmap, weight, keys) of each row: set size, a hash of the set, its bitmap, how crowded its shingles are, and its tile keys."""
    crowding = rows.sparkSession.sparkContext.broadcast(_crowding(rows, width))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = crowding.value
        for part in slices(batches, "text"):
            size, same, maps, weight, keys = [], [], [], [], []
            for values in shingle_sets(Words(part.column("text"), lower=True), width):
                n = len(values)
                size.append(n)
                same.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                maps.append(bitmap(values))
                step = steps[(values >> np.uint64(64 - BIN_BITS)).astype(np.int64)]
                weight.append(float(step.mean()) if n else 0.0)
                order = np.argsort(step, kind="stable")
                keys.append(values[order[: n - -(-percent * n // 100) + 1 if n else 0]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(size, pa.int64()), pa.array(same, pa.binary()), pa.array(maps, pa.list_(pa.int64())), pa.array(weight, pa.float64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n", "same", "bitmap", "weight", "keys"],
            )

    return rows.mapInArrow(describe, f"id {kind}, n long, same binary, bitmap array<long>, weight double, keys array<long>")


def _sets(tables: Tables, rows: DataFrame, ids: DataFrame, width: int, kind: str) -> DataFrame:
    """(id, values) of the rows with these ids: their sorted sets.  They are written, so no task holds the workers of two steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values = [s.view(np.int64) for s in shingle_sets(Words(part.column("text"), lower=True), width)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(values, pa.list_(pa.int64()))], names=["id", "values"])

    return tables.put(only(tables, rows, ids).mapInArrow(run, f"id {kind}, values array<long>"))


def _verified(tables: Tables, rows: DataFrame, pairs: DataFrame, width: int, percent: int, kind: str) -> DataFrame:
    """Those of the pairs (a, b) whose sets link, by intersection of sorted arrays."""
    pairs = tables.put(pairs)
    sets = _sets(tables, rows, pairs.select(F.col("a").alias("id")).union(pairs.select("b")), width, kind)
    both = pairs.join(sets.withColumnsRenamed({"id": "b", "values": "of_b"}), "b").join(sets.withColumnsRenamed({"id": "a", "values": "of_a"}), "a")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = zip(*((c.values.to_numpy(zero_copy_only=False).view(np.uint64), c.offsets.to_numpy()) for c in (batch.column("of_a"), batch.column("of_b"))), strict=True)
            linked = []
            for k in range(batch.num_rows):
                x, y = (flat[s][at[s][k] : at[s][k + 1]] for s in range(2))
                place = np.searchsorted(x, y)
                common = int((x[np.minimum(place, len(x) - 1)] == y).sum()) if len(x) and len(y) else 0
                linked.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return tables.put(both.select("a", "b", "of_a", "of_b").mapInArrow(intersect, f"a {kind}, b {kind}"))


def linked_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, crowd: int = CROWD) -> DataFrame:
    """(id, n_shingles, component_id) for each row of df: sets link from percent % of Jaccard similarity on."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tables = Tables(df.sparkSession)
    sets = tables.put(_described(rows, width, percent, kind))
    known = sets.where("id IS NOT NULL AND n > 0")
    equal = known.groupBy("n", "same").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    copies = tables.put(known.select("id", "n", "same").join(equal.where("first <> last"), ["n", "same"]).where("id <> first").groupBy("id").agg(F.min("first").alias("first")))
    about = known.select("id", "n", "bitmap")
    finer = BANDS / math.log(100.0 / percent)

    def band(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) * finer + 1e-9)

    def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """labels (id, component) after links (a, b) between documents; an id without links needs no label."""
        if labels is None:
            return components(tables, links)
        ends = [labels.select(F.col("id").alias(x), F.col("component").alias(f"c_{x}")) for x in "ab"]
        lifted = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
        found = components(tables, lifted)
        old = labels.join(found.select(F.col("id").alias("component"), F.col("component").alias("lowest")), "component", "left").select("id", F.coalesce("lowest", "component").alias("component"))
        return tables.put(old.unionByName(found.join(labels, "id", "left_anti")))

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sets link; size and bitmap come before the texts."""
        a, b = (about.select(*[F.col(c).alias(f"{c}_{x}") for c in about.columns]) for x in "ab")
        both = pairs.join(a, pairs["a"] == a["id_a"]).join(b, pairs["b"] == b["id_b"])
        n, m, bound = F.col("n_a"), F.col("n_b"), _overlap_bound(F.col("n_a"), F.col("n_b"), F.col("bitmap_a"), F.col("bitmap_b"))
        near = both.where((100 * F.least(n, m) >= percent * F.greatest(n, m)) & (100 * bound >= percent * (n + m - bound)))
        return _verified(tables, rows, near.select("a", "b").distinct(), width, percent, kind)

    def by_pivot(tiles: DataFrame) -> DataFrame:
        """Links of documents with the pivot of most of their tiles; a tile's pivot is its document of most weight."""
        pivots = tiles.groupBy("key").agg(F.min_by("id", F.struct(-F.col("weight"), F.col("id"))).alias("pivot"))
        counts = tiles.join(pivots, "key").where("id <> pivot").groupBy("id", "pivot").agg(F.count("*").alias("shared"))
        return linked(counts.groupBy(F.col("id").alias("a")).agg(F.min_by("pivot", F.struct(-F.col("shared"), F.col("pivot"))).alias("b")))

    def split(tiles: DataFrame, labels: DataFrame) -> DataFrame:
        """tiles with more than one component, with each row's component, the tile's largest one and whether it is crowded."""
        placed = tiles.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        sizes = placed.groupBy("key", "component").agg(F.count("*").alias("members"))
        mixed = sizes.groupBy("key").agg(F.sum("members").alias("size"), F.count("*").alias("parts"), F.min_by("component", F.struct(-F.col("members"), F.col("component"))).alias("main")).where("parts > 1")
        return tables.put(placed.join(mixed.select("key", "main", (F.col("size") > crowd).alias("crowded")), "key"))

    def recounted(ids: DataFrame) -> DataFrame:
        """(key, id, place, n, weight) of these documents, their keys in the order of how many of them hold a shingle."""
        values = _sets(tables, rows, ids, width, kind).select("id", F.size("values").cast("long").alias("n"), F.explode("values").alias("key"))
        held = values.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
        shared = values.join(held, "key")
        of_one = Window.partitionBy("id")
        ranked = shared.select("*", F.row_number().over(of_one.orderBy("held", "key")).alias("rank"), F.count("*").over(of_one).alias("n_shared"), F.avg("held").over(of_one).alias("mean"))
        placed = ranked.withColumn("place", (F.col("n") - F.col("n_shared") + F.col("rank") - 1).cast("int")).where(F.col("place") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100))
        return tables.put(placed.select("key", "id", "place", "n", (F.col("mean") * F.col("n_shared") / F.col("n")).alias("weight")))

    def across(mixed: DataFrame) -> DataFrame:
        """Candidate pairs (a, b) of different components of a tile, one of them outside the largest."""
        # with a common key at places p and q, an overlap is 1 + min(n - 1 - p, m - 1 - q) at most if the key is the first that the sets share
        most = F.floor((F.col("n") - F.col("place")) * (100 + percent) / percent) - F.col("n")
        seen = mixed.select("key", "id", "n", "component", "main", most.alias("most"))
        one = seen.where("component <> main").withColumns({"low": F.ceil(F.col("n") * percent / 100), "high": F.least(F.floor(F.col("n") * 100 / percent), F.col("most"))}).where("low <= high")
        one = one.withColumn("band", F.explode(F.sequence(band(F.col("low")), band(F.col("high"))))).select("key", "band", "low", "high", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "component")])
        two = seen.select("key", band(F.col("n")).alias("band"), *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "component", "main", "most")])
        fits = F.col("n_b").between(F.col("low"), F.col("high")) & (F.col("most_b") >= F.col("n_a")) & (F.col("component_a") != F.col("component_b"))
        once = (F.col("component_b") == F.col("main_b")) | (F.col("id_a") < F.col("id_b"))
        return one.join(two, ["key", "band"]).where(fits & once).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()

    keys = without(tables, known, copies.select("id"), "id").select("id", "n", "weight", F.posexplode("keys").alias("place", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").select("key")
    tiles = tables.put(keys.join(shared, "key").select("key", "id", "place", "n", "weight"))
    labels = merged(None, by_pivot(tiles))
    mixed = split(tiles, labels)
    candidates = across(mixed.where("NOT crowded"))
    crowds = tables.put(mixed.where("crowded").select("id").distinct())
    if not crowds.isEmpty():
        again = recounted(crowds)
        labels = merged(labels, by_pivot(split(again, labels)))
        candidates = candidates.union(across(split(again, labels)))
    labels = merged(labels, linked(candidates.distinct()))
    final = sets.select("id", "n").join(copies, "id", "left").join(labels.withColumnRenamed("id", "first_"), F.coalesce("first", "id") == F.col("first_"), "left")
    found = tables.last(final.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "first", "id").alias("component_id")))
    return found
