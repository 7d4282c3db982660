"""Exact Jaccard self-join of documents on sets of word shingles, with connected components.

Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its distinct runs of `WORDS` words (with
fewer words the whole sequence). Two documents link when 100 * intersection >= `PERCENT` * union. Equal sets are one node.

The join works in the metric space of the Jaccard distance. Unrelated documents are all at distance 1 from each other and from
any document, so the outermost pivots are the single shingles {s}: a document's nearest ones are its own shingles. Let r be
the largest linking distance. A document within r of another can lack at most floor(r n) of its n shingles there, so
the two meet in the region of one of the first floor(r n) + 1 shingles of each, in any common order: these are the regions
to which a document is replicated. The order puts rare shingles first, by counts of all documents in hash buckets, so
passages that many documents share make no regions but in documents that hold little else.

Regions that hold the same nodes are one: of those, only the first in the common order can be where a pair first meets.
Inside a region the node that shares most of its shingles with others is the first pivot: near copies are mostly copies of
one text, which links to nearly all of them. Its exact distances make a Voronoi cell, the nodes that it links to, and the
rest. A pivot's cell grows to all that are connected to it; the next pivots come from outside all cells, or, where all nodes are
in cells but not all connected, from these. A pivot is compared with those nodes of its region that the triangle inequality
leaves: x can link to y only if their distances to the first pivot differ by at most r. Nodes already known to be connected
need no comparison. Each round takes `PIVOT_GROWTH` times as many pivots a region as the one before, and a region is
joined recursively until all that is left of it is connected, so every region ends, one of k unconnected nodes after about log k
rounds. Groups whose members are nearly all just below the bound have no pivot that settles them; only the filters spare pairs there.

Shingles and sets are 64-bit hashes. Rows are dealt by region; regions whose bucket count says that they may be
huge are dealt in slices. Missing and empty texts have no shingles and link with nothing; repeated rows of an id are one
document each with the same component; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import split_skewed_joins
from .common import checkpointed, files_go, keyed_text, let_go, only_maybe, per_text, reading, small_batches, written
from .components import components

WORDS = 5
PERCENT = 80
BUCKETS = 1 << 16
SLICE_ROWS = 1_000_000
PIVOT_GROWTH = 8
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of a text, sorted."""

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        # hashing a word takes less time than finding it among many
        one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        if len(words) < WORDS:
            # a short sequence is told from every full shingle by its length
            code = np.full(1, len(words), dtype=np.uint64)
            for word in one:
                code = _mixed(code * FACTOR + word)
            return code
        places = len(words) - WORDS + 1
        code = one[:places].copy()
        for i in range(1, WORDS):
            code *= FACTOR
            code += one[i:i + places]
        code = np.sort(_mixed(code))
        return code[np.concatenate([[True], code[1:] != code[:-1]])]


def set_key(shingles: np.ndarray) -> int:
    """The hash of a whole set, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64)) if len(shingles) else 0


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """How many of n shingles, first in the common order, a set is replicated by: the largest number that a linked set can
    lack, and one."""
    return n - -(-percent * n // 100) + 1


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many documents' shingles fall in each hash bucket: a table of fixed size, whatever the corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(), np.zeros(BUCKETS, dtype=np.int64)
        for batch in small_batches(batches):
            # text by text: a whole batch of Python strings would need a multiple of its memory
            found = [shingler(t.as_py()) for t in batch.column(1)]
            if found:
                total += np.bincount((np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    with files_go(texts.sparkSession):
        rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return counts


PREFIX = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("digest", pa.string()), ("prefix", pa.list_(pa.int64()))])


def prefixes(texts: DataFrame, counts: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """For each document: size of its set, its node, the digest of its text, and the shingles by whose regions it is replicated."""
    def make():
        shingler = Shingler()

        def work(ids, contents):
            sizes, nodes, digests, first = [], [], [], []
            for text in contents:
                shingles = shingler(text)
                n = len(shingles)
                sizes.append(n)
                nodes.append(set_key(shingles))
                digests.append(hashlib.md5(text.encode("utf-8", "replace"), usedforsecurity=False).hexdigest())
                seen = counts[(shingles & np.uint64(BUCKETS - 1)).astype(np.int64)]
                first.append(shingles[np.lexsort((shingles, seen))[:prefix_size(n, percent)]].view(np.int64) if n else shingles.view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in first])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(first)))
            return ids, sizes, nodes, digests, lists
        return work

    return per_text(texts, make, PREFIX, "id long, n int, node long, digest string, prefix array<long>")


def shared_regions(rows: DataFrame) -> DataFrame:
    """Of rows (shingle, node, n, place, slices), sorted by shingle and node in each task, those whose region has several
    nodes, once each. All a task holds of a region is its last row, so a region of any size needs no memory."""
    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_has_company = np.empty((0, 5), dtype=np.int64), False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block = np.concatenate([held, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)])
            block = block[np.concatenate([[True], (block[1:, :2] != block[:-1, :2]).any(axis=1)])]
            with_next = block[1:, 0] == block[:-1, 0]
            company = np.concatenate([[held_has_company], with_next])
            keep = company | np.concatenate([with_next, [False]]) | (block[:, 4] > 1)
            held, held_has_company = block[-1:], bool(company[-1])
            yield _region_batch(block[:-1][keep[:-1]])
        if len(held):
            yield _region_batch(held[: int(held_has_company or held[0, 4] > 1)])

    return rows.mapInArrow(filtered, "shingle long, node long, n int, place int")


def _region_batch(rows: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int32)), pa.array(rows[:, 3].astype(np.int32))],
                           names=["shingle", "node", "n", "place"])


def regions(prefixed: DataFrame, counts: np.ndarray, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(shingle, node, n, place) of all regions with several nodes; the place is the shingle's in the node's order, from 0."""
    rows = prefixed.select("node", "n", F.posexplode("prefix").alias("place", "shingle"))
    hot = {int(b): int(-(-counts[b] // slice_rows)) for b in np.flatnonzero(counts > slice_rows)}
    bucket = F.col("shingle").bitwiseAND(BUCKETS - 1)
    slices: Column = F.lit(1)
    if hot:
        table = F.broadcast(rows.sparkSession.createDataFrame(list(hot.items()), "bucket long, slices int"))  # at most BUCKETS rows
        rows = rows.join(table, bucket == table["bucket"], "left").drop("bucket")
        slices = F.coalesce(F.col("slices"), F.lit(1))
    rows = rows.select("shingle", "node", "n", "place", slices.alias("slices"))
    dealt = rows.repartition("shingle", F.pmod(F.xxhash64("node"), F.col("slices"))).sortWithinPartitions("shingle", "node")
    return shared_regions(dealt)


def compatible(n: Column, i: Column, m: Column, j: Column, percent: int = PERCENT) -> Column:
    """Sets of n and m shingles whose first common one is at places i and j can link: the sizes are near enough, and what
    follows those places holds as many shingles as linked sets share. Every linked pair passes in the region of its first common shingle."""
    shared = F.ceil((n + m) * percent / (100 + percent) - 1e-9)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (n - i >= shared) & (m - j >= shared)


def distances(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds `shared` and `total`, the sizes of intersection and union, to pairs (a, b) of nodes, from (node, text)."""
    pairs = checkpointed(pairs.select("a", "b"))
    one = only_maybe(texts, "node", pairs, "a").withColumnsRenamed({"node": "a", "text": "text_a"})
    two = only_maybe(texts, "node", pairs, "b").withColumnsRenamed({"node": "b", "text": "text_b"})
    both = pairs.join(two, "b").join(one, "a")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        last, last_set = None, None   # pairs of one pivot come together
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shared, total = [], []
            for i, node in enumerate(a):
                if node != last:
                    last, last_set = node, shingler(batch.column(2)[i].as_py())
                other = shingler(batch.column(3)[i].as_py())
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                shared.append(both)
                total.append(len(last_set) + len(other) - both)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(shared, pa.int32()), pa.array(total, pa.int32())],
                                  names=["a", "b", "shared", "total"])

    return reading(both.select("a", "b", "text_a", "text_b").mapInArrow(measure, "a long, b long, shared int, total int"), pairs)


def node_texts(texts: DataFrame, prefixed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of one document of each of the nodes, written once."""
    # rows of one id may differ in text, so the digest tells which is wanted
    first = prefixed.groupBy("node").agg(F.min(F.struct("id", "digest")).alias("first")).join(nodes, "node", "left_semi")
    first = checkpointed(first.select("node", "first.id", "first.digest"))
    found = only_maybe(texts, "id", first, "id").withColumn("digest", F.md5(F.col("text").cast("binary"))).join(first, ["id", "digest"])
    made = written(found.dropDuplicates(["id", "digest", "node"]).select("node", "text"), "jaccard-texts")  # dealt as joined
    let_go(first)
    return made


def _pairs(p: Column, q: Column) -> list[Column]:
    return [F.least(p, q).alias("a"), F.greatest(p, q).alias("b")]


def merged_regions(found: DataFrame) -> DataFrame:
    """One region of all that hold the same nodes, the first in the common order, with `size`, its nodes, and `copies`, the regions it
    stands for. No pair is lost: a pair needs the region of its first common shingle alone, and where that is left out, an earlier one with
    the same nodes would hold the pair too. Places grow along the common order for each node alike, so the least sum of places tells the first."""
    sets = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("one"),
                                        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two"), F.sum("place").alias("places"))
    first = sets.groupBy("size", "one", "two").agg(F.min_by("shingle", F.struct("places", "shingle")).alias("shingle"), F.count(F.lit(1)).alias("copies"))
    return found.join(first.select("shingle", "size", "copies"), "shingle")


def with_partners(merged: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The regions without those of two nodes that can not link there."""
    region = Window.partitionBy("shingle")
    rows = merged.withColumns({"other_n": F.sum("n").over(region) - F.col("n"), "other_place": F.sum("place").over(region) - F.col("place")})
    rows = rows.filter((F.col("size") > 2) | compatible(F.col("n"), F.col("place"), F.col("other_n"), F.col("other_place"), percent))
    return rows.drop("other_n", "other_place")


def weighed(merged: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Adds `weight`: how many nodes share a node's region shingles, as the mean logarithm over its whole prefix. A node amid
    its near copies, whose shingles all of them have, weighs more than one with shingles of its own."""
    lacking = F.floor(F.col("n") * ((100 - percent) / 100)) + 1
    total = F.sum(F.log("size") * F.col("copies")).over(Window.partitionBy("node"))  # a node's rows are at most its prefix
    return merged.select("shingle", "node", "n", "place", (total / lacking).cast("float").alias("weight"))


def connected(found: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of all nodes that link to another, from regions (shingle, node, n, place, weight) and (node, text)."""
    r = (100 - percent) / 100 + 1e-9
    rows = found.select("shingle", "node", "n", "place", "weight", F.col("node").alias("component"), F.lit(False).alias("in_cell"),
                        F.array().cast("array<double>").alias("near"))  # distances to first pivots; null where there was no need to know
    measured = joined = table = None
    known_links, pivots = 0, 1
    while True:
        # the next pivots of a region: the weightiest nodes outside all cells, then of those in cells
        order = Window.partitionBy("shingle").orderBy("in_cell", F.desc("weight"), "node")
        chosen = checkpointed(rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= pivots))
        other = chosen.select("shingle", F.struct("node", "n", "place", "component", "near").alias("other"))
        met = rows.join(other, "shingle").filter(F.col("component") != F.col("other.component"))
        met = met.filter(compatible(F.col("n"), F.col("place"), F.col("other.n"), F.col("other.place"), percent))
        met = met.filter(F.forall(F.zip_with("near", "other.near", lambda x, y: F.coalesce(F.abs(x - y) <= r, F.lit(True))), lambda fits: fits))
        pairs = met.select(*_pairs(F.col("node"), F.col("other.node"))).distinct()
        if measured is not None:
            pairs = pairs.join(measured, ["a", "b"], "left_anti")
        found_out = distances(pairs, texts)
        new = found_out.select("a", "b", (1 - F.col("shared") / F.col("total")).alias("distance"),
                               (F.col("shared") * 100 >= F.col("total") * percent).alias("linked"))
        before, measured = measured, checkpointed(new if measured is None else measured.unionByName(new))
        let_go(found_out, before)
        with files_go(measured.sparkSession):
            links = measured.filter("linked").count()
        if joined is None or links > known_links:  # else the components stay as they are
            let_go(joined)
            joined, known_links = components(measured.filter("linked")), links
        rows = rows.drop("component").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if pivots == 1:
            first = chosen.select("shingle", F.col("node").alias("pivot"))
            rows = rows.join(first, "shingle").withColumns(dict(zip(("a", "b"), _pairs(F.col("node"), F.col("pivot"))))).join(measured, ["a", "b"], "left")
            rows = rows.withColumn("near", F.concat("near", F.array("distance"))).drop("a", "b", "pivot", "distance", "linked")
        # pivots have met all that they could link to, and leave their region; what they are connected to is in cells. A region's pivots are a bounded list
        cells = chosen.select("shingle", "node").join(joined, "node", "left").groupBy("shingle").agg(
            F.collect_list("node").alias("pivots"), F.collect_set(F.coalesce("component", "node")).alias("cells"))
        rows = rows.join(cells, "shingle").filter(~F.array_contains("pivots", F.col("node")))
        rows = rows.withColumn("in_cell", F.col("in_cell") | F.array_contains("cells", F.col("component")))
        # regions in which several components are left
        region = Window.partitionBy("shingle")
        rows = rows.withColumns({"least": F.min("component").over(region), "most": F.max("component").over(region)}).filter("least < most")
        before, table = table, checkpointed(rows.select("shingle", "node", "n", "place", "weight", "component", "in_cell", "near"))
        let_go(chosen, before)
        rows = table
        if rows.isEmpty():
            let_go(rows, measured)
            return joined
        pivots *= PIVOT_GROWTH


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """A row for each document: id, `n_shingles`, and `component_id`, the least id that can be reached by links."""
    split_skewed_joins(df.sparkSession)
    texts = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    counts = bucket_counts(texts)
    prefixed = written(prefixes(texts, counts, percent), "jaccard-prefixes")
    whole = written(regions(prefixed, counts, slice_rows), "jaccard-regions")
    found = written(weighed(with_partners(merged_regions(whole), percent), percent), "jaccard-weights")
    let_go(whole)
    of_nodes = node_texts(texts, prefixed, found.select("node"))
    joined = connected(found, of_nodes, percent)
    let_go(found, of_nodes)
    facts = prefixed.select("id", "n", "node").join(joined, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = facts.filter("n > 0").groupBy("group").agg(F.min("id").alias("least"))
    # the few columns of all documents are dealt by group; a hot group's rows can be split, as its other side is one row
    named = facts.join(least, "group", "left")
    # a few bytes a document, for which prefixes, the largest table, can go
    made = written(named.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                                F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id")), "jaccard-components")
    let_go(prefixed, joined)
    return made


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents but those whose component has a lesser id; all columns. Rows of one id stay or go together."""
    gone = join(df, id_col, text_col).filter(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("__gone")).distinct()
    return df.join(gone, df[id_col] == F.col("__gone"), "left_anti")
