"""Near-duplicate documents by banded MinHash, Odd sketches and full-set checks.

1. Each text becomes its set of word shingles; texts of equal sets are one
   node, so copies cost one partial aggregate and no pairs.
2. Bands of a node's MinHash samples name its buckets. Buckets of the same
   nodes are kept once.
3. Nodes that share a bucket get an Odd sketch: ``SAMPLES`` further MinHash
   samples folded into a parity bitmap. The population count of two bitmaps'
   XOR tells precisely how many samples differ.
4. Three rounds of comparing sketches within buckets, confirming on full sets
   and contracting links to components. Round one takes each node's best
   partners in random blocks; round two its best partner in each component it
   is not part of; round three every pair of a bucket that is still in
   different components and not ruled out by its sketches. Pairs inside a
   component need no test: they would change nothing.

Missed links: a pair at the threshold shares no band with probability
(1 - 0.8^5)^40, about 1e-7, and is ruled out by its sketches five standard
deviations off; nothing is capped, sampled or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelloom.llm import words
from panelloom.llm.graph import components
from panelloom.llm.registry import query, table
from panelloom.llm.shared import binary_array, flat_bytes, spans_of_rows, trimmed, written

BANDS, ROWS = 40, 5
SAMPLES, BITS = 1024, 2048  # of an Odd sketch
SLACK = 0.07  # estimates this far under the threshold are still confirmed; five standard deviations
BLOCK = 512  # nodes of a bucket that meet in one task
PARTNERS = 4  # confirmed for a node in round one
PAIRS = 1 << 13  # sketches laid side by side at once
SMALL = 16  # groups up to which pairs are formed for many groups at once
PART = 1 << 18

_RNG = np.random.default_rng(41)
_TIMES = _RNG.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_SALT = _RNG.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_BAND = _RNG.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(hashes: np.ndarray, bounds: np.ndarray, samples: int) -> np.ndarray:
    """The first ``samples`` MinHash values of non-empty sets, one row each."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, samples), np.uint32)
    for i in range(samples):
        out[:, i] = np.minimum.reduceat(low * _TIMES[i] + _PLUS[i], bounds[:-1])
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Fold samples into parity bitmaps: each (place, value) flips one bit."""
    n = len(samples)
    bit = words.mix(samples.astype(np.uint64) ^ _SALT) % np.uint64(BITS)
    flips = np.bincount((bit.astype(np.int64) + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, BITS), axis=1)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of sets from their sketches, rows of uint64 words."""
    differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    flips = -0.5 * BITS * np.log(np.maximum(1 - 2 * differ / BITS, 1e-9))
    return 1 - flips / (2 * SAMPLES)


def band_keys(samples: np.ndarray) -> np.ndarray:
    picked = samples.astype(np.uint64).reshape(-1, BANDS, ROWS)
    return words.mix((words.mix(picked + np.uint64(1)) * _BAND).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _fingerprints(width: int):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat_bytes(batch.column("text"))
            for a, b in spans_of_rows(starts, PART):
                sets, bounds = words.shingle_sets(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], width)
                some = np.flatnonzero(np.diff(bounds))
                marks: list[bytes | None] = [None] * (b - a)
                for i in some:
                    marks[i] = hashlib.blake2b(sets[bounds[i] : bounds[i + 1]].tobytes(), digest_size=16).digest()
                bands = np.zeros((b - a, BANDS), np.int64)
                if len(some):
                    bands[some] = band_keys(minhash(sets, np.append(bounds[some], bounds[-1]), BANDS * ROWS))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[a:b],
                        batch.column("text_key")[a:b],
                        pa.array(np.diff(bounds)),
                        pa.array(marks, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, (b - a + 1) * BANDS, BANDS), pa.int32()), pa.array(bands.ravel())
                        ),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "digest", "bands"],
                )

    return trimmed(run)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, object]]:
    """Sorted batches as columns, cut so that no group of equal keys is torn."""

    def columns(batch: pa.Table) -> dict[str, object]:
        out = {}
        for name in batch.column_names:
            column = batch.column(name).combine_chunks()
            if pa.types.is_binary(column.type):
                data, _ = flat_bytes(column)
                out[name] = data.reshape(len(column), -1)
            elif pa.types.is_list(column.type):
                out[name] = column.to_pylist()
            else:
                out[name] = column.to_numpy(zero_copy_only=False)
        return out

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        piece = pa.Table.from_batches([batch])
        rest = piece if rest is None else pa.concat_tables([rest, piece]).combine_chunks()
        same = np.ones(len(rest), bool)
        for k in keys:
            values = rest.column(k).to_numpy()
            same &= values == values[-1]
        cut = len(rest) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield columns(rest.slice(0, cut))
            rest = rest.slice(cut)
    if rest is not None and len(rest):
        yield columns(rest)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat_bytes(batch.column("text"))
            for a, b in spans_of_rows(starts, PART):
                sets, bounds = words.shingle_sets(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node")[a:b],
                        pa.array(np.diff(bounds)),
                        binary_array(odd_sketch(minhash(sets, bounds, SAMPLES))),
                        batch.column("text")[a:b],
                    ],
                    names=["node", "n_shingles", "sketch", "text"],
                )

    return trimmed(run)


def _pairs(part: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of rows of one group, the one that asks first."""
    key, block, asks, out, node, comp = (part[k] for k in ("key", "block", "asks", "out", "node", "comp"))
    cuts = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(block) != 0)])
    size = np.diff(np.append(cuts, len(key)))

    def useful(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        # of two nodes that both ask, the smaller does
        return asks[i] & ~asks[j] & (comp[i] != comp[j]) & ~(out[j] & (node[j] < node[i]))

    few = np.repeat(size <= SMALL, size)
    here = np.flatnonzero(few)
    group = np.repeat(np.arange(len(cuts)), size)
    for step in range(1, SMALL):
        here = here[here + step < len(key)]
        here = here[group[here] == group[here + step]]
        if not len(here):
            break
        for i, j in ((here, here + step), (here + step, here)):
            use = useful(i, j)
            yield i[use], j[use]
    for g in np.flatnonzero(size > SMALL):
        rows = np.arange(cuts[g], cuts[g] + size[g])
        asking, asked = rows[asks[rows]], rows[~asks[rows]]
        for k in range(0, len(asking), 64):
            i = np.repeat(asking[k : k + 64], len(asked))
            j = np.tile(asked, len(asking[k : k + 64]))
            use = useful(i, j)
            yield i[use], j[use]


def _compared(threshold: int, best_of: str | None):
    """Pairs (u, v, about) of groups (key, block) that sketches do not rule out.

    ``best_of`` "block": only each asking node's best partner of the group;
    "component": its best in each component; None: all of them, each in the
    first of the buckets that both nodes are in.
    """
    floor = threshold / 100 - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_groups(batches, ["key", "block"]):
            sketch = np.ascontiguousarray(part["sketch"]).view(np.uint64)
            n, found = part["n_shingles"], []
            for i, j in _pairs(part):
                fits = 100 * np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])
                i, j = i[fits], j[fits]
                if len(i):
                    steps = range(0, len(i), PAIRS)
                    about = np.concatenate([estimate(sketch[i[k : k + PAIRS]], sketch[j[k : k + PAIRS]]) for k in steps])
                    fine = about >= floor
                    found.append((i[fine], j[fine], about[fine]))
            if not found:
                continue
            i, j, about = (np.concatenate(x) for x in zip(*found))
            if best_of:
                other = part["comp"][j] if best_of == "component" else np.zeros(len(j), np.int64)
                order = np.lexsort((part["node"][j], -about, other, i))
                i, j, about, other = i[order], j[order], about[order], other[order]
                first = np.r_[True, (i[1:] != i[:-1]) | (other[1:] != other[:-1])][: len(i)]
            else:
                keys, buckets = part["key"], part["buckets"]
                common = (min(set(buckets[a]) & set(buckets[b])) for a, b in zip(i, j))
                first = np.fromiter(common, np.int64, len(i)) == keys[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part["node"][i[first]]), pa.array(part["node"][j[first]]), pa.array(about[first])],
                names=["u", "v", "about"],
            )

    return trimmed(run)


def _confirm(threshold: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, left_at = flat_bytes(batch.column("text_u"))
            right, right_at = flat_bytes(batch.column("text_v"))
            keep = []
            for a, b in spans_of_rows(left_at + right_at, PART):
                one, one_at = words.shingle_sets(left[left_at[a] : left_at[b]], left_at[a : b + 1] - left_at[a], width)
                two, two_at = words.shingle_sets(
                    right[right_at[a] : right_at[b]], right_at[a : b + 1] - right_at[a], width
                )
                for i in range(b - a):
                    x, y = one[one_at[i] : one_at[i + 1]], two[two_at[i] : two_at[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return trimmed(run)


def near_duplicates(docs: DataFrame, threshold: int = 80, width: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) for every row of ``docs`` (doc_id, text).

    Texts whose shingle sets have ``100 * intersection >= threshold * union``
    are linked; component_id is the smallest doc_id reachable over links and
    kept marks the row that carries it. A text that is null or without words
    has the empty set: it is linked with nothing and kept. A row without
    doc_id counts for links, is kept only if it is linked with nothing that
    has one, and gets the null component_id then. Repeated rows are judged
    alike. Further columns are ignored.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    prints = written(
        docs.mapInArrow(
            _fingerprints(width), "doc_id long, text_key long, n_shingles long, digest binary, bands array<long>"
        ),
        "prints",
    )
    nodes = prints.where("digest is not null").groupBy("digest")
    nodes = nodes.agg(
        F.min("doc_id").alias("low_id"),
        F.min_by(F.struct("doc_id", "text_key"), F.xxhash64("doc_id", "text_key")).alias("at"),
        F.first("bands").alias("bands"),
    )
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = _members(nodes)
    faces = _faces(docs, nodes, members, width)
    return _judged(prints, nodes, _roots(members, faces, threshold, width))


def _members(nodes: DataFrame) -> DataFrame:
    """(key, node, size): the nodes of every bucket of several, buckets of equal nodes once."""
    rows = nodes.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(
        F.count("*").alias("size"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("xor"),
    )
    once = shared.where("size > 1").groupBy("size", "sum", "xor").agg(F.min("key").alias("key"))
    return written(rows.join(once.select("key", "size"), "key"), "members")


def _faces(docs: DataFrame, nodes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(node, n_shingles, sketch, text) of every node that shares a bucket."""
    wanted = nodes.select("node", "at.*").join(members.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("doc_id").alias("at_id"), F.col("text_key").alias("at_key"))
    same = docs.doc_id.eqNullSafe(wanted.at_id) & (docs.text_key == wanted.at_key)
    found = docs.join(wanted, same).select("node", "text").dropDuplicates(["node"])
    faces = found.mapInArrow(_sketches(width), "node long, n_shingles long, sketch binary, text string")
    return written(faces, "faces")


def _roots(members: DataFrame, faces: DataFrame, threshold: int, width: int) -> DataFrame:
    """(node, root) of nodes with links."""
    links, roots = None, None
    for best_of in ("block", "component", None):
        rows = _first_rows(members) if roots is None else _open_rows(members, roots)
        if best_of is None:
            rows = rows.join(members.groupBy("node").agg(F.collect_list("key").alias("buckets")), "node")
        rows = rows.join(faces.select("node", "n_shingles", "sketch"), "node")
        dealt = rows.repartition("key", "block").sortWithinPartitions("key", "block")
        pairs = dealt.mapInArrow(_compared(threshold, best_of), "u long, v long, about double")
        if best_of == "block":
            best = Window.partitionBy("u").orderBy(F.desc("about"), "v")
            pairs = pairs.distinct().withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= PARTNERS)
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        found = _confirmed(pairs, faces, threshold, width)
        links = found if links is None else links.unionByName(found)
        roots = components(links)
    return roots


def _first_rows(members: DataFrame) -> DataFrame:
    """Random blocks of every bucket; each row both asks and is asked."""
    block = F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("size") / BLOCK))
    role = F.explode(F.array(F.lit(True), F.lit(False)))
    return members.select(
        "key", block.alias("block"), "node", F.col("node").alias("comp"), F.lit(True).alias("out"), role.alias("asks")
    )


def _open_rows(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components.

    Nodes outside a bucket's largest component ask all its other nodes. Both
    sides are dealt into blocks that meet in every combination.
    """
    placed = members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    open_keys = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"), F.count("*").alias("comps"))
        .where("comps > 1")
        .select("key", F.col("top.comp").alias("main"), "total", (F.col("total") - F.col("top.n")).alias("outside"))
    )
    rows = placed.join(open_keys, "key").withColumn("out", F.col("comp") != F.col("main"))
    ask_blocks, all_blocks = F.ceil(F.col("outside") / BLOCK), F.ceil(F.col("total") / (4 * BLOCK))
    ask_spot, all_spot = (F.pmod(F.xxhash64("node", "key"), n) for n in (ask_blocks, all_blocks))
    zero = F.lit(0).cast("long")
    asked = F.transform(F.sequence(zero, ask_blocks - 1), lambda i: F.struct(i.alias("i"), all_spot.alias("j"), F.lit(False).alias("asks")))
    asking = F.transform(F.sequence(zero, all_blocks - 1), lambda j: F.struct(ask_spot.alias("i"), j.alias("j"), F.lit(True).alias("asks")))
    roles = F.when(F.col("out"), F.concat(asked, asking)).otherwise(asked)
    return rows.withColumn("role", F.explode(roles)).select(
        "key",
        (F.col("role.i") * all_blocks + F.col("role.j")).alias("block"),
        "node",
        "comp",
        "out",
        F.col("role.asks").alias("asks"),
    )


def _confirmed(pairs: DataFrame, faces: DataFrame, threshold: int, width: int) -> DataFrame:
    first = faces.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    second = faces.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    both = pairs.join(first, "u").join(second, "v")
    return written(both.mapInArrow(_confirm(threshold, width), "u long, v long"), "found")


def _judged(prints: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    placed = nodes.select("digest", "node", "low_id").join(roots, "node", "left")
    placed = placed.select("digest", "low_id", F.coalesce("root", "node").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = placed.join(lowest, "root").select("digest", "component_id")
    some = prints.where("digest is not null").join(named, "digest")
    none = prints.where("digest is null").withColumn("component_id", F.col("doc_id"))
    names = ["doc_id", "n_shingles", "component_id", "text_key"]
    judged = some.select(names).unionByName(none.select(names))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return judged.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_key")


def without_near_duplicates(docs: DataFrame, width: int = 4) -> DataFrame:
    """One row of each component of ``docs`` (doc_id, text, ...), with all its columns; shingles have ``width`` words.

    Repeated rows are one. Rows without words are linked with nothing and
    stay, once each.
    """
    rows = docs.select(F.struct("*").alias("row")).select("row", "row.doc_id", F.xxhash64("row.text").alias("key"))
    kept = near_duplicates(docs, width=width).where("kept").select(F.col("doc_id").alias("kept_id"), "text_key").distinct()
    same = rows.doc_id.eqNullSafe(kept.kept_id) & (rows.key == kept.text_key)
    once = Window.partitionBy("doc_id", "key").orderBy(F.lit(1))
    found = rows.join(kept, same).withColumn("nth", F.row_number().over(once))
    return found.where("nth = 1").select("row.*")


@query("op1_minhash_near_dedup")
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")
