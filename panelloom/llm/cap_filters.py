"""Near-duplicate embeddings by spherical-cap filters.

Filter directions form a random product code: a vector is rotated, cut in two
halves, and every pair of one codeword a half is a direction. A vector goes to
every direction that exceeds its cap, that is, whose score is within ``DEPTH``
standard deviations of the vector's best; they are listed from the halves'
scores without going through the code. Similar vectors share directions (of
60,000 random pairs at cosine 0.98 none was missed), others rarely do; joined
on directions, pairs are verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.graph import components
from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed, written

COSINE = 0.98
TABLES, DEPTH = 2, 0.25
BLOCK = 512  # vectors compared with as many others at once, and the least number of a direction that go to a task together
BLOCK_BYTES = 1 << 26  # of the vectors of a block


def _codewords(rows: int) -> int:
    """Codewords a half: as many directions as four times the largest group's vectors, so that chance meetings stay few."""
    n = 64
    while n * n < 4 * rows:
        n *= 2
    return n


def _block_size(n: Column, size: Column) -> Column:
    """Vectors a block: 8 * sqrt(n) of a direction's n, so that each is sent sqrt(n) / 8 times; bounded by bytes."""
    room = F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest(size, F.lit(128))))
    return F.greatest(F.lit(BLOCK), F.least(F.ceil(8 * F.sqrt(n)), room, F.lit(1 << 13)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; brought near 1 by powers of two first, so that no square is too large or small."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    vectors = np.ldexp(vectors, -power)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class _Code:
    def __init__(self, size: int, words: int):
        self.size, self.half = size, max(-(-size // 2), 1)
        words = min(words, 4 ** min(self.half, 16))  # few dimensions: more words would lie within one another's caps
        rng = np.random.default_rng(size * 1_000_003 + words)
        self.words, self.tables = words, []
        for _ in range(TABLES):
            turn, _ = np.linalg.qr(rng.normal(size=(2 * self.half, 2 * self.half)))
            code = rng.normal(size=(2, words, self.half))
            self.tables.append((turn, code / np.linalg.norm(code, axis=2, keepdims=True)))

    def directions(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted numbers of the directions that exceed its cap."""
        padded = np.zeros((len(unit), 2 * self.half))
        padded[:, : self.size] = unit
        rows, numbers = [], []
        for t, (turn, code) in enumerate(self.tables):
            turned = padded @ turn
            lack = []
            for h in (0, 1):
                score = turned[:, h * self.half : (h + 1) * self.half] @ code[h].T
                lack.append((score.max(axis=1, keepdims=True) - score) * np.sqrt(self.half))
            (ra, ca), (rb, cb) = (np.nonzero(x <= DEPTH) for x in lack)
            count = np.bincount(rb, minlength=len(unit))
            first = np.cumsum(count) - count
            a = np.repeat(np.arange(len(ra)), count[ra])
            b = first[ra[a]] + np.arange(len(a)) - np.repeat(np.cumsum(count[ra]) - count[ra], count[ra])
            fits = lack[0][ra[a], ca[a]] + lack[1][rb[b], cb[b]] <= DEPTH
            a, b = a[fits], b[fits]
            rows.append(ra[a])
            numbers.append((t * self.words + ca[a]) * self.words + cb[b])
        rows, numbers = np.concatenate(rows), np.concatenate(numbers)
        order = np.lexsort((numbers, rows))
        return np.split(numbers[order], np.cumsum(np.bincount(rows, minlength=len(unit)))[:-1])


def _decode(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, _Code] = {}
        for batch in batches:
            vectors, sizes = batch.column("embedding"), batch.column("size").to_numpy()
            out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(batch)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                x = _unit(np.array(vectors.take(pa.array(own)).flatten(), np.float64).reshape(-1, size))
                code = codes.setdefault(size, _Code(int(size), words))
                for i in range(0, len(own), 1024):
                    for k, found in zip(own[i : i + 1024], code.directions(x[i : i + 1024])):
                        out[k] = found
            bounds = np.cumsum([0, *map(len, out)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(out).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=[*batch.schema.names, "directions"]
            )

    return trimmed(run)


def _lowest(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest label that each row and each column of ``near`` reaches, from labels ``a`` and ``b``."""
    far = np.iinfo(np.int64).max
    while True:
        low_a = np.minimum(a, np.where(near, b[None, :], far).min(axis=1))
        low_b = np.minimum(b, np.where(near, low_a[:, None], far).min(axis=0))
        if (low_a == a).all() and (low_b == b).all():
            return a, b
        a, b = low_a, low_b


def _joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest label that each place reaches over the links u - v."""
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        if (low == label).all():
            return label
        label = low


def _verify(cosine: float, tile: int):
    """(node, links, low): for each row of a group how many vectors it is linked with here, and its local root."""

    def one(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = rows.take(pa.array(np.argsort(rows.column("side").to_numpy(), kind="stable"))).combine_chunks()
        node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        m, here, size = len(node), rows.column("direction")[0].as_py(), rows.column("size")[0].as_py()
        x = _unit(np.array(rows.column("embedding").combine_chunks().flatten(), np.float64).reshape(m, size))
        lists = rows.column("directions").combine_chunks()
        flat, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        other = int(m - rows.column("side").to_numpy().sum())  # where the second block begins, if there are two
        two = 0 < other < m
        cuts = lambda a, b: [(k, min(k + tile, b)) for k in range(a, b, tile)]

        def earlier(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
            """The directions before this one that vectors a to b go to, each with its vector."""
            own = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
            numbers = flat[bounds[a] : bounds[b]]
            return numbers[numbers < here], own[numbers < here]

        links, joins = np.zeros(m, np.int64), []
        for a, b in cuts(0, other if two else m):
            for c, d in cuts(other, m) if two else cuts(a, m):
                near = x[a:b] @ x[c:d].T >= cosine
                if a == c:
                    np.fill_diagonal(near, False)
                if not near.any():
                    continue
                low_a, low_c = _lowest(near, np.arange(a, b), np.arange(c, d))
                joins += [np.stack([np.arange(a, b), low_a]), np.stack([np.arange(c, d), low_c])]
                # a pair counts in the first direction that both vectors go to
                (left, rows_a), (right, rows_c) = earlier(a, b), earlier(c, d)
                names = np.intersect1d(left, right)
                if len(names):
                    held = []
                    for numbers, own, n in ((left, rows_a, b - a), (right, rows_c, d - c)):
                        at = np.minimum(np.searchsorted(names, numbers), len(names) - 1)
                        hits = names[at] == numbers
                        table = np.zeros((n, len(names)), np.float32)
                        table[own[hits], at[hits]] = 1
                        held.append(table)
                    near &= ~((held[0] @ held[1].T) > 0)
                links[a:b] += near @ copies[c:d]
                if a != c:
                    links[c:d] += copies[a:b] @ near
        label = np.arange(m)
        if joins:
            u, v = np.concatenate(joins, axis=1)
            label = _joined(label, u[u != v], v[u != v])
        low = np.full(m, np.iinfo(np.int64).max)
        np.minimum.at(low, label, node)
        return node, links, low[label]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        keys = ["label", "size", "direction", "pair"]

        def groups(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            change = np.zeros(len(rows), bool)
            for k in keys:
                v = rows.column(k).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            cuts = [0, *np.flatnonzero(change), len(rows)]
            parts = [one(rows.slice(a, b - a)) for a, b in zip(cuts, cuts[1:]) if b - a > 1]
            if parts:
                node, links, low = (np.concatenate(c) for c in zip(*parts))
                some = (links > 0) | (low != node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(low[some])],
                    names=["node", "links", "low"],
                )

        for batch in batches:
            if not len(batch):
                continue
            rest = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            same = np.ones(len(rest), bool)
            for k in keys:
                v = rest.column(k).to_numpy()
                same &= v == v[-1]
            cut = 0 if same.all() else len(rest) - int(np.argmin(same[::-1]))
            if cut:
                yield from groups(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None:
            yield from groups(rest)

    return trimmed(run)


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal, non-null label and equal length are linked when their
    cosine in double precision is at least ``cosine``. A vector that is null
    or zero, or has a null or non-finite component, links with nothing, nor
    does one without label: its component is itself. Equal vectors of a label
    are handled once and counted as often as they come, repeated rows too.
    A row without vec_id counts as a link of others; its own component_id is
    the smallest id that it reaches, null if none. Further columns are ignored.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(fine & some & F.col("label").isNotNull(), F.lit(False))
    rows = vectors.withColumn("usable", usable)
    nodes = (
        rows.where("usable")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("low_id"), F.count("*").alias("copies"))
        .withColumn("size", F.size("embedding"))
    )
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    largest = nodes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    found = written(_found(nodes, _codewords(largest), cosine), "met")
    links = found.where("low != node").select(F.col("low").alias("u"), F.col("node").alias("v")).distinct()
    roots = components(written(links, "links"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = placed.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = (
        placed.join(lowest, "root")
        .join(counts, "node", "left")
        .select(
            "label",
            "embedding",
            "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    linked = rows.where("usable").join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _found(nodes: DataFrame, codewords: int, cosine: float) -> DataFrame:
    decoded = nodes.select("node", "label", "size", "embedding", "copies")
    schema = decoded.schema.simpleString()[len("struct<") : -1] + ",directions:array<bigint>"
    decoded = written(decoded.mapInArrow(_decode(codewords), schema), "decoded")
    rows = decoded.select("node", "label", "size", F.explode("directions").alias("direction"))
    sizes = rows.groupBy("label", "size", "direction").agg(F.count("*").alias("n")).where("n > 1")
    met = rows.join(sizes, ["label", "size", "direction"])
    blocks = F.ceil(F.col("n") / _block_size(F.col("n"), F.col("size")))
    met = met.withColumn("blocks", blocks).withColumn("spot", F.pmod(F.xxhash64("node", "direction"), blocks))

    def pair(k):  # the block meets block k; "side" tells the two apart
        low, high = F.least("spot", k), F.greatest("spot", k)
        return F.struct((low * F.col("blocks") + high).alias("pair"), (F.col("spot") > k).alias("side"))

    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), pair)
    met = met.select("node", "direction", F.explode(pairs).alias("p")).select("node", "direction", "p.pair", "p.side")
    full = met.join(decoded, "node").select(
        "label", "size", "direction", "pair", "side", "node", "copies", "embedding", "directions"
    )
    keys = ["label", "size", "direction", "pair"]
    dealt = full.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_verify(cosine, BLOCK), "node long, links long, low long")


_SQL = f"""
with v as (
  select vec_id, label, cast(embedding as double[]) e from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= {COSINE}
), recursive_reach as (
  with recursive r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on r.b = l.a)
  select a, min(b) c from r group by a
)
select vec_id, (select count(*) from l where l.a = vec_id) n_links, c component_id, c = vec_id kept
from embeddings join recursive_reach on a = vec_id
"""


@query("op3_cap_filter_near_dedup", _SQL)
def op3_cap_filter_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
