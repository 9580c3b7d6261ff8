"""Packing documents into sequences of tokens by minimum bin slack.

Documents become token ids closed by an end token; only longer ones are cut.
What a bin may hold depends on lengths alone, so the pieces are counted by
length (at most ``capacity`` numbers, whatever the corpus) and the plan is
made on the counts: a bin takes the longest length left, a subset-sum over a
bitset of reachable fills finds the fullest combination of the lengths that
are left, and the combination is taken as often as the counts allow. Pieces
then find their places by a running number within their length.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed, written

CAPACITY, END = 1024, 2
SHARDS = 256  # parts in which pieces of one length are numbered
_SLICE = 1 << 22

# Characters up to U+017F and no long run of white space: there the two tokenizer libraries split texts alike (tested
# over this whole range); other texts, and those that spell a special token, go to the slower one.
_UNLIKE = re.compile("[^\u0000-\u017f]|[\t-\r \u0085\u00a0]{1000}")


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    ``path`` is a vocabulary of the library tokenizers and decides the ids.
    ``ranks`` is the same vocabulary for tiktoken, with the split pattern; it
    is several times faster.
    """

    def __init__(self, path: str, ranks: tuple[str, str] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.slow = re.compile("|".join([_UNLIKE.pattern, *special]))
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks[0], "rb") as file:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast is None or self.slow.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text).astype("<u4").tobytes()


def _pieces(path: str, ranks: tuple[str, str] | None, capacity: int, end: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = Encoder(path, ranks), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.ids(text.as_py() or "") + last
                n = len(ids) // 4
                stop, start, piece = n % capacity or capacity, 0, 0
                while start < n:
                    rows.append((doc_id, piece, start, stop - start, ids[4 * start : 4 * stop]))
                    start, stop, piece = stop, stop + capacity, piece + 1
                size += len(ids)
                if size > _SLICE:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    return trimmed(run)


def token_pieces(
    docs: DataFrame, path: str, ranks: tuple[str, str] | None = None, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document of ``docs`` (doc_id, text).

    ``ids`` holds little-endian 32-bit token ids, ``end`` the last of each
    document. A document of more than ``capacity`` ids is cut into pieces of
    exactly that many, the first one shorter where the number does not divide.
    A null or empty text is one piece that holds ``end`` alone. Rows without
    doc_id and repeated rows are packed like others. ``path`` and ``ranks``,
    see ``Encoder``, must be readable on every executor.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(path, ranks, capacity, end), "doc_id long, piece int, start long, length long, ids binary"
    )


def public_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, tuple[str, str]]:
    """``path`` and ``ranks`` of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), (public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, long ones first, whose sum comes closest to ``room`` from below.

    Bit s of a bitset says that the fill s can be reached with the lengths
    seen so far; it is kept for every length, longest first, so that the way
    back takes the longest lengths that reach the best fill.
    """
    lengths = [n for n in sorted(counts, reverse=True) if counts[n] and n <= room]
    mask, reach, stages = (1 << (room + 1)) - 1, 1, [1]
    used = []
    for n in lengths:
        left, part = min(counts[n], room // n), 1
        while left:  # copies in powers of two
            take = min(part, left)
            reach |= (reach << (take * n)) & mask
            left -= take
            part *= 2
        used.append(n)
        stages.append(reach)
        if reach >> room & 1:
            break
    fill, picked, k = reach.bit_length() - 1, [], len(used)
    while fill:
        while stages[k - 1] >> fill & 1:
            k -= 1
        n, copies = used[k - 1], 0
        while not stages[k - 1] >> fill & 1:
            fill -= n
            copies += 1
        picked += [n] * copies
        k -= 1
    return sorted(picked, reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many bins hold each.

    Each entry uses up some length or brings its count below what the entry
    takes of it, so there are no more than about capacity * (1 + ln capacity)
    entries for any corpus.
    """
    left = {n: c for n, c in counts.items() if c}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = [longest, *fullest(left, capacity - longest)]
        left[longest] += 1
        times = min(left[n] // combination.count(n) for n in set(combination))
        for n in set(combination):
            left[n] -= times * combination.count(n)
            if not left[n]:
                del left[n]
        out.append((combination, times))
    return out


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences of ``capacity`` as the plan finds.

    ``pieces`` needs doc_id, piece and length (1 to ``capacity``) and may carry
    more columns, of which ``sequence_id`` and ``offset`` are replaced; it is
    written once. Places within a sequence have no gaps.
    """
    spark = pieces.sparkSession
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces").select(F.struct("*").alias("row"))
    shard = F.pmod(F.xxhash64("row.doc_id", "row.piece"), F.lit(SHARDS))
    pieces = pieces.select("row", F.col("row.length").cast("long").alias("length"), shard.alias("shard"))
    sizes = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written(sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    within = Window.partitionBy("length", "shard").orderBy("row.doc_id", "row.piece")
    numbered = (
        pieces.withColumn("nth", F.row_number().over(within))
        .join(sizes.select("length", "shard", "before"), ["length", "shard"])
        .withColumn("number", F.col("before") + F.col("nth") - 1)
    )
    slots = spark.createDataFrame(
        _slots(plan(counts, capacity)), "length long, low long, high long, each long, first long, place long"
    )
    # at most a few entries a length and combination, whatever the corpus: the plan is bounded by the capacity
    placed = numbered.join(F.broadcast(slots), "length").where("number >= low and number < high")
    index = F.col("number") - F.col("low")
    return placed.select(
        "row.*",
        (F.col("first") + F.floor(index / F.col("each"))).alias("sequence_id"),
        (F.col("place") + F.pmod(index, F.col("each")) * F.col("length")).alias("offset"),
    )


def _slots(entries: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length of each combination, which numbers of that length go there."""
    out, taken, first = [], {}, 0
    for combination, times in entries:
        place = 0
        for n in sorted(set(combination), reverse=True):
            each = combination.count(n)
            at = taken.get(n, 0)
            out.append((n, at, at + each * times, each, first, place))
            taken[n] = at + each * times
            place += each * n
        first += times
    return out


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), *public_vocabulary())
    return pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
