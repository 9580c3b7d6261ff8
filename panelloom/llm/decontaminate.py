"""Benchmark decontamination by a broadcast set of hashed word blocks.

A window of w consecutive benchmark words that occurs in a document covers one
of the document's aligned blocks of (w + 1) // 2 words, wherever it starts. So
a scan hashes one block in that many words, looks it up among the hashes of
all blocks inside benchmark windows, and carries the words around a block
along. Only matching blocks go on: the windows around them are compared word
by word with the benchmark's. The corpus itself is never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.registry import query, table
from panelloom.llm.shared import written

WINDOW = 10
BROADCAST_BYTES = 256 << 20  # measured size of benchmark blocks or windows up to which a side is broadcast; more are shuffled
ROW_BYTES = 100  # of a hashed row beside its texts
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | Column) -> Column:
    """Words of a text with A-Z as a-z; a null text has none.

    Cutting at the gaps takes an eighth of the time of matching the words.
    """
    text = F.col(text) if isinstance(text, str) else text
    return _between_gaps(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER))


def _between_gaps(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def _up_to(n: Column) -> Column:
    """0, 1, ..., n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _key(words: Column, start: Column, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words_n, key, item_ids): every distinct window and the items that have it.

    An item of fewer than ``window`` words, but not none, is one window.
    """
    items = benchmark.select("item_id", words_of("text").alias("words")).withColumn("n", F.size("words"))
    items = items.where("n > 0").withColumn("words_n", F.least("n", F.lit(window)))
    starts = F.explode(_up_to(F.col("n") - F.col("words_n") + 1))
    return (
        items.withColumn("start", starts)
        .select("item_id", "words_n", _key(F.col("words"), F.col("start"), F.col("words_n")).alias("key"))
        .groupBy("words_n", "key")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )


def _small(df: DataFrame, size: int) -> DataFrame:
    """``df`` with a broadcast hint where its measured bytes allow one."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, runs, item_ids) for every row of ``docs`` (doc_id, text).

    ``runs`` are the maximal runs [start, stop) of words inside an occurrence
    of a benchmark window, ``item_ids`` the items with an occurring window,
    ``text_key`` is xxhash64(text). A null or empty text has no words and no
    runs; a null benchmark text has no windows; the words of an item without
    item_id count, but it is not listed. Every row is judged by its text
    alone, so repeated rows and rows without doc_id have the same results as
    any other. An empty benchmark hits nothing. Further columns are ignored.
    """
    windows = written(benchmark_windows(benchmark, window), "windows")
    ids = F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ",")
    texts = F.sum(F.octet_length("key") + F.coalesce(F.octet_length(ids), F.lit(0)))
    # one row for each length up to the window
    counts = windows.groupBy("words_n").agg(F.count("*").alias("n"), texts.alias("bytes")).collect()
    lengths = sorted(r["words_n"] for r in counts)
    n_windows, n_bytes = sum(r["n"] for r in counts), sum(r["bytes"] for r in counts)
    blocks = {length: (length + 1) // 2 for length in lengths}
    reach = max([n - b for n, b in blocks.items()], default=0)

    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of("text").alias("words"))
    docs = docs.withColumn("n_words", F.size("words"))

    def blocks_of(size: int) -> Column:
        def block(k: Column) -> Column:
            at = k * size
            first = F.greatest(at - reach, F.lit(0))
            return F.struct(
                F.lit(size).alias("size"),
                at.alias("at"),
                first.alias("first"),
                F.xxhash64(F.slice(F.col("words"), at + 1, size)).alias("hash"),
                _key(F.col("words"), first, at - first + size + reach).alias("around"),
            )

        return F.transform(_up_to(F.floor(F.col("n_words") / size).cast("int")), block)

    sizes = sorted(set(blocks.values()))
    if sizes:
        parts = reduce(F.concat, [blocks_of(size) for size in sizes])
        scanned = docs.select("doc_id", "text_key", "n_words", F.posexplode_outer(parts).alias("nth", "block"))
        wanted = reduce(DataFrame.unionByName, [_blocks_inside(windows, n, b) for n, b in blocks.items()]).distinct()
        wanted = _small(wanted, n_windows * (reach + 1) * ROW_BYTES)
        scanned = (
            scanned.select("*", F.col("block.size").alias("size"), F.col("block.hash").alias("hash"))
            .join(wanted.withColumn("hit", F.lit(True)), ["size", "hash"], "left")
            .where("hit or coalesce(nth, 0) = 0")
            .select("doc_id", "text_key", "n_words", F.coalesce("nth", F.lit(0)).alias("nth"), "hit", "block")
        )
    else:
        scanned = docs.select(
            "doc_id",
            "text_key",
            "n_words",
            F.lit(0).alias("nth"),
            F.lit(False).alias("hit"),
            F.lit(None).cast("struct<size:int,at:int,first:int,hash:bigint,around:string>").alias("block"),
        )
    scanned = written(scanned, "scanned")
    found = _verified(scanned.where("hit"), _small(windows, n_windows * ROW_BYTES + n_bytes), blocks)
    every = scanned.where("nth = 0").select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"))
    same = every.doc_id.eqNullSafe(found.hit_id) & (every.text_key == found.hit_key)
    return every.join(found, same, "left").select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("runs", F.array().cast("array<struct<start:int,stop:int>>")).alias("runs"),
        F.coalesce("item_ids", F.array().cast(windows.schema["item_ids"].dataType)).alias("item_ids"),
    )


def _blocks_inside(windows: DataFrame, length: int, size: int) -> DataFrame:
    words = F.split("key", " ")
    inside = F.transform(_up_to(F.lit(length - size + 1)), lambda o: F.xxhash64(F.slice(words, o + 1, size)))
    return windows.where(F.col("words_n") == length).select(
        F.lit(size).alias("size"), F.explode(inside).alias("hash")
    )


def _verified(hits: DataFrame, windows: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """(hit_id, hit_key, runs, item_ids) of documents in which whole windows occur."""
    around = F.split("block.around", " ")
    at, first, n = F.col("block.at"), F.col("block.first"), F.col("n_words")

    def windows_over(length: int, size: int) -> Column:
        low = F.greatest(at - (length - size), F.lit(0))
        starts = _up_to(F.least(at, n - length) - low + 1)
        made = F.transform(
            starts,
            lambda s: F.struct(
                (low + s).alias("start"),
                F.lit(length).alias("words_n"),
                _key(around, low + s - first, length).alias("key"),
            ),
        )
        return F.when(F.col("block.size") == size, made).otherwise(F.slice(made, 1, 0))

    empty = F.array().cast("array<struct<start:int,words_n:int,key:string>>")
    over = reduce(F.concat, [windows_over(length, size) for length, size in blocks.items()], empty)
    pairs = hits.select("doc_id", "text_key", F.explode(over).alias("w")).select("doc_id", "text_key", "w.*")
    occurring = pairs.join(windows, ["words_n", "key"])
    zero = F.array().cast("array<struct<start:int,stop:int>>")

    def join_runs(done: Column, hit: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], hit["stop"]).alias("stop"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= hit["start"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(hit))
        )

    ranges = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("words_n")).alias("stop"))))
    return (
        occurring.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"))
        .agg(ranges.alias("ranges"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids"))
        .select("hit_id", "hit_key", F.aggregate("ranges", zero, join_runs).alias("runs"), "item_ids")
    )


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with hit words cut out of their texts, each with the separators after it.

    Other texts, null ones included, stay as they are, and so do all further
    columns. A text whose every word is hit keeps what stood before its first
    word.
    """
    names = docs.columns
    found = contamination(docs, benchmark, window).where(F.size("runs") > 0)
    found = found.select(F.col("doc_id").alias("hit_id"), "text_key", "runs").dropDuplicates(["hit_id", "text_key"])
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row.text")
    # gap i stands before word i; both lists are made once and gone through together
    words = F.concat(F.array(F.lit("")), _between_gaps(text))
    pairs = F.arrays_zip(words.alias("word"), F.split(text, ANY_CASE_WORD).alias("gap"))

    def part(pair: Column, i: Column) -> Column:
        hit = F.exists("runs", lambda r: (i > r["start"]) & (i <= r["stop"]))
        return F.when(hit, "").otherwise(F.concat(pair["word"], pair["gap"]))

    clean = F.array_join(F.transform(pairs, part), "")
    same = F.col("row.doc_id").eqNullSafe(found.hit_id) & (F.xxhash64(text) == found.text_key)
    new = F.when(F.col("runs").isNull(), text).otherwise(clean).alias("text")
    return rows.join(found, same, "left").select(*[new if c == "text" else F.col(f"row.`{c}`") for c in names])


_SQL = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') ws from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') ws from benchmark
), bw as (
  select distinct item_id, least(len(ws), {WINDOW}) n, array_to_string(list_slice(ws, s, s + least(len(ws), {WINDOW}) - 1), ' ') k
  from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) s from b where len(ws) > 0)
), lengths as (select distinct n from bw
), dw as (
  select doc_id, s, n, array_to_string(list_slice(ws, s, s + n - 1), ' ') k
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) s from d, lengths where len(ws) >= n)
), h as (select doc_id, s, n, item_id from dw join bw using (n, k)
), w as (
  select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from h) group by doc_id
), i as (
  select doc_id, count(distinct item_id) n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') items from h group by doc_id
)
select doc_id, cast(len(ws) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join w using (doc_id) left join i using (doc_id)
"""


@query("op2_benchmark_decontamination", _SQL)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
