"""Language identification by compression.

Each language is a zstandard raw-content dictionary made of short pieces of
training texts. A text belongs to the language whose dictionary compresses it
best; where the first two are close, further dictionaries of each language
are asked and sizes are added up. A text whose margin stays narrow is
rejected. Pieces are short so that a passage that stands in many documents
cannot decide by one long match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed

DOCS_PER_LANGUAGE = 4_000  # pieces a language, at most in expectation; the bound of the fit
PIECE = 80  # characters of a piece; one a document, at a place that its doc_id decides, or several where documents are few
DICTIONARIES = 8
MOST_LANGUAGES = 256  # of the training; each keeps its dictionaries in every task
LEVEL = 6
CLOSE = 12  # bytes of margin below which further dictionaries are asked
REJECT = 10  # bytes of margin a KB of compressed size below which a text is rejected, a tie at any size
SATURATED = 4_000  # compressed bytes a dictionary from which margins hardly grow; a longer text needs no wider one
UNKNOWN = "und"

_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """Lower-case letters of a text with single blanks for everything between them."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_SPACED).split())


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


Model = list[tuple[str, list[bytes]]]


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Dictionaries of each language in ``docs`` (doc_id, text, lang), frequent languages first.

    About ``per_language`` pieces of each language are taken by the hash of
    their doc_id, so what reaches the driver is bounded by the number of
    languages, which may be ``MOST_LANGUAGES``; more raise. A language of fewer documents gives several pieces of each, as
    evenly as their lengths allow, until there are as many or no text is left.
    Rows without lang, text or doc_id teach nothing.
    """
    docs = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")
    pieces = F.greatest(F.ceil(F.length("text") / PIECE), F.lit(1))
    steps = [1 << k for k in range(max(per_language, 1).bit_length() + 1)]
    sums = [F.sum(F.least(pieces, F.lit(n))).alias(f"n{n}") for n in steps]
    counts = {r["lang"]: [r[f"n{n}"] for n in steps] for r in docs.groupBy("lang").agg(*sums).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values of lang; a model keeps dictionaries of each")
    languages = sorted(counts, key=lambda name: (-counts[name][0], name))
    if not languages:
        return []
    # the fewest pieces a document by which a language fills its share, or all there are
    each = {name: next((k for k, n in enumerate(counts[name]) if n >= per_language), len(steps) - 1) for name in languages}
    named = lambda f: F.try_element_at(F.create_map(*[F.lit(x) for name in languages for x in (name, f(name))]), F.col("lang"))
    most, share = named(lambda name: steps[each[name]]), named(lambda name: min(1.0, per_language / counts[name][each[name]]))
    docs = docs.withColumns({"most": most, "share": share, "nth": F.explode(F.sequence(F.lit(0).cast("long"), F.least(pieces, most) - 1))})
    single = F.col("most") == 1
    spot = F.pmod(F.when(single, F.xxhash64("doc_id")).otherwise(F.xxhash64("doc_id", "nth")), F.lit(1_000_000)) / 1_000_000
    place = F.xxhash64("doc_id", F.lit(1))
    start = F.when(single, F.pmod(place, F.greatest(F.length("text") - PIECE, F.lit(1))))
    start = start.otherwise(F.pmod(F.pmod(place, pieces) + F.col("nth"), pieces) * PIECE)
    piece = F.substr(F.col("text"), (start + 1).cast("int"), F.lit(PIECE))
    rows = docs.where(spot < F.col("share")).select("lang", "doc_id", piece.alias("piece"))
    rows = rows.groupBy("lang").agg(F.array_sort(F.collect_set(F.struct(F.xxhash64("doc_id", F.lit(2)), "piece"))).alias("pieces"))
    found = {r["lang"]: [plain(p["piece"]) for p in r["pieces"]] for r in rows.collect()}
    model = []
    for name in languages:
        pieces = [p for p in found.get(name, []) if p]
        model.append((name, [b" ".join(pieces[k::DICTIONARIES]) for k in range(DICTIONARIES)]))
    return model


class Judge:
    def __init__(self, model: Model):
        self.names = [name for name, _ in model]
        self.coders = [[self._coder(d) for d in parts] for _, parts in model]

    @staticmethod
    def _coder(content: bytes) -> zstandard.ZstdCompressor:
        options = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}
        if len(content) < 8:  # too short for a dictionary
            return zstandard.ZstdCompressor(level=LEVEL, **options)
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **options)

    def judge(self, text: str | None) -> tuple[str, float, int, bool]:
        """Language, score, margin in bytes over the dictionaries asked, and whether that is too narrow; ties go to the more frequent language."""
        if not self.names or text is None or not has_letter(text):
            return UNKNOWN, 0.0, 0, True
        data = plain(text)
        sizes = [len(own[0].compress(data)) for own in self.coders]
        asked = 1
        best, second = self._first_two(sizes)
        if len(sizes) > 1 and second - best < CLOSE:
            sizes = [n + sum(len(c.compress(data)) for c in own[1:]) for n, own in zip(sizes, self.coders)]
            asked = DICTIONARIES
            best, second = self._first_two(sizes)
        scale = max(2.0, 0.02 * best / asked) * asked
        weights = [math.exp((best - n) / scale) for n in sizes]
        margin = second - best
        return self.names[sizes.index(best)], 1 / sum(weights), margin, 1000 * margin < REJECT * min(best, SATURATED * asked)

    @staticmethod
    def _first_two(sizes: list[int]) -> tuple[int, int]:
        first, second = (sorted(sizes) + [sizes[0] + 1_000_000])[:2]
        return first, second


def _judged(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            found = [judge.judge(t.as_py()) for t in batch.column("text")]
            lang, score, margin, rejected = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in batch.schema.names),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(margin, pa.int64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=[*batch.schema.names, "lang_pred", "score", "margin", "rejected"],
            )

    return trimmed(run)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score, margin and rejected; only ``text`` is looked at.

    A null text or one without a letter is ``und`` with score 0 and rejected,
    as is every text when the model has no language. A text whose margin is
    below ``REJECT`` for its compressed size is rejected; lang_pred then names
    the best, the most frequent of those that tie. Rows are judged one by one, repeated rows alike; further columns pass through, but
    columns of the four new names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "margin", "rejected")
    schema = T.StructType([*docs.schema.fields])
    schema = schema.add("lang_pred", "string").add("score", "double").add("margin", "long").add("rejected", "boolean")
    return docs.mapInArrow(_judged(model), schema)


def crc_of_id(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


@query("op8_compression_language_id")
def op8_compression_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(4) == 2
    judged = identify(docs.select("doc_id", "text"), fit(docs.where(~held_out)))
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")
