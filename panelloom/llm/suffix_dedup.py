"""Passages that already stand in an earlier document, by merging sorted suffix runs.

A window of ``LENGTH`` bytes repeats when a document with a smaller doc_id has
it too. Suffixes are taken at anchors only (``anchors.py``): each stands for
the windows around it, and equal windows have equal anchors.

1. Documents are packed into chunks, written once.
2. Each chunk deals the hashes of its anchors' grams into buckets; a bucket
   answers which grams stand in several documents and which are so frequent in
   some chunk that they need splitting.
3. Each chunk takes the suffixes at its repeated anchors and sorts them into
   front-coded runs, dealt into buckets by the hash of their first bytes. What a
   smaller document of the same chunk covers whole is not sent, so copies
   collapse before the exchange. A frequent gram's windows are sent as suffixes
   of their own, dealt by the hash of all their bytes, so that one common line
   does not meet in one task.
4. Each bucket merges its runs by a loser tree over shared prefix lengths. From
   the merged order and its shared lengths follow, for each window, the
   smallest document that has it; covered bytes go back to their chunk.
5. Each chunk joins the spans and cuts them out.

What is exchanged goes in one blob for each partition, however many buckets the
partition has and whichever of a task's chunks it comes from; partitions follow
the bytes of the corpus. So the bytes sent are those of the suffixes, and the
number of blobs grows with tasks and partitions, not with chunks and buckets.

Nothing is sampled or capped; a 64-bit hash only chooses buckets and
candidates, and a wrong candidate is ruled out by the suffixes' bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import anchors, loser_tree
from panelloom.llm.anchors import GRAM, LENGTH
from panelloom.llm.registry import query, table
from panelloom.llm.shared import flat_bytes, trimmed, written

CHUNK = 8 << 20  # bytes of text
HOT = 32  # occurrences in one chunk above which a gram's windows are dealt one by one
BUCKET = 2 << 20  # bytes of text whose suffixes one bucket merges, in the mean
PARTITION = 16 << 20  # bytes of text whose suffixes one partition merges
LEAST_PARTITIONS = 64  # where the session allows as many
OUTBOX = 24 << 20  # bytes of runs that a task holds before it sends them
ROWS = 1 << 16  # suffixes laid out and sorted at once
_U = np.uint64
_BACK = LENGTH - GRAM


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob: their lengths, then the bytes of their values, planes apart."""
    sizes = np.array([len(x) for x in arrays], np.int64)
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b"" for x in (sizes, *arrays)]
    return zstandard.compress(b"".join(planes), 1)


def _unpacked(blob: bytes, kinds: list[type]) -> list[np.ndarray]:
    raw, out = np.frombuffer(zstandard.decompress(blob), np.uint8), []
    at = 8 * len(kinds)
    sizes = np.ascontiguousarray(raw[:at].reshape(8, -1).T).view(np.int64).ravel()
    for kind, n in zip(kinds, sizes):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


SPANS = [np.int64, np.int64, np.int64]  # text, start, stop


def _chunks(limit: int):
    def blob(held: list[pa.RecordBatch]) -> bytes:
        rows = pa.Table.from_batches(held).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        return sink.getvalue().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            place = batch.schema.get_field_index("text")
            text = batch.column("text").cast(pa.large_string()).cast(pa.large_binary())
            rows = batch.set_column(place, "text", text)
            _, starts = flat_bytes(rows.column("text"))
            a = 0
            while a < len(rows):
                b = int(np.searchsorted(starts, starts[a] + limit - size, "right")) - 1
                b = max(b, a if held else a + 1)
                if b > a:
                    held.append(rows.slice(a, b - a))
                    size += int(starts[b] - starts[a])
                if b < len(rows) or size >= limit:
                    yield pa.RecordBatch.from_pydict({"chunk": [made], "size": [size], "docs": [blob(held)]})
                    made, held, size = made + 1, [], 0
                a = b
        if held:
            yield pa.RecordBatch.from_pydict({"chunk": [made], "size": [size], "docs": [blob(held)]})

    return trimmed(run)


class _Chunk:
    """Documents of a chunk as flat bytes, with their anchors."""

    def __init__(self, blob: bytes, with_anchors: bool = True):
        with pa.ipc.open_stream(pa.BufferReader(blob)) as stream:
            self.rows = rows = stream.read_all().combine_chunks()
        self.ids = rows.column("doc_id")
        self.data, self.starts = flat_bytes(rows.column("text"))
        if not with_anchors:
            return
        self.padded = np.concatenate([np.zeros(_BACK, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        a = anchors.find(self.data, self.starts)
        if self.ids.null_count:  # documents without an id take no part
            known = ~np.asarray(self.ids.is_null())[a.text]
            a = anchors.Anchors(*(x[known] for x in (a.at, a.first, a.last, a.text, a.gram)))
        self.anchors = a
        self.doc = self.ids.combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)[a.text]


def _grams_of(chunk: _Chunk, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams, 0 in one document, 1 in several, 2 frequent; and each anchor's place among them."""
    gram, doc = chunk.anchors.gram, chunk.doc
    if not len(gram):
        return gram, np.zeros(0, np.uint8), np.zeros(0, np.int64)
    order = np.argsort(gram)
    g, d = gram[order], doc[order]
    begin = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    state = (np.minimum.reduceat(d, begin) != np.maximum.reduceat(d, begin)).astype(np.uint8)
    count = np.diff(np.append(begin, len(g)))
    state[(count > hot) & (state > 0)] = 2
    place = np.empty(len(g), np.int64)
    place[order] = np.repeat(np.arange(len(begin)), count)
    return g[begin], state, place


def _deal_grams(parts: int, hot: int):
    """A partition is one bucket of grams here: hashes are small, and are answered all at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("chunk").to_pylist(), batch.column("docs")):
                grams, state, _ = _grams_of(_Chunk(blob.as_buffer()), hot)
                cuts = np.searchsorted(_bucket(grams, parts), np.arange(parts + 1))
                full = np.flatnonzero(np.diff(cuts))
                own = [slice(cuts[k], cuts[k + 1]) for k in full]
                blobs = [_steps_packed(grams[mine]) + state[mine].tobytes() for mine in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array([number] * len(full), pa.int64()),
                        pa.array(np.diff(cuts)[full].astype(np.int32)),
                        pa.array([zstandard.compress(b, 1) for b in blobs], pa.binary()),
                    ],
                    names=["part", "chunk", "n", "grams"],
                )

    return trimmed(run)


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted hashes are dealt already."""
    return ((grams >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _steps_packed(grams: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte planes apart, so that they compress."""
    return np.diff(grams, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _steps_unpacked(raw: bytes, n: int) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


@trimmed
def _answer_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in batch.to_pylist()]
    if not rows:
        return
    grams, states = [], []
    for row in rows:
        raw = zstandard.decompress(row.pop("grams"))
        grams.append(_steps_unpacked(raw, row["n"]))
        states.append(np.frombuffer(raw, np.uint8, row["n"], 8 * row["n"]))
    every, place, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    state = np.zeros(len(every), np.uint8)
    np.maximum.at(state, place, np.concatenate(states))
    state = np.maximum(state, count > 1)[place]
    at, answers = 0, []
    for g in grams:
        answers.append(zstandard.compress(state[at : at + len(g)].tobytes(), 1))
        at += len(g)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r["chunk"] for r in rows], pa.int64()),
            pa.array([r["part"] for r in rows], pa.int32()),
            pa.array(answers, pa.binary()),
        ],
        names=["chunk", "part", "answer"],
    )


def _suffixes(chunk: _Chunk, at: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Rows of bytes: ``LENGTH`` for the text from ``at`` to ``stop``, then the text before ``at`` down to ``start``,
    read backwards. Where the text ahead is shorter, 0xFF fills up, which no UTF-8 text holds."""
    ahead, back = stop - at, at - start
    wide = np.lib.stride_tricks.sliding_window_view(chunk.padded, LENGTH + _BACK)
    around = wide[at]  # from _BACK bytes before the anchor on
    matrix = np.empty_like(around)
    matrix[:, :LENGTH] = around[:, _BACK:]
    matrix[:, LENGTH:] = around[:, _BACK - 1 :: -1]
    place = np.arange(LENGTH, dtype=np.uint8)
    matrix[:, :LENGTH] |= np.where(place < ahead.astype(np.uint8)[:, None], np.uint8(0), np.uint8(255))
    matrix[:, LENGTH:] *= place[:_BACK] < back.astype(np.uint8)[:, None]
    return matrix, ahead, back


def _order(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Order of rows as byte strings: by bytes, shorter first."""
    words = np.zeros((len(matrix), -(-matrix.shape[1] // 8) * 8), np.uint8)
    words[:, : matrix.shape[1]] = matrix
    keys = words.view(">u8").astype(np.uint64)
    return np.lexsort([lengths, *keys.T[::-1]])


# A run's columns, a value a suffix but for the bytes, and its directory: bucket, chunk, suffixes and bytes of each run.
RUNS = [np.uint8, np.uint8, np.uint8, np.uint8, np.int64, np.int32, np.int64, np.int64, np.int64, np.int32, np.int64]


class _Outbox:
    """Runs of any chunks and buckets, by the partition they go to."""

    def __init__(self, parts: int, per_part: int):
        self.parts, self.per_part = parts, per_part
        self.held: dict[int, list[tuple]] = {}
        self.size = 0

    def add(self, number: int, bucket: np.ndarray, windows: bool, known, more, rest, columns: list[np.ndarray]) -> None:
        """Sorted suffixes by ascending ``bucket``; buckets of single windows are numbered below zero."""
        ends = np.cumsum(more.astype(np.int64))
        begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        part = bucket[begin] // self.per_part
        for p in np.unique(part):
            mine = begin[part == p]
            a = int(mine[0])
            later = begin[part > p]
            b = int(later[0]) if len(later) else len(bucket)
            n = np.diff(np.append(mine, b))
            low = int(ends[a - 1]) if a else 0
            size = np.diff(np.r_[low, ends[np.append(mine[1:], b) - 1]])
            name = -1 - bucket[mine] if windows else bucket[mine]
            run = (known[a:b], more[a:b], rest[low : ends[b - 1]], *(c[a:b] for c in columns), name, np.full(len(mine), number), n.astype(np.int32), size)
            self.held.setdefault(int(p), []).append(run)
            self.size += sum(x.nbytes for x in run)

    def sent(self) -> pa.RecordBatch:
        parts = sorted(self.held)
        blobs = [_packed(*(np.concatenate(c).astype(k) for c, k in zip(zip(*self.held[p]), RUNS))) for p in parts]
        self.held, self.size = {}, 0
        return _blob_rows([(p, None, b) for p, b in zip(parts, blobs)])


def _deal_suffixes(parts: int, buckets: int, hot: int, outbox: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(parts, buckets // parts)
        for batch in batches:
            for number, docs, answers in zip(
                batch.column("chunk").to_pylist(), batch.column("docs"), batch.column("answers").to_pylist()
            ):
                chunk = _Chunk(docs.as_buffer())
                grams, _, place = _grams_of(chunk, hot)
                state = np.zeros(len(grams), np.uint8)
                cuts = np.searchsorted(_bucket(grams, parts), np.arange(parts + 1))
                for reply in answers or []:
                    k = reply["part"]
                    state[cuts[k] : cuts[k + 1]] = np.frombuffer(zstandard.decompress(reply["answer"]), np.uint8)
                state = state[place]
                a = chunk.anchors
                spans = []
                some = np.flatnonzero(state == 1)
                key = _bucket(a.gram[some], buckets)
                # laid out in ranges of buckets, so a bucket gets one run and equal suffixes stay together
                share = key * -(-len(some) // ROWS) // buckets
                for p in np.unique(share):
                    own, k = some[share == p], key[share == p]
                    _runs(box, chunk, number, own, a.at[own], a.first[own], a.last[own] + LENGTH, spans, k, False)
                often = np.flatnonzero(state == 2)
                size = a.last[often] - a.first[often] + 1
                which = np.repeat(often, size)
                window = a.first[which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                key = _bucket(_window_hashes(chunk.data, window), buckets)
                share = key * -(-len(which) // ROWS) // buckets
                for p in np.unique(share):
                    w, own, k = window[share == p], which[share == p], key[share == p]
                    _runs(box, chunk, number, own, w, w, w + LENGTH, spans, k, True)
                if spans:
                    text, start, stop = (np.concatenate(x) for x in zip(*spans))
                    yield _blob_rows([(number % parts, number, _packed(*_joined(text, start, stop)))])
                if box.size >= outbox:
                    yield box.sent()
        if box.held:
            yield box.sent()

    return trimmed(run)


def _blob_rows(rows: list[tuple[int, int | None, bytes]]) -> pa.RecordBatch:
    """Rows of (part, chunk, blob): spans of a chunk, or runs where there is no chunk."""
    part, chunk, blob = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(chunk, pa.int64()), pa.array(blob, pa.binary())], names=["part", "chunk", "blob"])


def _joined(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of texts, overlapping and touching ones made one."""
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], stop[order]
    text, start, stop = (x.astype(np.int64) for x in (text, start, stop))
    if not len(text):
        return text, start, stop
    shift = text << 40
    reach = np.maximum.accumulate(stop + shift)
    fresh = np.r_[True, start[1:] + shift[1:] > reach[:-1]]
    begin = np.flatnonzero(fresh)
    return text[begin], start[begin], np.maximum.reduceat(stop, begin)


def _runs(box: _Outbox, chunk: _Chunk, number: int, own, at, start, stop, spans, key, windows: bool) -> None:
    """Sorted, front-coded runs of suffixes, one for each bucket in ``key``, put in ``box``; what the chunk itself covers goes to ``spans``.

    Suffixes of the same bytes and the same anchor place are one; those of
    documents above the smallest are covered and not sent.
    """
    a = chunk.anchors
    matrix, ahead, back = _suffixes(chunk, at, start, stop)
    lengths = LENGTH + back
    doc = chunk.doc[own]
    order = _order(matrix, lengths)
    m, n, d = matrix[order], lengths[order], doc[order]
    known = loser_tree.shared_prefixes(m, n)
    same = np.zeros(len(m), bool)
    same[1:] = (known[1:] == n[1:]) & (n[1:] == n[:-1])
    # equal bytes may be cut differently into ahead and back; only equal cuts are equal suffixes
    group = np.cumsum(~same)
    cut = ahead[order]
    inner = np.lexsort((d, cut, group))
    order, m, n, d, cut, group = order[inner], m[inner], n[inner], d[inner], cut[inner], group[inner]
    fresh = np.r_[True, (group[1:] != group[:-1]) | (cut[1:] != cut[:-1])]
    low = d[np.maximum.accumulate(np.where(fresh, np.arange(len(d)), 0))]
    covered = d > low
    if covered.any():
        c = order[covered]
        text = a.text[own[c]]
        spans.append((text, start[c] - chunk.starts[text], stop[c] - chunk.starts[text]))
    keep = ~covered
    order, m, n = order[keep], m[keep], n[keep]
    bucket = key[order]
    deal = np.argsort(bucket, kind="stable")
    order, bucket, m, n = order[deal], bucket[deal], m[deal], n[deal]
    known = loser_tree.shared_prefixes(m, n)
    known[np.r_[True, bucket[1:] != bucket[:-1]]] = 0  # a bucket's run starts with a whole string
    place = np.arange(m.shape[1])
    rest = m[(place >= known[:, None]) & (place < n[:, None])]
    text = a.text[own[order]]
    columns = [ahead[order].astype(np.uint8), chunk.doc[own[order]], text.astype(np.int32), (at[order] - chunk.starts[text]).astype(np.int64)]
    box.add(number, bucket, windows, known.astype(np.uint8), (n - known).astype(np.uint8), rest, columns)


def _window_hashes(data: np.ndarray, window: np.ndarray) -> np.ndarray:
    """A hash of the ``LENGTH`` bytes from each place of ``window`` on."""
    out = np.zeros(len(window), np.uint64)
    part = window // anchors.PART
    for p in np.unique(part):
        mine, low = part == p, int(p) * anchors.PART
        out[mine] = anchors.rolling(data[low : low + anchors.PART + LENGTH], LENGTH)[window[mine] - low]
    return out


class _Inbox:
    """The runs of one blob, found by bucket."""

    def __init__(self, blob: bytes):
        known, more, rest, ahead, doc, text, at, bucket, chunk, n, size = _unpacked(blob, RUNS)
        self.columns = known, more, rest, ahead, doc, text, at
        self.bucket, self.chunk = bucket, chunk
        self.rows, self.bytes = np.r_[0, np.cumsum(n, dtype=np.int64)], np.r_[0, np.cumsum(size)]

    def run(self, k: int):
        known, more, rest, ahead, doc, text, at = self.columns
        a, b = self.rows[k], self.rows[k + 1]
        strings = loser_tree.decode(known[a:b].tobytes(), more[a:b].tobytes(), rest[self.bytes[k] : self.bytes[k + 1]].tobytes())
        return strings, (ahead[a:b], doc[a:b], text[a:b], at[a:b]), int(self.chunk[k])


@trimmed
def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    boxes, spans = [], {}
    for batch in batches:
        for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist()):
            if chunk is None:
                boxes.append(_Inbox(blob))
            else:  # what a chunk found by itself
                spans.setdefault(chunk, []).append(tuple(_unpacked(blob, SPANS)))
    if boxes:
        bucket = np.concatenate([b.bucket for b in boxes])
        box = np.repeat(np.arange(len(boxes)), [len(b.bucket) for b in boxes])
        place = np.concatenate([np.arange(len(b.bucket)) for b in boxes])
        order = np.argsort(bucket, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            runs = [boxes[box[i]].run(place[i]) for i in mine]
            for chunk, found in _covered(runs, bool(bucket[mine[0]] < 0)):
                spans.setdefault(chunk, []).append(found)
    for chunk, found in spans.items():
        yield _blob_rows([(0, chunk, _packed(*_joined(*(np.concatenate(x) for x in zip(*found)))))])


def _covered(found: list[tuple], windows: bool) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Spans by chunk of one bucket's merged runs."""
    runs = [strings for strings, _, _ in found]
    columns = [(*values, np.full(len(values[0]), number)) for number, (_, values, _) in enumerate(found)]
    from_run, shared = loser_tree.merge(runs)
    source = np.array(from_run)
    shared = np.array(shared, np.int64)
    order = np.empty(len(source), np.int64)
    by_run = np.argsort(source, kind="stable")
    order[by_run] = np.arange(len(source))  # the k-th string taken from a run is its k-th
    ahead, doc, text, at, run = (np.concatenate(x)[order] for x in zip(*columns))
    length = np.array([len(s) for r in runs for s in r[0]])[order]
    if windows:
        group = np.cumsum(shared < LENGTH)
        low = np.minimum.reduceat(doc, np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))[group - group[0]]
        hit = doc > low
        where, start, stop = np.flatnonzero(hit), at[hit], at[hit] + LENGTH
    else:
        where, start, stop = _anchored(runs, order, shared, ahead.astype(np.int64), length, doc, at)
    for r in np.unique(run[where]):
        m = run[where] == r
        yield found[r][2], _joined(text[where[m]], start[m], stop[m])


def _anchored(runs, order, shared, ahead, length, doc, at):
    """Spans of windows that a smaller document has, from suffixes in merged order.

    A window that starts ``o`` bytes before the anchor is equal for two
    suffixes when they share ``LENGTH - o`` bytes ahead and ``o`` bytes back.
    Neighbours in the merged order tell the first; the second is read off an
    order by the bytes back, taken only inside groups that differ.
    """
    back = length - LENGTH
    ahead_shared = np.minimum(shared, np.minimum(ahead, np.r_[0, ahead[:-1]]))
    group = np.cumsum(ahead_shared < GRAM) - 1
    same = np.r_[False, (shared[1:] == length[1:]) & (length[1:] == length[:-1]) & (ahead[1:] == ahead[:-1])]
    n_groups = group[-1] + 1
    low = np.full(n_groups, np.iinfo(np.int64).max)
    np.minimum.at(low, group, doc)
    high = np.full(n_groups, np.iinfo(np.int64).min)
    np.maximum.at(high, group, doc)
    plain = np.bincount(group, ~same, n_groups) == 1
    whole = plain[group] & (doc > low[group])
    picked = np.flatnonzero(whole)
    parts = [(picked, at[picked] - back[picked], at[picked] + ahead[picked])]
    mixed = np.flatnonzero(~plain[group] & (high > low)[group])
    if len(mixed):
        parts.append(_windows(runs, order, mixed, group, shared, ahead, back, doc, at))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _windows(runs, order, rows, group, shared, ahead, back, doc, at):
    strings = [s for r in runs for s in r[0]]
    n = len(rows)
    tail = np.zeros((n, _BACK + 8), np.uint8)
    for i, r in enumerate(rows):
        s = strings[order[r]][LENGTH:]
        tail[i, : len(s)] = np.frombuffer(s, np.uint8)
    ahead_r, back_r, doc_r, group_r = ahead[rows], back[rows], doc[rows], group[rows]
    # rows of a group stand together, so neighbours here are neighbours in the merged order
    link = np.minimum(shared[rows], np.minimum(ahead_r, np.r_[0, ahead_r[:-1]]))
    link[np.r_[True, group_r[1:] != group_r[:-1]]] = -1
    keys = np.ascontiguousarray(tail[:, : -(-_BACK // 8) * 8]).view(">u8").astype(np.uint64)
    by_back = np.lexsort([back_r, *keys.T[::-1], group_r])
    back_link = loser_tree.shared_prefixes(tail[by_back], back_r[by_back])
    g = group_r[by_back]
    back_link[np.r_[True, g[1:] != g[:-1]]] = -1
    where, offset = [], []
    for o in range(_BACK + 1):
        front = np.cumsum(link < LENGTH - o)
        behind = np.empty(n, np.int64)
        behind[by_back] = np.cumsum(back_link < o)
        use = np.flatnonzero((back_r >= o) & (ahead_r >= LENGTH - o))
        if not len(use):
            continue
        pair = np.lexsort((doc_r[use], behind[use], front[use]))
        use = use[pair]
        fresh = np.r_[True, (front[use][1:] != front[use][:-1]) | (behind[use][1:] != behind[use][:-1])]
        low = doc_r[use][np.maximum.accumulate(np.where(fresh, np.arange(len(use)), 0))]
        hit = use[doc_r[use] > low]
        where.append(hit)
        offset.append(np.full(len(hit), o))
    where, offset = np.concatenate(where), np.concatenate(offset)
    start = at[rows[where]] - offset
    return rows[where], start, start + LENGTH


@trimmed
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        for docs, blobs in zip(batch.column("docs"), batch.column("blobs").to_pylist()):
            chunk = _Chunk(docs.as_buffer(), with_anchors=False)
            parts = [_unpacked(b, SPANS) for b in blobs or []]
            empty = np.zeros(0, np.int64)
            text, start, stop = (np.concatenate(x) for x in zip(*parts)) if parts else (empty, empty, empty)
            text, start, stop = _joined(text, start, stop)
            data = chunk.data.tobytes()
            cuts = np.searchsorted(text, np.arange(len(chunk.ids) + 1))
            for lo in range(0, len(chunk.ids), 1000):
                hi = min(lo + 1000, len(chunk.ids))
                kept, spans = [], []
                for i in range(lo, hi):
                    own = data[chunk.starts[i] : chunk.starts[i + 1]]
                    mine = [(int(start[k]), int(stop[k])) for k in range(cuts[i], cuts[i + 1])]
                    left, at = [], 0
                    for s, e in mine:
                        left.append(own[at:s])
                        at = e
                    kept.append(b"".join([*left, own[at:]]))
                    spans.append([{"start": s, "stop": e} for s, e in mine])
                own = chunk.rows.drop_columns(["text"]).slice(lo, hi - lo).combine_chunks()
                own = own.append_column("n_bytes", pa.array(np.diff(chunk.starts)[lo:hi]))
                own = own.append_column("spans", pa.array(spans, pairs))
                yield from own.append_column("kept", pa.array(kept, pa.binary())).to_batches()


def _dealing(spark: SparkSession, chunks: DataFrame) -> tuple[int, int]:
    """Numbers of partitions and buckets for the text in ``chunks``; each partition has the same number of buckets."""
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), LEAST_PARTITIONS)
    parts = max(-(-size // PARTITION), least, 1)
    return parts, parts * max(-(-size // (BUCKET * parts)), 1)


def cut_repeats(docs: DataFrame, chunk_bytes: int = CHUNK, hot: int = HOT, outbox: int = OUTBOX) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_bytes, spans and kept in the place of text.

    ``spans`` are the maximal runs of bytes, as [start, stop), that lie in
    some 50-byte string which also starts in a document with a smaller doc_id;
    ``kept`` is the text without them, as bytes. A null text is empty. Rows
    without doc_id stay whole and remove nothing; rows that repeat a doc_id
    remove nothing from each other. Further columns pass through, but
    ``n_bytes``, ``spans`` and ``kept`` are replaced.
    """
    docs = docs.drop("n_bytes", "spans", "kept")
    chunks = written(docs.mapInArrow(_chunks(chunk_bytes), "chunk long, size long, docs binary"), "chunks")
    parts, buckets = _dealing(docs.sparkSession, chunks)
    chunks = chunks.drop("size")
    answers = (
        chunks.mapInArrow(_deal_grams(parts, hot), "part int, chunk long, n int, grams binary")
        .repartitionById(parts, "part")
        .mapInArrow(_answer_grams, "chunk long, part int, answer binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
    )
    spans = (
        chunks.join(answers, "chunk", "left")
        .mapInArrow(_deal_suffixes(parts, buckets, hot, outbox), "part int, chunk long, blob binary")
        .repartitionById(parts, "part")
        .mapInArrow(_merge_runs, "part int, chunk long, blob binary")
        .groupBy("chunk")
        .agg(F.collect_list("blob").alias("blobs"))
    )
    schema = T.StructType([f for f in docs.schema.fields if f.name != "text"]).add("n_bytes", "long")
    span = T.StructType().add("start", "long").add("stop", "long")
    schema = schema.add("spans", T.ArrayType(span)).add("kept", "binary")
    return chunks.join(spans, "chunk", "left").mapInArrow(_cut, schema)


@trimmed
def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [b.as_py().decode("utf-8", "ignore") for b in batch.column("kept")]
        place = batch.schema.get_field_index("kept")
        yield batch.set_column(place, "kept", pa.array(text, pa.string()))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; characters cut in part go whole.

    A null text becomes empty; all other columns stay.
    """
    names = docs.columns
    rest = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in names if c not in ("doc_id", "text")])
    left = cut_repeats(docs.select("doc_id", "text", rest.alias("rest"))).select("doc_id", "rest", "kept")
    fields = [T.StructField("kept", T.StringType()) if f.name == "kept" else f for f in left.schema.fields]
    found = left.mapInArrow(_decoded, T.StructType(fields))
    place = {"doc_id": "doc_id", "text": "kept"}
    return found.select(*[F.col(place.get(c, f"rest.`{c}`")).alias(c) for c in names])


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
