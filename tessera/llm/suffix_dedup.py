"""Removal of repeated passages by a distributed merge sort of suffixes.

Every byte covered by a ``WINDOW`` = 100-byte string that also starts earlier
(smaller id, or same document and earlier start) is removed.

Sampled suffixes.  In each window the 32-byte string of least hash is its
anchor, so equal windows have equal anchors at the same place.  The windows of
one anchor form an element: the suffix from the anchor to the end of its last
window, then the bytes before the anchor in reverse.  Windows are equal only
within elements that share the first 32 bytes.

1. Documents are packed into blocks (compressed, written once) with anchors.
2. Anchor hashes of all blocks meet by hash range; a code comes back to each
   block: occurs once, repeats, or repeats in very many contexts.
3. Each block sorts its repeating elements into a run, front-codes it, and
   cuts it at common splitters.
4. Each range merges its runs with a loser tree over common prefixes.  Equal
   elements fall together; within a 32-byte group the windows of the different
   elements are compared.  Anchors with very many contexts are dealt window by
   window instead, by the window's 128-bit hash, so that no group meets in one
   task.
5. The later windows come back to their blocks, where the bytes are cut.

A task holds one block, or one range of about ``RANGE_BYTES`` of text, at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .blocks import NOTE_SCHEMA, PART_SCHEMA, dicts, first_block_number, range_edges, rows_of, with_notes
from .common import written
from .front_coding import Run, encode, merge

WINDOW, GRAM = 100, 32
SPAN = WINDOW - GRAM  # the anchor lies this far into a window at most
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 16 << 20
CHUNK = 900_000  # places hashed at a time; with a window more it fits in PLACE bits
PLACE = np.uint64((1 << 20) - 1)
HOT_CONTEXTS = 4096
#: The same for an anchor with more entries than this, also where all are alike:
#: a passage that stands in every block.
HOT_ENTRIES = 1 << 16
#: Anchors that the driver takes splitters from, at most about.
SPLIT_SAMPLE = 1 << 20
MARK_BITS = np.uint64(16)
SAMPLES, PREFIX = 64, 16

_rng = np.random.default_rng(2024)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [np.uint64(int(x) | 1) for x in _rng.integers(1, 1 << 63, 8)]
_BASE = int(_STEP[5])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _STEP[6]
    x ^= x >> np.uint64(31)
    x *= _STEP[7]
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, first window, last window)`` of every element of documents
    laid end to end; windows lie inside one document."""
    found = []
    starts = np.concatenate([[0], ends[:-1]])
    for at in range(0, max(0, len(data) - WINDOW + 1), CHUNK):
        n = min(CHUNK, len(data) - WINDOW + 1 - at)  # windows that start here
        h = _BYTE[data[at:at + n + WINDOW - 1]]
        size = 1
        for step in _STEP[:5]:
            h = h[:-size] * step + h[size:]
            size *= 2
        h = (_mix(h) & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= SPAN + 1:
            h = np.minimum(h[:-size], h[size:])
            size *= 2
        rest = SPAN + 1 - size
        h = np.minimum(h[:-rest], h[rest:]) if rest else h
        place = (h[:n] & PLACE).astype(np.int64) + at
        # windows that do not end in the document they start in
        inside = np.zeros(n + 1, np.int32)
        first = np.clip(starts - at, 0, n)
        last = np.clip(ends - WINDOW + 1 - at, 0, n)
        ok = last > first
        np.add.at(inside, first[ok], 1)
        np.add.at(inside, last[ok], -1)
        inside = np.cumsum(inside[:-1]) > 0
        cut = np.zeros(n, bool)  # a document starts here
        cut[(starts - at)[(starts >= at) & (starts < at + n)]] = True
        new = inside.copy()
        new[1:] &= cut[1:] | ~inside[:-1] | (place[1:] != place[:-1])
        a = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        sizes = np.bincount(run[inside], minlength=len(a)) if len(a) else np.zeros(0, np.int64)
        found.append((place[a], a + at, a + at + sizes - 1))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


def gram_hashes(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    if not len(place):
        return np.zeros(0, np.uint64)
    words = np.lib.stride_tricks.sliding_window_view(data, GRAM)[place].view(np.uint64)
    g = np.zeros(len(place), np.uint64)
    for k in range(GRAM // 8):
        g = _mix(g * _STEP[k] + words[:, k] + _STEP[k + 1])
    return g


def context_marks(data: np.ndarray, place, first, last) -> np.ndarray:
    """16 bits of a hash of each element's whole bytes and shape."""
    base = pow(_BASE, 1, 1 << 64)
    power = np.full(len(data) + 1, base, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * power[:-1], dtype=np.uint64)])
    size = len(data)
    # moved to a common power, so that the place of the element does not count
    h = (total[last + WINDOW] - total[first]) * power[size - first]
    return (_mix(h + (place - first).astype(np.uint64) * _STEP[3]) >> np.uint64(48)).astype(np.uint16)


class Block:
    """Documents of a block, laid end to end in order of their ids."""

    def __init__(self, row: dict):
        raw = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["size"])) if row["size"] else b""
        self.raw, self.data = raw, np.frombuffer(raw, np.uint8)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["anchors"]), np.uint8).reshape(4, -1)
        found = np.ascontiguousarray(planes.T).view(np.int32).reshape(3, -1).astype(np.int64)
        found[0] = np.cumsum(found[0])
        self.place, self.first, self.last = found[0], found[0] - found[1], found[0] - found[2]

    def id_at(self, places: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.ends, places, side="right")]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (hash, mark) in order; each anchor's entry; how often its hash occurs here."""
        g = gram_hashes(self.data, self.place)
        mark = context_marks(self.data, self.place, self.first, self.last)
        order = np.lexsort((mark, g))
        gs, ms = g[order], mark[order]
        new_g = np.concatenate([[True], gs[1:] != gs[:-1]])[:len(gs)]
        new = new_g.copy()
        new[1:] |= ms[1:] != ms[:-1]
        entry, times = np.empty(len(g), np.int64), np.empty(len(g), np.int64)
        entry[order] = np.cumsum(new) - 1
        group = np.cumsum(new_g) - 1
        times[order] = np.bincount(group, minlength=1)[group] if len(g) else 0
        return gs[new], ms[new], entry, times


BLOCK_SCHEMA = "block long, ids binary, ends binary, data binary, size long, anchors binary, sample array<binary>, extra binary"


def _pack(number: int, ids: list, texts: list[bytes], extra: pa.Table | None) -> pa.RecordBatch:
    key = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)
    order = np.argsort(key, kind="stable")
    texts = [texts[i] for i in order]
    raw = b"".join(texts)
    data = np.frombuffer(raw, np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    place, first, last = anchors(data, ends)
    packer = zstandard.ZstdCompressor(level=6)  # a block is written once and moves twice
    # places as steps, windows as distances before the anchor: mostly under 256,
    # so the bytes of equal weight go together
    small = np.stack([np.diff(place, prepend=0), place - first, place - last]).astype(np.int32)
    planes = np.ascontiguousarray(small.view(np.uint8).reshape(-1, 4).T)
    g = gram_hashes(data, place)
    low = place[np.argpartition(g, SAMPLES)[:SAMPLES]] if len(g) > SAMPLES else place
    stored = b""
    if extra is not None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, extra.schema) as out:
            out.write_table(extra.take(pa.array(order)))
        stored = packer.compress(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([key[order].tobytes()]), pa.array([ends.tobytes()]), pa.array([packer.compress(raw)]),
         pa.array([len(raw)]), pa.array([packer.compress(planes.tobytes())]),
         pa.array([[raw[p:p + PREFIX] for p in low.tolist()]], pa.list_(pa.binary())), pa.array([stored])],
        [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])


def blocks_of(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Documents packed into blocks of about ``BLOCK_BYTES``, written once.
    ``carry`` keeps all columns of ``docs`` with the block; the text is there
    already, so its column goes along empty."""
    cols = [F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text")]
    if carry:
        cols += [(F.lit(None).cast(docs.schema[c].dataType) if c == text_col else F.col(c)).alias(f"c{k}")
                 for k, c in enumerate(docs.columns)]

    most = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = first_block_number()
        ids, texts, extra, size = [], [], [], 0

        def block():
            return _pack(number, ids, texts, pa.Table.from_batches(extra) if carry else None)

        for batch in batches:
            start = 0
            for k, (i, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                t = t or b""
                if ids and size + len(t) > most:
                    if carry:
                        extra.append(batch.slice(start, k - start).select(range(2, batch.num_columns)))
                        start = k
                    yield block()
                    number += 1
                    ids, texts, extra, size = [], [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t) + 8
            if carry:
                extra.append(batch.slice(start).select(range(2, batch.num_columns)))
        if ids:
            yield block()

    return written(docs.select(*cols).mapInArrow(run, BLOCK_SCHEMA), "blocks")


RUN, HOT, DONE = 0, 1, 2


def _codes(blocks: DataFrame, parts: int) -> DataFrame:
    """Per block and hash range: a code for each distinct entry of the block.

    An entry travels as 48 bits of its hash and its 16-bit mark.  Different
    anchors that agree in 48 bits only count as repeats, whose elements are
    compared in full later.
    """
    edges = np.array(range_edges(parts), np.uint64)
    most_contexts, most_entries = HOT_CONTEXTS, HOT_ENTRIES

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in dicts(batches):
            g, mark, _, _ = Block(row).entries()
            cut = np.concatenate([[0], np.searchsorted(g, edges), [len(g)]])
            key = (g >> MARK_BITS << MARK_BITS) | mark
            full = np.flatnonzero(np.diff(cut))  # the ranges that the block has entries of
            yield from rows_of(PART_SCHEMA, [(p, 0, row["block"], key[a:b].tobytes())
                                             for p, a, b in zip(full.tolist(), cut[full].tolist(), cut[full + 1].tolist())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, who, keys = 0, [], []
        for batch in batches:
            for p, b, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                part = p
                who.append(b)
                keys.append(np.frombuffer(blob, np.uint64))
        if not who:
            return
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        key = key[order]
        other = np.concatenate([[True], key[1:] != key[:-1]])
        new = np.concatenate([[True], key[1:] >> MARK_BITS != key[:-1] >> MARK_BITS])
        group = np.cumsum(new) - 1
        times = np.bincount(group)
        contexts = np.bincount(group, other)
        code = np.empty(len(key), np.uint8)
        code[order] = ((times > 1).astype(np.uint8) + ((contexts > most_contexts) | (times > most_entries)).astype(np.uint8))[group]
        at, rows = 0, []
        packer = zstandard.ZstdCompressor(level=1)
        for b, x in zip(who, keys):
            rows.append((b, part, packer.compress(code[at:at + len(x)].tobytes())))
            at += len(x)
        yield from rows_of(NOTE_SCHEMA, rows)

    sent = blocks.select("block", "ids", "ends", "data", "size", "anchors").mapInArrow(send, PART_SCHEMA)
    return sent.repartitionById(parts, F.col("part")).mapInArrow(meet, NOTE_SCHEMA)


def _element(raw: bytes, place: int, first: int, last: int) -> bytes:
    """Suffix from the anchor, then the bytes before it in reverse."""
    return raw[place:last + WINDOW] + raw[first:place][::-1]


def _ranges(windows: np.ndarray) -> bytes:
    """Sorted window starts as pairs (first, last) of runs."""
    if not len(windows):
        return b""
    new = np.concatenate([[True], windows[1:] != windows[:-1] + 1])
    return np.stack([windows[new], windows[np.concatenate([new[1:], [True]])]], 1).astype(np.int32).tobytes()


def _runs(splitters: list[bytes], parts: int):
    """Step 3 for one block and its codes."""
    wide = parts - 1

    def run(row: dict, notes: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_left, bisect_right

        block, number = Block(row), row["block"]
        if not len(block.place):
            return
        _, _, entry, times = block.entries()
        unpack = zstandard.ZstdDecompressor()
        code = np.concatenate([np.frombuffer(unpack.decompress(blob), np.uint8) for _, blob in sorted(notes)])[entry]
        hot = code == 2
        want = ((code > 0) | (times > 1)) & ~hot
        out: list[tuple] = []
        done: list[np.ndarray] = []
        raw = block.raw
        # the block's run: sorted, equal elements once (its first place)
        place, first, last = block.place[want], block.first[want], block.last[want]
        size = (last + WINDOW - place).tolist()
        items = sorted(zip([_element(raw, p, a, b) for p, a, b in zip(place.tolist(), first.tolist(), last.tolist())],
                           size, place.tolist(), first.tolist(), last.tolist()))
        kept = []
        for item in items:
            if kept and kept[-1][0] == item[0] and kept[-1][1] == item[1]:
                done.append(np.arange(item[3], item[4] + 1))
            else:
                kept.append(item)
        if kept:
            texts = [x[0] for x in kept]
            if len(texts) < len(splitters):
                to = np.array([bisect_right(splitters, t) for t in texts], np.int64)
            else:
                cuts = [bisect_left(texts, s) for s in splitters]
                to = np.searchsorted(np.array(cuts, np.int64), np.arange(len(texts)), side="right")
            full, begin = np.unique(to, return_index=True)  # the ranges that the run has elements of
            where = np.array([x[2] for x in kept], np.int64)
            sizes = np.array([x[1] for x in kept], np.uint8)
            ids = block.id_at(where)
            for p, a, b in zip(full.tolist(), begin.tolist(), [*begin[1:].tolist(), len(texts)]):
                shared, rest, rests = encode(texts[a:b])
                out.append((p, RUN, number, b"".join([
                    np.int32(b - a).tobytes(), shared.astype(np.uint8).tobytes(), rest.astype(np.uint8).tobytes(),
                    sizes[a:b].tobytes(), where[a:b].astype(np.int32).tobytes(), ids[a:b].tobytes(), rests])))
        # anchors in very many contexts: window by window, by hash
        seen: dict[bytes, int] = {}
        digest = xxhash.xxh3_128_digest
        later = []
        for a, b in zip(block.first[hot].tolist(), block.last[hot].tolist()):
            for w in range(a, b + 1):
                if seen.setdefault(digest(raw[w:w + WINDOW]), w) != w:
                    later.append(w)
        if seen:
            h = np.frombuffer(b"".join(seen), np.uint8).reshape(-1, 16)
            at = np.fromiter(seen.values(), np.int64, len(seen))
            ids = block.id_at(at)
            to = (h[:, :4].copy().view(np.uint32)[:, 0].astype(np.uint64) * np.uint64(wide + 1) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            full, begin = np.unique(to[order], return_index=True)
            for p, o in zip(full.tolist(), np.split(order, begin[1:])):
                out.append((p, HOT, number, h[o].tobytes() + ids[o].tobytes() + at[o].astype(np.int32).tobytes()))
        if later:
            done.append(np.array(later))
        if done:
            out.append(((number >> 24) % parts, DONE, number, _ranges(np.unique(np.concatenate(done)))))
        pack = zstandard.ZstdCompressor(level=3).compress
        yield from rows_of(PART_SCHEMA, [(p, kind, n, pack(blob)) for p, kind, n, blob in out])

    return run


def _merge_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4: the runs of one range to the later windows of each block."""
    unpack = zstandard.ZstdDecompressor().decompress
    rows = [(k, b, unpack(blob)) for batch in batches for k, b, blob in
            zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())]
    # what a block has settled alone only passes through
    yield from rows_of(NOTE_SCHEMA, [(b, 0, blob) for k, b, blob in rows if k == DONE])
    later: dict[int, list[tuple[int, int]]] = {}

    runs, where = [], []
    for _, number, blob in sorted((r for r in rows if r[0] == RUN), key=lambda r: r[1]):
        n = int(np.frombuffer(blob, np.int32, 1)[0])
        shared, rest, sizes = (np.frombuffer(blob, np.uint8, n, 4 + k * n) for k in range(3))
        place = np.frombuffer(blob, np.int32, n, 4 + 3 * n)
        ids = np.frombuffer(blob, np.int64, n, 4 + 7 * n)
        runs.append(Run(len(runs), shared.astype(np.int32), rest.astype(np.int32), blob[4 + 15 * n:]))
        where.append((number, sizes.tolist(), place.tolist(), ids.tolist()))

    # a group: elements with the same first GRAM bytes, as text -> shape -> places
    group: dict[tuple[bytes, int], list[tuple[int, int, int]]] = {}

    def close() -> None:
        """Later windows of a finished group."""
        firsts = []
        for (text, size), places in group.items():
            least = min(places)
            for one in places:
                if one is not least:
                    mark(one, text, size)
            firsts.append((least, text, size))
        if len(firsts) > 1:
            firsts.sort()
            seen: set[bytes] = set()
            for one, text, size in firsts:
                # window d bytes before the anchor, oldest element first
                line = text[size:][::-1] + text[:size]
                before = len(text) - size
                count = len(line) - WINDOW + 1
                start = one[2] - before
                windows = [line[k:k + WINDOW] for k in range(count)]
                hit = [w in seen for w in windows]
                if True in hit:
                    at = 0
                    while at < count:
                        if hit[at]:
                            stop = at
                            while stop + 1 < count and hit[stop + 1]:
                                stop += 1
                            later.setdefault(one[1], []).append((start + at, start + stop))
                            at = stop
                        at += 1
                seen.update(windows)

    def mark(one: tuple[int, int, int], text: bytes, size: int) -> None:
        start = one[2] - (len(text) - size)
        later.setdefault(one[1], []).append((start, start + len(text) - WINDOW))

    for text, shared, run, at in merge(runs):
        if shared < GRAM and group:
            close()
            group = {}
        number, sizes, place, ids = where[run]
        group.setdefault((text, sizes[at]), []).append((ids[at], number, place[at]))
    if group:
        close()

    hot = [r for r in rows if r[0] == HOT]
    if hot:
        sizes = [len(blob) // 28 for _, _, blob in hot]
        h = np.concatenate([np.frombuffer(blob, np.uint64, 2 * n).reshape(-1, 2) for (_, _, blob), n in zip(hot, sizes)])
        ids = np.concatenate([np.frombuffer(blob, np.int64, n, 16 * n) for (_, _, blob), n in zip(hot, sizes)])
        at = np.concatenate([np.frombuffer(blob, np.int32, n, 24 * n) for (_, _, blob), n in zip(hot, sizes)])
        number = np.repeat(np.array([b for _, b, _ in hot]), sizes)
        order = np.lexsort((at, number, ids, h[:, 1], h[:, 0]))
        hs = h[order]
        again = order[1:][(hs[1:] == hs[:-1]).all(1)]
        for b in np.unique(number[again]):
            pairs = np.frombuffer(_ranges(np.sort(at[again][number[again] == b])), np.int32).reshape(-1, 2)
            later.setdefault(int(b), []).extend(map(tuple, pairs.tolist()))
    yield from rows_of(NOTE_SCHEMA, [(b, 0, np.array(pairs, np.int32).tobytes()) for b, pairs in later.items()])


def later_windows(blocks: DataFrame, parts: int) -> DataFrame:
    """``(block, note, blob)``: ranges of windows that also start earlier."""
    # splitters: quantiles of a sample of the least hashed anchors, of at most about SPLIT_SAMPLE rows
    n_blocks = max(1, blocks.count())
    share = min(1.0, min(200.0 * parts, SPLIT_SAMPLE) / (n_blocks * SAMPLES))
    sample = blocks.select(F.explode("sample").alias("s")).where(F.rand(7) <= share)
    cuts = sorted(bytes(r.s) for r in sample.collect())
    splitters = sorted({cuts[len(cuts) * k // parts] for k in range(1, parts)}) if cuts else []
    runs = with_notes(blocks.drop("sample", "extra"), _codes(blocks, parts), parts, _runs(splitters, parts), PART_SCHEMA)
    return runs.repartitionById(parts, F.col("part")).mapInArrow(_merge_range, NOTE_SCHEMA)


def _kept(block: Block, notes: list[tuple[int, bytes]]) -> np.ndarray:
    """Mask of the bytes that stay."""
    edge = np.zeros(len(block.data) + 1, np.int32)
    for _, blob in notes:
        pairs = np.frombuffer(blob, np.int32).reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, pairs[:, 1] + WINDOW, -1)
    return np.cumsum(edge[:-1]) == 0


def _prepared(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> tuple[DataFrame, DataFrame, int]:
    blocks = blocks_of(docs, id_col, text_col, carry)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    return blocks, later_windows(blocks, parts), parts


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` per row.

    ``kept`` are the bytes that stay, or with ``digest`` their SHA-256.  A null
    text is empty; a null id comes before all others; of rows with equal ids
    the order is fixed within a run but not defined; other columns are ignored;
    an empty table gives an empty one.
    """
    blocks, later, parts = _prepared(docs, id_col, text_col, False)

    def cut(row: dict, notes: list) -> Iterator[pa.RecordBatch]:
        block = Block(row)
        keep = _kept(block, notes)
        out, at = [], 0
        for i, end in zip(block.ids.tolist(), block.ends.tolist()):
            k = keep[at:end]
            removed = int(len(k) - k.sum())
            spans = int((~k[:1]).sum() + (k[:-1] & ~k[1:]).sum())
            raw = block.raw[at:end] if not removed else block.data[at:end][k].tobytes()
            out.append((None if i == np.iinfo(np.int64).min else i, len(k), removed, spans,
                        hashlib.sha256(raw).digest() if digest else raw))
            at = end
        yield from rows_of(RESULT, out)

    return with_notes(blocks.drop("sample"), later, parts, cut, RESULT)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes cut from each text, all columns kept.

    What is left of a character cut in two is dropped too; ``chars_col``, if
    there, is the new length.  A null text becomes an empty one.
    """
    blocks, later, parts = _prepared(docs, id_col, text_col, True)
    names = docs.columns
    text_at = names.index(text_col)

    def cut(row: dict, notes: list) -> Iterator[pa.RecordBatch]:
        block = Block(row)
        keep = _kept(block, notes)
        extra = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["extra"])).read_all().combine_chunks()
        texts, at = [], 0
        for end in block.ends.tolist():
            texts.append(block.data[at:end][keep[at:end]].tobytes().decode("utf-8", "ignore"))
            at = end
        cols = [extra.column(k) for k in range(extra.num_columns)]
        cols[text_at] = pa.chunked_array([pa.array(texts, cols[text_at].type)])
        if chars_col in names:
            k = names.index(chars_col)
            cols[k] = pa.chunked_array([pa.array(list(map(len, texts)), cols[k].type)])
        yield from pa.table(cols, names=names).to_batches(4096)

    return with_notes(blocks.drop("sample"), later, parts, cut, docs.schema)


def op2(docs: DataFrame) -> DataFrame:
    """What repeats of earlier bytes leave of every ``documents`` text, in the
    contract's columns; see ``remove_repeats`` for nulls, repeated rows and empty
    tables.  Texts of any length are read whole."""
    found = remove_repeats(docs, digest=True)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                        F.lower(F.hex("kept")).alias("kept_sha256"))
