"""Exact removal of repeated byte strings of a minimum length.

A byte goes if some ``length``-byte string that covers it also starts anywhere
else, in the same text or another.  The work is cut into independent pieces by
content, and each piece is decided on a Burrows-Wheeler transform.

1. *Anchors.*  In every window of ``length`` bytes the least hash of its
   ``GRAM``-byte strings is an anchor.  Equal windows hold equal anchors at equal
   places, so a window can only be repeated if its anchor is.
2. *Segments.*  An anchor with all the bytes of the windows that it is the (last)
   least hash of is a segment.  An anchor seen once is dropped.  An anchor seen
   with one segment only is decided: every window of it is repeated.
3. *Interval expansion.*  The distinct segments of the other anchors meet in one
   partition by anchor, as sequences of 8-byte symbols counted from the anchor.
   There the suffixes are ordered, the transform taken, and intervals of suffixes
   with a common prefix grow by backward extension, breadth first: level l + 1
   comes from level l by putting the preceding symbol in front (an LF step of
   every suffix of every interval).  Intervals of one suffix are dropped, and
   expansion stops at the symbols that a window of the minimum length must hold.
   Within each interval that is left, the bytes on either side decide the windows
   exactly.
4. Anchors with more than ``GROUP`` distinct segments do not go to one task: their
   windows are counted by 128-bit hashes, aggregated before the shuffle.
5. Each text gets the repeated windows of its segments, by content, and drops the
   bytes they cover.

Edge cases: null is the empty text; texts shorter than ``length`` keep all bytes
(and none of their strings can match); repeated rows match each other; a string
that overlaps its own copy counts; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import GOLDEN, batches_bytes, ensure_checkpoint_dir, in_groups, lean, mix64, stage

LENGTH = 200
GRAM = 56
SYMBOL = 8             # bytes of a symbol of the transform
GROUP = 8192           # segments of one anchor that one task takes
BLOCK_BYTES = 3 << 20  # segments expanded together

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.empty(n + 1, np.uint64)
    down = np.empty(n + 1, np.uint64)
    up[0] = down[0] = 1
    done = 1
    while done <= n:     # doubling
        take = min(done, n + 1 - done)
        up[done:done + take] = up[:take] * np.uint64(pow(_BASE, done, 1 << 64))
        down[done:done + take] = down[:take] * np.uint64(pow(_BASE, -done, 1 << 64))
        done += take
    return up, down


_CHUNK = 1 << 20
_UP, _DOWN = _powers(_CHUNK + 4096)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram``-byte string of ``data``."""
    n = len(data) - gram + 1
    out = np.empty(max(n, 0), np.uint64)
    for at in range(0, n, _CHUNK):
        part = data[at:min(at + _CHUNK, n) + gram - 1]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[part] * _UP[:len(part)], out=total[1:])
        own = (total[gram:] - total[:-gram]) * _DOWN[:len(part) - gram + 1]
        out[at:at + len(own)] = mix64(own)
    return out


def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of every ``width`` consecutive values."""
    op = np.minimum if least else np.maximum
    n = len(values) - width + 1
    fill = np.uint64(0xFFFFFFFFFFFFFFFF if least else 0)
    padded = np.full(-(-len(values) // width) * width, fill, np.uint64)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = op.accumulate(rows, axis=1).ravel()
    back = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[width - 1:width - 1 + n])


def segments(raws: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text, hash, id, from, to, anchor in segment) arrays: the segments of some texts, in order.

    Each window belongs to one anchor, the last of the least hashes in it; an
    anchor's segment is the bytes of its windows, which lie side by side.  Texts
    are treated together, in arrays of all their bytes.
    """
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    blob = b"".join(raws)
    width = length - gram + 1
    none = np.empty(0, np.int64)
    if len(blob) < length:
        return none, none, none, none, none, none
    hashes = _gram_hashes(np.frombuffer(blob, np.uint8), gram)
    low = _slide(hashes, width, least=True)                # least hash of each window
    for end in ends[:-1].tolist():                         # windows do not cross texts
        low[max(0, end - length + 1):end] = 0
    edge = np.zeros(width - 1, np.uint64)
    best = _slide(np.concatenate((edge, low, edge)), width, least=False)
    at = np.flatnonzero((best == hashes) & (hashes != 0))
    hashes = hashes[at]
    text = np.searchsorted(ends, at, side="right")
    start = ends - sizes
    lo = np.maximum(at - width + 1, start[text])           # first and last window start
    hi = np.minimum(at, ends[text] - length)
    open_ = np.arange(1, len(at))                          # a smaller one before
    for k in range(1, len(at)):
        open_ = open_[open_ >= k]
        open_ = open_[at[open_] - at[open_ - k] < width]
        if not len(open_):
            break
        less = hashes[open_ - k] < hashes[open_]
        cut = open_[less]
        lo[cut] = np.maximum(lo[cut], at[cut - k] + 1)
        open_ = open_[~less]
    open_ = np.arange(len(at) - 1)                         # one as small after
    for k in range(1, len(at)):
        open_ = open_[open_ + k < len(at)]
        open_ = open_[at[open_ + k] - at[open_] < width]
        if not len(open_):
            break
        less = hashes[open_ + k] <= hashes[open_]
        cut = open_[less]
        hi[cut] = np.minimum(hi[cut], at[cut + k] - width)
        open_ = open_[~less]
    own = lo <= hi
    at, hashes, text, lo, hi = at[own], hashes[own], text[own], lo[own], hi[own] + length
    seg = np.fromiter((_segment_id(blob[a:b], p - a) for a, b, p in zip(lo.tolist(), hi.tolist(), at.tolist())),
                      np.uint64, len(at))
    return text, hashes.view(np.int64), seg.view(np.int64), lo - start[text], hi - start[text], at - lo


def _segment_id(part: bytes, place: int) -> int:
    """The place of the anchor in the segment belongs to its identity."""
    return xxhash.xxh3_64_intdigest(part, place)


# -- Burrows-Wheeler transform and interval expansion -------------------------

def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of an integer text ordered by at least their first ``depth``
    symbols (prefix doubling; only suffixes whose order is open are sorted again)."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n + 1, np.int64)
    ordered = text[order]
    head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank[order], rank[n] = np.maximum.accumulate(np.where(head, np.arange(n), 0)), -1
    step = 1
    slots = np.flatnonzero(~(head & np.append(head[1:], True)))      # open places of the order
    while step < depth and len(slots):
        own = order[slots]
        key = rank[own] * (n + 1) + rank[np.minimum(own + step, n)] + 1
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[slots] = own
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[own] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        step *= 2
        slots = slots[~(head & np.append(head[1:], True))]
    return order


def repeated_groups(text: np.ndarray, length: int, useful: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose ``length`` first symbols occur again, and the interval they share.

    Intervals of the suffix order grow one symbol at a time, all at once; a place
    that is not ``useful`` ends its interval.
    """
    n = len(text)
    order = suffix_order(text, length)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    at = order[useful[order]]
    own = text[at]
    group = np.cumsum(np.concatenate(([True], own[1:] != own[:-1]))) if len(at) else np.empty(0, np.int64)
    level = 1
    mark, holder = np.zeros(n, bool), np.empty(n, np.int64)
    while True:
        if len(at):                                    # intervals of one suffix go
            head = np.concatenate(([True], group[1:] != group[:-1]))
            many = ~(head & np.append(head[1:], True))
            at, group = at[many], group[many]
        if level >= length or not len(at):
            return at, group
        # LF step: the suffix with the preceding symbol in front; the new intervals
        # are cut where the old interval or the symbol differs
        ok = at > 0
        before = at[ok] - 1
        spot = place[before]
        mark[spot], holder[spot] = True, group[ok]
        spot = np.flatnonzero(mark)
        mark[spot] = False
        at = order[spot]
        ok = useful[at]
        at, came = at[ok], holder[spot][ok]
        if len(at):
            put = text[at]
            group = np.cumsum(np.concatenate(([True], (came[1:] != came[:-1]) | (put[1:] != put[:-1]))))
        level += 1


def repeated_windows(parts: list[bytes], anchor: np.ndarray, place: np.ndarray, often: np.ndarray,
                     length: int = LENGTH) -> list[list[int]]:
    """For each segment, the runs (from, to, from, to ...) of repeated window starts.

    ``anchor`` groups the segments, ``place`` is the anchor's offset in each and
    ``often`` tells that the segment itself occurs more than once.  Starts are
    offsets in the segment.
    """
    place = np.asarray(place, np.int64)
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) + SYMBOL
    raw = np.frombuffer(b"".join([b"\0" * SYMBOL, *parts, b"\0" * SYMBOL]), np.uint8)
    packed = np.zeros(len(raw), np.uint64)
    for k in range(SYMBOL):
        packed[:len(raw) - k] |= raw[k:].astype(np.uint64) << np.uint64(8 * (SYMBOL - 1 - k))
    first = place % SYMBOL
    counts = (sizes - first) // SYMBOL
    # the symbol text: each segment's symbols and a separator of its own
    seg = np.repeat(np.arange(len(parts)), counts + 1)
    inner = np.arange(len(seg)) - np.repeat(np.concatenate(([0], np.cumsum(counts + 1)[:-1])), counts + 1)
    useful = inner < counts[seg]
    where = starts[seg] + first[seg] + SYMBOL * inner            # byte place of each symbol
    names, symbols = np.unique(packed[where[useful]], return_inverse=True)
    text = np.empty(len(seg), np.int64)
    text[useful], text[~useful] = symbols, len(names) + np.arange(len(parts))
    core = (length - SYMBOL + 1) // SYMBOL                       # whole symbols in any window
    at, group = repeated_groups(text, core, useful)
    out: list[list[int]] = [[] for _ in parts]
    if len(at):
        own, spot = seg[at], where[at]
        labels = np.unique(anchor, return_inverse=True)[1]
        shift = inner[at] - (place // SYMBOL)[own]               # from the anchor, in symbols
        by = np.lexsort((shift, labels[own], group))
        own, spot, g, m, c = own[by], spot[by], group[by], labels[own][by], shift[by]
        cut = np.concatenate(([True], (g[1:] != g[:-1]) | (m[1:] != m[:-1]) | (c[1:] != c[:-1])))
        many = ~(cut & np.append(cut[1:], True))
        own, spot, sub = own[many], spot[many], np.cumsum(cut)[many]
        hits = []
        rest = length - SYMBOL * core                            # bytes that lie beside the core
        for left in range(SYMBOL):
            # a window: the core, ``left`` bytes before it and ``rest - left`` after
            if left > rest:
                break
            start = spot - left - starts[own]
            ok = (start >= 0) & (start + length <= sizes[own])
            o, s, q = own[ok], sub[ok], spot[ok]
            key = np.zeros(len(o), np.uint64)
            if left:
                key = packed[q - SYMBOL] & np.uint64((1 << (8 * left)) - 1)
            tail = rest - left                                   # up to 2 * SYMBOL - 1 bytes
            keys = [s, key]
            for k in range(0, tail, SYMBOL):
                more = packed[np.minimum(q + SYMBOL * core + k, len(packed) - 1)]
                keys.append(more >> np.uint64(8 * max(0, SYMBOL - (tail - k))))
            by = np.lexsort(keys[::-1])
            differ = np.zeros(max(len(o) - 1, 0), bool)
            for one in keys:
                one = one[by]
                differ |= one[1:] != one[:-1]
            if len(o):
                cut = np.concatenate(([True], differ))
                hits.append((o[by], start[ok][by], ~(cut & np.append(cut[1:], True))))
        if hits:
            own = np.concatenate([h[0][h[2]] for h in hits])
            off = np.concatenate([h[1][h[2]] for h in hits])
            code = np.unique(own * (1 << 20) + off)
            cut = np.flatnonzero(np.concatenate(([True], np.diff(code) != 1))) if len(code) else np.empty(0, np.int64)
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(code)).tolist() if len(code) else []):
                one = int(code[a])
                out[one >> 20] += [one & 0xFFFFF, (int(code[b - 1]) & 0xFFFFF) + 1]
    for k in np.flatnonzero(often).tolist():
        out[k] = [0, int(sizes[k]) - length + 1]
    return out


# -- distributed steps ----------------------------------------------------------

def _expand(parts: DataFrame, length: int) -> DataFrame:
    """(anchor, seg, runs) of every segment, anchor by anchor in blocks of bounded size."""
    import pyarrow as pa

    def emit(rows: list) -> "pa.RecordBatch":
        anchor = np.array([r[0] for r in rows], np.int64)
        runs = repeated_windows([r[2] for r in rows], anchor, np.array([r[1] for r in rows]),
                                np.array([r[3] for r in rows], bool), length)
        seg = np.array([_segment_id(r[2], r[1]) for r in rows], np.uint64).view(np.int64)
        full = [k for k, r in enumerate(runs) if r]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor[full]), pa.array(seg[full]), pa.array([runs[k] for k in full], pa.list_(pa.int32()))],
            names=["anchor", "seg", "runs"])

    @lean
    def run(batches):
        rows: list = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("anchor", "place", "segment", "often"))):
                if size > BLOCK_BYTES and row[0] != last:
                    yield emit(rows)
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[2]), row[0]
        if rows:
            yield emit(rows)

    return (parts.select("anchor", "place", "segment", "often").repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "anchor long, seg long, runs array<int>"))


def _count_windows(parts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many segments for one task: windows counted by hash."""
    import pyarrow as pa

    schema = "anchor long, shift int, h1 long, h2 long, n long"

    def windows(rows):
        for anchor, place, part, often in rows:
            for a in range(len(part) - length + 1):
                h = xxhash.xxh3_128_intdigest(part[a:a + length])
                yield anchor, place, part, often, a, h

    @lean
    def count(batches):
        for batch in batches:
            seen: dict = {}
            rows = zip(*(batch.column(n).to_pylist() for n in ("anchor", "place", "segment", "often")))
            for anchor, place, _, often, a, h in windows(rows):
                one = (anchor, place - a, h)
                seen[one] = seen.get(one, 0) + (2 if often else 1)
            keys = list(seen)
            h1 = np.array([k[2] >> 64 for k in keys], np.uint64).view(np.int64)
            h2 = np.array([k[2] & (1 << 64) - 1 for k in keys], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()), pa.array(h1),
                 pa.array(h2), pa.array(list(seen.values()), pa.int64())], names=["anchor", "shift", "h1", "h2", "n"])

    @lean
    def spread(batches):
        for batch in batches:
            out: list = []
            rows = zip(*(batch.column(n).to_pylist() for n in ("anchor", "place", "segment", "often")))
            for anchor, place, part, _, a, h in windows(rows):
                out.append((anchor, place - a, h, _segment_id(part, place), a))
            h1 = np.array([k[2] >> 64 for k in out], np.uint64).view(np.int64)
            h2 = np.array([k[2] & (1 << 64) - 1 for k in out], np.uint64).view(np.int64)
            seg = np.array([k[3] for k in out], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int32()), pa.array(h1),
                 pa.array(h2), pa.array(seg), pa.array([k[4] for k in out], pa.int32())],
                names=["anchor", "shift", "h1", "h2", "seg", "at"])

    parts = parts.select("anchor", "place", "segment", "often")
    keys = ["anchor", "shift", "h1", "h2"]
    many = stage(parts.mapInArrow(count, schema).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n > 1").drop("n"), "suffix-many")
    return (parts.mapInArrow(spread, "anchor long, shift int, h1 long, h2 long, seg long, at int").join(many, keys)
            .groupBy("anchor", "seg").agg(F.sort_array(F.collect_set("at")).alias("at"))
            .select("anchor", "seg", F.flatten(F.transform("at", lambda a: F.array(a, a + 1))).alias("runs")))


def _spans(found: list, known: dict, single: set, length: int) -> list[int]:
    """Byte ranges (from, to, from, to ...) that a text's repeated windows cover."""
    ranges: list[tuple[int, int]] = []
    for k, s, a, b in found:
        if k in single:
            ranges.append((a, b))
        elif (runs := known.get((k, s))) is not None:
            ranges += [(a + runs[i], a + runs[i + 1] - 1 + length) for i in range(0, len(runs), 2)]
    out: list[int] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   digest: bool = False) -> DataFrame:
    """``docs`` without the bytes of repeated strings, with every other column as it was.

    Adds ``repeat_bytes`` (bytes of the input text), ``repeat_removed`` and
    ``repeat_spans`` (maximal removed runs).  Bytes are cut, so a character may lose
    a part; such remains become U+FFFD in the text column.  With ``digest`` the text
    column goes and ``repeat_sha256`` holds the digest of the kept bytes themselves.
    """
    import pyarrow as pa

    ensure_checkpoint_dir(docs.sparkSession)
    gram = max(SYMBOL, min(GRAM, length // 3))
    added = ["repeat_bytes", "repeat_removed", "repeat_spans"] + (["repeat_sha256"] if digest else [])
    others = [f.name for f in docs.schema.fields if f.name not in (text_col, *added)]
    quoted = [f"`{n}`" for n in others]
    base = docs.select(F.struct(*quoted).alias("rest"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("key"))
    # the key brings what is known of a text back to it, rows without an id included; only rows
    # that repeat id and text share one (or a rare clash of hashes), and sets below hold each
    # fact of a key once.  All is matched by content, so a shared key changes no result.

    @lean
    def count_anchors(batches):
        for batch in batches:
            a, s = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, raws in in_groups(batches_bytes(batch.column("text"))):
                _, h, seg, *_ = segments(raws, length, gram)
                a.append(h)
                s.append(seg)
            a, s = np.concatenate(a), np.concatenate(s)
            by = np.lexsort((s, a))
            a, s = a[by], s[by]
            first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.empty(0, np.int64)
            end = np.append(first[1:], len(a)) if len(a) else first
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[first]), pa.array((end - first).astype(np.int32)), pa.array(s[first]),
                 pa.array(s[first] != s[end - 1])], names=["anchor", "n", "seg", "mixed"])

    found = base.select("text").mapInArrow(count_anchors, "anchor long, n int, seg long, mixed boolean")
    repeated = stage(found.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("seg").alias("lo"), F.max("seg").alias("hi"),
                                                 F.max("mixed").alias("mixed"))
                     .filter("n > 1").select("anchor", (~F.col("mixed") & (F.col("lo") == F.col("hi"))).alias("single")),
                     "suffix-anchors")

    @lean
    def list_anchors(batches):
        for batch in batches:
            own = batch.column("key").to_numpy(zero_copy_only=False)
            keys, a, s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for first, raws in in_groups(batches_bytes(batch.column("text"))):
                text, h, seg, *_ = segments(raws, length, gram)
                by = np.lexsort((seg, text))
                text, h, seg = text[by], h[by], seg[by]
                one = np.ones(len(seg), bool)
                one[1:] = (text[1:] != text[:-1]) | (seg[1:] != seg[:-1])
                keys.append(own[first + text[one]])
                a.append(h[one])
                s.append(seg[one])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, a, s)], names=["key", "anchor", "seg"])

    held = stage(base.select("key", "text").mapInArrow(list_anchors, "key long, anchor long, seg long")
                 .join(repeated, "anchor"), "suffix-held")
    wanted = stage(held.filter("not single").groupBy("key").agg(F.collect_set("seg").alias("segs")), "suffix-wanted")

    @lean
    def cut_segments(batches):
        for batch in batches:
            seen: dict = {}
            wants = batch.column("segs")
            for first, raws in in_groups(batches_bytes(batch.column("text"))):
                text, h, seg, lo, hi, place = segments(raws, length, gram)
                cuts = np.searchsorted(text, np.arange(len(raws) + 1))
                for j, raw in enumerate(raws):
                    own = slice(cuts[j], cuts[j + 1])
                    if own.start == own.stop:
                        continue
                    use = np.flatnonzero(np.isin(seg[own], wants[first + j].values.to_numpy())) + own.start
                    for k, a, b, p in zip(h[use].tolist(), lo[use].tolist(), hi[use].tolist(), place[use].tolist()):
                        one = (k, p, raw[a:b])
                        seen[one] = seen.get(one, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.int64()), pa.array([k[1] for k in seen], pa.int32()),
                 pa.array([k[2] for k in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())],
                names=["anchor", "place", "segment", "n"])

    cut = (base.select("key", "text").join(wanted, "key").select("text", "segs")
           .mapInArrow(cut_segments, "anchor long, place int, segment binary, n long"))
    parts = stage(cut.groupBy("anchor", "place", "segment").agg((F.sum("n") > 1).alias("often")), "suffix-segments")
    crowds = stage(parts.groupBy("anchor").count().filter(F.col("count") > GROUP).select("anchor"), "suffix-crowds")
    if crowds.isEmpty():
        runs = _expand(parts, length)
    else:
        runs = _expand(parts.join(crowds, "anchor", "left_anti"), length)             .unionByName(_count_windows(parts.join(crowds, "anchor", "left_semi"), length))
    runs = stage(runs, "suffix-runs")
    known = stage(held.filter("single").select("key", "anchor", F.lit(None).cast("long").alias("seg"), F.lit(None).cast("array<int>").alias("runs"))
                  .unionByName(held.filter("not single").select("key", "anchor", "seg").join(runs, ["anchor", "seg"])
                               .select("key", "anchor", "seg", "runs"))
                  .groupBy("key").agg(F.collect_set(F.struct("anchor", "seg", "runs")).alias("known")), "suffix-known")
    out = [T.StructField("rest", base.schema["rest"].dataType), *([] if digest else [T.StructField("text", T.StringType())]),
           *[T.StructField(n, T.LongType()) for n in added[:3]], *([T.StructField(added[3], T.StringType())] if digest else [])]

    @lean
    def cut_spans(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in out[1:]]
            facts_of = batch.column("known").to_pylist()
            raws_of = batches_bytes(batch.column("text"))
            # only the texts that hold a repeated anchor are looked at again
            spans_of: dict[int, list[int]] = {}
            use = [k for k, f in enumerate(facts_of) if f]
            for first, raws in in_groups([raws_of[k] for k in use]):
                text, h, seg, lo, hi, _ = segments(raws, length, gram)
                cuts = np.searchsorted(text, np.arange(len(raws) + 1))
                for j in range(len(raws)):
                    own, facts = slice(cuts[j], cuts[j + 1]), facts_of[use[first + j]]
                    single = {f["anchor"] for f in facts if f["runs"] is None}
                    known = {(f["anchor"], f["seg"]): f["runs"] for f in facts if f["runs"] is not None}
                    found = zip(h[own].tolist(), seg[own].tolist(), lo[own].tolist(), hi[own].tolist())
                    spans_of[use[first + j]] = _spans(list(found), known, single, length)
            for k, raw in enumerate(raws_of):
                spans = spans_of.get(k, [])
                edges = [0, *spans, len(raw)]
                kept = b"".join([raw[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)])
                row = [len(raw), len(raw) - len(kept), len(spans) // 2]
                row = [*row, hashlib.sha256(kept).hexdigest()] if digest else [kept.decode("utf-8", "replace"), *row]
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), *[pa.array(c, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64())
                                         for c, f in zip(columns, out[1:])]], names=[f.name for f in out])

    done = base.join(known, "key", "left").select("rest", "text", "known").mapInArrow(cut_spans, T.StructType(out))
    by_name = {n: F.col("rest").getField(n).alias(n) for n in others} | {n: F.col(n) for n in added}
    if not digest:
        by_name[text_col] = F.col("text").alias(text_col)
    order = [f.name for f in docs.schema.fields if f.name in by_name and f.name not in added]
    return done.select(*[by_name[n] for n in [*order, *added]])
