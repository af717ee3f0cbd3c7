"""Byte-level BPE encoding and decoding as a bounded-lookahead transducer.

Encoding
    The text is cut into pretokens (the byte-level pre-tokenizer's pattern) in
    blocks that end between a non-space and a space, where no pretoken can span.
    Within a pretoken the merge list is applied by a streaming transducer: bytes
    enter a window, the window is merged, and every token that ends at least
    *lookahead* bytes before the end of the window is emitted, since no later
    byte can change it; the window then restarts at the last emitted boundary.
    The window never holds more than ``lookahead + longest token + block`` bytes,
    so memory is constant for a pretoken of any length.

    ``sufficient lookahead`` is computed from the merge list in one pass by rank
    (see :func:`lookahead`).

Decoding
    Each id maps to bytes; an incremental UTF-8 state machine turns the byte
    stream into text, with U+FFFD for what is not UTF-8.

Short pretokens repeat a lot, so their result is kept in a table of bounded size,
which is emptied when a task ends.  New short pretokens of a group of blocks are merged
together, one merge of every pretoken per step, in numpy: they are shorter than the
lookahead, so that the transducer would hold them whole.  Texts pass block by block;
nothing but its text, its digests or its ids is held of one.

Edge cases: null or empty text has no tokens and decodes to the empty text; the
literal text of an added token becomes its id, as in the tokenizers library;
rows are independent, so repeated rows, ties and extra columns do not matter.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame

from shoplens.llm.common import block_groups, ensure_checkpoint_dir, lean

# The pattern of the public byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK_CHARS = 1 << 16
GROUP_CHARS = 1 << 19  # of blocks whose new chunks are learnt together
SHORT = 48             # longest chunk (characters) that is merged in a batch and kept
CACHE_ENTRIES = 60_000
NONE = 1 << 30
_SPACED = re.compile(r"\s ")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte: printable Latin-1 stands for itself, the
    others take code points from 256 on, in byte order."""
    keep = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def lookahead(pairs: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Bytes beyond a token's end that can still change it.

    ``pairs`` are (left, right, merged) ids in rank order.  A token ``v`` present
    at some time is only disturbed from the right by an earlier-ranked rule
    (v, x), if x is there, which in turn depends on what follows x, or by its own
    right child having been taken before v was formed.  Both are known when the
    rules are visited by rank, so the reach of each token is a running maximum.
    """
    reach: dict[int, int] = {}     # by rules that have the token on the left
    inner: dict[int, int] = {}     # through the token's own right child
    for left, right, merged in pairs:
        through = max(reach.get(right, 0), inner.get(right, 0))
        reach[left] = max(reach.get(left, 0), length[right] + through)
        inner[merged] = max(inner.get(merged, 0), through)
    return max([0, *reach.values(), *inner.values()])


class Bpe:
    """Merge table of one tokenizer file with the transducers built on it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()}
        self.token_bytes |= {i: s.encode() for s, i in self.added.items()}
        self.byte_id = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_id[byte] = vocab[char]
        pairs = []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.append((vocab[a], vocab[b], vocab[a + b]))
        self.rank = {(a, b): (r, m) for r, (a, b, m) in enumerate(pairs)}
        length = {i: len(b) for i, b in self.token_bytes.items()}
        self.lookahead = lookahead(pairs, length)
        self.longest = max(length.values())
        # the same rules as arrays: pair key sorted, with rank and merged id
        self.size = max(self.token_bytes) + 1
        key = np.array([a * self.size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(key)
        self._key = key[order]
        self._rank = order.astype(np.int32)
        self.merged = np.array([m for _, _, m in pairs], np.int64)
        # ranks of two single bytes, the first look-up of every pretoken
        self._byte_rank = np.full((256, 256), NONE, np.int32)
        ids = {int(i): b for b, i in enumerate(self.byte_id)}
        for r, (a, b, _) in enumerate(pairs):
            if a in ids and b in ids:
                self._byte_rank[ids[a], ids[b]] = r
        self.pattern = regex.compile(PATTERN)
        self.split_added = regex.compile("|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True))) \
            if self.added else None
        self.table = Table(self)

    # -- one pretoken ------------------------------------------------------
    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merge list to a short id sequence: lowest rank first, then leftmost."""
        rank = self.rank
        while len(ids) > 1:
            best = min((rank.get(p, (NONE, 0))[0] for p in zip(ids, ids[1:])), default=NONE)
            if best == NONE:
                break
            out, i, n = [], 0, len(ids)
            while i < n:
                if i + 1 < n and (hit := rank.get((ids[i], ids[i + 1]))) and hit[0] == best:
                    out.append(hit[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Ids of one pretoken given in pieces; a token goes out once it is stable."""
        window = b""
        hold = self.lookahead + self.longest
        for chunk in chunks:
            for at in range(0, len(chunk), 1024):
                window += chunk[at:at + 1024]
                if len(window) > 2 * hold:
                    stable, end = len(window) - self.lookahead, 0
                    for token in self.merge([int(self.byte_id[b]) for b in window]):
                        end += len(self.token_bytes[token])
                        if end > stable:
                            end -= len(self.token_bytes[token])
                            break
                        yield token
                    window = window[end:]
        yield from self.merge([int(self.byte_id[b]) for b in window])

    # -- many short pretokens at once --------------------------------------
    def merge_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pretokens: flat ids and the end offset of each pretoken.

        Every step applies, in each pretoken, its lowest-ranked merge, and then
        drops the pretokens that have none left.
        """
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(p) for p in pieces])
        out = self.byte_id[raw]
        alive = np.ones(len(raw), bool)
        at = np.arange(len(raw), dtype=np.int32)    # tokens of unfinished pretokens
        own, ids = owner, out
        ranks = np.full(len(raw), NONE, np.int32)   # of each token with the next one
        if len(raw) > 1:
            ranks[:-1] = np.where(own[1:] == own[:-1], self._byte_rank[raw[:-1], raw[1:]], NONE)
        while len(at):
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            least = np.minimum.reduceat(ranks, starts)
            best = np.repeat(least, np.diff(np.append(starts, len(own))))
            if (least == NONE).any():
                open_ = best < NONE
                done = ~open_
                out[at[done]] = ids[done]
                at, own, ids, ranks, best = at[open_], own[open_], ids[open_], ranks[open_], best[open_]
                if not len(at):
                    break
            hit = np.flatnonzero(ranks == best)
            # of adjacent hits (as in "aaa") only every second one applies, from the left
            chain = np.concatenate(([True], np.diff(hit) > 1))
            if not chain.all():
                first = np.maximum.accumulate(np.where(chain, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            ids[hit] = self.merged[ranks[hit]]
            alive[at[hit + 1]] = False
            keep = np.ones(len(at), bool)
            keep[hit + 1] = False
            # ranks change at a merged token and at the token before it
            spot = hit - np.arange(len(hit))        # place of the merged token once others are dropped
            at, own, ids, ranks = at[keep], own[keep], ids[keep], ranks[keep]
            changed = np.zeros(len(at) + 1, bool)
            changed[spot] = True
            changed[spot - 1] = True                # -1 marks the spare last entry
            spot = np.flatnonzero(changed[:-1])
            after = np.minimum(spot + 1, len(at) - 1)
            key = ids[spot] * self.size + ids[after]
            found = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
            good = (self._key[found] == key) & (own[spot] == own[after]) & (after > spot)
            ranks[spot] = np.where(good, self._rank[found], NONE)
        return out[alive], np.cumsum(np.bincount(owner[alive], minlength=len(pieces)))

    def learn(self, chunks: list[str]) -> None:
        """Fill the table with the results of short chunks, all merged together."""
        pieces: list[bytes] = []
        ends: list[int] = []
        for chunk in chunks:
            pieces.extend([p.encode("utf-8", "surrogatepass") for p in self.pattern.findall(chunk)])
            ends.append(len(pieces))
        if not pieces:
            return
        ids, stops = self.merge_many(pieces)
        ids, stops, start = ids.tolist(), stops.tolist(), 0
        for chunk, end in zip(chunks, ends):
            stop = stops[end - 1]
            self.table.put(chunk, ids[start:stop])
            start = stop

    # -- texts ---------------------------------------------------------------
    def blocks(self, text: str) -> Iterator[str]:
        """Pieces of about BLOCK_CHARS that end between a non-space and a space,
        where no pretoken can span; a longer run without such a place stays whole."""
        at, n = 0, len(text)
        while n - at > BLOCK_CHARS:
            cut = at + BLOCK_CHARS
            while cut < n and not (text[cut].isspace() and not text[cut - 1].isspace()):
                cut += 1
            yield text[at:cut]
            at = cut
        yield text[at:]

    def spans(self, text: str) -> Iterator[str]:
        """Blocks and the literal texts of added tokens, in text order."""
        at = 0
        for hit in self.split_added.finditer(text) if self.split_added else ():
            yield from self.blocks(text[at:hit.start()])
            yield hit.group()
            at = hit.end()
        yield from self.blocks(text[at:] if at else text)

    def chunks(self, span: str) -> list[str] | int:
        """The chunks of a block, or the id of an added token.

        A chunk is a space with what follows it up to the next space; chunks end
        between a non-space and a space.  A block with a space after white space
        goes in pretokens instead.
        """
        added = self.added.get(span)
        return self.cut(span) if added is None else added

    def cut(self, block: str) -> list[str]:
        if _SPACED.search(block):
            return self.pattern.findall(block)
        parts = block.split(" ")
        head = [parts[0]] if parts[0] else []
        return head + [" " + p for p in parts[1:]]

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text."""
        out: list[int] = []
        for part in map(self.chunks, self.spans(text or "")):
            if isinstance(part, int):
                out.append(part)
            else:
                for chunk in part:
                    out.extend(self.ids(chunk))
        return out

    def ids(self, chunk: str) -> list[int]:
        return [i for p in self.pattern.findall(chunk) for i in self.stream([p.encode("utf-8", "surrogatepass")])]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of an id stream, by the incremental UTF-8 state machine."""
        machine = codecs.getincrementaldecoder("utf-8")(errors="replace")
        return "".join([machine.decode(self.token_bytes[int(i)]) for i in ids]) + machine.decode(b"", final=True)

    def run(self, texts: list[str]) -> Iterator[tuple[str, bytes, bool]]:
        """(ids joined by commas, bytes that they decode to, whether it is the text's last) of all blocks in order."""
        for group in block_groups(texts, self.spans, GROUP_CHARS):
            parts = [self.chunks(span) for _, span, _ in group]
            self.prepare([p for p in parts if not isinstance(p, int)])
            for (_, _, last), part in zip(group, parts):
                if isinstance(part, int):
                    yield str(part), self.token_bytes[part], last
                else:
                    found = list(map(self.table.__getitem__, part))
                    yield ",".join([f[0] for f in found]), b"".join([f[1] for f in found]), last

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the comma-joined ids, SHA-256 of the decoded text, of each text.

        Only a block's ids are held at a time; they go straight into the digests.
        """
        state = None
        for joined, raw, last in self.run(texts):
            if state is None:
                state = hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")(errors="replace")
                count = 0
            ids_sha, text_sha, machine = state
            if joined:
                ids_sha.update(("," if count else "").encode() + joined.encode())
                text_sha.update(machine.decode(raw).encode("utf-8", "surrogatepass"))
                count += joined.count(",") + 1
            if last:
                text_sha.update(machine.decode(b"", final=True).encode())
                yield count, ids_sha.hexdigest(), text_sha.hexdigest()
                state = None

    def encoded(self, texts: list[str]) -> Iterator[tuple[int, list[int], str]]:
        """Number of ids, ids and decoded text of each text."""
        ids: list[int] = []
        for joined, _, last in self.run(texts):
            if joined:
                ids += map(int, joined.split(","))
            if last:
                yield len(ids), ids, self.decode(ids)
                ids = []

    def prepare(self, parts: list[list[str]]) -> None:
        """Make the table hold all short chunks of some parts."""
        self.table.turn()
        self.learn([c for c in self.table.missing(set().union(*parts)) if len(c) <= SHORT])


class Table(dict):
    """Chunk -> (ids joined by commas, decoded bytes); of bounded size.

    Two generations: when the young one is full it becomes the old one, so that
    chunks in use survive.  Long chunks are computed each time and never kept.
    """

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.old = bpe, {}

    def put(self, chunk: str, ids: list[int]) -> None:
        self[chunk] = self.result(ids)

    def result(self, ids: list[int]) -> tuple[str, bytes]:
        token_bytes = self.bpe.token_bytes
        return ",".join(map(str, ids)), b"".join([token_bytes[i] for i in ids])

    def turn(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()

    def empty(self) -> None:
        self.old = {}
        self.clear()

    def missing(self, chunks: set[str]) -> list[str]:
        out = []
        for chunk in chunks - self.keys():
            if (known := self.old.get(chunk)) is None:
                out.append(chunk)
            else:
                self[chunk] = known
        return out

    def __missing__(self, chunk: str) -> tuple[str, bytes]:
        return self.result(self.bpe.ids(chunk))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def tokenize(docs: DataFrame, path: str, text_col: str = "text", digest_only: bool = False) -> DataFrame:
    """The rows of ``docs`` with their token ids and the text decoded from them.

    Adds ``bpe_ids`` (array of int), ``bpe_text``, ``bpe_n`` (long); with
    ``digest_only`` the two large ones are replaced by ``bpe_ids_sha256`` and
    ``bpe_text_sha256``.  ``path`` must be readable on every executor.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    ensure_checkpoint_dir(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in
            ("bpe_n", "bpe_ids", "bpe_text", "bpe_ids_sha256", "bpe_text_sha256")]
    docs = docs.select(*[f"`{f.name}`" for f in kept])
    if digest_only:
        kept = [f for f in kept if f.name != text_col]
        extra = [T.StructField("bpe_n", T.LongType()), T.StructField("bpe_ids_sha256", T.StringType()),
                 T.StructField("bpe_text_sha256", T.StringType())]
    else:
        extra = [T.StructField("bpe_n", T.LongType()), T.StructField("bpe_ids", T.ArrayType(T.IntegerType())),
                 T.StructField("bpe_text", T.StringType())]
    keep_names = [f.name for f in kept]

    @lean
    def run(batches):
        bpe = load(path)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                columns: list[list] = [[], [], []]
                for row in bpe.digests(texts) if digest_only else bpe.encoded(texts):
                    for column, value in zip(columns, row):
                        column.append(value)
                arrays = [batch.column(n) for n in keep_names] + [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string() if digest_only else pa.list_(pa.int32())),
                    pa.array(columns[2], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=keep_names + [f.name for f in extra])
        finally:
            bpe.table.empty()

    return docs.mapInArrow(run, T.StructType([*kept, *extra]))
