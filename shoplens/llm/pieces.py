"""SentencePiece encoding and decoding of merge-type vocabularies.

Encoding
    Spaces become U+2581 and one more goes in front of a text that is not empty.  The
    characters are the first symbols; an agenda holds every pair of adjacent symbols that
    joins to a piece, ordered by the piece's score and, of equal scores, from the left.
    The best pair is joined, its neighbours' new pairs enter, pairs whose symbols have
    changed meanwhile are passed over.  Symbols that are no piece go as bytes.
Cutting
    Two characters that stand side by side in no piece can never be joined.  Texts are
    therefore cut at such places into chunks, mostly words, which need an agenda each;
    results of short chunks are kept in a table of bounded size that is emptied with the
    task.  A chunk is cut from the vocabulary's own pairs of characters, nothing else is
    assumed of it.
Decoding
    A state machine over ids: pieces give their text, U+2581 becomes a space, byte pieces
    are gathered until another piece comes and then read as UTF-8 (U+FFFD for a byte that
    is none), and the space in front of the text goes.

``check`` runs the sentencepiece library over the same Arrow batches and tells for each
row whether ids and decoded text are equal.

The model file is read here: only merge-type models with byte fallback, without
normalisation, user-defined or unused pieces are taken, others raise ``ValueError``.

Edge cases: a null or empty text has no ids and decodes to the empty text; U+2581 in a
text decodes to a space, as in the library; texts of control pieces are ordinary text;
rows are independent, so repeated rows, repeated or null ids and ties do not matter; an
empty table gives an empty table; other columns are carried along, those that have the
name of an added column are replaced.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from operator import add

import numpy as np
from pyspark.sql import DataFrame

from shoplens.llm.common import GROUP_BYTES, block_groups, ensure_checkpoint_dir, lean

SPACE = "▁"
TABLE = 120_000           # chunks of one generation of the table
SHORT = 40                # characters of a chunk that is kept in it
_PLACE = 40               # bits of a place in a chunk
_MASK = (1 << _PLACE) - 1
_NONE = 1 << 40           # rank of a pair that does not join
BLOCK = 1 << 16           # characters of a text that are looked at together

# Field numbers and kinds of the model file's format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, SUFFIX, BYTE_FALLBACK, UNKNOWN_SURFACE = 3, 24, 35, 44
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE = 2, 3, 4, 5
MERGE_TYPE = 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message of the protocol-buffer wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        if size is None:
            size = varint()
        yield tag >> 3, raw[at:at + size]
        at += size


def _bytewise(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("shoplens-bytewise", _bytewise)


class Pieces:
    """A vocabulary with its agenda, its cuts and its decoder."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.kind: list[int] = []
        self.text: list[str | None] = []
        self.byte: dict[int, int] = {}         # id of each byte
        self.byte_of: dict[int, int] = {}
        for i, raw in enumerate(v for n, v in model if n == PIECES):
            own = dict(_fields(raw))
            piece, kind = own[1].decode(), own.get(3, NORMAL)
            self.kind.append(kind)
            self.text.append(piece.replace(SPACE, " ") if kind == NORMAL else None if kind == UNKNOWN else "")
            if kind == NORMAL:
                self.id[piece] = i
                score[piece] = struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0]
            elif kind == BYTE:
                self.byte[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
        trainer = {n: v for m, raw in model if m == TRAINER for n, v in _fields(raw)}
        normal = {n: v for m, raw in model if m == NORMALIZER for n, v in _fields(raw)}
        surface = trainer.get(UNKNOWN_SURFACE, " \u2047 ".encode()).decode()
        self.text = [surface if t is None else t for t in self.text]
        plain = (trainer.get(MODEL_TYPE) == MERGE_TYPE and trainer.get(BYTE_FALLBACK) and not trainer.get(SUFFIX) and not normal.get(CHARSMAP)
                 and normal.get(DUMMY_PREFIX, 1) and not normal.get(REMOVE_SPACES, 1) and normal.get(ESCAPE, 1)
                 and len(self.byte) == 256 and not {USER, UNUSED} & set(self.kind))
        if not plain:
            raise ValueError("not a merge-type model with byte fallback and plain normalisation")
        place = {x: i for i, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: place[x] for p, x in score.items()}    # of its score, 0 for the best
        self._pairs()
        self.beside = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        before_space = any(b[1] == SPACE and b[0] != SPACE for b in self.beside)
        self._by_word = not before_space
        self._words = re.compile("(?s).+" if before_space else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.clear()

    def _pairs(self) -> None:
        """The pairs of symbols that join, as sorted keys with the rank and the symbol that comes of them."""
        symbols = list(dict.fromkeys([*self.rank, *(c for p in self.rank for c in p)]))
        self.symbol = {s: i for i, s in enumerate(symbols)}
        self.size = len(symbols) + 1                          # the last one joins with nothing
        found = [(self.symbol[p[:i]] * self.size + self.symbol[p[i:]], r, self.symbol[p]) for p, r in self.rank.items()
                 for i in range(1, len(p)) if p[:i] in self.symbol and p[i:] in self.symbol]
        self._key, self._rank, self._join = (np.array(x, np.int64) for x in zip(*sorted(found)))
        self._ids = [str(self.id[s]) if s in self.id else self._bytes(s) for s in symbols]
        self._text = [s.replace(SPACE, " ") for s in symbols]

    def _bytes(self, symbol: str) -> str:
        return ",".join([str(self.byte[b]) for b in symbol.encode("utf-8", "surrogatepass")])

    # -- encoding ------------------------------------------------------------
    def agenda(self, chunk: str) -> list[str]:
        """The symbols that are left of a chunk when no adjacent pair joins to a piece.

        An entry is a score's rank and the place of a pair's left symbol, in one number.
        It is passed over if the pair that now stands there has another rank; one of the
        same rank is due just then.
        """
        rank, n = self.rank, len(chunk)
        symbols: list[str] = list(chunk)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [rank[pair] << _PLACE | i for i, pair in enumerate(map(add, chunk, chunk[1:])) if pair in rank]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            left = entry & _MASK
            right = after[left]
            if right >= n or not symbols[left]:
                continue
            piece = symbols[left] + symbols[right]
            if rank.get(piece) != entry >> _PLACE:
                continue
            symbols[left], symbols[right] = piece, ""
            end = after[left] = after[right]
            if end < n:
                before[end] = left
                own = rank.get(piece + symbols[end])
                if own is not None:
                    heapq.heappush(heap, own << _PLACE | left)
            start = before[left]
            if start >= 0:
                own = rank.get(symbols[start] + piece)
                if own is not None:
                    heapq.heappush(heap, own << _PLACE | start)
        return [s for s in symbols if s]

    def ids(self, chunk: str) -> list[int]:
        out: list[int] = []
        for symbol in self.agenda(chunk):
            own = self.id.get(symbol)
            if own is None:
                out += [self.byte[b] for b in symbol.encode("utf-8", "surrogatepass")]
            else:
                out.append(own)
        return out

    def cut(self, chunk: str) -> Iterator[str]:
        """A long chunk, cut wherever two characters stand side by side in no piece."""
        at = 0
        for i in range(1, len(chunk)):
            if chunk[i - 1:i + 1] not in self.beside:
                yield chunk[at:i]
                at = i
        yield chunk[at:]

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text, chunk by chunk, each with its own agenda."""
        return [i for block in self.blocks(text or "") for chunk in self.parts(block) for i in self.ids(chunk)]

    # -- decoding ------------------------------------------------------------
    def spell(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of an id stream, the space in front included."""
        held = bytearray()
        for i in ids:
            if (byte := self.byte_of.get(i)) is not None:
                held.append(byte)
                continue
            if held:
                yield held.decode("utf-8", "shoplens-bytewise")
                held.clear()
            yield self.text[i]
        if held:
            yield held.decode("utf-8", "shoplens-bytewise")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids without the space that encoding puts in front; control ids have none."""
        ids = list(ids)
        text = "".join(self.spell(ids))
        first = next((self.kind[i] for i in ids if self.kind[i] != CONTROL), None)
        return text[1:] if first == NORMAL and text.startswith(" ") else text

    # -- many texts ------------------------------------------------------------
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined symbol of pairs; rank ``_NONE`` where they do not join."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        hit = self._key[at] == key
        return np.where(hit, self._rank[at], _NONE), self._join[at]

    def agendas(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of many chunks, flat, and the end of each chunk's.

        The agendas of all chunks lie in one array, by chunk and place; each step joins
        every chunk's best pair, the leftmost of the best rank, and brings its neighbours'
        ranks up to date.  Chunks without a pair drop out.
        """
        sizes = np.array([len(c) for c in chunks], np.int64)
        flat = "".join(chunks)
        codes, where = np.unique(np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
        ids = np.array([self.symbol.get(chr(c), self.size - 1) for c in codes.tolist()], np.int64)[where]
        out, alive = ids.copy(), np.ones(len(ids), bool)
        owner = np.repeat(np.arange(len(chunks)), sizes)
        at, own = np.arange(len(ids)), owner
        ranks, joins = np.full(len(ids), _NONE), np.zeros(len(ids), np.int64)
        ranks[:-1], joins[:-1] = self._ranks(ids[:-1], ids[1:])
        ranks[:-1][own[1:] != own[:-1]] = _NONE
        while len(at):
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            counts = np.diff(np.append(starts, len(own)))
            least = np.minimum.reduceat(ranks, starts)
            done = least == _NONE
            if done.any():
                gone = np.repeat(done, counts)
                out[at[gone]] = ids[gone]
                at, own, ids, ranks, joins = at[~gone], own[~gone], ids[~gone], ranks[~gone], joins[~gone]
                least, counts = least[~done], counts[~done]
                if not len(at):
                    break
            best = np.flatnonzero(ranks == np.repeat(least, counts))
            hit = best[np.concatenate(([True], own[best[1:]] != own[best[:-1]]))]
            ids[hit] = joins[hit]
            alive[at[hit + 1]] = False
            keep = np.ones(len(at), bool)
            keep[hit + 1] = False
            spot = hit - np.arange(len(hit))                  # places of the joined symbols among those kept
            at, own, ids, ranks, joins = at[keep], own[keep], ids[keep], ranks[keep], joins[keep]
            near = np.concatenate((spot[spot > 0] - 1, spot))
            after = np.minimum(near + 1, len(at) - 1)
            rank, join = self._ranks(ids[near], ids[after])
            rank[(own[near] != own[after]) | (after == near)] = _NONE
            ranks[near], joins[near] = rank, join
        return np.where(out == self.size - 1, -1 - np.arange(len(out)), out)[alive], \
            np.cumsum(np.bincount(owner[alive], minlength=len(chunks)))

    def learn(self, chunks: list[str]) -> None:
        """Put short chunks into the table, all agendas together."""
        flat = "".join(chunks)
        if not flat:
            return
        symbols, ends = self.agendas(chunks)
        ids = [self._ids[s] if s >= 0 else self._bytes(flat[-1 - s]) for s in symbols.tolist()]
        text = [self._text[s] if s >= 0 else flat[-1 - s] for s in symbols.tolist()]
        start = 0
        for chunk, end in zip(chunks, ends.tolist()):
            self.table[chunk] = ",".join(ids[start:end]), "".join(text[start:end])
            start = end

    def clear(self) -> None:
        self.table, self.old = Table(self), Table(self)

    def prepare(self, parts: list[list[str]]) -> None:
        """Make the table hold all short chunks of some parts."""
        if len(self.table) > TABLE:
            self.old, self.table = self.table, Table(self)
        table, old, new = self.table, self.old, []
        for chunk in set().union(*parts) - table.keys():
            if (found := old.get(chunk)) is not None:
                table[chunk] = found
            elif len(chunk) <= SHORT:
                new.append(chunk)
        self.learn(new)

    def blocks(self, text: str) -> Iterator[str]:
        """The text, marked, in blocks that end where a chunk does."""
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        at = 0
        while self._by_word and len(marked) - at > BLOCK:
            cut = marked.find(SPACE, at + BLOCK)
            while cut > 0 and marked[cut - 1] == SPACE:
                cut = marked.find(SPACE, cut + 1)
            if cut < 0:
                break
            yield marked[at:cut]
            at = cut
        yield marked[at:]

    def parts(self, block: str) -> list[str]:
        words = self._words.findall(block)
        if max(map(len, words), default=0) <= SHORT:
            return words
        return [c for w in words for c in ([w] if len(w) <= SHORT else self.cut(w))]

    def run(self, texts: list[str]) -> Iterator[tuple[str, str, bool]]:
        """(ids joined by commas, text that they spell, whether it is the text's last) of all blocks in order."""
        for group in block_groups(texts, self.blocks, GROUP_BYTES):
            parts = [self.parts(block) for _, block, _ in group]
            self.prepare(parts)
            for (_, _, last), part in zip(group, parts):
                found = list(map(self.table.__getitem__, part))
                yield ",".join([f[0] for f in found]), "".join([f[1] for f in found]), last

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the comma-joined ids, SHA-256 of the decoded text, of each text."""
        ids_sha, text_sha, count = hashlib.sha256(), hashlib.sha256(), 0
        for joined, spelt, last in self.run(texts):
            if joined:
                ids_sha.update(("," if count else "").encode() + joined.encode())
                text_sha.update((spelt if count else spelt[spelt.startswith(" "):]).encode("utf-8", "surrogatepass"))
                count += joined.count(",") + 1
            if last:
                yield count, ids_sha.hexdigest(), text_sha.hexdigest()
                ids_sha, text_sha, count = hashlib.sha256(), hashlib.sha256(), 0

    def encoded(self, texts: list[str]) -> Iterator[tuple[int, list[int], str]]:
        """Number of ids, ids and decoded text of each text."""
        ids: list[int] = []
        for joined, _, last in self.run(texts):
            if joined:
                ids += map(int, joined.split(","))
            if last:
                yield len(ids), ids, self.decode(ids)
                ids = []


class Table(dict):
    """Chunk -> (ids joined by commas, text that they spell); what is not kept is worked out each time."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, chunk: str) -> tuple[str, str]:
        ids = self.pieces.ids(chunk)
        return ",".join(map(str, ids)), "".join(self.pieces.spell(ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


@functools.lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def tokenize(docs: DataFrame, path: str, text_col: str = "text", digest_only: bool = False, check: bool = False) -> DataFrame:
    """The rows of ``docs`` with their ids and the text decoded from them.

    Adds ``piece_ids`` (array of int), ``piece_text``, ``piece_n`` (long); with
    ``digest_only`` the text column goes and the two large ones are replaced by
    ``piece_ids_sha256`` and ``piece_text_sha256``.  ``check`` adds ``piece_checked``:
    the library has the same ids and decodes them to the same text.  ``path`` must be
    readable on every executor.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    ensure_checkpoint_dir(docs.sparkSession)
    added = {"piece_n", "piece_ids", "piece_text", "piece_ids_sha256", "piece_text_sha256", "piece_checked"}
    kept = [f for f in docs.schema.fields if f.name not in added]
    docs = docs.select(*[f"`{f.name}`" for f in kept])
    extra = [T.StructField("piece_n", T.LongType())]
    if digest_only:
        kept = [f for f in kept if f.name != text_col]
        extra += [T.StructField("piece_ids_sha256", T.StringType()), T.StructField("piece_text_sha256", T.StringType())]
    else:
        extra += [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("piece_text", T.StringType())]
    if check:
        extra.append(T.StructField("piece_checked", T.BooleanType()))
    names = [f.name for f in kept]
    kinds = {T.LongType: pa.int64(), T.StringType: pa.string(), T.ArrayType: pa.list_(pa.int32()), T.BooleanType: pa.bool_()}

    def same(row: tuple, text: str) -> bool:
        model = library(path)
        ids = model.encode(text)
        if not digest_only:
            return (ids, model.decode(ids)) == row[1:]
        return row == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(model.decode(ids).encode()).hexdigest())

    @lean
    def run(batches):
        pieces = load(path)
        try:
            for batch in batches:
                columns: list[list] = [[] for _ in extra]
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                for row, text in zip(pieces.digests(texts) if digest_only else pieces.encoded(texts), texts):
                    for column, value in zip(columns, (*row, same(row, text)) if check else row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in names] + [pa.array(c, kinds[type(f.dataType)]) for c, f in zip(columns, extra)],
                    names=names + [f.name for f in extra])
        finally:
            pieces.clear()

    return docs.mapInArrow(run, T.StructType([*kept, *extra]))
