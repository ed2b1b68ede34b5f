"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

Text is split by a pattern; each piece is encoded by itself. Every byte prefix of a piece
has exactly one token that can end its encoding: the token t for which the last token of
the prefix before t, followed by t, is left alone by the merges. One array of last tokens
therefore holds the encodings of all prefixes: an append only adds entries, and after an
edit entries are computed anew until they agree with the old ones for the length of the
longest token. Whether two tokens may stand together is found by merging their bytes
and remembered.

The vocabulary (under 1 MB) is broadcast as its rank file; a worker builds its tables once.
"""

from __future__ import annotations

import base64
import itertools
import os
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import bounded

#: Remembered pairs and pieces of a worker, and the characters of a remembered piece, at most.
PAIRS, PIECES, PIECE_CHARS = 1 << 20, 3 << 18, 64
#: Characters that are split together, and pieces of a longer text at a time.
TEXT_CHARS, LONG_PIECES = 1 << 20, 1 << 18
#: Tokens after which a batch of results is handed on.
BATCH_TOKENS = 1 << 20
#: A rank file larger than this is no vocabulary to broadcast.
RANK_BYTES = 64 << 20


class Vocabulary:
    """Tokens with ranks, and the pattern that splits text; ranks are token ids from 0."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.rank_file, self.pattern = rank_file, pattern
        self._ready = False

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a rank file on the driver: a base64 token and its rank on each line."""
        with open(path, "rb") as file:
            content = file.read(RANK_BYTES + 1)
        if len(content) > RANK_BYTES:
            raise ValueError("the rank file is too large to be broadcast")
        return cls(content, pattern)

    def __getstate__(self):
        return {"rank_file": self.rank_file, "pattern": self.pattern, "_ready": False}

    def ready(self) -> Vocabulary:
        """Build the tables, once in a worker."""
        if self._ready:
            return self
        self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.rank_file.splitlines())}
        if missing := [b for b in range(256) if bytes([b]) not in self.ids]:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        #: every end of a token: its id, or -1 where it is no token itself
        self.ends: dict[bytes, int] = {}
        for token, rank in self.ids.items():
            self.tokens[rank] = token
            self.ends[token] = rank
            for i in range(1, len(token)):
                self.ends.setdefault(token[i:], -1)
        self.longest = max(map(len, self.ids))
        self.split = regex.compile(self.pattern)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self._ready = True
        return self

    def merged(self, data: bytes) -> list[int]:
        """Encoding by merging the lowest rank first, for the few bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ids.get(a + b, len(self.tokens)) for a, b in zip(parts, parts[1:])]
            low = min(ranks)
            if low == len(self.tokens):
                break
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: begin a piece)."""
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            alone = before < 0
            want = [token] if alone else [before, token]
            known = self.merged((b"" if alone else self.tokens[before]) + self.tokens[token]) == want
            self.pairs[before, token] = known
        return known

    def extend(self, data: bytes, last: list[int], until: int) -> None:
        """Append to ``last``, the last tokens of the prefixes of ``data``, those up to ``until`` bytes."""
        ends, pairs, fits = self.ends.get, self.pairs.get, self.fits
        for end in range(len(last), until + 1):
            begin, found = end, []
            while begin:
                token = ends(data[begin - 1 : end])
                if token is None:
                    break
                begin -= 1
                if token >= 0:
                    found.append((last[begin], token))
            for pair in reversed(found):
                known = pairs(pair)
                if fits(*pair) if known is None else known:
                    last.append(pair[1])
                    break
            else:
                raise AssertionError("a prefix without a last token")

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is a token is that token, whatever the merges make of it."""
        whole = self.ids.get(data)
        return [whole] if whole is not None else Prefixes(self, data).encoding()

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of ``pieces``, encoded in byte order: neighbours share the last tokens of their common prefix."""
        out, row = {}, Prefixes(self)
        for data, piece in sorted((p.encode(), p) for p in pieces):
            whole = self.ids.get(data)
            if whole is None:
                row.turn_into(data)
            out[piece] = array("i", [whole] if whole is not None else row.encoding()).tobytes()
        return out

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text as 32-bit integers, one after the other."""
        known, rows, fresh = self.pieces, [], set()
        for text in texts:
            rows.append(self.split.findall(text))
            fresh.update(p for p in rows[-1] if p not in known)
        if fresh:
            short = self.learn(fresh)
            if len(known) + len(short) > PIECES:
                known.clear()
                short |= self.learn({p for row in rows for p in row if p not in short})
            known.update((p, ids) for p, ids in short.items() if len(p) <= PIECE_CHARS)
            return [b"".join([short[p] if p in short else known[p] for p in row]) for row in rows]
        return [b"".join([known[p] for p in row]) for row in rows]

    def packed_long(self, text: str) -> bytes:
        """As :meth:`packed`, some pieces at a time."""
        matches, out = (m.group() for m in self.split.finditer(text)), []
        while some := list(itertools.islice(matches, LONG_PIECES)):
            new = self.learn(set(some))
            out.append(b"".join([new[p] for p in some]))
        return b"".join(out)

    def table(self) -> pa.Array:
        return pa.array(self.tokens, pa.large_binary())


class Prefixes:
    """Last tokens of every byte prefix of a piece; entry 0 is the empty prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary.ready(), b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last, len(self.data))

    def turn_into(self, data: bytes) -> None:
        """Another piece: what it has in common with this one's beginning stays."""
        shared = len(os.path.commonprefix([self.data, data]))
        del self.last[shared + 1 :]
        self.data = data
        self.vocabulary.extend(data, self.last, len(data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns how many entries were computed."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[: start + 1]
        settled, edited, computed = 0, start + len(new), 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)
            computed += 1
            settled = settled + 1 if end > edited and self.last[end] == old[end - shift] else 0
            if settled >= self.vocabulary.longest:
                self.last += old[end - shift + 1 :]
                break
        return computed

    def encoding(self, end: int | None = None) -> list[int]:
        """Tokens of ``data[:end]``, of all by default."""
        out, end = [], len(self.data) if end is None else end
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


def edited(vocabulary: Vocabulary, text: str, ids: np.ndarray, start: int, stop: int, new: str, ahead: int = 2) -> np.ndarray:
    """Ids of ``text`` with ``new`` in place of ``text[start:stop]``, from its old ``ids``.

    Pieces that end ``ahead`` characters before the edit stay (the pattern decides a piece
    by so many characters behind it), and so do all from the first one behind the edit
    that begins where an old one did. Only those between are encoded.
    """
    vocabulary.ready()
    lengths = np.fromiter(map(len, vocabulary.tokens), np.int64, len(vocabulary.tokens))
    ends = np.concatenate([[0], np.cumsum(lengths[ids])])  # in bytes
    bounds = [0] + [m.end() for m in vocabulary.split.finditer(text)]
    if bounds[-1] != len(text):
        raise ValueError("the pattern leaves out part of the text")
    head = max((b for b in bounds if b + ahead <= start), default=0)
    result = text[:start] + new + text[stop:]
    shift, behind, old = len(new) - (stop - start), start + len(new), set(bounds)
    middle, at = [], head
    while at < len(result) and not (at >= behind and at - shift in old):
        at = vocabulary.split.match(result, at).end()
        middle.append(at)
    cut = [head, *middle]
    inner = [np.array(vocabulary.encode_piece(result[a:b].encode()), np.int32) for a, b in zip(cut, cut[1:])]
    first = int(np.searchsorted(ends, len(text[:head].encode())))
    rest = int(np.searchsorted(ends, len(text[: at - shift].encode())))
    return np.concatenate([ids[:first], *inner, ids[rest:]]).astype(np.int32)


def _lists(keys: list, packed: list[bytes], kind: pa.DataType, name: str) -> pa.RecordBatch:
    limits = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(limits), pa.array(np.frombuffer(b"".join(packed), np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), ids], [name, "tokens"])


def _flushed(rows, kind: pa.DataType, name: str):
    """``(key, packed ids)`` as batches of about ``BATCH_TOKENS`` tokens."""
    keys, packed, held = [], [], 0
    for key, ids in rows:
        keys.append(key)
        packed.append(ids)
        held += len(ids) // 4
        if held >= BATCH_TOKENS:
            yield _lists(keys, packed, kind, name)
            keys, packed, held = [], [], 0
    if keys:
        yield _lists(keys, packed, kind, name)


def _encoder(shared, name: str):
    def run(batches):
        vocabulary = shared.value.ready()

        def rows(batch):
            held, chars = [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                key, text = key.as_py(), text.as_py() or ""
                if len(text) > TEXT_CHARS:
                    yield key, vocabulary.packed_long(text)
                    continue
                held.append((key, text))
                chars += len(text)
                if chars > TEXT_CHARS:
                    yield from zip([k for k, _ in held], vocabulary.packed([t for _, t in held]))
                    held, chars = [], 0
            yield from zip([k for k, _ in held], vocabulary.packed([t for _, t in held]))

        for batch in batches:
            yield from _flushed(rows(batch), batch.schema.types[0], name)

    return run


def _editor(shared, name: str):
    def run(batches):
        vocabulary = shared.value.ready()

        def one(row):
            ids = np.array(row["tokens"] or [], np.int32)
            text = b"".join(vocabulary.tokens[i] for i in ids).decode()
            begin = min(max(row["start"] or 0, 0), len(text))
            end = min(max(row["stop"] or 0, begin), len(text))
            return row["key"], edited(vocabulary, text, ids, begin, end, row["new"] or "").tobytes()

        for batch in batches:
            rows = ({c: batch.column(c)[i].as_py() for c in batch.schema.names} for i in range(batch.num_rows))
            yield from _flushed(map(one, rows), batch.schema.field("key").type, name)

    return run


def _decoder(shared, at: int):
    def run(batches):
        table = shared.value.ready().table()
        for batch in batches:
            column = batch.column(at)
            limits = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
            ids = column.flatten()
            row = 0
            while row < len(column):  # some million tokens at a time
                upto = max(row + 1, int(np.searchsorted(limits, limits[row] + 4 * BATCH_TOKENS, "right")) - 1)
                taken = table.take(ids[int(limits[row]) : int(limits[upto])])
                _, ends, data = taken.buffers()
                ends = np.frombuffer(ends, np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
                ends = ends[limits[row : upto + 1] - limits[row]]
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), upto - row, [None, pa.py_buffer(ends.tobytes()), data or pa.py_buffer(b"")])
                rest = [batch.column(i).slice(row, upto - row) for i in range(batch.num_columns) if i != at]
                names = [n for i, n in enumerate(batch.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, whole.cast(pa.binary())], [*names, "decoded"])
                row = upto

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, tokens`` for every row: the ids of its whole text, without special tokens.

    A null or empty text has no tokens. Repeated rows and null keys come back as they are,
    other columns do not; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.select(key).schema[0].dataType.simpleString()
    return bounded(docs).select(key, text).mapInArrow(_encoder(shared, key), f"`{key}` {kind}, tokens array<int>")


def edit(encoded: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``key, tokens`` after an edit of every row of ``key, tokens, start, stop, new``.

    ``new`` takes the place of the code points from ``start`` to ``stop`` of the decoded
    text; places outside it count as its nearest end, nulls as 0 and as the empty text. Only
    pieces near the edit are encoded. Rows as in :func:`encode`.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    kind = encoded.select(key).schema[0].dataType.simpleString()
    rows = bounded(encoded).select(F.col(key).alias("key"), "tokens", "start", "stop", "new")
    return rows.mapInArrow(_editor(shared, key), f"`{key}` {kind}, tokens array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary, tokens: str = "tokens") -> DataFrame:
    """``encoded`` with the bytes of its tokens, ``decoded``, in place of the tokens.

    No tokens (or null) are no bytes. A column that is already named ``decoded`` gives way.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    rows = bounded(encoded.drop("decoded") if tokens != "decoded" else encoded)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != tokens)
    return rows.mapInArrow(_decoder(shared, rows.columns.index(tokens)), f"{schema + ', ' if schema else ''}decoded binary")
