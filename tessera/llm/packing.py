"""Token packing: bounded-space online best fit, then a merge of leftovers."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StructField, StructType)
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import store, worker_cache

#: A space between two characters that no definition of white space includes:
#: byte-level BPE always starts a new piece at such a space.
GAP = re.compile(r"(?<=\S) (?=\S)")
#: Marks that may follow a word and form one piece of their own.
MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: Entries of each generation of a worker's cache of encoded parts (a tenth of it
#: for other pieces), and the longest such part.
CACHE, CACHED_CHARS = 650_000, 64


def byte_names() -> dict[int, str]:
    """The printable stand-ins that byte-level BPE files use for bytes (format
    of the vocabulary): printable Latin-1 for itself, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _bytes(ids: list[int]) -> bytes:
    """Little-endian 32-bit ids."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Recent(dict):
    """A bounded cache in two generations of what ``learn`` gives for a key: when
    the young one (this dict) is full it becomes the old one, and what is asked
    for again comes back, so that frequent entries are never learned twice.
    Looking up a known key is a plain dict's lookup."""

    def __init__(self, learn: Callable[[str], bytes], share: float = 1):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.learn, self.share = learn, share

    @property
    def young(self) -> dict[str, bytes]:
        return self

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.learn(key)
        if len(key) <= CACHED_CHARS and "\n" not in key:  # two words and a line break seldom meet again
            self[key] = out
        return out

    def age(self) -> None:
        if len(self) > CACHE * self.share:
            self.old = {}  # its entries go before the copy
            self.old = dict(self)
            self.clear()


class _NoPart(Exception):
    """What lies between two spaces is empty or has white space at an end."""


class Encoder:
    """Token ids of whole texts by a byte-level BPE file.

    A text that holds an added token (``<|endoftext|>``) goes through the whole
    tokenizer, where it is one id.  Any other text is cut at single spaces, where
    a new piece must start, and the ids of each part are kept.  A part of letters
    and marks is the part without the marks, a piece that goes straight to the
    tokenizer's model, and a piece of marks; also on both sides of a line break.
    All other parts go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = byte_names()
        self.parts, self.words = Recent(self._part), Recent(self._piece, 0.1)
        self.line = self._piece("\n")

    def _encode(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece; a leading space belongs to it."""
        # Printable ASCII stands for itself.
        rest = piece[1:]
        if piece[0] == " " and rest.isascii() and rest.isalpha():
            named = self.names[32] + rest
        else:
            named = piece.encode().decode("latin-1").translate(self.names)
        return _bytes([t.id for t in self.tokenizer.model.tokenize(named)])

    def _part(self, part: str) -> bytes:
        """Ids of a space and a part that has no white space at either end."""
        word = part.rstrip(MARKS)
        if word.isalpha():
            if len(word) == len(part):
                return self._piece(" " + part)
            return self.parts[word] + self.words[part[len(word):]]
        if not part or part[0].isspace() or part[-1].isspace():
            raise _NoPart
        # One line break between two parts of letters and marks is a piece of its own.
        end, line, start = part.partition("\n")
        word = start.rstrip(MARKS)
        if not line or not word.isalpha() or not end.rstrip(MARKS).isalpha():
            return self._encode(" " + part)
        out = self.parts[end] + self.line + self.words[word]
        return out + self.words[start[len(word):]] if len(word) < len(start) else out

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Little-endian 32-bit ids of each text."""
        for text in texts:
            if any(token in text for token in self.added):
                yield np.frombuffer(self._encode(text), dtype="<u4")
                continue
            self.parts.age()
            self.words.age()
            first, *rest = text.split(" ")
            try:
                if first[-1:].isspace():
                    raise _NoPart
                out = b"".join(map(self.parts.__getitem__, rest))
            except _NoPart:
                first, *rest = GAP.split(text)
                # Only the last of these may have white space at its end.
                last = self._encode(" " + rest.pop()) if rest and rest[-1][-1].isspace() else b""
                out = b"".join(map(self.parts.__getitem__, rest)) + last
            head = self._encode(first) if first else b""
            yield np.frombuffer(head + out, dtype="<u4")


class Packer:
    """Places pieces of at most ``window`` tokens into ``open_windows`` windows.

    A piece goes where it leaves the least room.  When none has room, the
    fullest window is topped up with the piece's front and emitted full; the
    rest of the piece opens the next window.
    """

    def __init__(self, window: int, open_windows: int):
        self.window, self.limit = window, open_windows
        self.open: list[list] = []  # [used, [(row, start, ids), ...]]
        self.full: list[list] = []

    def _add(self, w: list, row, start: int, ids: np.ndarray) -> None:
        w[1].append((row, start, ids))
        w[0] += len(ids)
        if w[0] == self.window:
            self.open.remove(w)
            self.full.append(w[1])

    def place(self, row, start: int, ids: np.ndarray) -> None:
        while len(ids) >= self.window:
            self.full.append([(row, start, ids[: self.window])])
            start, ids = start + self.window, ids[self.window:]
        if not len(ids):
            return
        fits = [w for w in self.open if self.window - w[0] >= len(ids)]
        if fits:
            self._add(max(fits, key=lambda w: w[0]), row, start, ids)
            return
        if len(self.open) == self.limit:
            fullest = max(self.open, key=lambda w: w[0])
            room = self.window - fullest[0]
            self._add(fullest, row, start, ids[:room])
            start, ids = start + room, ids[room:]
        self.open.append([0, []])
        self._add(self.open[-1], row, start, ids)

    def merge(self) -> list[tuple]:
        """Empties the open windows, fullest first, into full ones; returns the
        pieces of the last one, which is not full."""
        last: list[tuple] = []
        used = 0
        for _, pieces in sorted(self.open, key=lambda w: -w[0]):
            for row, start, ids in pieces:
                while len(ids):
                    cut = ids[: self.window - used]
                    last.append((row, start, cut))
                    used += len(cut)
                    start, ids = start + len(cut), ids[len(cut):]
                    if used == self.window:
                        self.full.append(last)
                        last, used = [], 0
        self.open = []
        return last


def _powers(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """The pieces cut into sequences whose lengths are powers of two."""
    left, now, want = sum(len(p[2]) for p in pieces), [], 0
    for row, start, ids in pieces:
        while len(ids):
            want = want or 1 << (left.bit_length() - 1)
            cut = ids[:want]
            now.append((row, start, cut))
            start, ids, want, left = start + len(cut), ids[len(cut):], want - len(cut), left - len(cut)
            if not want:
                yield now
                now = []


def _schema(id_type) -> StructType:
    return StructType([
        StructField("doc_id", id_type), StructField("start", LongType()), StructField("length", LongType()),
        StructField("ids_crc32", LongType()), StructField("doc_tokens", LongType()),
        StructField("sequence_id", LongType()), StructField("offset", LongType()),
        StructField("part", IntegerType()), StructField("ids", BinaryType())])


def _rows(sequences, first: int, part: int, keep_ids: bool = False) -> list[tuple]:
    out = []
    for n, pieces in enumerate(sequences):
        offset = 0
        for (doc_id, tokens), start, ids in pieces:
            data = ids.tobytes()
            out.append((doc_id, start, len(ids), zlib.crc32(data), tokens, first + n, offset, part,
                        data if keep_ids else None))
            offset += len(ids)
    return out


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack(docs: DataFrame, tokenizer: str, *, window: int = 1024, open_windows: int = 64,
         end_id: int = 0, merge_parts: int = 1024) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``window`` tokens.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.  A document's tokens are its ids and ``end_id``;
    every token lies in exactly one piece.  ``tokenizer`` is the path of a
    tokenizer file that every executor can read.

    Each partition packs its rows in one pass with ``open_windows`` windows in
    memory, and hands on less than one window of leftovers.  Those meet in
    groups of ``merge_parts`` partitions and fill further sequences; what
    remains of a group is cut at powers of two, which need no padding.  A null
    text is empty (one token), a null id is kept, repeated rows are packed
    each, an empty table gives an empty result, other columns are ignored.  A
    text is encoded whole, so a worker needs memory for its longest text.
    """
    schema = _schema(docs.schema["doc_id"].dataType)
    arrow = to_arrow_schema(schema)

    def first_pass(batches):
        cache = worker_cache("packing")
        encoder = cache.get(tokenizer) or cache.setdefault(tokenizer, Encoder(tokenizer))
        part, made = TaskContext.get().partitionId(), 0
        packer = Packer(window, open_windows)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(texts)):
                packer.place((doc_id, len(ids) + 1), 0, np.concatenate([ids, end]))
                if len(packer.full) >= 2000:
                    yield from _batches(_rows(packer.full, (part << 32) + made, part), arrow)
                    made, packer.full = made + len(packer.full), []
        last = packer.merge()
        yield from _batches(_rows(packer.full, (part << 32) + made, part), arrow)
        yield from _batches(_rows([last], -1, part, keep_ids=True), arrow)

    def merge_pass(batches):
        groups: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                groups.setdefault(r["part"] // merge_parts, []).append(r)
        for group, rows in sorted(groups.items()):
            rows.sort(key=lambda r: (r["part"], r["offset"]))
            packer = Packer(window, 1)
            packer.open = [[0, [((r["doc_id"], r["doc_tokens"]), r["start"], np.frombuffer(r["ids"], "<u4"))
                                for r in rows]]]
            last = packer.merge()
            yield from _batches(_rows([*packer.full, *_powers(last)], (1 << 62) + (group << 32), group), arrow)

    made = store(docs.select("doc_id", "text").mapInArrow(first_pass, schema))
    left = (made.where("sequence_id = -1").withColumn("g", F.floor(F.col("part") / merge_parts))
            .repartition("g").drop("g").mapInArrow(merge_pass, schema))
    return made.where("sequence_id >= 0").union(left).drop("part", "ids")
