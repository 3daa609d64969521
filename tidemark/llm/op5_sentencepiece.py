"""SentencePiece encoding and decoding that keeps byte offsets.

A text is normalised as the model's compiled character map says: at each place the longest prefix that the map has is
replaced, else one character is taken as it is; every byte of the result remembers the span of the original bytes it
came from. Spaces become the visible space, with one put in front. The result is cut where no piece of the vocabulary
can reach over (a visible space after another character), so each segment is encoded on its own, and segments seen
before come from a table of bounded size. Every piece is then projected through the alignment to original byte spans.

Defined results: a null text counts as empty and gives the end id alone; repeated rows are encoded one by one; bytes
that are no UTF-8 count as U+FFFD; other columns are not read. One pass, no shuffle, memory bounded by the longest
text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common

SPACE = "▁"
#: Segments that a worker remembers; beyond that the table starts anew.
REMEMBERED = 500_000
#: Bytes of text whose ids and spans a worker holds at a time.
CHUNK_BYTES = 1 << 20
MODEL = "piece_bpe_32k.model"


def fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message; bytes or int."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 8 if kind == 1 else 4
            yield key >> 3, data[at : at + n]
            at += n


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 keys, and the replacements it points into."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.values = b""
        if blob:
            (n,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{n // 4}I", blob, 4)
            self.values = blob[4 + n :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that text has at a place."""
        units = self.units
        if not units:
            return None
        found = None
        node = units[0]
        pos = (node >> 10) << ((node & (1 << 9)) >> 6)
        for i in range(at, len(text)):
            b = text[i]
            pos ^= b
            if pos >= len(units):
                break
            node = units[pos]
            if node & 0x800000FF != b:
                break
            pos ^= (node >> 10) << ((node & (1 << 9)) >> 6)
            if node & 256:
                start = units[pos] & 0x7FFFFFFF
                found = i + 1 - at, self.values[start : self.values.index(b"\0", start)]
        return found


class Encoder:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            self.serialized = f.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.serialized)
        spec = dict(fields(dict(x for x in fields(self.serialized) if x[0] == 3).get(3, b"")))
        self.map = CharMap(spec.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        # Cutting is exact only if no piece goes on over a visible space, and every segment can be told to the library.
        self.cuts = self.dummy and self.escape and not self.squeeze and not self.map.units and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.segment = re.compile(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+")
        self.known: dict[str, tuple[int, ...]] = {}
        self.end = self.library.eos_id()
        self.opens = np.array([p.startswith(SPACE) for p in pieces])
        #: Bytes of the normalised text that each id stands for; -1: as many as the next character has.
        self.width = np.array([self._width(i, p) for i, p in enumerate(pieces)], np.int64)

    def _width(self, i: int, piece: str) -> int:
        if self.library.is_control(i):
            return 0
        if self.library.is_byte(i):
            return 1
        return -1 if self.library.is_unknown(i) else len(piece.encode())

    def normalised(self, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The text as the vocabulary sees it, and for each of its bytes the original byte span it stands for."""
        raw = text.encode()
        out, spans = bytearray(), []

        def put(piece: bytes, span: tuple[int, int]) -> None:
            piece = piece.replace(b" ", SPACE.encode()) if self.escape else piece
            out.extend(piece)
            spans.extend([span] * len(piece))

        at, stop = 0, len(raw)
        if self.squeeze:
            at = len(raw) - len(raw.lstrip(b" "))
        if at < stop and self.dummy:
            put(b" ", (at, at))
        blank = self.squeeze
        while at < stop:
            hit = self.map.longest(raw, at)
            if hit is None:
                n = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                piece = raw[at : at + n]
            else:
                n, piece = hit
            if self.squeeze:
                while blank and piece.startswith(b" "):
                    piece = piece[1:]
                if piece:
                    blank = piece.endswith(b" ")
            put(piece, (at, at + n))
            at += n
        if self.squeeze:
            tail = (SPACE if self.escape else " ").encode()
            while out.endswith(tail) and len(out) > 0:
                del out[-len(tail) :], spans[-len(tail) :]
        return out.decode(), spans

    def aligned(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """normalised() with the starts and the ends of the spans as arrays; by whole arrays where the map has no key."""
        if self.map.units or self.squeeze:
            normal, spans = self.normalised(text)
            both = np.array(spans, np.int64).reshape(-1, 2)
            return normal, both[:, 0], both[:, 1]
        raw = np.frombuffer(text.encode(), np.uint8)
        lead = (raw & 0xC0) != 0x80
        edges = np.append(np.flatnonzero(lead), len(raw))
        char = np.cumsum(lead) - 1
        space, wide = (SPACE, 3) if self.escape else (" ", 1)
        if wide > 1:
            char = np.repeat(char, np.where(raw == 32, wide, 1))
        starts, ends = edges[char], edges[char + 1]
        normal = text.replace(" ", space)
        if self.dummy and text:
            front = np.zeros(wide, np.int64)
            normal, starts, ends = space + normal, np.concatenate((front, starts)), np.concatenate((front, ends))
        return normal, starts, ends

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The ids, the end id last, and the starts and ends of their original byte spans."""
        normal, starts, ends = self.aligned(text)
        ids = self._ids(text, normal)
        width = self.width[ids]
        if (width < 0).any():
            both = np.array(self.spans(text, ids), np.int64)
            return ids, both[:, 0], both[:, 1]
        if not len(ends):
            none = np.zeros(len(ids), np.int64)
            return ids, none, none
        upto = np.cumsum(width)
        first, last = upto - width, len(ends) - 1
        inside = (width > 0) & (first <= last)
        return ids, np.where(inside, starts[np.minimum(first, last)], ends[-1]), np.where(inside, ends[np.minimum(upto - 1, last)], ends[-1])

    def plain(self, text: str) -> str:
        """normalised() without the alignment, for a map that changes nothing."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def ids(self, text: str) -> list[int]:
        """The ids, the end id last."""
        return self._ids(text, self.plain(text))

    def _ids(self, text: str, normal: str) -> list[int]:
        if not self.cuts:
            return [*self.library.encode(text, num_threads=1), self.end]
        parts = self.segment.findall(normal)
        known = self.known
        if new := set(parts).difference(known):
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(parts)
            self._learn(new)
        out: list[int] = []
        for part in parts:
            out += known[part]
        out.append(self.end)
        return out

    def _learn(self, segments: set[str]) -> None:
        """Words are encoded together, as no piece reaches over the space between; the result is cut where a space opens a piece."""
        words = [p[1:] for p in segments if p[0] == SPACE and p[1:2] not in ("", SPACE)]
        ids = np.array(self.library.encode(" ".join(words), num_threads=1), np.int64)
        starts = np.flatnonzero(self.opens[ids]) if words else []
        if len(starts) == len(words):
            flat, bounds = ids.tolist(), [*map(int, starts), len(ids)]
            for word, a, b in zip(words, bounds, bounds[1:], strict=False):
                self.known[SPACE + word] = tuple(flat[a:b])
        for p in segments.difference(self.known):  # the library puts one visible space in front itself
            self.known[p] = tuple(self.library.encode(p[1:].replace(SPACE, " "), num_threads=1)) if len(p) > 1 else (self.library.piece_to_id(SPACE),)

    def spans(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """Original byte span (start, end) of each id; empty at the end for the end id."""
        normal, align = self.normalised(text)
        raw = normal.encode()
        out, at = [], 0
        library = self.library
        for i in ids:
            if library.is_control(i):
                n = 0
            elif library.is_byte(i):
                n = 1
            elif library.is_unknown(i):
                n = len(raw[at:].decode()[:1].encode())
            else:
                n = len(library.id_to_piece(i).encode())
            if n and at < len(align):
                out.append((align[at][0], align[min(at + n, len(align)) - 1][1]))
            else:
                end = align[-1][1] if align else 0
                out.append((end, end))
            at += n
        return out


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
ENCODED = "ids array<int>, starts array<int>, ends array<int>"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", offsets: bool = True) -> DataFrame:
    """The ids of every text and, unless offsets is false, the original byte span of each."""
    path = path or default_model()

    def make():
        tool = encoder(path)

        def work(texts: list[bytes | None]) -> dict[str, list[Any]]:
            made = [tool.encode((raw or b"").decode("utf-8", "replace")) for raw in texts]
            return {"ids": [ids for ids, _, _ in made], "starts": [a if offsets else [] for _, a, _ in made], "ends": [b if offsets else [] for _, _, b in made]}

        return work

    return common.map_texts(docs, [id_column], text_column, ENCODED, make)


def round_trip_digests(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", tokens: bool = False) -> DataFrame:
    """Number and digest of the ids of every text, the digests of what they decode to and of their original byte spans

    (start and end of each id, as little-endian longs); with tokens, the ids and their original byte spans too."""
    path = path or default_model()

    def make():
        tool = encoder(path)
        name = [str(i) for i in range(tool.library.get_piece_size())].__getitem__

        def work(texts: list[bytes | None]) -> dict[str, list[Any]]:
            out: dict[str, list[Any]] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "ids", "starts", "ends")}
            for raw in texts:
                ids, starts, ends = tool.encode((raw or b"").decode("utf-8", "replace"))
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(_sha256(" ".join(map(name, ids))))
                out["decoded_sha256"].append(_sha256(tool.library.decode(ids)))
                spans = np.column_stack((starts, ends)).astype("<i8")
                out["spans_sha256"].append(hashlib.sha256(spans.tobytes()).hexdigest())
                if tokens:
                    for k, values in (("ids", ids), ("starts", starts), ("ends", ends)):
                        out[k].append(np.asarray(values, np.int32))
            return out

        return work

    return common.map_texts(docs, [id_column], text_column, f"{DIGESTS}, {ENCODED}" if tokens else DIGESTS, make, CHUNK_BYTES if tokens else common.CHUNK_BYTES)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(common.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document with their original byte spans, and the contract's digests."""
    return round_trip_digests(docs, tokens=True).select("doc_id", "n_tokens", "ids", "starts", "ends", "ids_sha256", "decoded_sha256", "spans_sha256")
