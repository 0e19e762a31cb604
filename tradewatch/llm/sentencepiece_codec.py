"""Offset-preserving encoding and decoding with a SentencePiece BPE model.

Normalisation walks the text by the longest prefix found in the model's compiled character
map (a double-array trie over UTF-8 bytes) and notes, for every byte it writes, the source
byte it stands for. The normalised text is merged by the model's scores, and each piece is
projected through that alignment to a byte span of the original text. Decoding joins the
pieces again, byte pieces included.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import ship_package

SPACE = chr(0x2581)  # fixed value: the escaped blank of the model format
SPACE_BYTES = SPACE.encode()
CACHE_CHUNKS = 500_000
CACHE_LENGTH = 64
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values: piece types


class CharMap:
    """Longest-prefix look-up in a compiled character map.

    Layout: trie size in bytes (little-endian 32 bits), the trie's units, then the
    replacements, each ended by a zero byte; a leaf's value is its replacement's place.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size :]

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of the longest mapped prefix of ``data[at:]`` and that prefix's length."""
        if not self.units:
            return None
        found, node = None, self._jump(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units) or self.units[node] & 0x800000FF != data[i]:
                break
            unit = self.units[node]
            node ^= self._jump(unit)
            if unit >> 8 & 1:
                found = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(b"\0", found[0])], found[1]


class Encoded(NamedTuple):
    ids: list[int]
    begin: np.ndarray  # byte span of each id in the UTF-8 of the original text
    end: np.ndarray


def _char_len(byte: int) -> int:
    return 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


class Codec:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            m = pb.ModelProto.FromString(f.read())
        if m.trainer_spec.model_type != 2 or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with blanks before words is expected")
        if len(m.denormalizer_spec.precompiled_charsmap):
            raise ValueError("a denormalising map is not supported")
        spec = m.normalizer_spec
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.byte_fallback, self.unk_surface = m.trainer_spec.byte_fallback, m.trainer_spec.unk_surface
        self.pieces = [p.piece for p in m.pieces]
        self.types = [p.type for p in m.pieces]
        kept = [(i, p) for i, p in enumerate(m.pieces) if p.type in (NORMAL, USER, UNUSED)]
        if any(p.type in (USER, UNUSED) for _, p in kept):
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids = {p.piece: i for i, p in kept}
        self.scores = {p.piece: p.score for _, p in kept}
        self.unk = self.types.index(UNKNOWN)
        self.bos = self.pieces.index(m.trainer_spec.bos_piece)
        self.eos = self.pieces.index(m.trainer_spec.eos_piece)
        self.byte_ids = [self.pieces.index(f"<0x{b:02X}>") for b in range(256)] if self.byte_fallback else []
        # A character outside every longer piece stands alone, and no piece has a blank after
        # another character: so merges never cross these borders and chunks can be cached.
        joins = {c for p in self.ids if len(p) > 1 for c in p} - {SPACE}
        inside = "".join(map(re.escape, sorted(joins)))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or not inside:
            self.chunks = re.compile(r"(?s).+")
        else:
            self.chunks = re.compile(f"(?s){SPACE}*[{inside}]+|{SPACE}+|[^{inside}{SPACE}]")
        self.cache: dict[str, tuple[list[int], list[int]]] = {}
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    # ------------------------------------------------------------ normalisation
    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its UTF-8 bytes (and its end) the source byte it comes from."""
        data = text.encode("utf-8", "replace")
        if not data:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze and self.escape:
            # No map: blanks become three bytes, all else is copied.
            raw = np.frombuffer(data, np.uint8)
            align = np.repeat(np.arange(len(raw) + 1), np.append(np.where(raw == 0x20, len(SPACE_BYTES), 1), 1))
            out = text.replace(" ", SPACE)
            if self.dummy:
                out, align = SPACE + out, np.concatenate([np.zeros(len(SPACE_BYTES), np.int64), align])
            return out, align
        return self._normalize_mapped(data)

    def _normalize_mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        blank = SPACE_BYTES if self.escape else b" "
        out, align, at = bytearray(), [], 0

        def prefix(at: int) -> tuple[bytes, int]:
            if found := self.map.longest(data, at):
                return found
            n = _char_len(data[at])
            return data[at : at + n], n

        if self.squeeze:
            while at < len(data) and (p := prefix(at))[0] == b" ":
                at += p[1]
            if at >= len(data):
                return "", np.array([at])
        if self.dummy:
            out += blank
            align += [at] * len(blank)
        after_blank = self.squeeze
        while at < len(data):
            piece, n = prefix(at)
            if after_blank:
                piece = piece.lstrip(b" ")
            if piece:
                after_blank = self.squeeze and piece.endswith(b" ")
                piece = piece.replace(b" ", blank)
                out += piece
                align += [at] * len(piece)
            at += n
        if self.squeeze:
            while out.endswith(blank):
                del out[-len(blank) :]
                at = align[len(out)]
                del align[len(out) :]
        return out.decode("utf-8"), np.array([*align, at])

    # ------------------------------------------------------------ merging
    def _merge(self, chunk: str) -> tuple[list[int], list[int]]:
        """Ids of a chunk and the normalised bytes each covers; byte pieces of a character
        cover it with the first of them."""
        sym: list[str] = list(chunk)
        n, scores = len(sym), self.scores
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(-s, i, sym[i] + sym[i + 1]) for i in range(n - 1) if (s := scores.get(sym[i] + sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i]
            if not sym[i] or j < 0 or sym[i] + sym[j] != both:
                continue  # stale
            sym[i], sym[j] = both, ""
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (s := scores.get(both + sym[k])) is not None:
                    heapq.heappush(heap, (-s, i, both + sym[k]))
            if (h := left[i]) >= 0 and (s := scores.get(sym[h] + both)) is not None:
                heapq.heappush(heap, (-s, h, sym[h] + both))
        ids, sizes = [], []
        for s in sym:
            if not s:
                continue
            b = s.encode()
            if (i := self.ids.get(s)) is not None:
                ids.append(i)
                sizes.append(len(b))
            elif self.byte_fallback:
                ids += [self.byte_ids[x] for x in b]
                sizes += [len(b)] + [0] * (len(b) - 1)
            else:
                ids.append(self.unk)
                sizes.append(len(b))
        return ids, sizes

    def encode(self, text: str | None, begin: bool = True, end: bool = True) -> Encoded:
        """Ids with their byte spans; begin and end ids span nothing. Null counts as empty.

        Bytes of one character that fall back share its span: the first has it, the others
        are empty at its end. Unknown neighbours become one id, as the format asks.
        """
        norm, align = self.normalize(text or "")
        ids: list[int] = []
        sizes: list[int] = []
        cache = self.cache
        for chunk in self.chunks.findall(norm):
            got = cache.get(chunk)
            if got is None:
                got = self._merge(chunk)
                # Frequent chunks come early: a full cache keeps what it has.
                if len(chunk) <= CACHE_LENGTH and len(cache) < CACHE_CHUNKS:
                    cache[chunk] = got
            ids += got[0]
            sizes += got[1]
        if not self.byte_fallback:
            for i in range(len(ids) - 1, 0, -1):
                if ids[i] == ids[i - 1] == self.unk:
                    sizes[i - 1] += sizes.pop(i)
                    del ids[i]
        edge = align[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)]
        first, last = edge[:-1], edge[1:]
        if begin:
            ids, first, last = [self.bos, *ids], np.append(0, first), np.append(0, last)
        if end:
            stop = align[-1]
            ids, first, last = [*ids, self.eos], np.append(first, stop), np.append(last, stop)
        return Encoded(ids, first, last)

    # ------------------------------------------------------------ decoding
    def _surface(self, i: int) -> bytes:
        kind = self.types[i]
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if kind == UNKNOWN:
            return self.unk_surface.encode()
        return self.pieces[i].replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids vanish, the blank that begins the text is the dummy one."""
        data = b"".join([self.surface[i] for i in ids])
        if self.dummy or self.squeeze:
            first = next((i for i in ids if self.types[i] != CONTROL), None)
            if first is not None and self.types[first] == NORMAL and data[:1] == b" ":
                data = data.lstrip(b" ") if self.squeeze else data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return _decode_bytewise(data)


def _decode_bytewise(data: bytes) -> str:
    """Every byte outside a well-formed character becomes one replacement character."""
    out, at = [], 0
    while at < len(data):
        n = _char_len(data[at])
        try:
            out.append(data[at : at + n].decode("utf-8"))
            at += n
        except UnicodeDecodeError:
            out.append(chr(0xFFFD))
            at += 1
    return "".join(out)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per Python worker and model."""
    return Codec(path)


def encode_docs(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ids (with begin and end), byte spans (begin, end) and decoded text.

    A null or empty text has the begin and end ids and decodes to an empty text; null ids,
    repeated rows and equal ids keep their rows; an empty table gives an empty result; other
    columns are not read. Map-only, ``path`` is read by each worker for itself.
    """
    return _map(docs, path, id_col, text_col, False)


def codec_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode_docs`, but with the digests of what it would return: n_tokens, ids_sha256
    (ids as little-endian unsigned 32 bits), decoded_sha256 and spans_sha256 (begin, end pairs alike)."""
    return _map(docs, path, id_col, text_col, True)


def _map(docs: DataFrame, path: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    longs, string = T.ArrayType(T.LongType()), T.StringType()
    cols = (
        [("n_tokens", T.LongType()), ("ids_sha256", string), ("decoded_sha256", string), ("spans_sha256", string)]
        if digest
        else [("ids", longs), ("span_begin", longs), ("span_end", longs), ("decoded", string)]
    )
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in cols]])

    def row(c: Codec, text: str | None) -> tuple:
        e = c.encode(text)
        back = c.decode(e.ids)
        if not digest:
            return e.ids, e.begin.tolist(), e.end.tolist(), back
        sha = lambda b: hashlib.sha256(b).hexdigest()
        spans = np.stack([e.begin, e.end], axis=1).astype("<u4")
        return len(e.ids), sha(np.array(e.ids, "<u4").tobytes()), sha(back.encode("utf-8")), sha(spans.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string()] if digest else [pa.list_(pa.int64())] * 3 + [pa.string()]
        for b in batches:
            rows = [row(c, t.as_py()) for t in b.column(1)]
            got = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *got], names=out.names)

    ship_package(docs.sparkSession)
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias(id_col), text.alias("__text")).mapInArrow(run, out)
