"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at the added special tokens and then into pre-tokens by the vocabulary's
pattern. A pre-token's bytes are its initial symbols; a heap holds the ranks of adjacent
pairs and a doubly linked list the symbols that are left. The lowest rank (the leftmost of
equal ones) is popped and merged until no ranked pair remains. The count is the initial
symbols minus the merges; no identifier is made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import ship_package

# Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# ``regex`` takes \x1c-\x1f for white space, the vocabulary's own library does not; spelled out.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CACHE_WORDS = 500_000  # pre-tokens remembered per Python worker
CACHE_LENGTH = 64  # longer ones are merged each time


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class MergeCounter:
    """Counts tokens under one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE vocabulary without normaliser is expected")
        if pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a prefix space or a missing split pattern is not supported")
        self.symbols = byte_symbols()
        # (left, right) -> (rank, merged)
        self.ranks = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.ranks[a, b] = i, a + b
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens are matched as they stand")
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        pattern = PATTERN.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Initial symbols minus merges of one pre-token."""
        sym: list[str | None] = [self.symbols[b] for b in piece.encode("utf-8", "surrogatepass")]
        n, ranks, merges = len(sym), self.ranks, 0
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r[0], i, r[1]) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, both = heapq.heappop(heap)
            j = right[i]
            # Stale: one of the two symbols has changed since the pair was pushed.
            if sym[i] is None or j < 0 or sym[i] + sym[j] != both or ranks[sym[i], sym[j]][0] != rank:
                continue
            sym[i], sym[j], merges = both, None, merges + 1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if r := ranks.get((both, sym[k])):
                    heapq.heappush(heap, (r[0], i, r[1]))
            if (h := left[i]) >= 0 and (r := ranks.get((sym[h], both))):
                heapq.heappush(heap, (r[0], h, r[1]))
        return n - merges

    def _pieces(self, text: str) -> int:
        total, cache = 0, self.cache
        for p in self.pattern.findall(text):
            n = cache.get(p)
            if n is None:
                n = self.merged(p)
                # Frequent pre-tokens come early: a full cache keeps what it has.
                if len(p) <= CACHE_LENGTH and len(cache) < CACHE_WORDS:
                    cache[p] = n
            total += n
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a text; an added special token inside it is one; null and empty: none."""
        if not text:
            return 0
        if self.added is None:
            return self._pieces(text)
        total, at = 0, 0
        for m in self.added.finditer(text):
            total += self._pieces(text[at : m.start()]) + 1
            at = m.end()
        return total + self._pieces(text[at:] if at else text)


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    """One per Python worker and vocabulary."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows and
    equal ids each keep their row; an empty table gives an empty result; no other column is read.
    ``path`` names the vocabulary file, which every executor reads for itself.
    Map-only: texts go to the Python workers in Arrow batches and three numbers come back.
    """
    id_type = docs.schema[id_col].dataType
    out = T.StructType(
        [T.StructField(id_col, id_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            n = pa.array([c.count(t.as_py()) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=[id_col, "n_bytes", "n_tokens"])

    ship_package(docs.sparkSession)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("__text"))
    return rows.mapInArrow(run, out).withColumn("over_limit", F.col("n_tokens") > limit)
