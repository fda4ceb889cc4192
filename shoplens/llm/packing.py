"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut into pieces: full windows, and what is left. Left pieces are dealt at
random into groups of a fixed number of tokens; within a group multiway differencing merges partial
partitions so that large sums meet small ones, which gives windows of nearly equal length. If one
exceeds the capacity, the group gets one window more. In one of ``SAND`` documents the left piece is
cut into grains, which come last in the differencing and level what the large pieces left uneven.

Defined results: a null or empty text is its closing id alone; rows repeated with one ``doc_id`` are
packed each on its own; a text of any length is cut, none is shortened; an empty table gives no rows;
other columns are ignored. Every id lies in exactly one piece.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slices, texts, wide, worker_cache, written

WINDOW = 2048
CLOSING_ID = 1
GRAIN, SAND = 64, 8
GROUP_TOKENS = 256 * WINDOW
# Words a Python worker remembers; when full, it starts anew.
REMEMBERED_WORDS = 600_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"


# Letters and signs whose normal form and lower case are plain, and how the vocabulary's splitter
# cuts words of them (fixed values: its contractions and classes, on lower case).
PLAIN = re.compile(r"[\x21-\x7e\xc0-\xff]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class _Parts(dict):
    """Ids of a part of a word, from the tokenizer's own merges."""

    def __init__(self, tokenizer) -> None:
        self.model = tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        # The byte alphabet: printable bytes stand for themselves, the others follow from 256 on.
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(hidden)}

    def __missing__(self, part: str) -> bytes:
        spelt = part.encode().decode("latin-1").translate(self.alphabet)
        ids = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        self[part] = ids
        return ids


class _Words(dict):
    """Ids of a word between white space; words of other letters go to the tokenizer as they are."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.parts = tokenizer, _Parts(tokenizer)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and not ("<|" in text and any(s in text for s in self.special)):
            ids = b"".join(map(self.parts.__getitem__, PARTS.findall(text.lower())))
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


def encoder(path: str) -> Callable[[list[bytes]], Iterator[bytes]]:
    """Function from texts to their ids as little-endian 32-bit numbers, for the word vocabulary.

    Its splitter never lets a token cross ASCII white space, so words, and the parts that the splitter
    cuts them into, are encoded once and remembered. The marks of special tokens count as the
    library takes them by default.
    """
    cache = worker_cache(path)
    if "words" not in cache:
        from tokenizers import Tokenizer

        cache["words"] = _Words(Tokenizer.from_file(path))
    known = cache["words"]

    def encode(batch: list[bytes]) -> Iterator[bytes]:
        for text in batch:
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            if len(known.parts) > REMEMBERED_WORDS:
                known.parts.clear()
            yield b"".join(map(known.__getitem__, text.split()))

    return encode


def cut(ids: bytes, window: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then the rest, in grains for some."""
    n = len(ids) // 4
    full = n - n % window
    for start in range(0, full, window):
        yield start, window
    step = GRAIN if zlib.crc32(ids) % SAND == 0 else window
    for start in range(full, n, step):
        yield start, min(step, n - start)


def pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents; ``ids`` is filled on demand only."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in slices(batches, most_bytes=4 << 20):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts(batch)), strict=True):
                ids += closing
                for start, length in cut(ids, window):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, zlib.crc32(own), len(ids) // 4, own if keep_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indexes of ``sizes`` in ``k`` sets of nearly equal sum (largest differencing method).

    A partial partition keeps its non-empty sets in descending order; the two with the largest
    spread merge, the largest set of one with the smallest of the other.
    """
    ties = count()
    heap = [(-s, next(ties), [(s, i)]) for i, s in sorted(enumerate(sizes), key=lambda x: -x[1])]
    members: dict[int, tuple[int, int]] = {}  # of a merged set: the two it came from
    fresh = count(len(sizes))
    if k == 1:
        return [list(range(len(sizes)))]
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - k)
        free = len(a) - over
        merged = a[:free] + b[: len(b) - over]
        for (x, i), (y, j) in zip(a[free:], reversed(b[len(b) - over :]), strict=True):
            name = next(fresh)
            members[name] = (i, j)
            merged.append((x + y, name))
        merged.sort(reverse=True)
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-spread, next(ties), merged))

    def leaves(name: int) -> list[int]:
        found, stack = [], [name]
        while stack:
            x = stack.pop()
            if x in members:
                stack.extend(members[x])
            else:
                found.append(x)
        return sorted(found)

    return [leaves(name) for _, name in heap[0][2]] if heap else []


def windows_of(sizes: list[int], window: int) -> list[list[int]]:
    """Sets of at most ``window`` tokens; their number rises until the capacity holds."""
    k = -(-sum(sizes) // window)
    while True:
        sets = differencing(sizes, k) if k else []
        if all(sum(sizes[i] for i in s) <= window for s in sets):
            return sets
        k += 1


def assign(cut_pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. The pieces are written once; groups hold a fixed number
    of tokens, so that their number, not their size, grows with the input."""
    stored = written(cut_pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    total = stored.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // GROUP_TOKENS))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece", ignore_index=True)
        sizes = group["length"].to_numpy()
        sets = [[i] for i in np.flatnonzero(sizes == window)]
        rest = np.flatnonzero(sizes != window)
        sets += [[int(rest[i]) for i in s] for s in windows_of(sizes[rest].tolist(), window)]
        sequence, offset = np.zeros(len(group), "int64"), np.zeros(len(group), "int64")
        for number, s in enumerate(sets):
            sequence[s] = (int(group["group"].iloc[0]) << 32) + number
            offset[s] = np.cumsum(sizes[s]) - sizes[s]
        return group.assign(sequence_id=sequence, offset=offset)

    dealt = stored.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    dealt = dealt.repartition(wide(stored.sparkSession, groups, 16), "group")
    schema = ", ".join([PIECES, "piece bigint, group bigint, sequence_id bigint, offset bigint"])
    return dealt.groupBy("group").applyInPandas(solve, schema).drop("piece", "group")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """One row per piece with its place: (doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset)."""
    return assign(pieces(docs, path, window, keep_ids), window)


def sequences(packed: DataFrame, window: int = WINDOW, padding_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the windows themselves, from pieces packed with ``keep_ids``.
    Padded to ``window`` except where the length is a power of two."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.unhex(F.lit("")), lambda a, p: F.concat(a, p["ids"]))
    n = F.sum("length")
    grouped = packed.groupBy("sequence_id").agg(n.alias("n_tokens"), joined.alias("ids"))
    gap = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(window - F.col("n_tokens")).cast("int")
    unit = F.unhex(F.lit(int(padding_id).to_bytes(4, "little").hex()))
    pad = F.aggregate(F.array_repeat(unit, gap), F.unhex(F.lit("")), lambda a, p: F.concat(a, p))
    return grouped.withColumn("ids", F.concat("ids", pad))
