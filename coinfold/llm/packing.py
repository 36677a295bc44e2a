"""Packing of tokenized documents into sequences of a fixed length.

The plan needs only how many pieces there are of each length, at most ``limit`` numbers whatever
the corpus, so the driver makes it. It takes the longest length left and looks up what fills its
gap exactly: one length, a pair, or three, found over an index of the sums of available lengths,
for as many sequences as the counts allow at once. Where nothing fills the gap exactly, the best
fitting length goes in and the rest of the gap is looked up again. Each step uses up a length, or
all but a few of its pieces, so the plan has a number of lines in proportion to ``limit``.

The executors then place the pieces: a piece's rank among those of its length selects the line
and the sequence. Ranks come from counts per task and length, so a length that a third of all
pieces share is no task's burden.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinfold.llm.common import staged, text_bytes

LIMIT = 2048
TOKENIZER = "byte_bpe_50k.json"
END = b"\0\0\0\0"

# ---- tokens ------------------------------------------------------------------------------


def _byte_letters() -> list[str]:
    """Byte-level vocabularies write bytes as letters: printable ones as they are, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


#: Fixed value: how byte-level tokenizers of this kind cut a text before they merge.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _plain(model: dict):
    """The same merges for the quicker of the two libraries, if the tokenizer file holds byte-level merges and no more:
    bytes first, then each merge's token in the order of the merges, so that ids are ranks."""
    import tiktoken

    cuts = model["pre_tokenizer"] or {}
    plain = (
        model["model"]["type"] == "BPE"
        and not model["normalizer"]
        and cuts.get("type") == "ByteLevel"
        and cuts.get("use_regex", True)
        and not cuts.get("add_prefix_space")
        and not any(model["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    )
    vocabulary = model["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]] if plain else []
    if not plain or any(vocabulary.get(a + b) != 256 + rank for rank, (a, b) in enumerate(merges)):
        return None
    of_letter = {letter: byte for byte, letter in enumerate(_byte_letters())}
    made = {token: bytes(map(of_letter.__getitem__, token)) for token in (*of_letter, *(a + b for a, b in merges))}
    if {vocabulary.get(letter) for letter in of_letter} != set(range(256)):
        return None
    ranks = {text: vocabulary[token] for token, text in made.items()}
    return tiktoken.Encoding("plain", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts by a tokenizer file, as little-endian unsigned 32-bit numbers.

    Byte-level merges are made by the quicker library, whose ids are the same for every code point; a text that
    holds one of the tokenizer's added tokens, and any other kind of tokenizer, goes to the file's own one.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.exists(name):
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(name)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(name, encoding="utf-8") as file:
            self.quick = _plain(json.load(file))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if self.quick is None or any(token in text for token in self.added):
            return self.whole(text)
        return array("I", self.quick.encode_ordinary(text)).tobytes()


@lru_cache(maxsize=2)
def encoder_of(name: str) -> Encoder:
    """One a worker process, for all its tasks."""
    return Encoder(name)


def cut(tokens: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full ones after a first, shorter one."""
    if tokens <= limit:
        return [(0, tokens)]
    ends = range(tokens % limit or limit, tokens + 1, limit)
    return [(max(0, end - limit), end - max(0, end - limit)) for end in ends]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task, nth (among the task's pieces of that length), and ids if wanted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["piece", "start", "length", "ids_crc32", "task", "nth", *["ids"] * keep_ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, task = encoder_of(tokenizer), np.zeros(limit + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            view, rows, made = memoryview(data), [], []
            for row, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                ids = encoder.ids(str(view[a:b], "utf-8", "replace")) + END
                for nth, (start, length) in enumerate(cut(len(ids) // 4, limit)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append(row)
                    made.append((nth, start, length, zlib.crc32(part), task, int(seen[length]), *[part] * keep_ids))
                    seen[length] += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            columns = zip(*made, strict=True) if made else [[]] * len(names)
            arrays = [pa.array(list(x), k) for x, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *arrays], names=["doc_id", *names]
            )

    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return source.mapInArrow(work, shape + ", ids binary" * keep_ids)


# ---- the plan ----------------------------------------------------------------------------


class Complements:
    """Available lengths by count, and for each sum how many pairs of available lengths make it."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.limit = len(counts) - 1
        self.there = (self.left > 0).astype(np.int64)
        self.there[0] = 0
        self.pairs = np.convolve(self.there, self.there)[: self.limit + 1].astype(np.int64)  # ordered pairs

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times
        for x in set(lengths):
            if not self.left[x]:
                self.there[x] = 0
                gone = 2 * self.there  # pairs x, y and y, x
                gone[x] = 1  # and x, x
                self.pairs[x:] -= gone[: self.limit + 1 - x]

    def has(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in set(lengths))

    def pair(self, total: int, held: tuple[int, ...]) -> tuple[int, ...] | None:
        if total < 2 or not self.pairs[total]:
            return None
        low = self.there[1:total]
        for small in np.flatnonzero(low & low[::-1])[: (total + 1) // 2] + 1:
            small = int(small)
            if 2 * small > total:
                return None
            if self.has((*held, total - small, small)):
                return total - small, small
        return None

    def filling(self, gap: int, held: tuple[int, ...]) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``gap``, next to those held; larger ones first."""
        if gap <= 0:
            return () if gap == 0 else None
        if self.there[gap] and self.has((*held, gap)):
            return (gap,)
        if found := self.pair(gap, held):
            return found
        first = np.flatnonzero(self.there[1:gap] & (self.pairs[gap - 1 : 0 : -1] > 0)) + 1
        for big in first[::-1]:
            big = int(big)
            if 3 * big < gap:
                break
            if self.has((*held, big)) and (found := self.pair(gap - big, (*held, big))):
                return (big, *found)
        return None

    def best_fit(self, gap: int, held: tuple[int, ...]) -> int | None:
        for x in np.flatnonzero(self.there[: gap + 1])[::-1]:
            if self.has((*held, int(x))):
                return int(x)
        return None


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Lines (lengths, sequences): so many sequences hold these lengths. ``counts[x]`` pieces have length x."""
    index, lines = Complements(counts), []
    for longest in range(index.limit, 0, -1):
        while index.left[longest]:
            held = (longest,)
            while True:
                gap = index.limit - sum(held)
                found = index.filling(gap, held)
                if found is not None:
                    held = (*held, *found)
                    break
                best = index.best_fit(gap, held)
                if best is None:
                    break
                held = (*held, best)
            times = int(min(index.left[x] // held.count(x) for x in set(held)))
            index.take(held, times)
            lines.append((held, times))
    return lines


def _placing(lines: list[tuple[tuple[int, ...], int]], limit: int):
    """Sorted keys (length, first rank), and for each the first sequence, pieces a sequence and offset."""
    used, first, rows = np.zeros(limit + 1, np.int64), 0, []
    for held, times in lines:
        offset = 0
        for x in dict.fromkeys(held):
            each = held.count(x)
            rows.append((x << 40 | int(used[x]), first, each, offset))
            used[x] += each * times
            offset += each * x
        first += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return tuple(table[:, k] for k in range(4))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if kept): one row a piece.

    A document's ids end with id 0. Defined cases: a null or empty text is that one id; a document
    of more than ``limit`` ids is cut, its first piece taking what full pieces leave; repeated rows
    are documents of their own; a null id stays null; an empty table gives no rows. Other columns
    are ignored. ``tokenizer`` is a file, or a name among the public tokenizers.
    """
    made = staged(pieces(docs, tokenizer, limit, keep_ids), "pieces")
    per_task = made.groupBy("task", "length").count()
    counts = np.zeros(limit + 1, np.int64)
    for length, n in made.groupBy("length").count().collect():  # at most ``limit`` rows
        counts[length] = n
    keys, firsts, eaches, offsets = _placing(plan(counts), limit)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    ranked = made.join(starts, ["task", "length"]).withColumn("rank", F.col("ahead") + F.col("nth"))
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            line = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            nth = rank - (keys[line] & ((1 << 40) - 1))
            found = [firsts[line] + nth // eaches[line], offsets[line] + nth % eaches[line] * length]
            columns = [*(batch.column(c) for c in wanted), *(pa.array(x, pa.int64()) for x in found)]
            yield pa.RecordBatch.from_arrays(columns, names=[*wanted, "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{', ids binary' * keep_ids}, sequence_id long, offset long"
    return ranked.select(*wanted, "rank").mapInArrow(place, shape)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids binary: the sequences themselves, of pieces packed with their ids; at most the limit's ids each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda out, p: F.concat(out, p["ids"])).alias("ids")
    )
