"""Toxicity of texts: averaged bags of subword vectors under a linear softmax.

A passage is a run of ``PASSAGE`` words of a text. It is the bag of the character n-grams of its
words, a word's ends marked, each n-gram hashed to one of ``2 ** bits`` vectors; the mean of the
vectors goes through a linear softmax. Vectors and softmax are trained jointly in numpy. As words
exist only as n-grams, a misspelling never seen in training still shares most of its vectors with
the word. A text scores as its worst passage, so a long text does not dilute what it holds.

Labels mark texts, not passages. Training first takes every passage for its text's label, then
twice goes on with the passage of each toxic text that scores highest, against the highest and
other passages of clean texts.

The bags are made of bytes, with whole-array operations over the buffers Arrow hands over. In use
the softmax is folded into the vectors: one number for each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinfold.llm.common import pieces_of, staged, text_bytes

BITS = 16
GRAMS = (3, 4, 5, 6)
DIM = 8
PASSAGE = 8
#: A word goes on as the next one after so many bytes, at the edge of a code point: scripts without blanks have
#: passages like others.
WORD_BYTES = 64
#: A bag is filled up with so many zero vectors, which keeps the mean of a word or two near 0.
PADDING = 40
#: Training takes at most so many documents of either label, those first in order of a hash of
#: their id, and at first so many passages of each, evenly spread.
SAMPLE_EACH, SAMPLE_PASSAGES = 1500, 16
RATE, BATCH, ROUNDS = 0.02, 256, 3

# bytes: letters a-z and all of longer UTF-8 sequences make words, anything else parts them
_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[ord("a") : ord("z") + 1] = _FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)
_STEP, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Passages:
    """Of some rows: where each row's passages begin (one more at the end), and the n-grams."""

    begin: np.ndarray
    buckets: list[np.ndarray]  # for each n
    owners: list[np.ndarray]  # the passage of each of those


def passages(data: np.ndarray, starts: np.ndarray, bits: int = BITS) -> Passages:
    """``data`` holds the rows' bytes one after the other.

    An n-gram may begin or end with the place between two words but has none inside.
    """
    rows = len(starts) - 1
    padded = np.full(len(data) + rows + 1, 32, dtype=np.uint32)  # a gap before each row and at the end
    own = np.ones(len(padded), dtype=bool)
    own[starts[:-1] + np.arange(rows)] = False
    own[-1] = False
    padded[own] = _FOLD[data]
    gap = padded == 32
    opens = np.zeros(len(padded), dtype=bool)
    opens[1:] = gap[:-1] & ~gap[1:]
    _part_long_words(padded, gap, opens)
    word = np.cumsum(opens, dtype=np.int32) - 1  # the latest word begun
    row_words = np.concatenate([word[starts[:-1] + np.arange(rows)] + 1, word[-1:] + 1])
    counts = -(-np.diff(row_words) // PASSAGE)
    begin = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    row_of = np.repeat(np.arange(rows), np.diff(row_words))
    owner = (begin[row_of] + (np.arange(len(row_of)) - row_words[row_of]) // PASSAGE).astype(np.int64)
    hashed, clear, buckets, owners = padded, np.ones(len(padded), dtype=bool), [], []
    for n in range(2, max(GRAMS) + 1):
        size = len(padded) - n + 1
        if size <= 0:
            break
        hashed = hashed[:size] * _STEP + padded[n - 1 :]
        if n > 2:
            clear = clear[:size] & ~gap[n - 2 : n - 2 + size]
        if n in GRAMS:
            found = np.flatnonzero(clear[:size])
            mixed = (hashed[found] ^ (hashed[found] >> np.uint32(15))) * _MIX
            buckets.append((mixed >> np.uint32(32 - bits)).astype(np.int64))
            owners.append(word[found + 1])
    fresh = _fresh(buckets, owners, owner)
    for k, words in enumerate(owners):
        kept = fresh[words]
        buckets[k], owners[k] = buckets[k][kept], owner[words[kept]]
    return Passages(begin, buckets, owners)


def _part_long_words(padded: np.ndarray, gap: np.ndarray, opens: np.ndarray) -> None:
    """Let words of more than ``WORD_BYTES`` open anew; n-grams still run over the place."""
    at = np.arange(len(padded))
    start = np.maximum.accumulate(np.where(opens, at, 0))
    if not ((at - start >= WORD_BYTES) & ~gap).any():
        return
    edges = np.flatnonzero(~gap & (padded & 0xC0 != 0x80))  # first bytes of code points
    slot = (edges - start[edges]) // WORD_BYTES
    later = (slot[1:] > slot[:-1]) & (start[edges[1:]] == start[edges[:-1]])
    opens[edges[1:][later]] = True


def _fresh(buckets: list[np.ndarray], words: list[np.ndarray], owner: np.ndarray) -> np.ndarray:
    """Which words are not a repeat of an earlier one of their passage (same n-gram buckets in sum)."""
    n = len(owner)
    total, count = np.zeros(n), np.zeros(n)
    for bucket, word in zip(buckets, words, strict=True):
        total += np.bincount(word, bucket, minlength=n)
        count += np.bincount(word, minlength=n)
    fresh = np.ones(n, dtype=bool)
    for back in range(1, min(PASSAGE, n)):
        fresh[back:] &= (total[back:] != total[:-back]) | (count[back:] != count[:-back]) | (owner[back:] != owner[:-back])
    return fresh


@dataclass(frozen=True)
class Model:
    """Folded to one weight per bucket; a passage scores logistic(bias + mean weight)."""

    weights: np.ndarray
    bias: float
    bits: int = BITS
    learnt: bool = True  # not if passages of only one label, or none, were there to learn from

    def of_passages(self, found: Passages) -> np.ndarray:
        n = int(found.begin[-1])
        total, count = np.zeros(n), np.zeros(n)
        for bucket, owner in zip(found.buckets, found.owners, strict=True):
            total += np.bincount(owner, self.weights[bucket], minlength=n)
            count += np.bincount(owner, minlength=n)
        return self.bias + total / (count + PADDING)

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A text without words scores as a passage whose mean is 0."""
        found = passages(data, starts, self.bits)
        best = np.full(len(starts) - 1, self.bias)
        full = np.flatnonzero(np.diff(found.begin))
        if len(full):
            best[full] = np.maximum.reduceat(self.of_passages(found), found.begin[full])
        return 1 / (1 + np.exp(-np.clip(best, -500, 500)))


def _chosen(found: Passages, model: Model | None) -> list[list[int]]:
    """The passages of each row to train on: spread ones, or the best one and a spread one."""
    values = model.of_passages(found) if model else None
    out = []
    for low, high in zip(found.begin[:-1], found.begin[1:], strict=True):
        n = int(high - low)
        if not n:
            out.append([])
        elif model is None:
            out.append([int(low) + k * n // SAMPLE_PASSAGES for k in range(SAMPLE_PASSAGES)] if n > SAMPLE_PASSAGES else list(range(low, high)))
        else:
            best = int(np.argmax(values[low:high]))
            out.append([int(low) + best, int(low) + best * 7919 % n])
    return out


def _training_bags(bits: int, model: Model | None):
    """(toxic, text) to (toxic, nth, buckets): chosen passages, each with its n-grams' buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high in pieces_of(starts):
                found = passages(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], bits)
                owner = np.concatenate([*found.owners, np.zeros(0, np.int64)])
                order = np.argsort(owner, kind="stable")
                bucket = np.concatenate([*found.buckets, np.zeros(0, np.int64)])[order]
                cuts = np.searchsorted(owner[order], np.arange(found.begin[-1] + 1))
                toxic, nth, lists = [], [], []
                for row, chosen in enumerate(_chosen(found, model)):
                    for k, p in enumerate(chosen):
                        toxic.append(int(labels[low + row]))
                        nth.append(k)
                        lists.append(np.sort(bucket[cuts[p] : cuts[p + 1]]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxic, pa.int32()), pa.array(nth, pa.int32()), pa.array(lists, pa.list_(pa.int32()))],
                    names=["toxic", "nth", "buckets"],
                )

    return work


class _Trainer:
    """Vectors and softmax, trained jointly by Adam."""

    def __init__(self, bits: int):
        rng = np.random.default_rng(9)
        self.bits, self.rng, self.steps = bits, rng, 0
        self.held = [
            rng.normal(0, 0.1, (1 << bits, DIM)).astype(np.float32),
            rng.normal(0, 0.1, (DIM, 2)).astype(np.float32),
            np.zeros(2, np.float32),
        ]
        self.first = [np.zeros_like(x) for x in self.held]
        self.second = [np.zeros_like(x) for x in self.held]

    def run(self, lists: list[np.ndarray], toxic: np.ndarray, epochs: int) -> None:
        used = np.flatnonzero([len(x) for x in lists])
        for _ in range(epochs):
            order = self.rng.permutation(used)
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                self._step([lists[i] for i in batch], toxic[batch])

    def _step(self, lists: list[np.ndarray], toxic: np.ndarray) -> None:
        sizes = np.array([len(x) for x in lists])
        flat = np.concatenate(lists)
        vectors, softmax, bias = self.held
        mean = np.add.reduceat(vectors[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
        sizes_padded = sizes + PADDING
        mean /= sizes_padded[:, None]
        logits = np.einsum("nd,dk->nk", mean, softmax) + bias  # not BLAS, whose sums may vary with memory layout
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(len(lists)), toxic] -= 1
        error /= len(lists)
        back = np.repeat(np.einsum("nk,dk->nd", error, softmax) / sizes_padded[:, None], sizes, axis=0)
        down = np.stack([np.bincount(flat, back[:, d], minlength=1 << self.bits) for d in range(DIM)], axis=1)
        self.steps += 1
        rate = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for x, m, s, slope in zip(self.held, self.first, self.second, (down, np.einsum("nd,nk->dk", mean, error), error.sum(axis=0)), strict=True):
            m += 0.1 * (slope.astype(np.float32) - m)
            s += 0.001 * (slope.astype(np.float32) ** 2 - s)
            x -= np.float32(rate) * m / (np.sqrt(s) + np.float32(1e-8))

    def model(self) -> Model:
        vectors, softmax, bias = (x.astype(np.float64) for x in self.held)
        return Model((vectors * (softmax[:, 1] - softmax[:, 0])).sum(axis=1), float(bias[1] - bias[0]), self.bits)


def _ordered(bags: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The same order whichever task came first."""
    lists = [x.values.to_numpy() for x in bags.column("buckets")]
    toxic, nth = (bags.column(c).to_numpy().astype(np.int64) for c in ("toxic", "nth"))
    order = sorted(range(len(lists)), key=lambda i: (toxic[i], nth[i], lists[i].tobytes()))
    return [lists[i] for i in order], toxic[order], nth[order]


def train_on(bags_of, bits: int = BITS) -> Model:
    """``bags_of(model or None)`` gives a table of training passages."""
    lists, toxic, _ = _ordered(bags_of(None))
    kinds = [np.flatnonzero(toxic == k) for k in (0, 1)]
    if not all(map(len, kinds)):
        share = float(np.clip(toxic.mean() if len(toxic) else 0.5, 1e-6, 1 - 1e-6))
        return Model(np.zeros(1 << bits), float(np.log(share / (1 - share))), bits, learnt=False)
    trainer = _Trainer(bits)
    clean = [lists[i] for i in kinds[0]]
    both = np.concatenate([np.resize(k, max(map(len, kinds))) for k in kinds])
    short = max(1, round(40_000 / len(both)))  # so small samples see enough steps
    trainer.run([lists[i] for i in both], toxic[both], min(2 * short, 60))
    for _ in range(ROUNDS):
        lists, toxic, nth = _ordered(bags_of(trainer.model()))
        hard = np.flatnonzero((toxic == 0) | (nth == 0))
        chosen = [lists[i] for i in hard] + clean[:: max(1, len(clean) // 4000)]
        marks = np.concatenate([toxic[hard], np.zeros(len(chosen) - len(hard), np.int64)])
        trainer.run(chosen, marks, min(6 * max(1, round(8_000 / len(chosen))), 60))
    return trainer.model()


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, each: int = SAMPLE_EACH) -> Model:
    """A model from the documents (doc_id, text) that labels (doc_id, toxic) mark 0 or 1 and are not held out.

    The sample is picked by ids alone, at most ``each`` of either label, so it is small enough to be
    sent to wherever the texts are, and no other text moves. Of labels that repeat an id the largest counts, of texts
    that do the least. Without both labels in the sample, every text scores the share of toxic
    passages in it, or 0.5 if there is none.
    """
    marks = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = docs.where(~is_held_out()).select("doc_id").join(marks, "doc_id").distinct()
    known = known.withColumn("nth", F.xxhash64("doc_id", F.lit(9)))
    picked = [known.where(F.col("toxic") == label).orderBy("nth", "doc_id").limit(each) for label in (0, 1)]
    ids = staged(picked[0].unionByName(picked[1]).select("doc_id", "toxic"), "toxicity-ids")
    sample = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .select("toxic", "text")
    )
    sample = staged(sample, "toxicity-sample")
    shape = "toxic int, nth int, buckets array<int>"
    return train_on(lambda model: sample.mapInArrow(_training_bags(bits, model), shape).toArrow(), bits)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, a double from 0 to 1. A null text is empty.

    The model, 8 bytes a bucket whatever the corpus, goes to the executors with the function.
    """
    names = docs.columns
    at = names.index(text_col)
    out = "score" if "score" not in names else "score_"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(at))
            parts = [
                model.scores(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
                for low, high in pieces_of(starts)
            ]
            found = pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, out])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def is_held_out(id_col: str = "doc_id"):
    """Rows that no label is learnt from: crc32 of the id as text, modulo 5, is 0 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for every row of ``docs``.

    Defined cases: a null or empty text scores as a passage of nothing. Repeated rows each give a
    row. Labels other than 0 and 1 and labels without a document are left out; without labels of
    both kinds every text has one score. A null id is not held out and has no label. An empty
    table gives no rows. Other columns are ignored.
    """
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5; all rows where one kind of label is missing, as nothing then tells texts apart."""
    model = train(docs, labels)
    if not model.learnt:
        return docs
    return score(docs.select(F.struct(*docs.columns).alias("row"), "text"), model).where("score < 0.5").select("row.*")
