"""Texts packed into containers of a fixed number of tokens by exact complements of their lengths.

Lengths are whole numbers up to the capacity, so all that packing needs is how many pieces there are of each
length: a histogram with at most capacity entries, whatever the size of the corpus. The plan is made on it once.
Sums are indexed: by each sum of two lengths, in how many ways the lengths left make it. The index is made once and
corrected whenever a length is used up; sums of three lengths are read through it, as one length and a sum of two.
A gap is closed with the one, two or three lengths that fill it exactly, as many times as the counts of all its lengths
allow at once; what is left goes to the best fit. The plan comes out as runs: pieces number a..b of length l go to
containers c, c + 1, ... . Pieces get their number within their length from counts per task and a running sum, not
from one sorted window, and meet their run by its range.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.session import materialize, spread

#: Folder of public tokenizers' vocabulary files.
TOKENIZERS = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k.json"


@lru_cache(maxsize=4)
def token_counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens, for a file that the library tokenizers reads, or a .model of sentencepiece."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def token_lengths(docs: DataFrame, doc_id: str, text: str, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens) of every text that is not NULL or empty; whole texts are counted."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = token_counter(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counter(part.column(1).to_pylist()), pa.int32())], ["doc_id", "n_tokens"])

    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return spread(read.where("text <> ''")).mapInArrow(count, "doc_id bigint, n_tokens int")


class _Stock:
    """How many pieces of each length are left, in how many ways two of them make each sum, and runs of those already placed."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.left = np.zeros(capacity + 1, np.int64)
        for n, c in counts.items():
            self.left[n] = c
        self.present = (self.left > 0).astype(np.int64)
        size = 2 * capacity + 1
        wave = np.fft.rfft(self.present, 1 << size.bit_length())
        #: Ordered pairs of lengths by their sum; a length with itself counts where two pieces of it are left.
        self.pairs = np.rint(np.fft.irfft(wave * wave, 1 << size.bit_length())[:size]).astype(np.int64)
        self.pairs[::2] -= self.left == 1
        self.taken = np.zeros(capacity + 1, np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first number, end, first container, offset
        self.containers = 0

    def take(self, n: int, pieces: int = 1) -> None:
        """Take pieces of length n, or give them back (pieces below 0), and correct the index where that ends or begins a way to make a sum."""
        before = int(self.left[n])
        after = before - pieces
        self.left[n] = after
        self.pairs[2 * n] += (after >= 2) - (before >= 2)
        if (before >= 1) != (after >= 1):
            self.present[n] = 0
            self.pairs[n : n + len(self.present)] += 2 * self.present if after >= 1 else -2 * self.present
            self.present[n] = after >= 1

    def longest(self, room: int) -> int:
        """The longest length left that room holds, 0 if there is none."""
        fits = np.flatnonzero(self.left[1 : room + 1])
        return int(fits[-1]) + 1 if len(fits) else 0

    def close(self, lengths: list[int]) -> None:
        """Fill new containers with lengths each, as many as the counts allow."""
        times = min(int(self.left[n]) // k for n, k in Counter(lengths).items())
        offset = 0
        for n in lengths:
            start = int(self.taken[n])
            self.runs.append((n, start, start + times, self.containers, offset))
            self.taken[n] += times
            self.take(n, times)
            offset += n
        self.containers += times

    def pair(self, total: int) -> list[int] | None:
        """Two lengths left with that sum; of all such pairs the one that can be taken most often."""
        low, high = (total + 1) // 2, min(total - 1, len(self.left) - 1)
        if low > high or self.pairs[total] == 0:
            return None
        one, other = self.left[low : high + 1], self.left[total - high : total - low + 1][::-1]
        often = np.minimum(one, other)
        if total == 2 * low:
            often[0] = one[0] // 2
        k = int(np.argmax(often))
        return [low + k, total - low - k]

    def complement(self, gap: int) -> list[int] | None:
        """One, two or three lengths left that sum to gap exactly; fewer are preferred."""
        if self.left[gap]:
            return [gap]
        found = self.pair(gap)
        if found:
            return found
        # one length a, the longest of three, whose rest is the sum of two
        least = -(-gap // 3)
        if least > gap - 2:
            return None
        rest = self.pairs[gap - least : 1 : -1]
        for a in (np.flatnonzero(self.present[least : gap - 1] * (rest > 0)) + least)[::-1].tolist():
            self.take(a)
            found = self.pair(gap - a)  # without the piece of a, which the index may have counted
            self.take(a, -1)
            if found:
                return [a, *found]
        return None


def packing_runs(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first number, end, first container, offset) that place all pieces, and the number of containers.

    The longest length left opens containers. Its exact complement is taken in bulk: as often as the counts allow. Where
    no exact complement of up to three lengths exists, the best fit is added, the longest length that still has room,
    and the complement is sought for what is left then. Each step uses a length up, or all but a few pieces of it, so
    steps grow with capacity, not with the number of pieces.
    """
    stock = _Stock(counts, capacity)
    while opener := stock.longest(capacity):
        chosen, room = [opener], capacity - opener
        stock.take(opener)  # what is chosen is not offered again
        while room:
            exact = stock.complement(room)
            if exact:
                for n in exact:
                    stock.take(n)
                chosen += exact
                break
            fit = stock.longest(room)
            if not fit:
                break
            stock.take(fit)
            chosen.append(fit)
            room -= fit
        for n in chosen:
            stock.take(n, -1)
        stock.close(chosen)
    return stock.runs, stock.containers


def pack_texts(docs: DataFrame, capacity: int, doc_id: str = "doc_id", text: str = "text", tokenizer: str = f"{TOKENIZERS}/{TOKENIZER}") -> DataFrame:
    """One row per piece: doc_id, piece_no, token_start, n_tokens, container_id, container_offset.

    A text is one piece unless it has more tokens than capacity; then its pieces have capacity tokens each but for the
    last. Every token of every non-empty text is in exactly one container, none of which exceeds capacity. NULL and empty
    texts are left out, as are texts of no tokens. Repeated texts and ids are pieces of their own. Empty docs give no rows.
    Which of the pieces of one length goes where is open, the number of containers is not.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spark = docs.sparkSession
    lengths = token_lengths(docs, doc_id, text, tokenizer).where("n_tokens > 0")
    starts = F.sequence(F.lit(0), F.col("n_tokens") - 1, F.lit(capacity))
    pieces = lengths.select("doc_id", "n_tokens", F.posexplode(starts).alias("piece_no", "token_start"))
    pieces = pieces.select("doc_id", "piece_no", "token_start", F.least(F.lit(capacity), F.col("n_tokens") - F.col("token_start")).alias("length"))
    # the task and place of a row stay as written: numbers taken from them are the same in every later job
    pieces = materialize(pieces.withColumn("task", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "pieces")
    held = pieces.groupBy("length", "task").count()  # capacity entries a task at most
    counts = {r.length: r.n for r in held.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs, _ = packing_runs(counts, capacity)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    base = held.select("length", "task", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "task").orderBy("row")) - 1  # a task's rows of one length
    numbered = pieces.withColumn("within", within).join(base, ["length", "task"]).withColumn("number", F.col("base") + F.col("within"))
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, start, end, container, offset in runs:
        by_length.setdefault(length, []).append((start, end, container, offset))
    plan = [(n, r) for n, r in by_length.items()]
    # one row per length; runs of a length are in order of their first number
    plan_df = spark.createDataFrame(plan, "length int, runs array<struct<start:bigint,end:bigint,container:bigint,offset:int>>")
    placed = numbered.join(F.broadcast(plan_df), "length")
    run = F.element_at(F.filter("runs", lambda r: (r["start"] <= F.col("number")) & (F.col("number") < r["end"])), 1)
    placed = placed.withColumn("run", run)
    return placed.select("doc_id", F.col("piece_no").cast("int").alias("piece_no"), "token_start", F.col("length").alias("n_tokens"), (F.col("run.container") + F.col("number") - F.col("run.start")).alias("container_id"), F.col("run.offset").alias("container_offset"))
