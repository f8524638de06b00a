"""Evaluation items that leaked into a corpus, by spaced-seed hashing of word windows.

Each mask is a pattern of word positions in a window, some of which it ignores; a window's hash under a mask covers
the others. Hashes of all windows of the items, under all masks, form one sorted array; the corpus streams past it,
and a window of a document whose hash is found there is a hit even where ignored words were replaced. Around every
hit the document and the item are compared word by word along their diagonal.

The items are the stated query set. They are taken in blocks of bounded size. Of a block only the texts are sent to
the workers, each of which makes the index once; it is held against every document in one narrow pass. Nothing of the
corpus is shuffled, and more items than a block holds mean more passes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.words import words
from citeloom.session import spread

#: Words of a window.
WINDOW = 12
#: Positions that count (1) and are ignored (0). A window with one or two replaced words, wherever they are, keeps a
#: mask whole. For items of fewer words than a window the masks are cut, and the same holds down to five words.
MASKS = ("110110110111", "101101101101", "011011011011", "111000111000", "000111000111", "111111000000", "100010100111", "010100010111", "000111111000")
#: Replaced words that an overlap may have in any window.
MAX_REPLACED = 2
#: Characters of the items of one block, but for an item that alone has more; its index takes about 25 bytes a character of a worker's memory.
BLOCK_CHARS = 8_000_000
#: Pairs of windows held at once.
HITS = 1_000_000


class SeedIndex:
    """Sorted window hashes of a block of items under all masks, and the items' words as numbers."""

    def __init__(self, items: Sequence[tuple[int, str | None]], window: int = WINDOW, masks: Sequence[str] = MASKS) -> None:
        self.window, self.masks = window, masks
        self.ids: list[int] = []
        self.words: list[np.ndarray] = []
        self.vocabulary: dict[str, int] = {}
        for item_id, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if own:
                self.ids.append(item_id)
                self.words.append(np.array(own, np.int64))
        draw = np.random.default_rng(20)
        self.value = draw.integers(1, 2**63, len(self.vocabulary) + 1, np.uint64)
        self.weight = draw.integers(1, 2**63, window, np.uint64) | np.uint64(1)
        self.tables: dict[tuple[int, str], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        gathered: dict[tuple[int, str], list[tuple[np.ndarray, int]]] = {}
        for i, own in enumerate(self.words):
            n = min(window, len(own))
            for mask in self.cut(n):
                gathered.setdefault((n, mask), []).append((self.hashes(own, n, mask), i))
        for key, parts in gathered.items():
            h = np.concatenate([p for p, _ in parts])
            item = np.concatenate([np.full(len(p), i, np.int32) for p, i in parts])
            at = np.concatenate([np.arange(len(p), dtype=np.int32) for p, _ in parts])
            order = np.argsort(h, kind="stable")
            self.tables[key] = (h[order], item[order], at[order])

    def cut(self, n: int) -> list[str]:
        """The masks for windows of n words; below five words none is ignored."""
        return list(dict.fromkeys(m[:n] if n > 4 and "1" in m[:n] else "1" * n for m in self.masks))

    def hashes(self, own: np.ndarray, n: int, mask: str) -> np.ndarray:
        """Hash of each window of n words under mask."""
        value, count = self.value[own], max(0, len(own) - n + 1)
        total = np.zeros(count, np.uint64)
        for p, use in enumerate(mask):
            if use == "1":
                total += value[p : p + count] * self.weight[p]
        return total

    def hits(self, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position in own, item, position in item) of all windows with a common hash, mask by mask, some at a time."""
        known, value = own > 0, self.value[own]
        for (n, mask), (h, item, at) in self.tables.items():
            count = max(0, len(own) - n + 1)
            used = [p for p, use in enumerate(mask) if use == "1"]
            # only windows whose words that count are all words of items have a hash to look for
            some = np.flatnonzero(np.logical_and.reduce([known[p : p + count] for p in used]))
            mine = np.zeros(len(some), np.uint64)
            for p in used:
                mine += value[some + p] * self.weight[p]
            first = np.searchsorted(h, mine, "left")
            met = np.flatnonzero(h[np.minimum(first, len(h) - 1)] == mine)
            every, first, last = some[met], first[met], np.searchsorted(h, mine[met], "right")
            # windows in stretches with about HITS pairs: a text of one word repeated meets an item of it at every place
            ends = np.searchsorted(np.cumsum(last - first), np.arange(HITS, (last - first).sum() + HITS, HITS), "left") + 1
            start = 0
            for end in np.unique(np.minimum(ends, len(every))).tolist():
                where, one, many = every[start:end], first[start:end], (last - first)[start:end]
                start = end
                row = np.repeat(one - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                yield np.repeat(where, many), item[row], at[row]


def _longest(flags: np.ndarray) -> tuple[int, int]:
    """Start and end of the longest run of true values; the first of equals."""
    if flags.all():
        return 0, len(flags)
    stops = np.flatnonzero(~flags)
    starts = np.concatenate([[0], stops + 1])
    sizes = np.concatenate([stops, [len(flags)]]) - starts
    k = int(sizes.argmax())
    return int(starts[k]), int(starts[k] + sizes[k])


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int = WINDOW, replaced: int = MAX_REPLACED) -> tuple[int, int, int] | None:
    """(words of the longest overlap, those of them that are equal, longest run of equal words) with item word k at doc word k + shift.

    An overlap is a stretch in which no window has more than the allowed replaced words; None if there is none.
    """
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    n = min(window, len(item))
    if b - a < n:
        return None
    same = item[a:b] == doc[a + shift : b + shift]
    bad = np.concatenate([[0], np.cumsum(~same)])
    start, end = _longest(bad[n:] - bad[:-n] <= (replaced if n > 2 * replaced else 0))
    if start >= end:
        return None
    within = same[start : end + n - 1]
    kept = np.flatnonzero(within)
    run = _longest(same)
    return int(kept[-1] - kept[0] + 1), len(kept), run[1] - run[0]


#: The index this worker made last, by the name of its block.
_made: dict[str, SeedIndex] = {}


def _index(name: str, items: Broadcast) -> SeedIndex:
    """The index of a block, made once in each worker; a worker holds one at a time."""
    if name not in _made:
        _made.clear()
        _made[name] = SeedIndex(items.value)
    return _made[name]


_OUT = "doc_id bigint, item_id bigint, item_words int, overlap_words int, equal_words int, exact_words int"
_SCHEMA = pa.schema([(f.split()[0], pa.int64() if f.split()[1] == "bigint" else pa.int32()) for f in _OUT.split(", ")])


def _search(index: SeedIndex, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Overlaps of the documents of one batch, (doc_id, text), with the items."""
    known, gap = index.vocabulary.get, [0] * index.window
    flat: list[int] = []
    starts: list[int] = []
    for text in batch.column(1).to_pylist():
        starts.append(len(flat))
        flat += [known(w, 0) for w in words(text)]
        flat += gap  # no window of words reaches from one document into the next
    own, begin = np.array(flat, np.int64), np.array([*starts, len(flat)], np.int64)
    del flat
    ids = batch.column(0).to_pylist()
    seen: dict[tuple[int, int], list[int]] = {}
    # a document, an item and a shift as one number, which sorts faster than three
    most = max(map(len, index.words), default=0)  # a shift is above -most and below len(own)
    span = len(own) + most + 1
    codes: list[np.ndarray] = []
    for where, item, at in index.hits(own):
        doc = np.searchsorted(begin, where, "right") - 1
        codes.append(np.unique((doc * len(index.ids) + item) * span + where - begin[doc] - at + most))
    if codes:
        for code in np.unique(np.concatenate(codes)).tolist():
            rest, shift = divmod(code, span)
            doc, item = divmod(rest, len(index.ids))
            shift -= most
            whole = len(index.words[item])
            if seen.get((doc, item)) == [whole, whole, whole]:
                continue  # the item is there as a whole; no other place says more
            got = overlap(own[begin[doc] : begin[doc + 1] - index.window], index.words[item], shift, index.window)
            if got:
                best = seen.setdefault((doc, item), [0, 0, 0])
                if (got[0], got[1]) > (best[0], best[1]):
                    best[:2] = got[:2]
                best[2] = max(best[2], got[2])
    rows = [(ids[d], index.ids[i], len(index.words[i]), *best) for (d, i), best in seen.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_SCHEMA), _SCHEMA, strict=True)], schema=_SCHEMA)


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that overlap: doc_id, item_id, item_words, overlap_words, equal_words, exact_words.

    overlap_words is the length of the longest stretch in which no twelve words have more than two replaced ones,
    equal_words how many of its words are equal, exact_words the longest run of equal words; for items of fewer words
    than a window, the whole item counts as the window. Every pair with such an overlap is found: some mask leaves
    out any two words of a window.

    NULL and empty texts, and texts without words, overlap with nothing. Repeated texts under other ids each have their
    rows; repeated ids too. Empty docs or items give no rows. Other columns of either input are not read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).cast("string").alias("t")).where("t IS NOT NULL")
    chars = asked.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    read = spread(docs.select(F.col(doc_id).cast("bigint"), F.col(doc_text).cast("string")).where(F.col(doc_text).isNotNull()))

    def against(k: int) -> DataFrame:
        block = asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").collect()  # about block_chars characters
        sent, name = spark.sparkContext.broadcast([tuple(r) for r in block]), uuid.uuid4().hex

        def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 500):
                    yield _search(_index(name, sent), batch.slice(start, 500))

        return read.mapInArrow(search, _OUT)

    return reduce(DataFrame.unionAll, map(against, range(blocks)))
