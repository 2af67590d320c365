"""Runs of periodic words: stretches that repeat a block of words over and over.

Words of many documents are laid end to end, numbered so that no two documents share a word. A
suffix array is built by doubling; each doubling names the blocks of its length, so the suffixes
that start with a block are a known interval of the array. A run of period q holds, at one length
2^k near q, a block at a multiple of 2^k that occurs again q words later. So every such dyadic block
asks a wavelet tree over the suffix array for its occurrences in the window behind it. The first
occurrences at equal distance are a progression and give one candidate period, since multiples of a
period are never the smallest; each occurrence behind the progression gives another. Candidates
grow both ways by the block names, which compares words exactly, and what is long enough is a run.

A text of n words takes O(n log n) words of memory and steps in the task that reads its row; short
texts share one array of about :data:`BATCH_WORDS` words. There is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.batches import sliced

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words from which on texts are worked on; longer texts are worked on whole.
BATCH_WORDS = 1 << 16
_RUNS = "array<struct<start:long,length:long,period:long>>"


class WaveletTree:
    """Counts and order statistics of value ranges of slices of an array of ints below 2**bits."""

    def __init__(self, values: np.ndarray):
        n = values.size
        self.bits = max(1, int(n - 1).bit_length())
        self.levels = []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: (n + 7) // 8] = np.packbits(bit, bitorder="little")
            words = packed.view(np.uint64)
            before = np.zeros(words.size, np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((b, words, before, n - int(np.count_nonzero(bit))))
            values = np.concatenate([values[~bit], values[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(words[block] & mask)

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Number of values < bound among positions [lo, hi)."""
        count, every = np.zeros(lo.size, np.int64), hi - lo
        for b, words, before, zeros in self.levels:
            one_lo, one_hi = self._ones(words, before, lo), self._ones(words, before, hi)
            up = (bound >> b & 1).astype(bool)
            count += np.where(up, (hi - lo) - (one_hi - one_lo), 0)
            lo, hi = np.where(up, zeros + one_lo, lo - one_lo), np.where(up, zeros + one_hi, hi - one_hi)
        return np.where(bound >> self.bits > 0, every, count)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value, from 0, among positions [lo, hi)."""
        value = np.zeros(lo.size, np.int64)
        for b, words, before, zeros in self.levels:
            one_lo, one_hi = self._ones(words, before, lo), self._ones(words, before, hi)
            low = (hi - lo) - (one_hi - one_lo)
            up = k >= low
            k = np.where(up, k - low, k)
            value += np.where(up, np.int64(1) << b, 0)
            lo, hi = np.where(up, zeros + one_lo, lo - one_lo), np.where(up, zeros + one_hi, hi - one_hi)
        return value


class BlockNames:
    """Suffix array of ``codes``, whose last value occurs once, and what doubling learns on the way.

    ``names[k][i]`` equals ``names[k][j]`` where the 2**k codes from i and from j are the same;
    ``repeated[k]`` holds (place, lo, hi) of the places at multiples of 2**k whose block occurs at
    least twice, with the interval of the suffixes that start with it.
    """

    def __init__(self, codes: np.ndarray):
        n = codes.size
        self.sa = np.argsort(codes, kind="stable")
        name = np.empty(n, np.int64)
        head, size = self._groups(codes[self.sa], np.arange(n))
        name[self.sa] = head
        self.names, self.repeated = [name.astype(np.int32)], []
        slots = np.flatnonzero(size > 1)
        self._keep(self.sa[slots], head[slots], size[slots], 1)
        width = 1
        while slots.size:
            places = self.sa[slots]
            key = name[places] * n + name[places + width]
            order = np.argsort(key, kind="stable")
            places, key = places[order], key[order]
            self.sa[slots] = places
            head, size = self._groups(key, slots)
            name[places] = head
            width *= 2
            self.names.append(name.astype(np.int32))
            many = size > 1
            self._keep(places[many], head[many], size[many], width)
            slots = slots[many]

    @staticmethod
    def _groups(key: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of the first and number of the members of each run of equal, sorted keys."""
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[first, key.size])
        return np.repeat(slots[first], sizes), np.repeat(sizes, sizes)

    def _keep(self, places: np.ndarray, lo: np.ndarray, size: np.ndarray, width: int) -> None:
        at = places % width == 0
        self.repeated.append((places[at], lo[at], lo[at] + size[at]))

    def alike_from(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal codes from places a and b on."""
        n, found = self.sa.size, np.zeros(a.size, np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            x, y = a + found, b + found
            same = np.maximum(x, y) + (1 << k) <= n
            same[same] = self.names[k][x[same]] == self.names[k][y[same]]
            found += np.where(same, 1 << k, 0)
        return found

    def alike_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal codes right before places a and b."""
        found = np.zeros(a.size, np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            x, y = a - found - (1 << k), b - found - (1 << k)
            same = np.minimum(x, y) >= 0
            same[same] = self.names[k][x[same]] == self.names[k][y[same]]
            found += np.where(same, 1 << k, 0)
        return found


def _candidates(index: BlockNames, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) pairs: the block at the place occurs again a period later."""
    tree = None
    for k, (place, lo, hi) in enumerate(index.repeated):
        width = 1 << k
        # a run of exponent * q words has room for an aligned block and its copy while 2 * width <= (exponent - 1) * q + 1;
        # each q uses the greatest such width, so this width serves the q up to reach
        reach = (4 * width - 2) // (exponent - 1)
        if not place.size or reach < 1:
            continue
        tree = tree or WaveletTree(index.sa)
        first = tree.below(lo, hi, place + 1)
        last = tree.below(lo, hi, place + reach + 1)
        some = last > first
        place, lo, hi, first, last = place[some], lo[some], hi[some], first[some], last[some]
        if not place.size:
            continue
        step = tree.smallest(lo, hi, first) - place
        yield place, step
        # while the text keeps the period step, the next occurrences are the progression place + j * step
        alike = index.alike_from(place, place + step)
        low = np.where(2 * step <= width, np.minimum(last - first, (alike - width) // step + 1), 1)
        left = last - first - low
        ends = np.cumsum(left)
        for a in range(0, place.size, BATCH_WORDS):  # a bounded number of blocks, so of occurrences, at a time
            part = slice(a, a + BATCH_WORDS)
            i = np.repeat(np.arange(place.size)[part], left[part])
            if i.size:
                k_th = first[i] + low[i] + np.arange(i.size) + (ends[a - 1] if a else 0) - (ends[i] - left[i])
                yield place[i], tree.smallest(lo[i], hi[i], k_th) - place[i]


def runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period), by start and period, of all maximal stretches of ``codes`` whose
    smallest period fits ``min_exponent`` times and that are ``min_length`` long. The last code occurs once."""
    if min_exponent < 2:
        raise ValueError("a run repeats its period twice at least")
    index = BlockNames(codes)
    found = []
    for place, period in _candidates(index, min_exponent):
        start = place - index.alike_before(place, place + period)
        length = place + period + index.alike_from(place, place + period) - start
        long_enough = length >= np.maximum(min_length, min_exponent * period)
        found.append(np.unique(np.stack([start, length, period], 1)[long_enough], axis=0))
    rows = np.unique(np.concatenate([np.empty((0, 3), np.int64), *found]), axis=0)
    # a stretch that also has multiples of its period: the rows are sorted, the smallest comes first
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _batch(texts: list[bytes | None], min_length: int, min_exponent: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """(number of words, runs, text without repeats) of each text."""
    split = [(t or b"").split() for t in texts]  # for bytes: at the six ASCII spaces
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    word = pa.array([w for ws in split for w in ws], pa.large_binary()).dictionary_encode()
    kinds = len(word.dictionary) + 1
    codes = np.empty(total, np.int64)
    owner = np.repeat(np.arange(sizes.size), sizes)
    codes[np.arange(owner.size) + owner] = owner * kinds + word.indices.to_numpy() + 1
    codes[starts + sizes] = np.arange(sizes.size) * kinds  # an end no other text has
    found = runs(codes, min_length, min_exponent)
    of = np.searchsorted(starts, found[:, 0], "right") - 1
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(edge) > 0
    bounds = np.searchsorted(of, np.arange(sizes.size + 1))
    for i, ws in enumerate(split):
        mine = found[bounds[i] : bounds[i + 1]]
        if len(mine):
            gone = dropped[starts[i] : starts[i] + len(ws)].tolist()
            kept = [w for w, g in zip(ws, gone, strict=True) if not g]
        else:
            kept = ws
        named = [{"start": a - int(starts[i]), "length": n, "period": q} for a, n, q in mine.tolist()]
        yield len(ws), named, b" ".join(kept)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text, ...).

    ``runs`` are (start, length, period) in words, by start and period; ``collapsed`` is the text's
    words joined by one space, each run cut to its first period. Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``. Repeated rows and null ids come back as often as they
    came; other columns are ignored.
    """
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            done = list(_batch(texts, min_length, min_exponent))
            columns = [ids, [n for n, *_ in done], [r for _, r, _ in done], [t.decode() for *_, t in done]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

        for batch in sliced(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                texts.append(text)
                size += len(text or b"")
                if size >= 6 * BATCH_WORDS:  # six bytes a word, about
                    yield flush()
                    ids, texts, size = [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        work, f"doc_id long, n_words long, runs {_RUNS}, collapsed string"
    )
