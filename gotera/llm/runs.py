"""Periodic runs of words, found online by square catchers over completed power-of-two blocks."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from gotera.llm.bpe import weighed
from gotera.llm.common import fresh, mapped, quoted

LEAST = 12
#: Words that are appended at once; catchers keep their state from one append to the next.
APPENDED = 1 << 16
#: Hits that are merged at once.
MERGED = 1 << 20
KNOWN_WORDS = 300_000
Words = list[bytes]


class Numbers(dict):
    """A number for every word, the same for equal words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class SquareCatchers:
    """Catchers of squares (a stretch of words said twice in a row) in a text that grows at its end.

    Level k cuts the text into blocks of 2**k words. A square of period q with 2**(k+1) - 1 <= q <= 2**(k+2) - 2 holds a
    whole block of level k in its first half, and the block stands again q words later. So every completed block gets a
    catcher that waits for the block to end the text again at one of those distances. Each appended word completes one
    window per level, which is compared with the two catchers that wait at that moment: two comparisons per word and
    level. Windows are named by 64-bit marks that are put together from the two halves' marks.

    ``runs`` merges what was caught: blocks caught one after another at the same distance are one agreement of the text
    with itself q words on; it is lengthened to both sides by at most a block, by halving steps, and is a run where it is
    as long as its period. Runs are then checked on the words.

    Memory is eight bytes a word and level. ``capacity`` is the number of words that will be appended in all, ``longest``
    the longest stretch that can hold a square.
    """

    def __init__(self, capacity: int, longest: int | None = None):
        self.words = np.zeros(capacity, np.int64)
        self.size = 0
        self.marks = [np.zeros(capacity, np.uint64)]
        while 4 * 2 ** len(self.marks) - 2 <= min(capacity, longest or capacity):
            self.marks.append(np.zeros(capacity - 2 ** len(self.marks) + 1, np.uint64))
        self.caught: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.marks]

    def append(self, words: np.ndarray) -> None:
        """Advance all catchers over ``words`` (numbers)."""
        old, self.size = self.size, self.size + len(words)
        self.words[old:self.size] = words
        for level, marks in enumerate(self.marks):
            block = 1 << level
            start, end = max(0, old - block + 1), self.size - block + 1
            if end <= start:
                return
            if level:
                half = self.marks[level - 1]
                marks[start:end] = mixed(half[start:end] * np.uint64(0x9E3779B97F4A7C15) + half[start + block // 2:end + block // 2])
            else:
                marks[start:end] = mixed(words.astype(np.uint64))
            self.catch(level, start, end)

    def catch(self, level: int, start: int, end: int) -> None:
        marks, block = self.marks[level], 1 << level
        first = max(start, 2 * block - 1)
        if first >= end:
            return
        at = np.arange(first, end)
        early = (at - 3 * block + 1) // block * block  # the older of the two catchers that wait
        for catcher in (early, early + block):
            here = at[(catcher >= 0) & (marks[catcher] == marks[at])]
            if len(here):
                waited = (here - 3 * block + 1) // block * block + (catcher[0] - early[0])
                self.caught[level].append((waited, here - waited))

    def agreements(self, level: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, period): maximal stretches where words agree with those ``period`` on, that hold a caught block."""
        if not self.caught[level]:
            return
        block = 1 << level
        at = np.concatenate([c[0] for c in self.caught[level]])
        period = np.concatenate([c[1] for c in self.caught[level]])
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        begins = np.r_[True, (period[1:] != period[:-1]) | (at[1:] != at[:-1] + block)]
        left, right, period = at[begins], at[np.r_[begins[1:], True]] + block, period[begins]
        for i in range(0, len(left), MERGED):
            l, r, q = (c[i:i + MERGED].copy() for c in (left, right, period))
            for j in range(level - 1, -1, -1):
                marks, step = self.marks[j], 1 << j
                back = l - step
                ok = back >= 0
                ok[ok] = marks[back[ok]] == marks[back[ok] + q[ok]]
                l[ok] = back[ok]
                ok = r + q + step <= self.size
                ok[ok] = marks[r[ok]] == marks[r[ok] + q[ok]]
                r[ok] += step
            yield l, r, q

    def runs(self, least: int = LEAST) -> np.ndarray:
        """(start, length, period) rows by start, then period: every run of at least ``least`` words."""
        found = []
        for level in range(len(self.marks)):
            for left, right, period in self.agreements(level):
                good = right - left >= np.maximum(period, least - period)
                found.append(np.stack([left[good], right[good] + period[good] - left[good], period[good]], axis=1))
        if not found:
            return np.zeros((0, 3), np.int64)
        rows = np.concatenate(found)
        # a stretch that has several periods is the run of the smallest, of which the others are multiples
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        again = np.r_[False, (rows[1:, :2] == rows[:-1, :2]).all(axis=1)][:len(rows)]
        rows = rows[~again]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        true = [np.array_equal(self.words[s:s + n - q], self.words[s + q:s + n]) for s, n, q in rows.tolist()]
        return rows[np.array(true, bool)]


def looped(words: Words, seed: int) -> Words:
    """The words with a loop planted from some place to the end, place and period drawn from ``seed``."""
    n = len(words)
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


def planted(key, words: Words) -> Words:
    """A tenth of the texts, by the crc32 of their key, with a loop."""
    if key is None or not words:
        return words
    drawn = zlib.crc32(str(key).encode())
    return words if drawn % 10 else looped(words, drawn // 10)


def find_runs(texts: list[Words], numbers: Numbers, least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text. All texts are one stream, with a word between them that never comes again."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    catchers = SquareCatchers(int(sizes.sum()), int(sizes.max(initial=1)))
    held: list[np.ndarray] = []
    waiting = 0
    for number, words in enumerate(texts):
        held += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), np.array([-1 - number], np.int64)]
        waiting += len(words) + 1
        if waiting >= APPENDED or number == len(texts) - 1:
            stream = np.concatenate(held)
            for i in range(0, waiting, APPENDED):
                catchers.append(stream[i:i + APPENDED])
            held, waiting = [], 0
    rows = catchers.runs(least)
    owner = np.searchsorted(ends, rows[:, 0], side="right")
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for number in range(len(texts)):
        mine = rows[bounds[number]:bounds[number + 1]].copy()
        mine[:, 0] -= ends[number] - sizes[number]
        out.append(mine)
    return out


def collapsed(words: Words, runs: np.ndarray) -> Words:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


RESULT = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def described(words: Words, runs: np.ndarray) -> tuple:
    """A text's values of ``RESULT`` and its collapsed text."""
    best = (None,) * 4
    if len(runs):
        start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = start, length, period, 1000 * length // period
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist()).encode()
    left = b" ".join(collapsed(words, runs))
    return len(runs), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(left).hexdigest(), left


def detect(df: DataFrame, text: str = "text", key: str = "doc_id", alter: Callable[[object, Words], Words] | None = None,
           least: int = LEAST, with_text: bool = False) -> DataFrame:
    """(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row, and with
    ``with_text`` also ``runs`` (all of them) and ``collapsed`` (the text with every run cut to its first period).

    Words are what stands between ASCII white space, told apart by letter case. A run is a stretch of at least ``least``
    words and two periods that repeats with its smallest period and cannot be lengthened. start, length, period and
    exponent_milli are those of the longest run (ties: smallest start, then period), null where there is none. Null,
    empty and blank texts have no runs and collapse to nothing. ``alter`` may change a text's words beforehand, knowing
    its key. Repeated rows and null keys are rows like others. Whole texts are read, rows stay in their partitions; a task
    holds a few megabytes of texts, or one longer text, at a time.
    """
    source = df.select(quoted(key).alias("given"), quoted(text).cast("string").cast("binary").alias("text"))
    schema = T.StructType([T.StructField(key, source.schema["given"].dataType)])
    for name in RESULT:
        schema.add(name, T.StringType() if name.endswith("sha256") else T.LongType())
    if with_text:
        listed, short = fresh(schema.names, "runs", "collapsed")
        run_type = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
        schema.add(listed, T.ArrayType(run_type)).add(short, T.StringType())

    def run(batches):
        numbers = Numbers()
        for batch in weighed(batches, 1):
            if len(numbers) > KNOWN_WORDS:
                numbers.clear()
            keys = batch.column(0).to_pylist()
            texts = [(v.as_py() or b"").split() for v in batch.column(1)]
            if alter:
                texts = [alter(k, words) for k, words in zip(keys, texts)]
            found = find_runs(texts, numbers, least)
            rows = [described(words, runs) for words, runs in zip(texts, found)]
            columns = [pa.array(c, pa.string() if n.endswith("sha256") else pa.int64())
                       for n, c in zip(RESULT, zip(*[r[:-1] for r in rows]))]
            if with_text:
                columns.append(pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs.tolist()] for runs in found],
                                        pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))))
                columns.append(pa.array([r[-1].decode("utf-8", "replace") for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return mapped(source, run, schema)
