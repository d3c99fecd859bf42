"""Periodic runs of words: stretches that repeat one block of words at least three times.

A run is a stretch of consecutive words with smallest period q, of at least ``LEAST_WORDS`` words and
``LEAST_PERIODS`` periods, that no neighbouring word extends. Texts of a batch are put after one another, each
followed by a word of its own that equals no other, so that no run crosses from one text to the next.

Periods up to ``SHORT`` are found by direct lag scans: words q apart are compared at every place, and long streaks
of equal ones are runs. Longer periods are found scale by scale, two scales an octave. A scale of size k
takes care of the periods between the scale before and k. It hashes every k words and keeps the places whose
hash is smallest in some window. Inside a run windows q apart are equal, so their minima lie q apart too, and k words
can't repeat at a smaller distance than q there; neighbours among the places of one hash are thus q
apart. Such a pair is a seed: it is checked word by word and extended to both sides. A window is so short that
the first one of a run and its copy q further on lie inside the run, so every run has a seed.

Nothing is dropped for speed: the work is a fixed number of passes over the words for each scale, and a text takes
part in a scale only if its length allows such a period. Hashes have 64 bits and are mixed without any linear
structure; what they propose is verified, and they can hide a run only by a collision inside one text, with a
probability of about the square of its words over 2^65 (10^-7 for a million words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import columns, map_partitions, slices, texts_as_bytes

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Longest period found by comparing words directly.
SHORT = 8
#: Bytes of text that are worked on at once; a longer text is worked on alone.
_PART = 1 << 20
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

Run = tuple[int, int, int]  # start, length, period


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, the order of which matters."""
    x = (a * _ODD[0]) ^ (b + _ODD[1])
    x ^= x >> np.uint64(31)
    x *= _ODD[1]
    x ^= x >> np.uint64(29)
    x *= _ODD[2]
    x ^= x >> np.uint64(32)
    return x


def _extremes(values: np.ndarray, width: int, choose: np.ufunc) -> np.ndarray:
    """The smallest (or greatest) of each ``width`` neighbours; ``width`` - 1 fewer than ``values``."""
    done = 1
    while 2 * done <= width:
        values = choose(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = choose(values[: done - width], values[width - done :])
    return values


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places whose value is the smallest of some window of ``width`` places that holds them."""
    if len(values) < width:
        return np.empty(0, np.int64)
    least = _extremes(values, width, np.minimum)
    # A value is at least the minimum of every window around it; it is one if the greatest of these is.
    edge = np.zeros(width - 1, values.dtype)
    return np.flatnonzero(_extremes(np.concatenate([edge, least, edge]), width, np.maximum) == values)


def _primes(n: int) -> list[int]:
    """The prime factors of ``n``, each once."""
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def _smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a run of ``period`` (three times at least) has no smaller period."""
    for prime in _primes(period):
        less = period // prime
        if np.array_equal(words[start : start + period], words[start + less : start + less + period]):
            return False
    return True


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, going by ``step``, equal those ``lag`` further on."""
    n, width = 0, 32
    while True:
        if step > 0:
            a, b = words[at + n : at + n + width], words[at + n + lag : at + n + lag + width]
            equal = a[: len(b)] == b
        else:
            low = max(at - n - width + 1, 0)
            a, b = words[low : at - n + 1], words[low + lag : at - n + lag + 1]
            equal = (a == b)[::-1]
        if not equal.all():
            return n + int(np.argmin(equal))
        n += len(equal)
        if len(equal) < width:
            return n
        width *= 2


def _lag_scan(words: np.ndarray, period: int) -> Iterator[tuple[int, int]]:
    """Start and length of the stretches of ``period`` that are long enough, over all words."""
    least = max(LEAST_WORDS, LEAST_PERIODS * period)
    if len(words) < least:
        return
    unequal = np.flatnonzero(words[period:] != words[:-period])
    edges = np.concatenate([[-1], unequal, [len(words) - period]])
    for i in np.flatnonzero(np.diff(edges) > least - period):
        start = int(edges[i]) + 1
        yield start, int(edges[i + 1]) - start + period


def _scales(longest: int) -> Iterator[tuple[int, int]]:
    """(smallest period, size) of each scale, up to texts of ``longest`` words."""
    before, size = SHORT, SHORT
    while LEAST_PERIODS * (before + 1) <= longest:
        size = size * 3 // 2 if size & (size - 1) == 0 else size // 3 * 4
        yield before + 1, size
        before = size


def _seeds(names: np.ndarray, smallest: int, size: int) -> list[tuple[int, int]]:
    """(lag, place) of minimizers that have one name and are a period of this scale apart, in order."""
    # A run has LEAST_PERIODS * q words: a window of this many places and its copy q on fit into it.
    width = (LEAST_PERIODS - 1) * smallest - size + 1
    at = _minima(names, width)
    order = np.argsort(names[at], kind="stable")
    at = at[order]
    same = names[at[1:]] == names[at[:-1]]
    lag = np.diff(at)
    chosen = np.flatnonzero(same & (lag >= smallest) & (lag <= size))
    return sorted(zip(lag[chosen].tolist(), at[chosen].tolist(), strict=True))


def runs(words: np.ndarray, lengths: np.ndarray) -> list[Run]:
    """All runs of the texts in ``words``, by start and period.

    ``words`` holds numbers, equal for equal words; a text's words are followed by one number that occurs once. ``lengths``
    are the numbers of words of the texts, without it.
    """
    found: set[Run] = set()

    def add(start: int, length: int, period: int) -> None:
        if length >= max(LEAST_WORDS, LEAST_PERIODS * period) and _smallest(words, start, period):
            found.add((start, length, period))

    for period in range(1, SHORT + 1):
        for start, length in _lag_scan(words, period):
            add(start, length, period)

    # Hashes of 1, 2, 4 .. words; later scales go on with the texts that are long enough for them.
    kept, sizes = np.arange(len(words)), lengths + 1
    hashed, of = _mix(words.astype(np.uint64), np.uint64(1)), 1
    for smallest, size in _scales(int(lengths.max(initial=0))):
        long = sizes > LEAST_PERIODS * smallest
        if not long.all():
            mask = np.repeat(long, sizes)
            kept, hashed, sizes = kept[mask], hashed[mask], sizes[long]
        while 2 * of <= size:
            # What would reach beyond the end gets any hash; no name of this or a later scale holds it.
            ahead = np.concatenate([hashed[of:], hashed[-of:]]) if len(hashed) > of else hashed
            hashed, of = _mix(hashed, ahead), 2 * of
        names = hashed[: len(hashed) - size + 1]
        if size > of:
            names = _mix(names, hashed[size - of : size - of + len(names)])
        ended: dict[int, int] = {}  # for each lag, up to where its words are known
        for lag, place in _seeds(names, smallest, size):
            at = int(kept[place])
            if at < ended.get(lag, -1) or words[at] != words[at + lag]:
                continue
            back, ahead = _reach(words, at, lag, -1), _reach(words, at, lag, 1)
            start, length = at - back + 1, back - 1 + ahead + lag
            ended[lag] = at + ahead
            add(start, length, lag)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _find(texts: list[bytes]) -> Iterator[tuple[list[Run], bytes]]:
    """For each text its runs and the words that are left, joined by a space."""
    split = [text.split() for text in texts]  # of bytes: only ASCII white space separates
    number: dict[bytes, int] = {}
    lengths = np.array([len(words) for words in split], np.int64)
    coded = np.empty(int(lengths.sum()) + len(split), np.int64)
    at = 0
    for i, words in enumerate(split):
        coded[at : at + len(words)] = [number.setdefault(word, len(number)) for word in words]
        coded[at + len(words)] = -1 - i
        at += len(words) + 1
    ends = np.cumsum(lengths + 1)
    own: list[list[Run]] = [[] for _ in split]
    for start, length, period in runs(coded, lengths):
        i = int(np.searchsorted(ends, start, "right"))
        own[i].append((start - int(ends[i - 1] if i else 0), length, period))
    for words, here in zip(split, own, strict=True):
        if here:
            keep = np.ones(len(words), bool)
            for start, length, period in here:
                keep[start + period : start + length] = False
            words = [words[i] for i in np.flatnonzero(keep)]
        yield here, b" ".join(words)


_RUNS = "runs array<struct<start: long, length: long, period: long>>"


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (by start, then period) and kept_text.

    Words are separated by ASCII white space; runs are counted in words from 0. ``kept_text`` has the words that no run
    contains after its first period, joined by one space. A NULL text has no words: no runs, an empty
    kept_text. Rows that repeat, or lack a doc_id, are rows of their own; no rows give no rows.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        for batch in batches:
            for part in slices(batch, "text", _PART):
                found = list(_find([text or b"" for text in texts_as_bytes(part, "text")]))
                named = [
                    [{"start": s, "length": n, "period": q} for s, n, q in here] for here, _ in found
                ]
                kept = pa.array([text for _, text in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(named, pa.list_(of_run)), kept], ["doc_id", "runs", "kept_text"]
                )

    rows = columns(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_partitions(rows, apply, f"doc_id {kind}, {_RUNS}, kept_text string")
