"""Context-tree weighting over bytes, and a smoothed word model beside it.

A byte is eight binary decisions; a node of the tree is a context of up to ``DEPTH`` preceding bytes and the
decisions already made inside the byte. Each node has the Krichevsky-Trofimov estimate of its next
decision, and all depths are mixed with the weights that the training bytes give them: half for a node's own
estimate, half for its children's, turned into posterior weights. The decisions' probabilities multiply to
that of the text: code length per byte.

A context that the training texts hold at least twice has nodes of its own, in a corpus of any size; those that
occur once share one estimate, the rest of their parent. So the tree is as large as the corpus makes it, and it is never
in one place: grams (a context and its byte) are placed by the ``SHALLOW`` nearest bytes, below which a subtree has a bounded
size, and lie in blocks of whole subtrees. Each block's sums go to the part of the tree above, which is bounded by a
constant and broadcast; a second pass over the blocks gives each gram its probability. Probabilities of the most frequent
grams are broadcast, others are looked up by a join, as are rarer words; which ones doesn't change a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import columns, cut, map_partitions, slices, texts_as_bytes

#: Bytes of a context, and of those that decide where a gram lies.
DEPTH, SHALLOW = 5, 3
#: Contexts that may have nodes at one depth, where somebody wants a smaller model.
CAPACITY = math.inf
#: Bounds of what is broadcast: grams, words and their bytes.
GRAMS, WORDS, WORD_BYTES = 1 << 21, 1 << 19, 64
#: Grams of a block, but for one subtree that has more.
_BLOCK = 1 << 15
#: Bytes that are worked on at once, grams and words that a task holds before it passes them on.
_CHUNK, _HELD, _HELD_WORDS = 1 << 20, 3 << 19, 1 << 18
#: Places for grams in a worker's table, as a power of two, and an odd number that spreads them.
_SLOT_BITS, _SPREAD = 22, np.uint64(0x9E3779B97F4A7C15)
_END = b""


def words(text: bytes) -> list[bytes]:
    """Lower-case words of the text, without the end token."""
    return text.lower().split()  # of bytes: only A-Z change, only ASCII white space separates


def grams(data: bytes) -> np.ndarray:
    """For each byte of ``data`` from place ``DEPTH`` on: the bytes before it and itself as one number.

    The nearest byte before stands highest, so that numbers in order share contexts of every depth.
    """
    raw = np.frombuffer(data, np.uint8)
    n = max(len(raw) - DEPTH, 0)
    code = np.zeros(n, np.int64)
    for at in [*range(DEPTH - 1, -1, -1), DEPTH] if n else []:
        code <<= 8
        code |= raw[at : at + n]
    return code


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Texts, each after ``DEPTH`` zero bytes, put together to chunks of limited size.

    Gives (text number, its bytes in the chunk) and the chunk; a long text goes on in the next chunk, after
    its last ``DEPTH`` bytes.
    """
    parts, data, size = [], [], 0
    for i, text in enumerate(texts):
        before = bytes(DEPTH)
        for at in range(0, len(text), _CHUNK):
            piece = text[at : at + _CHUNK]
            parts.append((i, len(piece)))
            data += [before, piece]
            size += DEPTH + len(piece)
            before = piece[-DEPTH:].rjust(DEPTH, b"\0")
            if size >= _CHUNK:
                yield parts, b"".join(data)
                parts, data, size = [], [], 0
    if parts:
        yield parts, b"".join(data)


def _own_places(parts: list[tuple[int, int]]) -> np.ndarray:
    """Which grams of a chunk belong to a text and not to the bytes before it."""
    mask = np.ones(sum(n + DEPTH for _, n in parts) - DEPTH, bool)
    at = 0
    for _, n in parts[:-1]:
        at += n + DEPTH
        mask[at - DEPTH : at] = False
    return mask


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a partition's grams and words in training texts: (gram, word, n).

    Grams that only held-out texts have are there with 0.
    """
    kinds = [pa.int64(), pa.binary(), pa.int64()]

    def rows(gram, word, n) -> pa.RecordBatch:
        arrays = [pa.nulls(len(n), k) if x is None else pa.array(x, k) for x, k in zip((gram, word, n), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["gram", "word", "n"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    seen: Counter = Counter()

    def merged() -> tuple[np.ndarray, np.ndarray]:
        code, number = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(code, kind="stable")  # sorted stretches are merged, not sorted again
        code, number = code[order], number[order]
        first = np.flatnonzero(np.diff(code, prepend=code[:1] - 1))
        return code[first], np.add.reduceat(number, first)

    for batch in (part for batch in batches for part in slices(batch, "text", _CHUNK)):
        every = [t or b"" for t in texts_as_bytes(batch, "text")]
        learn = [h is False for h in batch.column("held_out").to_pylist()]
        texts = [t for t, mine in zip(every, learn, strict=True) if mine]
        for text in texts:
            seen.update(words(text))
            if len(seen) > _HELD_WORDS:
                yield rows(None, list(seen), list(seen.values()))
                seen = Counter()
        if texts:
            seen[_END] += len(texts)
        others = [t for t, mine in zip(every, learn, strict=True) if not mine]
        for once, (parts, data) in [*((1, c) for c in _chunks(texts)), *((0, c) for c in _chunks(others))]:
            code, number = np.unique(grams(data)[_own_places(parts)], return_counts=True)
            held.append((code, once * number))
            if sum(len(c) for c, _ in held) > 2 * _HELD:
                code, number = merged()
                held = [(code, number)]
                if len(code) > _HELD:
                    yield rows(code, None, number)
                    held = []
    if held:
        code, number = merged()
        yield rows(code, None, number)
    if seen:
        yield rows(None, list(seen), list(seen.values()))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 10, taken back by the ten factors between."""
    back = sum(np.log(x + i) for i in range(10))
    y = x + 10
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - back


_FEW = np.arange(1 << 12, dtype=float)
_HALVES, _WHOLES = _log_gamma(_FEW + 0.5), _log_gamma(_FEW + 1.0)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    few = zeros + ones < len(_FEW)  # most nodes; looked up
    zero, one = (np.where(few, x, 0).astype(np.int64) for x in (zeros, ones))
    out = _HALVES[zero] + _HALVES[one] - _WHOLES[zero + one]
    zeros, ones = zeros[~few], ones[~few]
    out[~few] = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
    return out - math.log(math.pi)


Nodes = tuple[np.ndarray, np.ndarray, np.ndarray]


def levels(code: np.ndarray, n: np.ndarray, least: int, first: int, last: int) -> list[Nodes]:
    """(node numbers, zeros, ones) of the nodes with at least ``least`` bytes for each depth from ``first`` to ``last``.

    ``code`` are grams of ``last`` bytes before a byte, in order, and ``n`` their numbers.
    """
    out = []
    for depth in range(last, first - 1, -1):
        if depth < last:  # without the farthest byte
            code = code >> 16 << 8 | code & 255
            order = np.argsort(code, kind="stable")
            code, n = code[order], n[order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        code, n = code[starts], np.add.reduceat(n, starts) if len(starts) else n
        found = []
        for bit in range(8):
            prefix = code >> (8 - bit)  # the context and the bits before this one
            at = np.flatnonzero(np.diff(prefix, prepend=-1))
            one = n * (code >> (7 - bit) & 1)
            every, ones = (np.add.reduceat(x, at) if len(at) else x for x in (n, one))
            kept = every >= least
            key = code[at] >> 8 << 8 | 1 << bit | (code[at] & 255) >> (8 - bit)
            found.append((key[kept], (every - ones)[kept], ones[kept]))
        out.append(tuple(np.concatenate(x) for x in zip(*found, strict=True)))
    return out[::-1]


def _parents(keys: np.ndarray) -> np.ndarray:
    """Numbers of the nodes one byte nearer."""
    return (keys >> 16 << 8) | (keys & 255)


class Tree:
    """For each depth: sorted node numbers and what the mixture needs of each node.

    A tree may be a part of a larger one: ``first`` is then the depth it begins at, and ``inside`` has for the nodes of its last
    depth the sums over their children: (node numbers, zeros, ones, logarithms of the mixtures).
    """

    def __init__(self, levels: list[Nodes], first: int = 0, inside: tuple[np.ndarray, ...] | None = None):
        """``levels``: for each depth from ``first`` the node numbers, zeros and ones; all parents are there."""
        self.first, self.levels = first, [None] * len(levels)
        below = inside
        for depth in range(len(levels) - 1, -1, -1):
            order = np.argsort(levels[depth][0])
            keys, zeros, ones = (np.asarray(x)[order] for x in levels[depth])
            zeros, ones = zeros.astype(float), ones.astype(float)
            own = log_kt(zeros, ones)
            estimate = (ones + 0.5) / (zeros + ones + 1)
            if below is None:
                mixed, alone, weight = own, estimate, np.ones(len(keys))
            else:
                at = np.searchsorted(keys, below[0])
                inside = [np.bincount(at, x, len(keys)) for x in below[1:]]
                rest0, rest1 = zeros - inside[0], ones - inside[1]
                children = inside[2] + log_kt(rest0, rest1)
                mixed = np.logaddexp(own, children) - math.log(2)
                weight = np.exp(own - math.log(2) - mixed)
                rest = (rest1 + 0.5) / (rest0 + rest1 + 1)
                alone = weight * estimate + (1 - weight) * rest
            below = (_parents(keys), zeros, ones, mixed)
            self.levels[depth] = (keys, weight * estimate, 1 - weight, alone)
        #: Sums over this tree's nodes for those above it.
        self.above = below

    def one(self, code: np.ndarray, bit: int, one: np.ndarray) -> np.ndarray:
        """The probability that a bit of the last byte of each gram is 1.

        ``one`` is what deeper nodes say, NaN where there are none; the result is NaN where this tree has none too.
        """
        node = (1 << bit) | ((code & 255) >> (8 - bit))
        for i in range(len(self.levels) - 1, -1, -1):
            keys, share, others, alone = self.levels[i]
            if len(keys):
                key = code >> (8 * (DEPTH + 1 - self.first - i)) << 8 | node
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                mixed = np.where(np.isnan(one), alone[at], share[at] + others[at] * one)
                one = np.where(keys[at] == key, mixed, one)
        return one

    def log10(self, code: np.ndarray, deeper: Tree | None = None) -> np.ndarray:
        """log10 probability of the last byte of each gram after those before it; ``deeper`` has the nodes below."""
        byte, total = code & 255, np.zeros(len(code))
        # What this tree makes of a deeper probability is a straight line, the same for grams that differ far off.
        far = 8 * (DEPTH + 1 - self.first - len(self.levels))
        near, where = np.unique(code >> far >> 8 << 8 | byte, return_inverse=True)
        near = near >> 8 << far + 8 | near & 255
        for bit in range(8):
            one, at_0, at_1 = (self.one(near, bit, np.full(len(near), x))[where] for x in (np.nan, 0.0, 1.0))
            if deeper is not None:
                below = deeper.one(code, bit, np.full(len(code), np.nan))
                one = np.where(np.isnan(below), one, at_0 + (at_1 - at_0) * below)
            one = np.where(np.isnan(one), 0.5, one)
            total += np.log10(np.where((byte >> (7 - bit)) & 1, one, 1 - one))
        return total


    def remembered(self, code: np.ndarray) -> np.ndarray:
        """``log10``, computed once for each different gram."""
        different, where = np.unique(code, return_inverse=True)
        return self.log10(different)[where]


class Known:
    """log10 probabilities of some grams, looked up in a table of a worker."""

    def __init__(self, code: np.ndarray, log: np.ndarray):
        """``code``: in order, different."""
        self.code, self.log, self.slots = code, log, None

    def __getstate__(self) -> dict:
        return {"code": self.code, "log": self.log, "slots": None}

    def of(self, code: np.ndarray) -> np.ndarray:
        """The value of each gram, NaN for others."""

        def slot_of(code: np.ndarray) -> np.ndarray:
            return ((code.view(np.uint64) * _SPREAD) >> np.uint64(64 - _SLOT_BITS)).view(np.int64)

        if self.slots is None:
            # Of several grams with one slot the last one written stays, the likeliest.
            order = np.argsort(self.log, kind="stable")
            slot, self.slots = slot_of(self.code[order]), (np.full(1 << _SLOT_BITS, -1), np.zeros(1 << _SLOT_BITS))
            self.slots[0][slot], self.slots[1][slot] = self.code[order], self.log[order]
        slot = slot_of(code)
        out = self.slots[1][slot]
        missing = np.flatnonzero(self.slots[0][slot] != code)
        if len(missing):
            out[missing] = np.nan
            if len(self.code):
                at = np.minimum(np.searchsorted(self.code, code[missing]), len(self.code) - 1)
                out[missing] = np.where(self.code[at] == code[missing], self.log[at], np.nan)
        return out

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sum of each whole text, and the text numbers and codes of the grams that are not here."""
        out, owners, codes = np.zeros(len(texts)), [], []
        for parts, data in _chunks(texts):
            own = _own_places(parts)
            code, owner = grams(data)[own], np.repeat([i for i, _ in parts], [n for _, n in parts])
            log = self.of(code)
            missing = np.flatnonzero(np.isnan(log))
            log[missing] = 0
            out += np.bincount(owner, log, len(texts))
            owners.append(owner[missing])
            codes.append(code[missing])
        return out, np.concatenate([np.empty(0, np.int64), *owners]), np.concatenate([np.empty(0, np.int64), *codes])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole subtrees, (grams, numbers) as bytes, and (word, n), from partial counts in order of the gram."""
    left: list[tuple[np.ndarray, np.ndarray]] = []
    seen: Counter = Counter()

    def rows(word, n, grams, numbers) -> pa.RecordBatch:
        some = len(word or grams)
        values = zip((word, n, grams, numbers), (pa.binary(), pa.int64(), pa.binary(), pa.binary()), strict=True)
        arrays = [pa.nulls(some, k) if x is None else pa.array(x, k) for x, k in values]
        return pa.RecordBatch.from_arrays(arrays, ["word", "n", "grams", "numbers"])

    def blocks(whole: bool) -> Iterator[pa.RecordBatch]:
        code, n = (np.concatenate(x) for x in zip(*left, strict=True))
        first = np.flatnonzero(np.diff(code, prepend=-1))
        code, n = code[first], np.add.reduceat(n, first)
        subtrees = np.flatnonzero(np.diff(code >> 8 * (DEPTH + 1 - SHALLOW), prepend=-1))
        # Subtrees that begin within the same stretch of a block's length; the last one may go on.
        ends = subtrees[1:][np.diff(subtrees // _BLOCK) > 0].tolist()
        ends = [*ends, len(code)] if whole else [*ends, int(subtrees[-1])]
        for start, end in zip([0, *ends], ends, strict=False):
            if end > start:
                yield rows(None, None, [code[start:end].tobytes()], [n[start:end].tobytes()])
        left[:] = [(code[ends[-1] :], n[ends[-1] :])]

    for batch in batches:
        inside = batch.column("gram").is_valid()
        words_here = batch.filter(pc.invert(inside))
        for word, n in zip(*(words_here.column(c).to_pylist() for c in ("word", "n")), strict=True):
            seen[word] += n
        if len(seen) > _HELD_WORDS:
            yield rows(list(seen), list(seen.values()), None, None)
            seen = Counter()
        here = batch.filter(inside)
        if here.num_rows:
            left.append((here.column("gram").to_numpy(), here.column("n").to_numpy()))
            if sum(len(c) for c, _ in left) > max(1 << 18, 2 * len(left[0][0])):
                yield from blocks(False)
    if seen:
        yield rows(list(seen), list(seen.values()), None, None)
    if left and sum(len(c) for c, _ in left):
        yield from blocks(True)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for code, n in zip(batch.column("grams"), batch.column("numbers"), strict=True):
            yield tuple(np.frombuffer(x.as_buffer(), np.int64) for x in (code, n))


def _upper(blocks: DataFrame, least: int) -> Tree:
    """The part of the tree above the blocks; its size is bounded by the number of its contexts."""
    far = 8 * (DEPTH + 1 - SHALLOW)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _blocks(batches):
            near, where = np.unique(code >> far >> 8 << 8 | code & 255, return_inverse=True)
            whole = [near, np.bincount(where, n), np.zeros(len(near)), np.zeros(len(near))]
            parents, *inside = Tree(levels(code, n, least, SHALLOW, DEPTH), SHALLOW).above
            keys, where = np.unique(parents, return_inverse=True)
            inside = [keys, *(np.bincount(where, x, len(keys)) for x in inside)]
            for node, values in ((False, whole), (True, inside)):
                arrays = [pa.array(np.full(len(values[0]), node)), pa.array(values[0]), *(pa.array(x, pa.float64()) for x in values[1:])]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "key", "zeros", "ones", "mixed"])

    found = map_partitions(blocks, sums, "node boolean, key long, zeros double, ones double, mixed double")
    found = found.groupBy("node", "key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "mixed")]).toArrow()
    node, key, *values = (found.column(c).to_numpy() for c in ("node", "key", "zeros", "ones", "mixed"))
    node = node.astype(bool)
    order = np.argsort(key[~node])
    code, n = key[~node][order].astype(np.int64), values[0][~node][order].astype(np.int64)
    return Tree(levels(code, n, least, 0, SHALLOW - 1), 0, (key[node].astype(np.int64), *(x[node] for x in values)))


def _chances(blocks: DataFrame, least: int) -> DataFrame:
    """(gram, n, log) of every gram: the log10 probability of its byte after those before it."""
    upper = blocks.sparkSession.sparkContext.broadcast(_upper(blocks, least))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _blocks(batches):
            deeper = Tree(levels(code, n, least, SHALLOW, DEPTH), SHALLOW)
            arrays = [pa.array(code), pa.array(n), pa.array(upper.value.log10(code, deeper))]
            yield pa.RecordBatch.from_arrays(arrays, ["gram", "n", "log"])

    return map_partitions(blocks, apply, "gram long, n long, log double")


def _least_of_frequent(chances: DataFrame) -> int:
    """How often a gram must be there so that at most ``GRAMS`` are."""
    step = F.floor(F.log2(F.greatest("n", F.lit(1))) * 16).alias("step")  # a row for each sixteenth of a doubling
    steps = chances.groupBy(step).agg(F.count(F.lit(1)).alias("many"), F.min("n").alias("least")).collect()
    least, many = 1 << 62, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        many += row["many"]
        if many > GRAMS:
            break
        least = row["least"]
    return least


_SCORED = "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base double, score double, rest array<struct<word: binary, times: long>>, grams array<long>"


def score(docs: DataFrame, learn: str = "held_out", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``; the models learn from the rows whose boolean column ``learn`` is false.

    Returns doc_id, held_out (``learn``, NULL as false), n_bytes, n_tokens (words and one end), n_known,
    train_tokens, base_score (log10 by smoothed word counts), score (log10 by the context tree) and
    bits_per_byte (NULL for an empty text). A NULL text counts as empty. With nothing to learn from, every
    bit has probability 1/2.
    """
    spark = docs.sparkSession
    rows = columns(docs, doc_id=doc_id, text=text, held_out=learn)
    partial = map_partitions(rows.select("text", "held_out"), count, "gram long, word binary, n long")
    place = F.coalesce(F.shiftright("gram", 8 * (DEPTH + 1 - SHALLOW)), F.xxhash64("word"))
    placed = partial.repartition(place).sortWithinPartitions("gram")
    counts = cut(map_partitions(placed, _merged, "word binary, n long, grams binary, numbers binary"), "counts")
    blocks = counts.where("grams is not null").select("grams", "numbers")
    by_word = cut(counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("word")).first()
    least = 2
    if CAPACITY < math.inf:
        sizes = map_partitions(blocks, lambda b: (pa.record_batch({"n": [int(n.sum())]}) for _, n in _blocks(b)), "n long")
        least = max(least, math.ceil((sizes.agg(F.sum("n")).first()[0] or 0) / CAPACITY))
    chances = cut(_chances(blocks, least), "chances")
    enough = F.col("n") >= _least_of_frequent(chances)
    known = chances.where(enough).select("gram", "log").toArrow().sort_by("gram")
    known = Known(*(known.column(c).to_numpy() for c in ("gram", "log")))
    # At most WORDS words are that frequent, and the end token.
    often = (F.col("n") * WORDS >= total) & (F.octet_length("word") <= WORD_BYTES) | (F.octet_length("word") == 0)
    frequent = {bytes(r["word"]): r["n"] for r in by_word.where(often).collect()}
    bottom = total + 0.1 * (distinct + 1)
    model = spark.sparkContext.broadcast((known, {w: (n, math.log10((n + 0.1) / bottom)) for w, n in frequent.items()}))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_grams, frequent = model.value
        end = frequent.get(_END)
        for batch in (part for batch in batches for part in slices(batch, "text", _CHUNK)):
            texts = [t or b"" for t in texts_as_bytes(batch, "text")]
            n_tokens, known, base, ends, rare, times_of = [], [], [], [0], [], []
            for text in texts:
                times = Counter(words(text))
                n_tokens.append(sum(times.values()) + 1)
                seen, logs = (1, end[1]) if end else (0, 0.0)
                for word, n in times.items():
                    if (entry := frequent.get(word)) is not None:
                        seen += n
                        logs += n * entry[1]
                    else:
                        rare.append(word)
                        times_of.append(n)
                known.append(seen)
                base.append(logs)
                ends.append(len(rare))
            scores, owners, codes = known_grams.scores(texts)
            own_grams = np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)
            others = [pa.array(rare, pa.binary()), pa.array(times_of, pa.int64())]
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(others, ["word", "times"]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                    pa.array(scores), rest, pa.ListArray.from_arrays(pa.array(own_grams), pa.array(codes)),
                ],
                ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base", "score", "rest", "grams"],
            )

    long_ids = rows.select(F.col("doc_id").cast("long"), "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    scored = map_partitions(long_ids, apply, _SCORED)
    scored = cut(scored.withColumn("at", F.monotonically_increasing_id()), "scored")
    rest = scored.select("at", F.inline("rest")).join(by_word.where(~often), "word", "left")
    seen = F.coalesce("n", F.lit(0))
    of_rest = rest.groupBy("at").agg(
        F.sum(F.col("times") * F.log10((seen + 0.1) / F.lit(bottom))).alias("more"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    rare = scored.select("at", F.explode("grams").alias("gram")).join(chances.where(~enough).select("gram", "log"), "gram")
    of_rare = rare.groupBy("at").agg(F.sum("log").alias("more_score"))
    return scored.join(of_rest, "at", "left").join(of_rare, "at", "left").withColumn(
        "score", F.col("score") + F.coalesce("more_score", F.lit(0.0))
    ).select(
        "doc_id", "held_out", "n_bytes", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
