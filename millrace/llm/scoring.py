"""Code length of texts by context-tree weighting over bytes.

A byte is eight binary decisions; each of the 255 places in that decision tree
has a context tree of its own over the bytes before, as many as the depth says.  A node holds
how often 0 and 1 followed its context; the Krichevsky-Trofimov estimate of
these and the product of its children's weighted probabilities are mixed half
and half.  The probability of a bit, given all training texts, is then a
mixture of the estimates along its context, from the root down.

Texts travel in compressed packs, which are dealt into chunks of about ``CHUNK``
bytes.  A chunk sorts its strings of a context and its byte, nearest byte
first, a nearest byte at a time, and sends each group of contexts one list of
its distinct strings and their training counts, as compressed differences.  A
group holds all contexts that end in the same ``SUFFIX`` bytes; it merges the
lists of all chunks, and works its trees out level by level over the sorted
strings.  The levels above go by place.  Each list is answered by one value a
string, in the list's order, so the model is never held whole and no string
travels back.  Words and their counts take the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_words, mixed, word_hashes

DEPTH = 8
#: Last bytes of a context by which trees are dealt to groups.
SUFFIX = 3
CHUNK = 32 << 20
#: Groups of contexts for each chunk of text, and the parts a chunk's texts travel in.
GROUPS, PACKS = 8, 16
BEFORE, END = 0xFE, 0xFF
WORD_KIND, BYTE_KIND = 0, 1
#: Values are sent as -log10 times this: exact to 6e-11, up to 2^31.
UNIT = float(1 << 33)

Batches = Iterator[pa.RecordBatch]
#: Bytes whose tokens are hashed at once; bytes between words, and those no word goes on over.
PIECE = 1 << 20
GAP = np.isin(np.arange(256), [0x20, *range(9, 14), BEFORE])
APART = GAP | (np.arange(256) == END)
#: Bytes whose places are sorted at once; a place among them takes two bytes.
STRETCH = 1 << 16

LISTS = "group long, chunk long, part long, n long, keys binary, counts binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, eight steps up."""
    y, product = x + 8.0, np.ones_like(x, np.float64)
    for k in range(8):
        product = product * (x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product)


_HALVES, _WHOLES = log_gamma(np.arange(4096) + 0.5), log_gamma(np.arange(4096) + 1.0) + np.log(np.pi)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    total = zeros + ones
    large = np.flatnonzero(total >= len(_HALVES))
    if not len(large):
        return _HALVES[zeros] + _HALVES[ones] - _WHOLES[total]
    most = len(_HALVES) - 1
    out = _HALVES[np.minimum(zeros, most)] + _HALVES[np.minimum(ones, most)] - _WHOLES[np.minimum(total, most)]
    z, o = zeros[large], ones[large]
    out[large] = log_gamma(z + 0.5) + log_gamma(o + 0.5) - log_gamma(z + o + 1.0) - np.log(np.pi)
    return out


def log_mean(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the mean of two probabilities given by theirs, and the first one's share in it."""
    with np.errstate(over="ignore"):
        odds = np.exp(below - own)
        share = 1 / (1 + odds)
        # Where the odds are past what a double holds, the second is all there is.
        total = np.where(odds < 1e300, own + np.log1p(np.minimum(odds, 1e300)), below)
    return total - np.log(2), share


# Numbers in transit: the bytes of all, place by place, compressed.


def squeezed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 8, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(">u8").reshape(-1).astype(np.uint64)


def squeezed_keys(words: list[np.ndarray]) -> bytes:
    """Sorted keys of one word or more; each word is sent by what it differs in from the one before."""
    return squeezed(np.concatenate([np.bitwise_xor(w, np.concatenate([np.zeros(1, np.uint64), w[:-1]])) for w in words]))


def unsqueezed_keys(data: bytes, n: int, width: int) -> list[np.ndarray]:
    return [np.bitwise_xor.accumulate(w) for w in unsqueezed(data, n * width).reshape(width, n)]


def order_of(keys: np.ndarray) -> np.ndarray:
    """The stable order of the keys: by their first bytes, then those of one first byte by their low halves and by their high ones, each sorted as one number with its place."""
    if len(keys) >= 1 << 32:
        return np.argsort(keys, kind="stable")
    low = np.uint64(0xFFFFFFFF)

    def sorted_places(high: np.ndarray) -> np.ndarray:
        high |= np.arange(len(high), dtype=np.uint32)
        high.sort()
        high &= low
        return high.view(np.int64)

    top = (keys >> np.uint64(56)).astype(np.uint8)
    order = np.argsort(top, kind="stable").astype(np.uint32)
    ends = np.cumsum(np.bincount(top, minlength=256))
    for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        if end - begin > 1:
            some = keys[order[begin:end]]
            within = sorted_places(some << np.uint64(32))
            some = some[within]
            some &= ~low
            order[begin:end] = order[begin:end][within[sorted_places(some)]]
    return order


def first_places(keys: np.ndarray) -> np.ndarray:
    """Where a new key begins among sorted ones."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return np.flatnonzero(new)


def sorted_keys(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and where in that order a new key begins."""
    order = order_of(words[0]) if len(words) == 1 else np.lexsort(words[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for w in words:
        s = w[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


def counted_keys(words: list[np.ndarray], taught: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct keys in order, and how often each is taught."""
    if len(words) > 1:
        order, new = sorted_keys(words)
        first = np.flatnonzero(new)
        return [w[order[first]] for w in words], np.add.reduceat(taught[order], first, dtype=np.int64)
    known, other = words[0][taught], words[0][~taught]
    known.sort()
    other.sort()
    first = first_places(known)
    known, counts = known[first], np.diff(first, append=len(known))
    other = other[first_places(other)]
    if len(known):
        other = other[known[np.minimum(np.searchsorted(known, other), len(known) - 1)] != other]
    if len(other):
        known, counts = np.concatenate([known, other]), np.concatenate([counts, np.zeros(len(other), np.int64)])
        order = np.argsort(known)
        known, counts = known[order], counts[order]
    return [known], counts


def by_group(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that brings groups together, and each group with where it begins and ends there."""
    low = int(group.min())
    sizes = np.bincount(group - low)
    order = np.argsort((group - low).astype(np.uint16 if len(sizes) <= 1 << 16 else np.int64), kind="stable")
    ends = np.cumsum(sizes)
    return order, [(low + g, int(ends[g] - sizes[g]), int(ends[g])) for g in np.flatnonzero(sizes).tolist()]


class Dealing:
    """Which group a context, or a word, belongs to; frequent nearest bytes have more groups."""

    def __init__(self, depth: int, seen: dict[int, int], groups: int) -> None:
        self.depth, self.top = depth, min(SUFFIX, depth)
        total = sum(seen.values()) or 1
        many = [max(1, round(groups * seen.get(v, 0) / total)) if self.top > 1 else 1 for v in range(256)]
        self.first = np.concatenate([[0], np.cumsum(many)])
        self.words = max(1, groups // 8)

    @property
    def rest(self) -> int:
        """Bytes of a string besides the nearest one."""
        return max(1, self.depth)

    @property
    def width(self) -> int:
        return -(-self.rest // 8)

    def byte(self, words: list[np.ndarray], k: int) -> np.ndarray:
        """The k-th byte after the nearest of each string; the last of these is the byte itself."""
        left = self.rest - 8 * (k // 8)
        return (words[k // 8] >> np.uint64(8 * (min(8, left) - 1 - k % 8))).astype(np.uint8)

    def of_strings(self, nearest: int, words: list[np.ndarray]) -> np.ndarray:
        low, many = self.first[nearest], self.first[nearest + 1] - self.first[nearest]
        if many == 1:
            return np.full(len(words[0]), low, np.int64)
        value = np.zeros(len(words[0]), np.uint64)
        for k in range(self.top - 1):
            value = value << np.uint64(8) | self.byte(words, k)
        return low + (mixed(value) % np.uint64(many)).astype(np.int64)

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return self.first[256] + (mixed(hashes) % np.uint64(self.words)).astype(np.int64)

    def kind(self, group: int) -> int:
        return BYTE_KIND if group < self.first[256] else WORD_KIND

    def nearest(self, group: int) -> int:
        return int(np.searchsorted(self.first, group, side="right")) - 1


def tokens(padded: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First bytes and hashes of all tokens of lower-cased texts, each of which ends with END, a token too; eight more bytes follow."""
    data, low = padded[:-8], 0
    while low < len(data):
        # Pieces end where a token does.
        high = low + PIECE
        while high < len(data) and not APART[data[high - 1]]:
            high = min(len(data), high + 1 + int(np.argmax(APART[data[high : high + PIECE]])) if APART[data[high : high + PIECE]].any() else high + PIECE)
        piece = data[low:high]
        inside, end = in_words(piece) & (piece != BEFORE), piece == END
        first, last, gap = inside.copy(), inside.copy(), ~inside
        first[1:] &= gap[:-1] | end[:-1] | end[1:]
        last[:-1] &= gap[1:] | end[1:] | end[:-1]
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        yield low + first, word_hashes(padded[low : low + len(piece) + 8], first, last + 1 - first)
        low = high


def released(batches: Batches) -> Batches:
    """The same batches; then Arrow's unused memory goes back, as Python workers outlive their tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


class Chunk:
    """The texts of a chunk, one after the other, each with ``depth`` bytes before it and its end."""

    def __init__(self, packs: list[pa.Buffer], depth: int) -> None:
        self.depth = depth
        # One pack after the other, so that few copies of the texts are held at once.
        rows, parts = [], []
        for pack in packs:
            table = pa.ipc.open_stream(pack).read_all()
            rows.append(table.drop_columns("bytes"))
            parts.append(laid([t.lower() for t in table.column("bytes").to_pylist()], depth))
        self.rows = pa.concat_tables(rows)
        self.taught = ~self.rows.column("held_out").to_numpy().astype(bool)
        before = np.cumsum([0] + [len(data) for data, _ in parts])
        self.starts = np.concatenate([low + starts for low, (_, starts) in zip(before, parts, strict=False)])
        # Eight bytes more, so that eight can be read up to any place, and from any.
        self.padded = np.zeros(16 + before[-1], np.uint8)
        self.data = self.padded[8:-8]
        for low in before[:-1].tolist():
            data, _ = parts.pop(0)
            self.data[low : low + len(data)] = data

    def words(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hashes of tokens and the row each is in, some at a time."""
        for at, hashes in tokens(self.padded[8:]):
            yield hashes, np.repeat(np.arange(len(self.starts)), self.sizes(at))

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words' hashes in order, and how often each is taught."""
        names, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        held: list = []

        def merge() -> None:
            nonlocal names, counts
            every = np.concatenate([names, *[h for h, _ in held]])
            names, at = np.unique(every, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, *[c for _, c in held]]), len(names)).astype(np.int64)
            held.clear()

        for hashes, row in self.words():
            [some], times = counted_keys([hashes], self.taught[row])
            held.append((some, times))
            if len(held) >= 16:
                merge()
        merge()
        return names, counts

    def sizes(self, places: np.ndarray) -> np.ndarray:
        """How many of these places, in order, each text has."""
        return np.diff(np.searchsorted(places, self.starts.astype(places.dtype)), append=len(places))

    def strings(self) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """For each nearest byte the places of the bytes after it, in order, and their strings' words; a frequent one's by the byte before it, about ``PIECE`` at a time."""
        if not self.depth:
            yield 0, np.arange(len(self.data)), [self.data.astype(np.uint64)]
            return
        # Places by the byte there, a stretch at a time, and where each byte's begin in each stretch.
        places, stretches = np.empty(len(self.data), np.uint16), range(0, len(self.data), STRETCH)
        begins = np.zeros((len(stretches), 257), np.int64)
        for k, low in enumerate(stretches):
            some = self.data[low : low + STRETCH]
            places[low : low + STRETCH] = np.argsort(some, kind="stable")
            begins[k, 1:] = np.cumsum(np.bincount(some, minlength=256))
        sizes = np.diff(begins, axis=1)
        begins += np.arange(len(stretches))[:, None] * STRETCH
        after = np.array(stretches, np.uint32 if len(self.data) < 1 << 32 else np.int64) + 1
        for v in np.flatnonzero(sizes.sum(axis=0)).tolist():
            at = np.concatenate([places[low:high] for low, high in begins[:, v : v + 2].tolist()]) + np.repeat(after, sizes[:, v])
            if v >= BEFORE:
                # What follows here may be no byte of a text, but one of those before it.
                at = at[at < len(self.data)]
                at = at[at - self.starts[np.searchsorted(self.starts, at, side="right") - 1] >= self.depth]
            if len(at) <= PIECE or self.depth == 1:
                if len(at):
                    yield v, at, self._words_of(at)
                continue
            second = self.data[at - 2]
            part = np.cumsum(np.bincount(second, minlength=256)) // PIECE
            for some in np.unique(part[second]).tolist():
                yield v, (now := at[(part == some)[second]]), self._words_of(now)
                del now

    def _words_of(self, at: np.ndarray) -> list[np.ndarray]:
        # Eight bytes read as one number have the last one, which is nearest, on top.
        eight = np.ndarray(len(self.data) + 1, "<u8", self.padded, strides=(1,))
        words = []
        for low in range(0, self.depth, 8):
            context = min(low + 8, self.depth - 1) - low
            word = eight[at - (1 + low)] if context else np.zeros(len(at), np.uint64)
            if context < 8:
                word >>= np.uint64(8 * (8 - context) % 64)
            if low + context == self.depth - 1 and context < 8:
                word <<= np.uint64(8)
                word |= self.data[at]
            words.append(word)
        return words


def laid(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each with ``depth`` bytes before it and its end, and where each begins."""
    before, end = bytes([BEFORE]) * depth, bytes([END])
    starts = np.cumsum([0] + [len(t) + depth + 1 for t in texts])[:-1]
    return np.frombuffer(b"".join(x for t in texts for x in (before, t, end)), np.uint8), starts


def _packs(chunks: int, size: int):
    """Rows in compressed packs, each dealt to a chunk."""

    def run(batches: Batches) -> Batches:
        part, made, held, room = TaskContext.get().partitionId(), 0, [], 0

        def pack() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            chunk = int(mixed(np.array([part << 32 | made], np.uint64))[0] % np.uint64(chunks))
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "pack"])

        for batch in batches:
            for low in range(0, len(batch), 64):
                held.append(batch.slice(low, 64))
                room += held[-1].nbytes
                if room >= size:
                    yield pack()
                    made, held, room = made + 1, [], 0
        if held:
            yield pack()

    return run


def _seen(batches: Batches) -> Batches:
    """How often each byte comes."""
    for batch in batches:
        counts = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()).lower(), np.uint8), minlength=256)
        counts[BEFORE] += len(batch)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["key", "n"])


def _lists(dealing: Dealing):
    """For each group the distinct words or strings of a chunk, sorted, with their training counts."""

    def listed(chunk: int, part: int, group: np.ndarray, words: list[np.ndarray], counts: np.ndarray) -> Batches:
        order, groups = by_group(group)
        for g, low, high in groups:
            some = order[low:high]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (g, chunk, part, len(some))),
                 pa.array([squeezed_keys([w[some] for w in words])], pa.binary()),
                 pa.array([squeezed(counts[some].astype(np.uint64))], pa.binary())], names=["group", "chunk", "part", "n", "keys", "counts"])

    def run(key: tuple, batches: Batches) -> Batches:
        number = key[0].as_py()
        chunk = Chunk([p.as_buffer() for b in batches for p in b.column("pack")], dealing.depth)
        names, counts = chunk.names()
        yield from listed(number, 0, dealing.of_words(names), [names], counts)
        for part, (nearest, places, words) in enumerate(chunk.strings()):
            distinct, counts = counted_keys(words, np.repeat(chunk.taught, chunk.sizes(places)))
            # The largest arrays go before the next are made.
            del places, words
            yield from listed(number, part, dealing.of_strings(nearest, distinct), distinct, counts)

    def freed(key: tuple, batches: Batches) -> Batches:
        return released(run(key, batches))

    return freed


class Merged:
    """The lists of a group put together: distinct keys in order, their counts, and where each list's keys are."""

    def __init__(self, table: pa.Table, width: int) -> None:
        self.lists = [*zip(table.column("chunk").to_pylist(), table.column("part").to_pylist(), strict=True)]
        sizes = table.column("n").to_pylist()
        parts = [unsqueezed_keys(k, n, width) for k, n in zip(table.column("keys").to_pylist(), sizes, strict=True)]
        counts = np.concatenate([unsqueezed(c, n) for c, n in zip(table.column("counts").to_pylist(), sizes, strict=True)]).astype(np.int64)
        words = [np.concatenate(p) for p in zip(*parts, strict=True)]
        order, new = sorted_keys(words)
        first = np.flatnonzero(new)
        self.words = [w[order[first]] for w in words]
        self.counts = np.add.reduceat(counts[order], first)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        self.ranks = np.split(rank, np.cumsum(sizes)[:-1])

    def answers(self, group: int, values: np.ndarray, chunks: int = 0) -> Batches:
        """A row for each list; with ``chunks`` also for those without one, and what all need to know of the counts."""
        ranks = {(c, 0): np.empty(0, np.int64) for c in range(chunks)} | dict(zip(self.lists, self.ranks, strict=True))
        taught, distinct = (int(self.counts.sum()), int((self.counts > 0).sum())) if chunks else (0, 0)
        for (chunk, part), rank in ranks.items():
            whole = [pa.array([x], pa.int64()) for x in (chunk, group, part, len(rank), taught, distinct)]
            yield pa.RecordBatch.from_arrays([*whole, pa.array([squeezed(values[rank])], pa.binary())], names=["chunk", "group", "part", "n", "taught", "distinct", "answers"])


def summed(counts: np.ndarray) -> np.ndarray:
    """The sum before each entry, and that of all."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


class Nodes:
    """The nodes of one level at one place depth: runs of items that share a context and their byte's first bits."""

    def __init__(self, t: int, new_context: np.ndarray, byte: np.ndarray, counts: np.ndarray, sums: np.ndarray, below: tuple | None) -> None:
        new = new_context
        if t:
            high = byte >> np.uint8(8 - t)
            new = new_context.copy()
            new[1:] |= high[1:] != high[:-1]
        self.first = np.flatnonzero(new)
        ends = np.append(self.first, len(byte))
        self.lengths = np.diff(ends)
        self.bit = (byte >> np.uint8(7 - t)) & np.uint8(1)
        self.ones = np.diff(summed(counts * self.bit)[ends])
        self.zeros = np.diff(sums[ends]) - self.ones
        self.weighted, self.share = log_kt(self.zeros, self.ones), None
        if below is not None:
            weights, begins = below
            self.weighted, self.share = log_mean(self.weighted, np.add.reduceat(weights, begins[self.first]))

    def per_item(self, values: np.ndarray) -> np.ndarray:
        return np.repeat(values, self.lengths)

    def estimates(self) -> np.ndarray:
        """The node's own estimate of each item's bit."""
        one = self.per_item((self.ones + 0.5) / (self.zeros + self.ones + 1.0))
        return np.where(self.bit == 1, one, 1 - one)


def levels(dealing: Dealing, words: list[np.ndarray], counts: np.ndarray) -> Iterator[tuple]:
    """From the deepest level up: strings that enter there, the item of each one in, each item's byte and one string of it, and nodes by place depth.

    An item is a context of that depth with a byte.  Items come in order of context and byte, so
    nodes are runs; what a node weighs is left at its first item, which falls into the parent's run a level up.
    A string seen once at most, alone in its context, weighs a half a bit there and at all levels
    below, so it enters at the first level where it is not alone.
    """
    n, depth = len(words[0]), dealing.depth
    byte = dealing.byte(words, dealing.rest - 1)
    # How many context bytes each string shares with the one before it.
    common = np.full(n, depth, np.int16)
    for k in range(depth - 2, -1, -1):
        b = dealing.byte(words, k)
        common[1:][b[1:] != b[:-1]] = k + 1
    common[0] = 0
    enters = np.maximum(np.maximum(common, np.append(common[1:], np.int16(0))), dealing.top)
    enters[counts > 1] = depth
    sample, item = np.empty(0, np.int64), np.empty(0, np.int64)
    held, below = np.empty(0, np.int64), [np.empty(0)] * 8
    for d in range(depth, dealing.top - 1, -1):
        entering = np.flatnonzero(enters == d)
        if not len(entering) and not len(sample):
            yield entering, item, byte[:0], sample, []
            continue
        item = np.concatenate([item, len(sample) + np.arange(len(entering))])
        sample, held = np.concatenate([sample, entering]), np.concatenate([held, counts[entering]])
        context = np.cumsum(common < d)
        key = (context[sample] << 8) | byte[sample]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        up = np.empty(len(order), np.int64)
        up[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
        item, sample, held = up[item], sample[order[first]], np.add.reduceat(held[order], first)
        alone, sums = counts[entering] * -np.log(2), summed(held)
        starts, own = np.diff(key[first] >> 8, prepend=-1) != 0, (key[first] & 255).astype(np.uint8)
        made, left = [], []
        for t in range(8):
            weights = (np.concatenate([below[t], alone])[order], first) if d < depth else None
            nodes = Nodes(t, starts, own, held, sums, weights)
            made.append(nodes)
            weighted = np.zeros(len(own))
            weighted[nodes.first] = nodes.weighted
            left.append(weighted)
        yield entering, item, own, sample, made
        below = left


def suffixes(dealing: Dealing, nearest: int, words: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """The last ``top`` context bytes of some strings as one number, the nearest byte lowest."""
    out = np.full(len(at), nearest if dealing.top else 0, np.int64)
    for k in range(dealing.top - 1):
        out |= dealing.byte([w[at] for w in words], k).astype(np.int64) << (8 * (k + 1))
    return out


def _subtrees(dealing: Dealing):
    """The counts and weights of the nodes at ``top``, for the levels above."""

    def run(key: tuple, batches: Batches) -> Batches:
        group = key[0].as_py()
        if dealing.kind(group) == WORD_KIND:
            return
        merged = Merged(pa.Table.from_batches(batches), dealing.width)
        for _, _, byte, sample, made in levels(dealing, merged.words, merged.counts):
            pass
        suffix = suffixes(dealing, dealing.nearest(group), merged.words, sample)
        for t, nodes in enumerate(made):
            place = (1 << t) | (byte[nodes.first].astype(np.int64) >> (8 - t))
            arrays = [place, suffix[nodes.first], np.full(len(place), group, np.int64), nodes.zeros, nodes.ones, nodes.weighted]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["place", "suffix", "group", "zeros", "ones", "weighted"])

    def freed(key: tuple, batches: Batches) -> Batches:
        return released(run(key, batches))

    return freed


def _tops(top: int):
    """Of one place: per suffix what the levels above it give to 0 and to 1, and what they leave."""

    def run(key: tuple, batches: Batches) -> Batches:
        rows = pa.Table.from_batches(batches)
        suffix, group, zeros, ones, weighted = (rows.column(c).to_numpy() for c in ("suffix", "group", "zeros", "ones", "weighted"))
        given, rest = [np.zeros(len(suffix)) for _ in range(2)], np.ones(len(suffix))
        made, nodes, at = [], suffix, np.arange(len(suffix))
        for depth in range(top - 1, -1, -1):
            nodes, up = np.unique(nodes & ((1 << 8 * depth) - 1), return_inverse=True)
            zeros, ones = (np.bincount(up, x, len(nodes)).astype(np.int64) for x in (zeros, ones))
            weighted, share = log_mean(log_kt(zeros, ones), np.bincount(up, weighted, len(nodes)))
            at = up[at]
            made.append((share[at], zeros[at], ones[at]))
        for share, zeros, ones in reversed(made):
            for bit, n in enumerate((zeros, ones)):
                given[bit] += rest * share * (n + 0.5) / (zeros + ones + 1.0)
            rest = rest * (1 - share)
        place = np.full(len(suffix), key[0].as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (group, suffix, place, *given, rest)], names=["group", "suffix", "place", "g0", "g1", "rest"])

    return run


def _answers(dealing: Dealing, chunks: int):
    """One value for each key of each list: a word's count, or what a string's byte takes in ``UNIT`` parts of a digit."""

    def chances(group: int, merged: Merged, above: pa.Table) -> np.ndarray:
        chance, who, deepest = [np.empty(0)] * 8, np.empty(0, np.int64), True
        for entering, item, byte, sample, made in levels(dealing, merged.words, merged.counts):
            who = np.concatenate([who, entering])
            alone = np.where(merged.counts[entering] == 1, 0.75, 0.5)
            for t, nodes in enumerate(made):
                own = nodes.estimates()
                if deepest:
                    chance[t] = own[item]
                else:
                    share = nodes.per_item(nodes.share)
                    chance[t] = np.concatenate([chance[t], alone])
                    chance[t] *= (1 - share)[item]
                    chance[t] += (share * own)[item]
            deepest = False
        known = above.column("suffix").to_numpy() << 8 | above.column("place").to_numpy()
        order = np.argsort(known)
        g0, g1, rest = (above.column(c).to_numpy()[order] for c in ("g0", "g1", "rest"))
        suffix, total = suffixes(dealing, dealing.nearest(group), merged.words, sample), 1.0
        for t, nodes in enumerate(made):
            place = (1 << t) | (byte[nodes.first].astype(np.int64) >> (8 - t))
            at = nodes.per_item(np.searchsorted(known[order], suffix[nodes.first] << 8 | place))
            total = total * (np.where(nodes.bit == 1, g1[at], g0[at])[item] + rest[at][item] * chance[t])
        out = np.empty(len(who), np.uint64)
        out[who] = np.rint(np.maximum(-np.log10(total), 0.0) * UNIT).astype(np.uint64)
        return out

    def run(key: tuple, lists: Batches, tops: Batches) -> Batches:
        group, lists, tops = key[0].as_py(), list(lists), list(tops)
        if dealing.kind(group) == WORD_KIND:
            merged = Merged(pa.Table.from_batches(lists), 1)
            yield from merged.answers(group, merged.counts.astype(np.uint64), chunks)
        else:
            merged = Merged(pa.Table.from_batches(lists), dealing.width)
            yield from merged.answers(group, chances(group, merged, pa.Table.from_batches(tops)))

    return lambda key, lists, tops: pa.Table.from_batches(released(run(key, lists.to_batches(), tops.to_batches())))


def _scored(dealing: Dealing):
    names_out = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

    def run(packs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(packs):
            return pa.table({c: [] for c in names_out})
        chunk = Chunk([p.as_buffer() for p in packs.column("pack")], dealing.depth)
        total, distinct = (int(np.sum(answers.column(c).to_numpy())) for c in ("taught", "distinct"))
        found = dict(zip(zip(answers.column("group").to_pylist(), answers.column("part").to_pylist(), strict=True), zip(answers.column("n").to_pylist(), (a.as_buffer() for a in answers.column("answers")), strict=True), strict=True))

        def values(group: np.ndarray, part: int = 0) -> np.ndarray:
            """The answers to the keys, sorted in each group as they were listed."""
            order, groups = by_group(group)
            out = np.empty(len(group))
            for g, low, high in groups:
                out[order[low:high]] = unsqueezed(found[g, part][1], found[g, part][0])
            return out

        many = len(chunk.starts)
        words = []
        for hashes, row in chunk.words():
            coded = pa.array(hashes).dictionary_encode()
            words.append((coded.dictionary.to_numpy(), coded.indices.to_numpy(), row.astype(np.int32)))
        names = np.sort(np.concatenate([some for some, _, _ in words]))
        names = names[first_places(names)]
        counts = values(dealing.of_words(names))
        logs = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
        sizes, known, base = np.zeros(many, np.int64), np.zeros(many, np.int64), np.zeros(many)
        while words:
            some, code, row = words.pop(0)
            at = np.searchsorted(names, some)[code]
            sizes += np.bincount(row, minlength=many)
            known += np.bincount(row[counts[at] > 0], minlength=many)
            base += np.bincount(row, logs[at], many)
        del names, counts, logs
        score = np.zeros(many)
        for part, (nearest, places, words) in enumerate(chunk.strings()):
            order, new = sorted_keys(words)
            first = np.flatnonzero(new)
            distinct = [w[order[first]] for w in words]
            del new, words
            value = values(dealing.of_strings(nearest, distinct), part)
            value = np.repeat(value, np.diff(first, append=len(order)))
            score += np.bincount(np.repeat(np.arange(many), chunk.sizes(places))[order], value, many)
            del places, order, distinct
        taught = np.full(many, total, np.int64)
        pa.default_memory_pool().release_unused()
        return pa.table([chunk.rows.column("doc_id"), chunk.rows.column("held_out"), *[pa.array(x) for x in (sizes, known, taught, base, -score / UNIT)]], names=names_out)

    return run


def score_texts(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

    Rows where ``held_out`` is true do not teach the model.  ``score`` is log10 of
    the probability of the whole text, A-Z in lower case, and its end: its code
    length in decimal digits, negated.  ``base_score`` is the smoothed
    unigram score of its words and end.  A null text counts as empty and has its
    end alone.  Repeated rows are scored, and teach, each.  Without training rows
    every bit is even.  An empty table gives an empty table.  Contexts are of up
    to ``depth`` bytes.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"), held_out.alias("held_out"))
    seen = rows.select("bytes").mapInArrow(_seen, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    bytes_seen = {r["key"]: r["n"] for r in seen.collect()}
    chunks = max(1, -(-sum(bytes_seen.values()) // CHUNK))
    dealing = Dealing(depth, bytes_seen, GROUPS * chunks)
    # One plan: the shuffles of the packs and of the lists are read twice, not made twice.
    packs = rows.mapInArrow(_packs(chunks, CHUNK // PACKS), "chunk long, pack binary")
    lists = packs.groupBy("chunk").applyInArrow(_lists(dealing), LISTS)
    subtrees = lists.groupBy("group").applyInArrow(
        _subtrees(dealing), "place long, suffix long, group long, zeros long, ones long, weighted double")
    tops = subtrees.groupBy("place").applyInArrow(_tops(dealing.top), "group long, suffix long, place long, g0 double, g1 double, rest double")
    answers = lists.groupBy("group").cogroup(tops.groupBy("group")).applyInArrow(
        _answers(dealing, chunks), "chunk long, group long, part long, n long, taught long, distinct long, answers binary")
    return packs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _scored(dealing), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
