"""Operator 1: language-model scoring by context-tree weighting.

A text is scored as its tokens (white-space words, A-Z lower-cased) with one
space between and an end mark: the same events that the base model, smoothed
token counts, scores. Each byte is eight binary decisions; each decision has a
context tree over the preceding `depth` bytes. A node mixes its own
Krichevsky-Trofimov estimate with the product of its children's (weights of one
half before the data), from depth to the root (Willems, Shtarkov and Tjalkens
1995). The predictive probability of a bit is the mixture of the estimates of
all depths on its path. A context that training never saw leaves what weight
reaches it to the estimate of its parent.

Counts of all decisions follow from counts of (context, byte) strings, so
training counts those once. No count is dropped and nothing is hashed away: the
tree grows with the corpus, and is never held in one place.

1. Texts are normalised and dealt to blocks of a bounded number of bytes in the
   order they are read. 2. Each block sends its distinct strings, with training
   counts, to buckets named by the last three bytes of context. 3. A bucket adds
   up the blocks' counts and weights the subtrees below depth three; their roots
   (whose number is bounded by the alphabet) are joined to the top of the tree
   byte by byte of the newest context, 256 tasks, and only the nodes of depth
   one, at most 256 times 255, meet in one. 4. Buckets answer each block with the log probabilities
   of its own strings, and the block scores its texts. Words for the base model
   take the same way. Blocks and buckets are packed arrays, streamed in order,
   so a task holds one bucket's or one block's distinct strings. A block sends
   a row to each bucket that it has strings for, so rows are never more than
   the distinct strings of all blocks, which grow with the input. A text longer
   than a block is a block of its own and is held whole by its task.

Null texts count as empty: an end mark alone. A null id counts as empty text
where its remainder is taken. Repeated rows are learned and scored each. With no
training text every bit has probability one half and the base score is 0. Only
doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import common

DEPTH, ROOTS = 6, 3  # bytes of context; depth of the subtrees that buckets hold
BLOCK_BYTES = 32 << 20
END = b"\xff"  # stands before and after a text; no UTF-8 text holds it
STRIDE = 2 << 20  # positions that are worked on at a time
U = np.uint64


def _z(a: np.ndarray) -> bytes:
    """Compressed, all first bytes of the numbers first, then all second ones."""
    planes = np.ascontiguousarray(np.ascontiguousarray(a).reshape(-1).view(np.uint8).reshape(-1, a.itemsize).T)
    return zstandard.compress(planes, 1)


def _unz(b: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return _z(np.diff(a, prepend=U(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unz(b, U), dtype=U)


# the tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps further on."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    lower = np.ones_like(x)
    for i in range(8):
        lower *= x + i
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(lower)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Level:
    """The nodes of one depth: key is the context, newest byte first, and the
    decision's bits so far; up is the index of each node's parent."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.key, self.zeros, self.ones = key, zeros, ones
        estimate = log_kt(zeros, ones)
        if below is None:
            self.weighted, self.own = estimate, np.ones(len(key))
        else:
            self.weighted = np.logaddexp(estimate, below) - math.log(2)
            self.own = np.exp(estimate - math.log(2) - self.weighted)
        self.up: np.ndarray | None = None

    @property
    def seen(self) -> np.ndarray:
        return self.zeros + self.ones > 0

    @property
    def one(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1)

    def parents(self) -> Level:
        key = ((self.key >> U(16)) << U(8)) | (self.key & U(255))
        parent, self.up = np.unique(key, return_inverse=True)
        add = lambda v: np.bincount(self.up, v, len(parent))
        return Level(parent, add(self.zeros), add(self.ones), add(self.weighted))


class State:
    """What the path above leaves a level's nodes: probability of a one so far,
    weight left, and what an unseen node predicts."""

    def __init__(self, so_far: np.ndarray, left: np.ndarray, unseen: np.ndarray):
        self.so_far, self.left, self.unseen = so_far, left, unseen

    @staticmethod
    def root(level: Level) -> State:
        n = len(level.key)
        return State(np.zeros(n), np.ones(n), np.full(n, 0.5))

    def predict(self, level: Level) -> np.ndarray:
        return np.where(level.seen, self.so_far + self.left * level.one, self.unseen)

    def below(self, level: Level, child: Level) -> State:
        told = self.predict(level)[child.up]
        so_far = (self.so_far + self.left * level.own * level.one)[child.up]
        return State(so_far, (self.left * (1 - level.own))[child.up], told)


def decisions(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and bits of the eight decisions of each (context, byte) string."""
    context, byte = strings >> U(8), strings & U(255)
    keys = [(context << U(8)) | U(1 << j) | (byte >> U(8 - j)) for j in range(8)]
    bits = [(byte >> U(7 - j)) & U(1) for j in range(8)]
    return np.concatenate(keys), np.concatenate(bits).astype(bool)


def levels(strings: np.ndarray, counts: np.ndarray, depth: int, roots: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels from depth up to roots, and for each decision its node and bit."""
    keys, bits = decisions(strings)
    key, node = np.unique(keys, return_inverse=True)
    n = np.tile(counts.astype(np.float64), 8)
    out = [Level(key, np.bincount(node, n * ~bits, len(key)), np.bincount(node, n * bits, len(key)), None)]
    for _ in range(depth - roots):
        out.append(out[-1].parents())
    return out, node, bits


def log10_of(strings: np.ndarray, counts: np.ndarray, depth: int, roots: int, top: State) -> np.ndarray:
    """log10 probability of each string's byte after its context."""
    if not len(strings):
        return np.zeros(0)
    chain, node, bits = levels(strings, counts, depth, roots)
    state = top
    for level, child in zip(chain[:0:-1], chain[-2::-1], strict=True):
        state = state.below(level, child)
    one = np.clip(state.predict(chain[0]), 1e-15, 1 - 1e-15)[node]
    return np.log10(np.where(bits, one, 1 - one)).reshape(8, -1).sum(axis=0)


def rise(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray, steps: int) -> list[Level]:
    """Levels from weighted nodes on, so many depths up."""
    first = Level(key, zeros, ones, None)
    first.weighted = weighted
    chain = [first]
    for _ in range(steps):
        chain.append(chain[-1].parents())
    return chain


def descend(chain: list[Level], state: State) -> State:
    """The state of the lowest level of a chain, given that of its highest."""
    for level, child in zip(chain[:0:-1], chain[-2::-1], strict=True):
        state = state.below(level, child)
    return state


# texts and blocks


def strings_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) string of every byte and end mark of the texts, the
    newest byte of context highest, and each text's number of them."""
    pad = END * depth
    joined = np.frombuffer(b"".join([pad + t + END for t in texts]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    code = np.zeros(len(joined), U)
    for k in range(1, depth + 1):
        code <<= U(8)
        code[k:] |= joined[:-k]
    code <<= U(8)
    code |= joined
    starts = np.cumsum([0, *(lengths[:-1] + depth)]) + depth
    keep = np.ones(len(joined), bool)
    for k in range(1, depth + 1):
        keep[starts - k] = False
    return code[keep], lengths


def _strides(rows: Iterable[tuple], size) -> Iterator[list[tuple]]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= STRIDE:
            yield held
            held, n = [], 0
    if held:
        yield held


def _add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    key = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(key)
    key, n = key[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[starts], np.add.reduceat(n, starts)


class Sum:
    """Adds sorted arrays of counts, merging whenever much has gathered."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((key, n))
        self.waiting += len(key)
        if self.waiting > max(STRIDE, 2 * len(self.parts[0][0])):
            self.parts = [_add(self.parts)]
            self.waiting = 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        self.parts = [_add(self.parts)]
        return self.parts[0]


DOCS = "block long, doc_id {kind}, held_out boolean, text binary"
PARTS = "block long, bucket int, kind int, keys binary, numbers binary"
WORDS, STRINGS, ROOT, STATE = 0, 1, 2, 3


def to_blocks(docs: DataFrame, *, fold: int, block_bytes: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == fold
    rows = docs.select("doc_id", held.alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            names, texts = [], []
            for text in b.column("text"):
                t = b" ".join(text.as_py().lower().split())
                if size and size + len(t) > block_bytes:
                    block, size = block + 1, 0
                size += len(t) + 1
                names.append(block)
                texts.append(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), b.column("doc_id"), b.column("held_out"), pa.array(texts, pa.binary())],
                names=["block", "doc_id", "held_out", "text"],
            )

    return rows.mapInArrow(run, DOCS.format(kind=kind))


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for b in batches:
        columns = [b.column(n) for n in names]
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows by their first field, which comes in runs; streamed."""
    from itertools import groupby

    yield from groupby(rows, key=lambda r: r[0])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["block", "bucket", "kind", "keys", "numbers"],
    )


def bucket_of(strings: np.ndarray, depth: int, roots: int, buckets: int) -> np.ndarray:
    context = strings >> U(8 * (depth - roots + 1))
    return ((context * U(0x9E3779B97F4A7C15)) >> U(33)) % U(buckets)


def count_blocks(blocks: DataFrame, *, depth: int, roots: int, buckets: int) -> DataFrame:
    """For each block and bucket the block's distinct words and strings with
    their counts in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _runs(_rows(batches, ["block", "held_out", "text"])):
            words: Counter = Counter()
            asked: set = set()
            strings = Sum()
            for part in _strides(rows, lambda r: len(r[2])):
                for held in (False, True):
                    texts = [t for _, h, t in part if h == held]
                    if not texts:
                        continue
                    key, n = np.unique(strings_of(texts, depth)[0], return_counts=True)
                    strings.add(key, np.zeros(len(key), np.int64) if held else n.astype(np.int64))
                    for t in texts:
                        (asked if held else words).update(t.split())
            asked -= words.keys()
            by: dict[int, list[bytes]] = defaultdict(list)
            for w in [*words, *asked]:
                by[zlib.crc32(w) % buckets].append(w)
            out = []
            for i, held_words in by.items():
                if held_words:
                    n = np.array([words[w] if w in words else 0 for w in held_words], np.int64)
                    out.append((block, i, WORDS, zstandard.compress(b" ".join(held_words), 1), _z(n)))
            key, n = strings.total()
            of = bucket_of(key, depth, roots, buckets)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(buckets + 1, dtype=U))
            for i in np.flatnonzero(ends[:-1] < ends[1:]).tolist():
                at = order[ends[i] : ends[i + 1]]
                out.append((block, i, STRINGS, pack_sorted(key[at]), _z(n[at])))
            if out:
                yield _batch(out)

    return blocks.select("block", "held_out", "text").mapInArrow(run, PARTS)


def weigh(parts: DataFrame, *, depth: int, roots: int, buckets: int) -> DataFrame:
    """One row for each bucket and kind with the summed counts (kinds WORDS and
    STRINGS) and one for each newest byte of context with the subtrees' roots
    (kind ROOT, the byte in place of the block)."""
    dealt = parts.select("bucket", "kind", "keys", "numbers").repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(_rows(batches, ["bucket", "kind", "keys", "numbers"])):
            words: Counter = Counter()
            strings = Sum()
            for _, kind, keys, numbers in rows:
                n = _unz(numbers, np.int64)
                if kind == WORDS:
                    for w, k in zip(zstandard.decompress(keys).split(b" "), n.tolist(), strict=True):
                        if k:
                            words[w] += k
                else:
                    strings.add(unpack_sorted(keys), n)
            if words:
                n = np.array(list(words.values()), np.int64)
                yield _batch([(int(n.sum()), bucket, WORDS, zstandard.compress(b" ".join(words), 1), _z(n))])
            key, n = strings.total()
            if len(key):
                root = levels(key, n, depth, roots)[0][-1]
                byte = root.key >> U(8 * roots)
                ends = np.searchsorted(byte, np.arange(257, dtype=U))
                out = [(0, bucket, STRINGS, pack_sorted(key), _z(n))]
                for i in np.flatnonzero(ends[:-1] < ends[1:]).tolist():
                    part = slice(ends[i], ends[i + 1])
                    out.append((i, bucket, ROOT, pack_sorted(root.key[part]), _z(np.stack([root.zeros[part], root.ones[part], root.weighted[part]]))))
                yield _batch(out)

    return dealt.mapInArrow(run, PARTS)


def _roots_of_a_byte(rows: list[tuple], steps: int) -> tuple[list[np.ndarray], list[Level]]:
    """The keys of each row and the chain from all of them up."""
    keys = [unpack_sorted(r[3]) for r in rows]
    values = np.concatenate([_unz(r[4], np.float64).reshape(3, -1) for r in rows], axis=1)
    return keys, rise(np.concatenate(keys), *values, steps)


def weigh_top(model: DataFrame, *, roots: int) -> DataFrame:
    """For each bucket and newest byte of context the state of its subtrees'
    roots (kind STATE). Bytes are worked on apart; of the nodes of depth one,
    which alone meet in one task, there are at most 256 times 255."""
    kinds = ["block", "bucket", "kind", "keys", "numbers"]
    held = model.where(F.col("kind") == ROOT).select(*kinds)
    by_byte = held.repartitionById(64, F.pmod("block", F.lit(64)).cast("int")).sortWithinPartitions("block", "bucket")

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for byte, rows in _runs(_rows(batches, kinds)):
            top = _roots_of_a_byte(list(rows), roots - 1)[1][-1]
            order = np.argsort(top.key)
            yield _batch([(byte, -1, ROOT, pack_sorted(top.key[order]), _z(np.stack([top.zeros, top.ones, top.weighted])[:, order]))])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(_rows(batches, kinds))
        if not rows:
            return
        keys, chain = _roots_of_a_byte(rows, 1)
        state, at = descend(chain, State.root(chain[-1])), 0
        for row, k in zip(rows, keys, strict=True):
            part = slice(at, at + len(k))
            at += len(k)
            yield _batch([(row[0], -1, STATE, pack_sorted(k), _z(np.stack([state.so_far[part], state.left[part], state.unseen[part]])))])

    firsts = common.settle(by_byte.mapInArrow(up, PARTS), "ctw-firsts")
    states = common.settle(firsts.repartition(1).mapInArrow(join, PARTS), "ctw-first-states")

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for byte, rows in _runs(_rows(batches, kinds)):
            (*_, first_keys, first_state), *own = rows  # the state's bucket is -1
            keys, chain = _roots_of_a_byte(own, roots - 1)
            held, place = _unz(first_state, np.float64).reshape(3, -1), np.searchsorted(unpack_sorted(first_keys), chain[-1].key)
            state, at = descend(chain, State(*held[:, place])), 0
            for row, k in zip(own, keys, strict=True):
                part = slice(at, at + len(k))
                at += len(k)
                yield _batch([(byte, row[1], STATE, b"", _z(np.stack([state.so_far[part], state.left[part], state.unseen[part]])))])

    both = held.unionByName(states).repartitionById(64, F.pmod("block", F.lit(64)).cast("int")).sortWithinPartitions("block", "bucket")
    return both.mapInArrow(down, PARTS)


def answer(parts: DataFrame, model: DataFrame, top: DataFrame, *, depth: int, roots: int, buckets: int) -> DataFrame:
    """parts with the counts of words and log10 probabilities of strings."""
    kinds = ["block", "bucket", "kind", "keys", "numbers"]
    both = (
        model.where(F.col("kind") <= STRINGS)
        .unionByName(top)
        .select(F.lit(0).alias("turn"), *kinds)
        .unionByName(parts.select(F.lit(1).alias("turn"), *kinds))
    )
    dealt = both.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "turn", "kind", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(_rows(batches, ["bucket", "turn", "kind", "block", "keys", "numbers"])):
            words: dict[bytes, int] = {}
            key, n, told = np.zeros(0, U), np.zeros(0, np.int64), None
            states: list[np.ndarray] = []  # by newest byte, as the roots' keys rise
            for _, turn, kind, block, keys, numbers in rows:
                if turn == 0 and kind == WORDS:
                    words = dict(zip(zstandard.decompress(keys).split(b" "), _unz(numbers, np.int64).tolist(), strict=True))
                elif turn == 0 and kind == STRINGS:
                    key, n = unpack_sorted(keys), _unz(numbers, np.int64)
                elif turn == 0:
                    states.append(_unz(numbers, np.float64).reshape(3, -1))
                elif kind == WORDS:
                    found = [words.get(w, 0) for w in zstandard.decompress(keys).split(b" ")]
                    yield _batch([(block, bucket, kind, keys, _z(np.array(found, np.int64)))])
                else:
                    if told is None:
                        top = State(*np.concatenate(states, axis=1)) if states else None
                        told = log10_of(key, n, depth, roots, top).astype(np.float32)
                        states.clear()
                    yield _batch([(block, bucket, kind, keys, _z(told[np.searchsorted(key, unpack_sorted(keys))]))])

    return dealt.mapInArrow(run, PARTS)


class Lookup:
    """Values of sorted keys by a direct table; what shares a slot is searched."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.shift = U(64 - max(4, int(len(keys)).bit_length() + 1))
        self.table = np.zeros(1 << int(U(64) - self.shift), np.int32)
        self.table[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * U(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self._slot(keys)]
        miss = np.flatnonzero(self.keys[at] != keys)
        at[miss] = np.searchsorted(self.keys, keys[miss])
        return self.values[at]


RESULT = (
    "doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double, n_bytes long, bits_per_byte double"
)


def score_blocks(blocks: DataFrame, answers: DataFrame, *, depth: int, tokens: int, distinct: int, texts: int, n: int, sources: int) -> DataFrame:
    kind = blocks.schema["doc_id"].dataType.simpleString()
    nothing = F.lit(None)
    both = answers.select(
        "block", "kind", nothing.cast(kind).alias("doc_id"), nothing.cast("boolean").alias("held_out"), "keys", "numbers"
    ).unionByName(
        blocks.select("block", F.lit(9).alias("kind"), "doc_id", "held_out", F.col("text").alias("keys"), nothing.cast("binary").alias("numbers"))
    )
    # a block's number is its input partition's and its place there: a task each, or few
    place = F.pmod(F.shiftright("block", 32) + F.col("block").bitwiseAND(F.lit((1 << 32) - 1)) * sources, F.lit(n)).cast("int")
    dealt = both.repartitionById(n, place).sortWithinPartitions("block", "kind")
    scale = math.log10(tokens + 0.5 * (distinct + 1))
    unknown, end = math.log10(0.5) - scale, math.log10(texts + 0.5) - scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(_rows(batches, ["block", "kind", "doc_id", "held_out", "keys", "numbers"])):
            words: dict[bytes, float] = {}
            keys, values = [], []
            docs = None
            for row in rows:
                if row[1] == WORDS:
                    found = zstandard.decompress(row[4]).split(b" ")
                    logs = np.log10(_unz(row[5], np.int64) + 0.5) - scale
                    words.update((w, x) for w, x, c in zip(found, logs.tolist(), _unz(row[5], np.int64).tolist(), strict=True) if c)
                elif row[1] == STRINGS:
                    keys.append(unpack_sorted(row[4]))
                    values.append(_unz(row[5], np.float32))
                else:
                    docs = row
                    break
            if docs is None:
                continue
            key, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(key)
            lookup = Lookup(key[order], value[order])
            del keys, values, key, value, order

            def all_docs(first: tuple = docs, rest: Iterator[tuple] = rows) -> Iterator[tuple]:
                yield first
                yield from rest

            for part in _strides(all_docs(), lambda r: len(r[4])):
                codes, lengths = strings_of([r[4] for r in part], depth)
                sums = np.add.reduceat(lookup(codes).astype(np.float64), np.cumsum([0, *lengths[:-1]]))
                out = []
                for (_, _, doc_id, held, text, _), total, size in zip(part, sums.tolist(), lengths.tolist(), strict=True):
                    logs = list(map(words.get, text.split()))
                    missed = logs.count(None)
                    base = sum(filter(None, logs)) + missed * unknown + end
                    known = len(logs) - missed + (texts > 0)
                    bits = -total / math.log10(2) / size
                    out.append((doc_id, held, len(logs) + 1, known, tokens, base, total, size, bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)],
                    names=[f.name for f in arrow],
                )

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = RESULT.format(kind=kind)
    arrow = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema)
    return dealt.mapInArrow(run, schema)


def score(docs: DataFrame, *, fold: int = 1, depth: int = DEPTH, roots: int = ROOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (the
    model's log10 probability), n_bytes, bits_per_byte of every document, of
    models trained on the documents outside the fold."""
    if not 1 <= roots < depth <= 7:
        raise ValueError("depth must lie between roots + 1 and 7")
    blocks = common.settle(to_blocks(docs, fold=fold, block_bytes=block_bytes), "ctw-blocks")
    size = blocks.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("texts"),
        F.approx_count_distinct("block").alias("blocks"), F.max(F.shiftright("block", 32)).alias("last"),
    ).first()
    buckets = max(16, -(-(size["bytes"] or 0) // block_bytes))
    shape = {"depth": depth, "roots": roots, "buckets": buckets}
    parts = common.settle(count_blocks(blocks, **shape), "ctw-parts")
    model = common.settle(weigh(parts, **shape), "ctw-model")
    top = common.settle(weigh_top(model, roots=roots), "ctw-top")
    words = model.where(F.col("kind") == WORDS)
    distinct = words.select("keys").mapInArrow(_distinct, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0
    tokens = (words.agg(F.sum("block").alias("n")).first()["n"] or 0) + size["texts"]
    answers = answer(parts, model, top, **shape)
    return score_blocks(
        blocks, answers, depth=depth, tokens=tokens, distinct=distinct + (size["texts"] > 0), texts=size["texts"],
        n=max(1, size["blocks"]), sources=1 + (size["last"] or 0),
    )


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = [zstandard.decompress(k.as_py()).count(b" ") + 1 for k in b.column("keys")]
        yield pa.RecordBatch.from_pydict({"n": pa.array(n, pa.int64())})


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"))
