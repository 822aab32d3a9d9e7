"""Language-model scores from a hashed maximum-entropy model.

A word's hash gives its class and its member number in the class, and the
probability of a word is

    p(class | history) * p(member | class, history) * p(word | class, member)

The first two are softmaxes over a few outputs each. Their scores sum up weights
of hashed features of the history: a constant, the word before, the two words
before (n-grams), and the words two and three before (skips); members also have
a weight for each class. The last factor is the word's share of the training
count of its class and member, with one added to every count and one part for
unknown words.

Training starts from the shares of classes and members and goes in rounds. In a
round, groups of documents take local stochastic gradient steps from the common
weights. Then each row moves by the mean of the groups' moves, weighted by their
squared gradients, so that a feature which one group alone has seen keeps all it
learnt there. Every training token is used once. The weights have a fixed size
and are all that the driver and the tasks exchange in training. Groups and their
order follow from the documents alone: partitions do not change a score.

Counts: documents are dealt out in chunks; a chunk's vocabulary meets the
corpus counts in a shuffle on the word and comes back to score the chunk. So a
task never holds more than the words of its chunk, and a frequent word's group
has a row for each chunk.

A null or empty text has one token, its end. An id counts as training by the
CRC of its text form; a missing id counts as an empty one. Repeated rows count
again.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import (
    CHUNK_BYTES,
    chunks,
    lower_ascii,
    materialize,
    task_count,
    text_bytes,
    word_crcs,
)

CLASSES = MEMBERS = 24
#: Rows of the weight table: features are hashed to these.
ROWS = 1 << 16
#: The smallest type of a row's number sorts fastest.
_ROW_TYPE = np.min_scalar_type(ROWS - 1)
BATCH = 1024
#: Rows of the weight table that are averaged together.
BLOCK_ROWS = 64
#: Bytes of training text of a group, in each round.
GROUP = 16 << 20
#: Bytes of text whose vocabulary a task holds when it scores.
CHUNK = 12 << 20
#: Squared gradients that every row starts with.
FIRST_SEEN = 1e-5
#: The end of a text counts as a word; no other word is empty.
END = b""

SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def is_held_out() -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(key) % 7 == 2


def tokens_of(text: bytes | None) -> list[bytes]:
    words = lower_ascii(text).split() if text else []
    words.append(END)
    return words


def slot_of(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and member of words' CRCs."""
    return code % CLASSES, code // CLASSES % MEMBERS


def history_rows(code: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Weight rows of each token's features; ``place``: its place in its text."""

    def before(k: int) -> np.ndarray:
        moved = np.zeros(len(code), np.uint64)
        moved[k:] = code[: len(code) - k] if k < len(code) else 0
        return np.where(place >= k, moved, np.uint64(0xFFFFFFFF + k))

    def row(kind: int, value: np.ndarray) -> np.ndarray:
        value = (value + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value = value * np.uint64(0xBF58476D1CE4E5B9)
        return (value >> np.uint64(40)) % np.uint64(ROWS - 1) + np.uint64(1)

    one, two, three = before(1), before(2), before(3)
    pair = one * np.uint64(0x100000001B3) ^ two
    rows = [row(1, one), row(2, pair), row(3, two), row(4, three)]
    return np.stack([np.zeros(len(code), np.uint64), *rows]).astype(np.int64)


def _batches(code: np.ndarray, place: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Every ``BATCH`` tokens and their weight rows, which are made for a few batches at once."""
    for first in range(0, len(code), 16 * BATCH):
        # with the three words before
        own = slice(max(0, first - 3), first + 16 * BATCH)
        rows = history_rows(code[own], place[own])[:, first - own.start :]
        for at in range(0, rows.shape[1], BATCH):
            yield slice(first + at, first + at + BATCH), rows[:, at : at + BATCH]


@dataclass
class Weights:
    """``table``: a row for each feature, classes then members. ``pairs``: class by member.
    ``seen``: squared gradients of each row, and of each class in ``pairs_seen``."""

    table: np.ndarray
    pairs: np.ndarray
    seen: np.ndarray
    pairs_seen: np.ndarray

    @classmethod
    def zero(cls) -> Weights:
        return cls(
            np.zeros((ROWS, CLASSES + MEMBERS), np.float32),
            np.zeros((CLASSES, MEMBERS), np.float32),
            np.full(ROWS, FIRST_SEEN, np.float32),
            np.full(CLASSES, FIRST_SEEN, np.float32),
        )

    @classmethod
    def of_slots(cls, mass: np.ndarray) -> Weights:
        """Weights that give each class and member its share, whatever the history."""
        own, mass = cls.zero(), mass.reshape(MEMBERS, CLASSES).T
        own.table[0, :CLASSES] = np.log(mass.sum(axis=1) / mass.sum())
        own.pairs[:] = np.log(mass / mass.sum(axis=1, keepdims=True))
        return own

    def flat(self) -> np.ndarray:
        parts = (self.table, self.pairs, self.seen, self.pairs_seen)
        return np.concatenate([part.reshape(-1) for part in parts])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> Weights:
        zero, at, out = cls.zero(), 0, []
        for part in (zero.table, zero.pairs, zero.seen, zero.pairs_seen):
            out.append(values[at : at + part.size].reshape(part.shape).copy())
            at += part.size
        return cls(*out)

    def move(self, means: list) -> None:
        """Add the mean moves of blocks to these weights."""
        for row in means:
            seen = np.frombuffer(row.seen, "<f4")
            moves = np.frombuffer(row.moves, "<f2").reshape(len(seen), -1)
            if row.block == ROWS // BLOCK_ROWS:
                self.pairs += moves
                self.pairs_seen += seen
            else:
                own = slice(row.block * BLOCK_ROWS, (row.block + 1) * BLOCK_ROWS)
                self.table[own] += moves
                self.seen[own] += seen

    def probabilities(self, rows: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all classes, and of all members of each token's class: views of one table."""
        # row 0 is the constant, the same for every token
        scores = self.table.take(rows[1], axis=0)
        for own in rows[2:]:
            scores += self.table.take(own, axis=0)
        scores += self.table[0]
        scores[:, CLASSES:] += self.pairs.take(kind, axis=0)
        np.clip(scores, -40, 40, out=scores)  # so that no sum overflows
        np.exp(scores, out=scores)
        classes, members = scores[:, :CLASSES], scores[:, CLASSES:]
        classes /= (classes @ np.ones(CLASSES, np.float32))[:, None]
        members /= (members @ np.ones(MEMBERS, np.float32))[:, None]
        return classes, members

    def update(self, rows: np.ndarray, kind: np.ndarray, member: np.ndarray, rate: float) -> None:
        """One step on a batch of tokens, scaled by each row's squared gradients so far."""
        every = np.arange(len(kind))
        classes, members = self.probabilities(rows, kind)
        classes[every, kind] -= 1
        members[every, member] -= 1
        gradient = classes.base
        gradient /= np.float32(len(kind))

        def step(own, gradient, table, seen):
            target, total = _summed(own, gradient)
            now = seen.take(target)
            now += np.einsum("ij,ij->i", total, total)
            seen[target] = now
            np.sqrt(now, out=now)
            np.divide(np.float32(rate), now, out=now)
            total *= now[:, None]
            # a row is moved as one value, which is quicker than as a row of numbers
            moved = table.take(target, axis=0)
            moved -= total
            whole = np.dtype((np.void, table.itemsize * table.shape[1]))
            table.view(whole)[target] = moved.view(whole)

        for own in rows[1:]:
            step(own, gradient, self.table, self.seen)
        total = gradient.sum(axis=0)
        self.seen[0] += (total**2).sum()
        self.table[0] -= rate * total / np.sqrt(self.seen[0])
        step(kind, np.ascontiguousarray(members), self.pairs, self.pairs_seen)


def _summed(own: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct weight rows of a batch, and the sum of each one's gradients.

    Most rows come once; only those that come again are summed, those that come
    twice at once.
    """
    order = own.astype(_ROW_TYPE).argsort(kind="stable")
    own = own.take(order)
    is_first = np.empty(len(own), bool)
    is_first[0] = True
    np.not_equal(own[1:], own[:-1], out=is_first[1:])
    first = is_first.nonzero()[0]
    times = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=times[:-1])
    times[-1] = len(own) - first[-1]
    total = gradient.take(order.take(first), axis=0)
    twice = (times == 2).nonzero()[0]
    if len(twice):
        total[twice] += gradient.take(order.take(first.take(twice) + 1), axis=0)
    many = (times > 2).nonzero()[0]
    if len(many):
        starts, lengths = first.take(many), times.take(many)
        ends = lengths.cumsum()
        places = np.arange(ends[-1]) + (starts - ends + lengths).repeat(lengths)
        again = gradient.take(order.take(places), axis=0)
        total[many] = np.add.reduceat(again, ends - lengths, axis=0, dtype=np.float64)
    return own.take(first), total


def _coded(texts: list[list[bytes]], codes: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of all tokens of texts that are split already, and their places in their texts."""
    for word in set(chain.from_iterable(texts)).difference(codes):
        codes[word] = zlib.crc32(word)
    lengths = np.array([len(words) for words in texts], np.int64)
    total = int(lengths.sum())
    code = np.fromiter(map(codes.__getitem__, chain.from_iterable(texts)), np.uint64, total)
    return code, _places(lengths)


def _places(lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of all tokens of whole texts, and their places in their texts."""
    lowered = [lower_ascii(text) if text else b"" for text in texts]
    words, counts = word_crcs(pa.array(lowered, pa.binary()))
    code = np.insert(words, np.cumsum(counts), np.uint32(zlib.crc32(END)))
    return code.astype(np.uint64), _places(counts + 1)


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``_numbered`` with the distinct tokens as an Arrow array."""
    # the space before nothing leaves an empty word, the end
    lowered = [lower_ascii(text or b"").strip() for text in texts]
    spaced = [text + b" " if text else b"" for text in lowered]
    tokens = pc.ascii_split_whitespace(pa.array(spaced, pa.large_binary()).view(pa.large_string()))
    found = tokens.flatten().dictionary_encode()
    lengths = tokens.value_lengths().to_numpy().astype(np.int64)
    return lengths, found.indices.to_numpy(), found.dictionary.view(pa.large_binary())


def _numbered(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Each text's number of tokens, the number of every token, and the distinct tokens."""
    lengths, number, words = _tokens(texts)
    return lengths, number, words.to_numpy(zero_copy_only=False).tolist()


def train(docs: DataFrame, start: Weights, rounds: int = 3, rate: float = 1.0) -> Weights:
    """Weights after one pass over all documents, in ``rounds`` parts with a mean after each."""
    groups = task_count(text_bytes(docs) // rounds, GROUP)
    keyed = docs.select(
        F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("key")
    )
    weights = start
    for part in range(rounds):
        own = (
            keyed.filter(F.pmod("key", F.lit(rounds)) == part)
            .withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
            .repartition(groups, "group")
            .sortWithinPartitions("group", "key", "text")
        )
        moves = (
            own.mapInArrow(_learner(weights, rate), _MOVES)
            .repartition("block")
            .sortWithinPartitions("block", "group")
        )
        weights.move(moves.mapInArrow(_mean_moves, _MOVES).collect())
    return weights


#: What a group has learnt: the moves of a block's rows, and their squared gradients.
_MOVES = "block int, group int, moves binary, seen binary"


def _moves(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row[0] for row in found], pa.int32()),
            pa.array([row[1] for row in found], pa.int32()),
            pa.array([row[2].astype("<f2").tobytes() for row in found], pa.binary()),
            pa.array([row[3].astype("<f4").tobytes() for row in found], pa.binary()),
        ],
        ["block", "group", "moves", "seen"],
    )


def _grouped_texts(batches) -> Iterator[tuple[int, bool, list[bytes | None]]]:
    """A group, whether these are its last texts, and the texts, about ``CHUNK_BYTES`` of them.

    Where a list ends depends on the group's own rows, not on the batches they come in.
    """
    last, held, size = None, [], 0
    for batch in chunks(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for group, text in zip(batch.column("group").to_pylist(), texts, strict=True):
            if held and (group != last or size > CHUNK_BYTES):
                yield last, group != last, held
                held, size = [], 0
            last = group
            held.append(text)
            size += len(text or b"")
    if held:
        yield last, True, held


def _learner(start: Weights, rate: float):
    flat = start.flat()

    def learn(batches):
        weights = Weights.from_flat(flat)
        for group, ends, texts in _grouped_texts(batches):
            code, place = _codes(texts)
            for cut, rows in _batches(code, place):
                kind, member = (x.astype(np.int64) for x in slot_of(code[cut]))
                weights.update(rows, kind, member, rate)
            if ends:
                yield from _learnt(weights, Weights.from_flat(flat), group)
                weights = Weights.from_flat(flat)

    return learn


def _learnt(weights: Weights, start: Weights, group: int) -> Iterator[pa.RecordBatch]:
    """Moves of all rows, and of the pairs as the block after the last."""
    moves, seen = weights.table - start.table, weights.seen - start.seen
    found = [
        (at // BLOCK_ROWS, group, moves[at : at + BLOCK_ROWS], seen[at : at + BLOCK_ROWS])
        for at in range(0, ROWS, BLOCK_ROWS)
    ]
    pairs = (weights.pairs - start.pairs, weights.pairs_seen - start.pairs_seen)
    found.append((ROWS // BLOCK_ROWS, group, *pairs))
    yield _moves(found)


def _mean_moves(batches):
    """Mean moves of each block's rows, of sorted blocks; one block is held at a time."""
    last, total, seen = None, None, None

    def mean():
        return _moves([(last, 0, total / np.maximum(seen, 1e-30)[:, None], seen)])

    for batch in batches:
        for block, moves, own in zip(
            *(batch.column(name).to_pylist() for name in ("block", "moves", "seen")), strict=True
        ):
            own = np.frombuffer(own, "<f4").astype(np.float64)
            moves = np.frombuffer(moves, "<f2").reshape(len(own), -1) * own[:, None]
            if block == last:
                total += moves
                seen += own
                continue
            if last is not None:
                yield mean()
            last, total, seen = block, moves, own
    if last is not None:
        yield mean()


def _dealt(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and text, with the chunk that a document belongs to."""
    spark = docs.sparkSession
    count = max(task_count(text_bytes(docs), CHUNK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out().alias("held_out"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int").alias("chunk"),
    ).repartition(count, "chunk")


def _vocabularies(dealt: DataFrame) -> DataFrame:
    """(chunk, word, own): each chunk's words and their count in its training documents.

    A task gives out the words of some texts at a time, so that a chunk may give a
    word more than once.
    """

    def count(batches):
        for batch in chunks(batches):
            lengths, number, words = _tokens(batch.column("text").cast(pa.binary()).to_pylist())
            places, chunk = np.unique(batch.column("chunk").to_numpy(), return_inverse=True)
            is_own = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            key = np.repeat(chunk * len(words), lengths) + number
            size = len(places) * len(words)
            counts = np.bincount(key, minlength=size)
            own = np.bincount(key, np.repeat(is_own, lengths), size).astype(np.int64)
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places[found // len(words)], pa.int32()),
                    words.take(pa.array(found % len(words))).cast(pa.binary()).cast(pa.string()),
                    pa.array(own[found], pa.int64()),
                ],
                ["chunk", "word", "own"],
            )

    return dealt.mapInArrow(count, "chunk int, word string, own bigint")


def score_documents(docs: DataFrame, rounds: int = 3) -> DataFrame:
    """Scores (``SCORES``) of all documents by a model of those not held out."""
    by_word = Window.partitionBy("word")
    vocabulary = materialize(
        _vocabularies(_dealt(docs))
        # one shuffle serves the sums and the window
        .repartition("word")
        .groupBy("word", "chunk")
        .agg(F.sum("own").alias("own"))
        .withColumn("count", F.sum("own").over(by_word))
        .withColumn("is_first", F.col("chunk") == F.min("chunk").over(by_word))
        .select("chunk", "word", "count", "is_first")
    )
    slots = (
        vocabulary.filter("is_first AND count > 0")
        .groupBy((F.crc32("word") % (CLASSES * MEMBERS)).cast("int").alias("slot"))
        .agg(F.sum("count").alias("tokens"), F.count("*").alias("words"))
        .collect()
    )
    slot_mass = np.ones(CLASSES * MEMBERS)
    for row in slots:
        slot_mass[row.slot] += row.tokens + row.words
    train_tokens = sum(row.tokens for row in slots)
    base_mass = math.log10(train_tokens + sum(row.words for row in slots) + 1)
    flat = train(docs.filter(~is_held_out()), Weights.of_slots(slot_mass), rounds).flat()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        weights = Weights.from_flat(flat)
        words = right.column("word").cast(pa.binary()).to_pylist()
        number = dict(zip(words, range(len(words)), strict=True))
        count = np.array(right.column("count").to_numpy(), np.float64)
        code = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        kind, member = (x.astype(np.int64) for x in slot_of(code))
        add_one = np.log10(count + 1)
        leaf = add_one - np.log10(slot_mass[(code % (CLASSES * MEMBERS)).astype(np.int64)])
        known = count > 0
        out: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for batch in chunks(left.select(["text"]).to_batches()):
            lengths, own, words = _numbered(batch.column("text").cast(pa.binary()).to_pylist())
            starts = np.cumsum(lengths) - lengths
            own = np.fromiter(map(number.__getitem__, words), np.int64, len(words))[own]
            logs = leaf[own]
            for cut, rows in _batches(code[own], _places(lengths)):
                k, m = kind[own[cut]], member[own[cut]]
                classes, members = weights.probabilities(rows, k)
                every = np.arange(len(k))
                logs[cut] += np.log10(np.maximum(classes[every, k], 1e-30))
                logs[cut] += np.log10(np.maximum(members[every, m], 1e-30))
            out["n_tokens"] += lengths.tolist()
            out["n_known"] += np.add.reduceat(known[own].astype(np.int64), starts).tolist()
            base = np.add.reduceat(add_one[own], starts) - lengths * base_mass
            out["base_score"] += base.tolist()
            out["score"] += np.add.reduceat(logs, starts).tolist()
        out["train_tokens"] = [train_tokens] * left.num_rows
        names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = {"doc_id": left.column("doc_id"), "held_out": left.column("held_out")}
        columns |= {n: pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)}
        return pa.table(columns)

    return (
        _dealt(docs)
        .groupBy("chunk")
        .cogroup(vocabulary.select("chunk", "word", "count").groupBy("chunk"))
        .applyInArrow(score, SCORES)
    )
