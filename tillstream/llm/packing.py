"""Packing documents into fixed windows by lexical retrieval.

Documents are dealt out by a lexical key, so that those which share weighty words
come into one shard, and a BM25 inverted index is built for each shard. The key is
a weighted min-hash: of a text's words, ordered by a random priority that favours
rare ones, the first that another text has among its own first ones. Copies have
the same key, other texts with a chance that grows with the weight of what they
share; a text without such a word is its own key. Keys of many documents are
split into blocks by a hash of the row. A neighbour under another key is met only
by chance: the README says how many are.

A seed document fills windows with its own ids; its tail opens a window that is filled with the
seed's unused neighbours, best score first. The neighbour that does not fit is
cut there: its rest opens the next window and it becomes the next seed. Without
an unused neighbour that shares a weighty word, the next unused document in
order follows. The open window goes on into the task's next shard, so a task
leaves at most one window that needs padding.

Terms found in more than half of a shard weigh nothing in BM25 (their inverse
document frequency is set to 0), all other terms of the seed count.

Within a block rows are sorted by doc_id and text, so that a task that runs again
gives the same pieces. A null or empty text is its end id
alone; repeated rows are packed one by one; an empty table gives no piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import (
    chunks,
    give_back,
    materialize,
    only_keep,
    task_count,
    text_bytes,
    word_crcs,
)
from tillstream.llm.token_ids import byte_bpe

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)
#: Sequence numbers of one task start at this multiple of its number.
SEQUENCES_PER_TASK = 1 << 32
#: A shard is closed at so many documents or ids.
SHARD_DOCUMENTS, SHARD_IDS = 2048, 1 << 22
#: Documents of one key that stay together.
BLOCK_DOCUMENTS = 256
#: Words of a text that can become its key.
KEY_WORDS = 12
#: Words that are weighed by their number of documents, the most frequent ones.
WEIGHED_WORDS = 1 << 16
#: Words that a task gathers before it sums up their counts.
COUNTED_WORDS = 1 << 20
#: Frequent terms of a shard whose weights stand in a table of terms by documents.
TABLED_TERMS = 256


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs; ``keys`` is sorted in place."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


def _up_to_nth(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Whether a value is at most the ``n``-th smallest of its run, equal ones included."""
    kept = np.ones(len(values), bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a > n:
            own = values[a:b]
            kept[a:b] = own <= np.partition(own, n - 1)[n - 1]
    return kept


def word_hashes(text: str | None) -> np.ndarray:
    return word_crcs(pa.array([text], pa.string()))[0]


def _words_by_document(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and distinct word hashes, sorted by both."""
    words, counts = word_crcs(texts)
    doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    keys, _ = _counted(doc << np.uint64(32) | words)
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


class _WordCounts:
    """Counts of word hashes, which are summed up whenever many have gathered."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, words: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((words, counts))
        self.size += len(words)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct words and their counts, which are all that stay."""
        if len(self.held) > 1:
            words, counts = (np.concatenate(own) for own in zip(*self.held, strict=True))
            order = np.argsort(words)
            words, counts = words[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])[: len(words)])
            counts = np.add.reduceat(counts, first) if len(first) else counts
            self.held, self.size = [(words[first], counts)], len(first)
        return self.held[0]


def _counts_of_documents(batches):
    """(part, words, counts): in how many texts each word is; a part holds hashes of a range."""
    found = _WordCounts()

    def given():
        words, counts = found.total()
        cuts = np.searchsorted(words, np.arange(257) << 24)
        parts = np.flatnonzero(np.diff(cuts))
        arrays = [
            pa.array([own[cuts[k] : cuts[k + 1]].astype(kind).tobytes() for k in parts], pa.binary())
            for own, kind in ((words, "<u4"), (counts, "<i8"))
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), *arrays], ["part", "words", "counts"]
        )

    only_keep("words")
    for batch in chunks(batches):
        found.add(*_counted(_words_by_document(batch.column("text"))[1]))
        if found.size > COUNTED_WORDS and len(found.total()[0]) > COUNTED_WORDS // 2:
            yield given()
            found = _WordCounts()
    if found.held:
        yield given()


def _counts_of_parts(batches):
    """(word, count) of words in more than two texts, from sorted parts; one is held at a time."""
    last, found = None, _WordCounts()

    def given():
        words, counts = found.total()
        return pa.RecordBatch.from_arrays(
            [pa.array(words[counts > 2]), pa.array(counts[counts > 2])], ["word", "count"]
        )

    for batch in batches:
        for part, words, counts in zip(*(own.to_pylist() for own in batch.columns), strict=True):
            if part != last and found.held:
                yield given()
                found = _WordCounts()
            last = part
            found.add(np.frombuffer(words, "<u4").astype(np.int64), np.frombuffer(counts, "<i8"))
            if found.size > 2 * COUNTED_WORDS:
                found.total()
    if found.held:
        yield given()


def _word_weights(docs: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of frequent words, and their inverse document frequencies.

    They are counted over all documents and only order the words of a text. Words
    that are not found weigh most.
    """
    found = (
        docs.select("text")
        .mapInArrow(_counts_of_documents, "part int, words binary, counts binary")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_counts_of_parts, "word bigint, count bigint")
        .orderBy(F.desc("count"), "word")
        .limit(WEIGHED_WORDS)
        .collect()
    )
    words = np.array([row["word"] for row in found], np.int64)
    df = np.array([row["count"] for row in found], np.float64)
    order = np.argsort(words)
    return words[order], np.maximum(np.log((rows - df + 0.5) / (df + 0.5)), 0.0)[order]


def _key_words(docs: DataFrame, rows: int) -> DataFrame:
    """(id, word, place): the first ``KEY_WORDS`` words of each text by priority."""
    frequent, weights = _word_weights(docs, rows)
    most = np.log(max(1, rows) + 0.5)

    def make(batches):
        for batch in chunks(batches):
            doc, words = _words_by_document(batch.column("text"))
            weight = np.full(len(words), most)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
                weight = np.where(frequent[at] == words, weights[at], weight)
            doc, words, weight = (x[weight > 0] for x in (doc, words, weight))
            mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            chance = ((mixed >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)
            priority = -np.log(chance) / weight**2
            # no later one than the text's KEY_WORDS-th can be its key
            near = _up_to_nth(priority, np.searchsorted(doc, np.arange(batch.num_rows + 1)), KEY_WORDS)
            doc, words, priority = doc[near], words[near], priority[near]
            order = np.lexsort((words, priority, doc))
            doc, words = doc[order], words[order]
            place = np.arange(len(doc)) - np.searchsorted(doc, doc)
            first = place < KEY_WORDS
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(doc[first])), pa.array(words[first]), pa.array(place[first])],
                ["id", "word", "place"],
            )

    return docs.select("id", "text").mapInArrow(make, "id bigint, word bigint, place bigint")


def lexical_keys(docs: DataFrame) -> DataFrame:
    """(id, key, blocks) for each hash ``id`` of a text: its key, and in how many blocks that is split."""
    ids = materialize(docs.groupBy("id").agg(F.count("*").alias("rows")))
    words = materialize(_key_words(docs, ids.agg(F.sum("rows")).first()[0] or 0))
    shared = (
        words.groupBy("word")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .filter("least <> most")
    )
    chosen = words.join(shared, "word").groupBy("id").agg(F.min(F.struct("place", "word")).alias("best"))
    keys = materialize(
        ids.join(chosen, "id", "left").select(
            "id", "rows", F.coalesce(F.xxhash64("best.word"), "id").alias("key")
        )
    )
    sizes = keys.groupBy("key").agg(F.ceil(F.sum("rows") / BLOCK_DOCUMENTS).alias("blocks"))
    return keys.join(sizes, "key").select("id", "key", "blocks")


def deal_out(docs: DataFrame, tasks: int) -> DataFrame:
    """task, doc_id and text, with the rows of a key's block next to each other."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("id", F.xxhash64("text"))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.col("blocks"))
    return (
        rows.join(materialize(lexical_keys(rows)), "id")
        .select("doc_id", "text", "key", block.alias("block"))
        .repartition(tasks, "key", "block")
        .sortWithinPartitions("key", "block", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
        .select(F.spark_partition_id().alias("task"), "doc_id", "text")
    )


class LexicalIndex:
    """BM25 over the documents of a shard."""

    def __init__(self, terms: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        """``terms``: the hashes of each document's words, repeated ones too."""
        count = self.size = len(terms)
        lengths = np.array([len(own) for own in terms], np.int64)
        keys = np.concatenate([*terms, np.zeros(0, np.uint32)]).astype(np.uint64)
        keys <<= np.uint64(24)
        keys |= np.repeat(np.arange(count, dtype=np.uint64), lengths)
        keys, tf = _counted(keys)
        self.doc_of = (keys & np.uint64((1 << 24) - 1)).astype(np.int64)
        keys >>= np.uint64(24)
        _, df = _counted(keys)
        del keys
        self.term_of = np.repeat(np.arange(len(df), dtype=np.int32), df)
        self.starts = np.concatenate([[0], np.cumsum(df)])
        idf = np.maximum(np.log((count - df + 0.5) / (df + 0.5)), 0.0)
        norm = k1 * (1 - b + b * lengths / max(lengths.mean() if count else 1, 1e-9))
        weights = tf * (k1 + 1)
        weights /= tf + norm[self.doc_of]
        del tf
        weights *= idf[self.term_of]
        # rounded, and as wide as the scores that are summed of them
        self.weights = weights.astype(np.float32).astype(np.float64)
        del weights
        # most postings are of a few terms: their scores come of one product
        often = np.flatnonzero(df > count // 8)
        often = often[np.argsort(-df[often], kind="stable")][:TABLED_TERMS]
        row = np.full(len(df), -1, np.int16)
        row[often] = np.arange(len(often))
        row = row[self.term_of]
        useful = np.flatnonzero((self.weights > 0) & (df[self.term_of] > 1) & (row < 0))
        own = np.flatnonzero((row >= 0) & (self.weights > 0))
        table = np.zeros((len(often), count))
        table[row[own], self.doc_of[own]] = self.weights[own]
        del row, own
        self.tabled, self.kept = (table > 0).T.astype(np.float64) @ table, np.ones(count)
        del table
        # the smallest type sorts fastest
        docs = self.doc_of[useful].astype(np.min_scalar_type(count))
        order = useful[np.argsort(docs, kind="stable")]
        self.terms_by_doc = self.term_of[order]
        self.doc_starts = np.searchsorted(self.doc_of[order], np.arange(count + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Scores of all documents for the seed's terms; 0 for the seed itself."""
        terms = self.terms_by_doc[self.doc_starts[seed] : self.doc_starts[seed + 1]]
        lengths = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[terms] - (ends - lengths), lengths)
        at += np.arange(len(at))
        scores = self.tabled[seed] * self.kept
        scores += np.bincount(self.doc_of.take(at), self.weights.take(at), self.size)
        scores[seed] = 0
        return scores

    def drop(self, used: np.ndarray) -> None:
        """Score used documents no more; they can still be seeds."""
        self.kept = (~used).astype(np.float64)
        kept = ~used[self.doc_of]
        self.starts = np.concatenate([[0], np.cumsum(kept)])[self.starts]
        self.doc_of, self.weights = self.doc_of[kept], self.weights[kept]


class WindowFiller:
    """Lays documents into windows of ``size`` ids, one after another."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence, self.filled = size, first_sequence, 0

    def lay(self, doc_id, ids: bytes):
        """The pieces of a whole document."""
        total, start = len(ids) // 4, 0
        while start < total:
            length = min(self.size - self.filled, total - start)
            piece = ids[4 * start : 4 * (start + length)]
            yield (
                doc_id, start, length, zlib.crc32(piece), total, self.sequence, self.filled, piece,
            )
            start, self.filled = start + length, self.filled + length
            if self.filled == self.size:
                self.sequence, self.filled = self.sequence + 1, 0

    def lay_shard(self, doc_ids: list, ids: list[bytes], terms: list[np.ndarray]):
        """The pieces of all documents of a shard."""
        index, unused, first = LexicalIndex(terms), np.ones(len(ids), bool), 0
        scores, left = None, len(ids)
        some = left // 8 + 1
        while True:
            doc = None
            if scores is not None:
                # the best unused neighbour, the first of equals
                best = int(np.argmax(scores))
                doc = best if scores[best] > 0 else None
            if doc is None:
                while first < len(ids) and not unused[first]:
                    first += 1
                if first == len(ids):
                    return
                doc = first
            unused[doc] = False
            left -= 1
            if left % some == 0:
                index.drop(~unused)
            new_seed = scores is None or scores[doc] <= 0
            sequence = self.sequence
            yield from self.lay(doc_ids[doc], ids[doc])
            if not self.filled:
                scores = None
            elif new_seed or self.sequence != sequence:
                scores = index.scores(doc) * unused
            else:
                scores[doc] = 0


def pack_documents(
    docs: DataFrame,
    window: int = 1024,
    end: int = 0,
    tokenizer: str | None = None,
    task_bytes: int = 16 << 20,
) -> DataFrame:
    """Pieces (``PIECES``) of all documents, with their ids as unsigned 32-bit numbers."""
    tasks = task_count(text_bytes(docs), task_bytes)
    dealt = deal_out(docs, tasks)
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.binary()]

    def make(batches):
        only_keep("token ids", byte_bpe.cache_clear)
        encoder, filler = byte_bpe(tokenizer), None
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        terms: list[np.ndarray] = []
        size = 0

        def close():
            pieces = list(filler.lay_shard(doc_ids, ids, terms))
            columns = list(zip(*pieces, strict=True))
            arrays = [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in chunks(batches):
            filler = filler or WindowFiller(window, batch.column("task")[0].as_py() * SEQUENCES_PER_TASK)
            encoded = encoder.encode(batch.column("text").to_pylist(), end)
            give_back()
            words, counts = word_crcs(batch.column("text"))
            for doc_id, found, own in zip(
                batch.column("doc_id").to_pylist(),
                encoded,
                np.split(words, np.cumsum(counts)[:-1]),
                strict=True,
            ):
                doc_ids.append(doc_id)
                ids.append(found)
                terms.append(own)
                size += len(found) // 4
                if size >= SHARD_IDS or len(ids) >= SHARD_DOCUMENTS:
                    yield close()
                    doc_ids, ids, terms, size = [], [], [], 0
                    give_back()
        if ids:
            yield close()
            doc_ids, ids, terms = [], [], []
            give_back()

    return dealt.mapInArrow(make, PIECES)
