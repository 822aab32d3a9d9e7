"""Similarity self-join on word shingles with a token-group matrix.

Documents are linked when the Jaccard similarity of their shingle sets reaches
a threshold; the result is every document's connected component. The join is
exact: the tokens below only decide what is compared.

1. Equal sets are one: everything that follows works on distinct sets. Tokens
   that many documents share are found by counting; the most frequent ones, a
   bounded number, come last in the order of tokens.
2. Two sets that link share some of their first tokens in that order: at least
   a tenth of the smaller set's size among the first three tenths, at 0.8. Sets
   whose first tokens are shared less with all others together are done.
3. Similar sets are partitioned into groups: a set joins the group of the most
   shared of its first tokens. Large groups are split into parts, and a few
   members are in every part. Links inside a part join its members, so that
   groups become the components found so far, as a rule whole groups of copies.
4. The token-group matrix has a row for each token and cell: the token unions of
   a group's sets of about the same size. The tokens that a set shares with a
   cell's union and the sizes there bound the overlap with any member. Only cells
   that qualify, and hold another component, are opened and compared in full.

Words lie between ASCII white space, A-Z in lower case. A document of fewer
than five words has one shingle, all its words; without words it has none and
is linked with nothing. Rows without a doc_id link like others, but give no
component its name. Repeated rows are copies. Sets are compared by 64-bit
shingle hashes, and equal sets are told by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import chunks, lower_ascii, materialize, only_keep, unused
from tillstream.llm.components import connected

SHINGLE = 5
#: Tokens that come last in the order: at most so many, 8 bytes each.
COMMON_TOKENS = 1 << 16
#: Sets of a group that are compared at once, and how many of a group are in all its parts.
PART, HUBS = 256, 16
#: Words whose hashes a worker keeps from text to text, for speed only: about 20 MB.
_KNOWN_WORDS = 150_000
_known: dict[bytes, int] = {}


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    import xxhash

    if len(_known) > _KNOWN_WORDS:
        _known.clear()
    split = [lower_ascii(text).split() if text else [] for text in texts]
    for word in set().union(*split).difference(_known):
        _known[word] = xxhash.xxh3_64_intdigest(word)
    lengths = [len(words) for words in split]
    flat = np.fromiter(
        (h for words in split for h in map(_known.__getitem__, words)), np.uint64, sum(lengths)
    )
    step = np.uint64(0x9E3779B97F4A7C15)
    rolled = flat[: max(0, len(flat) - size + 1)].copy()
    for k in range(1, size):
        rolled = rolled * step + flat[k : k + len(rolled)]
    rolled = _mixed(rolled)
    out, start = [], 0
    for length in lengths:
        if length >= size:
            out.append(np.unique(rolled[start : start + length - size + 1]))
        elif length:
            value = np.full(1, length, np.uint64)
            for h in flat[start : start + length]:
                value = value * step + h
            out.append(_mixed(value))
        else:
            out.append(np.zeros(0, np.uint64))
        start += length
    return out


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Chunks with the shingle sets of their texts; a task keeps no words for the next one."""
    only_keep("sets")
    try:
        for batch in chunks(batches):
            yield batch, shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
    finally:
        _known.clear()


def _set_key(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, "<i8").tolist())


def least_shared(n: int) -> int:
    """First tokens that two linked sets share at least, ``n`` the smaller's size."""
    return max(1, n // 10)


def prefix_length(n: int, percent: int = 80) -> int:
    """How many tokens of a set count as its first ones.

    A linked set lacks at most n - ceil(n * percent / 100) of its tokens, so it
    has ``least_shared(n)`` of these. Of two linked sets take the one whose
    first tokens end earlier: those of them that the other has are among the
    other's first ones too.
    """
    return min(n, n - (-(-n * percent // 100)) + least_shared(n)) if n else 0


def _signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text and set keys, n_shingles; and tokens found three times or more in a chunk."""

    def make(batches):
        for batch, sets in _sets_of(batches):
            keys = [_set_key(tokens) for tokens in sets]
            distinct = list({key: tokens for key, tokens in zip(keys, sets, strict=True)}.values())
            tokens, counts = np.unique(np.concatenate(distinct), return_counts=True)
            often = counts > 2
            empty = [None] * (len(sets) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("text_key").cast(pa.string()),
                    pa.array([len(tokens) for tokens in sets], pa.int64()),
                    pa.array([key[0] for key in keys], pa.int64()),
                    pa.array([key[1] for key in keys], pa.int64()),
                    pa.array([tokens[often].view(np.int64), *empty], pa.list_(pa.int64())),
                    pa.array([counts[often], *empty], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "id", "id2", "often", "counts"],
            )

    return docs.select("doc_id", "text", F.md5("text").alias("text_key")).mapInArrow(
        make,
        "doc_id bigint, text_key string, n_shingles bigint, id bigint, id2 bigint, "
        "often array<bigint>, counts array<bigint>",
    )


def _common_tokens(signatures: DataFrame, limit: int) -> np.ndarray:
    """The most frequent tokens as far as chunks saw them; the driver gets ``limit`` at most."""
    found = (
        signatures.filter("often IS NOT NULL")
        .select(F.explode(F.arrays_zip("often", "counts")).alias("x"))
        .groupBy(F.col("x.often").alias("token"))
        .agg(F.sum("x.counts").alias("count"))
        .filter("count >= 32")
        .orderBy(F.desc("count"), "token")
        .limit(limit)
    )
    return np.sort(np.array([row.token for row in found.collect()], np.int64).view(np.uint64))


def _postings(docs: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """(token, id, n) for the first tokens of each distinct set, once a task."""

    def make(batches):
        seen: set[int] = set()
        for _, sets in _sets_of(batches):
            tokens, ids, sizes = [], [], []
            for own in sets:
                if not len(own) or (key := _set_key(own)[0]) in seen:
                    continue
                seen.add(key)
                take = prefix_length(len(own), percent)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    last = common[at] == own
                    own = np.concatenate([own[~last], own[last]])
                tokens.append(own[:take])
                ids.append(np.full(take, key, np.int64))
                sizes.append(np.full(take, len(own), np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.concatenate(ids)),
                        pa.array(np.concatenate(sizes)),
                    ],
                    ["token", "id", "n"],
                )

    return docs.select("text").mapInArrow(make, "token bigint, id bigint, n int")


def _sets(docs: DataFrame, signatures: DataFrame, places: DataFrame) -> DataFrame:
    """The sets of ``places`` (id, group, parts), made anew from one text of each.

    A text is found by its doc_id and its own key together: rows that only have the
    doc_id in common, or none, do not meet. Repeated rows may repeat a set.
    """
    chosen = (
        signatures.select("doc_id", "text_key", "id")
        .join(places, "id")
        .groupBy("id")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("row"),
            F.first("group").alias("group"),
            F.first("parts").alias("parts"),
        )
    )
    texts = docs.select("doc_id", "text", F.md5("text").alias("text_key")).alias("d").join(
        chosen.alias("c"), F.expr("d.doc_id <=> c.row.doc_id AND d.text_key = c.row.text_key")
    ).select("c.id", "c.group", "c.parts", "d.text")

    def make(batches):
        only_keep("sets")
        seen: set[int] = set()
        for batch in chunks(batches):
            once = {key: row for row, key in enumerate(batch.column("id").to_pylist()) if key not in seen}
            seen.update(once)
            batch = batch.take(pa.array(once.values(), pa.int64()))
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
            kept = batch.select(["id", "group", "parts"])
            tokens = pa.array([own.view(np.int64) for own in sets], pa.list_(pa.int64()))
            sizes = pa.array([len(own) for own in sets], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, sizes, tokens], ["id", "group", "parts", "n", "tokens"]
            )

    return texts.mapInArrow(
        make, "id bigint, group bigint, parts array<int>, n int, tokens array<bigint>"
    )


def overlaps(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections of a bounded number of sets."""
    counts = np.zeros((len(sets), len(sets)), np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(own) for own in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [first, first + columns])
        block = np.zeros((len(sets), columns), np.float32)
        block[owner[a:b], column[a:b] - first] = 1
        counts += (block @ block.T).astype(np.int64)
    return counts


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of each run of equal keys in sorted batches."""
    last, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[name] for name in keys)
            if key != last and held:
                yield held
                held = []
            last = key
            held.append(row)
    if held:
        yield held


def _links_in_parts(parts: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set that links with others of its part, and the least set it reaches there."""

    def make(batches):
        only_keep("sets")
        for rows in _groups(batches, ["group", "part"]):
            rows = list({row["id"]: row for row in rows}.values())
            ids = np.array([row["id"] for row in rows])
            common = overlaps([np.array(row["tokens"], np.int64) for row in rows])
            sizes = np.array([row["n"] for row in rows], np.int64)
            union = sizes[:, None] + sizes[None, :] - common
            linked = (100 * common >= percent * union) | np.eye(len(ids), dtype=bool)
            label = ids.copy()
            while True:
                least = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
                if (least == label).all():
                    break
                label = least
            moved = label != ids
            if moved.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[moved]), pa.array(label[moved])], ["a", "b"]
                )

    return parts.mapInArrow(make, "a bigint, b bigint")


def _needed(n: str, least: str, most: str, percent: int) -> str:
    """First tokens that a set must share with one of ``least`` to ``most`` tokens to link."""
    low = f"greatest({least}, ceil({n} * {percent} / 100))"
    high = f"least({most}, floor({n} * 100 / {percent}))"
    return f"CASE WHEN {low} > {high} THEN 1e9 ELSE greatest(1, floor(least({n}, {low}) / 10)) END"


def _shared_enough(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of tokens with two sets or more, of sets with enough such tokens."""
    by_token, by_id = Window.partitionBy("token"), Window.partitionBy("id")
    return (
        postings.withColumns(
            {"least": F.min("id").over(by_token), "most": F.max("id").over(by_token)}
        )
        .filter("least <> most")
        .dropDuplicates(["token", "id"])
        .withColumn("shared", F.count("*").over(by_id))
        .filter(f"shared >= greatest(1, floor(ceil(n * {percent} / 100) / 10))")
        .select("token", "id", "n")
    )


def link_sets(docs: DataFrame, signatures: DataFrame, percent: int, common: int) -> DataFrame:
    """Edges (a, b) between distinct sets that connect all that link."""
    postings = _postings(docs, _common_tokens(signatures, common), percent)
    by_token = Window.partitionBy("token")
    shared = materialize(_shared_enough(postings, percent))
    # what has lost its partners goes too
    shared = materialize(_shared_enough(shared, percent))

    # groups of similar sets, and the links inside their parts
    frequency = shared.groupBy("token").agg(F.count("*").alias("count"))
    grouped = (
        shared.join(frequency, "token")
        .groupBy("id")
        .agg(F.max(F.struct("count", "token")).alias("best"))
        .select("id", F.col("best.token").alias("group"), F.col("best.count").alias("size"))
    )
    n_parts = F.ceil(F.col("size") / PART).cast("int")
    is_hub = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / HUBS)) == 0
    own_part = F.pmod(F.xxhash64("id", F.lit(1)), n_parts).cast("int")
    parts = F.when(is_hub & (n_parts > 1), F.sequence(F.lit(0), n_parts - 1)).otherwise(
        F.array(own_part)
    )
    sets = materialize(
        _sets(docs, signatures, grouped.select("id", "group", parts.alias("parts")))
    )
    parts = (
        sets.select("group", F.explode("parts").alias("part"), "id", "n", "tokens")
        .repartition("group", "part")
        .sortWithinPartitions("group", "part", "id")
    )
    inside = materialize(_links_in_parts(parts, percent))

    # the token-group matrix over what is not yet connected
    label = connected(inside).select(F.col("node").alias("id"), "label")
    members = materialize(
        sets.join(label, "id", "left")
        .join(grouped.select("id", "size"), "id")
        .select("id", F.coalesce("label", "id").alias("component"), "n", _cell().alias("cell"))
    )
    placed = shared.select("token", "id").join(members, "id")
    between = materialize(
        placed.withColumns(
            {"least": F.min("component").over(by_token), "most": F.max("component").over(by_token)}
        )
        .filter("least <> most")
        .select("token", "id", "n", "component", "cell")
    )
    matrix = between.groupBy("token", "cell").agg(
        F.min("n").alias("least_n"),
        F.max("n").alias("most_n"),
        F.min("component").alias("least_c"),
        F.max("component").alias("most_c"),
    )
    # the smaller set of a pair asks the cell of the larger one
    sizes = f"q.n <= g.most_n AND ceil(g.least_n * {percent} / 100) <= q.n"
    other = "(g.least_c <> q.component OR g.most_c <> q.component)"
    bounds = materialize(
        between.alias("q")
        .join(matrix.alias("g"), F.expr(f"q.token = g.token AND {sizes} AND {other}"))
        .groupBy("q.id", "q.n", "g.cell")
        .agg(
            F.count("*").alias("shared"),
            F.min("g.least_n").alias("least_n"),
            F.max("g.most_n").alias("most_n"),
        )
        .filter(f"shared >= {_needed('n', 'least_n', 'most_n', percent)}")
        .select("id", "cell")
    )
    across = _links_across(bounds, members, sets, percent)
    return materialize(inside.unionByName(across))


def _cell() -> Column:
    """Row of the matrix: similar sets of about the same size, about ``PART`` at most."""
    band = F.floor(F.ln(F.col("n").cast("double")) * 10)
    share = F.pmod(F.xxhash64("id", F.lit(2)), F.ceil(F.col("size") / PART))
    return F.xxhash64("group", band, share)


def _links_across(
    bounds: DataFrame, members: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """(a, b) for a set and one set of each other component that it links with in a cell.

    The sets that ask a cell come in blocks, each with the cell's own sets.
    """
    blocks = bounds.groupBy("cell").agg(F.ceil(F.count("*") / (2 * PART)).cast("int").alias("n_blocks"))
    asking = bounds.join(blocks, "cell").select(
        "cell",
        F.pmod(F.xxhash64("id", F.lit(3)), F.col("n_blocks")).cast("int").alias("block"),
        F.lit(True).alias("asks"),
        "id",
    )
    asked = members.join(blocks, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"),
        F.lit(False).alias("asks"), "id",
    )
    rows = (
        asking.unionByName(asked)
        .join(members.select("id", "component"), "id")
        .join(sets.select("id", "n", "tokens"), "id")
        .repartition("cell", "block")
        .sortWithinPartitions("cell", "block", "asks", "id")
    )

    def make(batches):
        only_keep("sets")
        for rows in _groups(batches, ["cell", "block"]):
            rows = list({(row["asks"], row["id"]): row for row in rows}.values())
            asks = np.array([row["asks"] for row in rows])
            if asks.all() or not asks.any():
                continue
            common = overlaps([np.array(row["tokens"], np.int64) for row in rows])
            n = np.array([row["n"] for row in rows], np.int64)
            kind = np.array([row["component"] for row in rows])
            linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
            linked &= (kind[:, None] != kind[None, :]) & asks[:, None] & ~asks[None, :]
            found = {(a, kind[b]): b for a, b in zip(*np.nonzero(linked), strict=True)}
            if found:
                ends = [(rows[a]["id"], rows[b]["id"]) for (a, _), b in found.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in ends]), pa.array([b for _, b in ends])], ["a", "b"]
                )

    return rows.mapInArrow(make, "a bigint, b bigint")


def _labelled(docs: DataFrame, percent: int, common: int) -> DataFrame:
    """doc_id, text_key and n_shingles of every row; rows of a component agree in label and alone."""
    signatures = materialize(_signatures(docs))
    rows = signatures.select("doc_id", "text_key", "n_shingles", "id", "id2")
    label = connected(link_sets(docs, signatures, percent, common))
    label = label.select(F.col("node").alias("id"), "label")
    # a set that links with no other is its own component
    return (
        rows.join(label, "id", "left")
        .withColumn("alone", F.when(F.col("label").isNull(), F.col("id2")))
        .withColumn("label", F.coalesce("label", "id"))
    )


def components(docs: DataFrame, percent: int = 80, common: int = COMMON_TOKENS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = _labelled(docs, percent, common)
    names = rows.groupBy("label", "alone").agg(F.min("doc_id").alias("component_id"))
    named = rows.alias("r").join(
        names.alias("c"), F.expr("r.label = c.label AND r.alone <=> c.alone")
    )
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 80, common: int = COMMON_TOKENS) -> DataFrame:
    """One row of each component: the smallest doc_id, rows without one last, then by text.

    Ids need not be unique: a doc_id on texts of several components is kept once
    for each that it heads. Rows without words link with nothing and all stay.
    """
    rows = _labelled(docs, percent, common).filter("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key")
    # equal texts are in one component, so that a head is told by its id and text
    heads = (
        rows.groupBy("label", "alone")
        .agg(F.min(place).alias("head"))
        .select(F.col("head.doc_id").alias("doc_id"), F.col("head.text_key").alias("text_key"))
    )
    has_words = F.coalesce(F.col("text").rlike("[^ \\x09-\\x0D]"), F.lit(False))
    key = unused(docs.columns, "_text_key")
    keyed = docs.filter(has_words).withColumn(key, F.md5("text"))
    named = keyed.alias("d").join(
        heads.alias("h"), F.expr(f"d.doc_id <=> h.doc_id AND d.{key} = h.text_key"), "left_semi"
    )
    kept = named.dropDuplicates(["doc_id", key]).drop(key)
    return kept.unionByName(docs.filter(~has_words))
