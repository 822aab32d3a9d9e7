"""Operators against plain answers over small tables, round trips and held-out accuracy."""

import hashlib
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tillstream.llm import (
    common,
    fingerprints,
    jaccard_groups,
    lm_scoring,
    mixing,
    packing,
    pseudonyms,
    queries,
    quality_rules,
    sharding,
    token_blocks,
    token_ids,
)


def _by_id(frame):
    return {row.doc_id: row for row in frame.collect()}


def test_quality_statistics_and_verdict(spark, documents, texts, sf_dir):
    found = _by_id(queries.op1_quality_rules(spark, sf_dir))
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        words, chars, symbols, dup, repeat = brute.statistics(texts[doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols) == (words, chars, symbols)
        assert (row.n_dup_lines, row.n_repeat_words) == (dup, repeat)
        assert row.base_failed == (words < 50 or 100 * repeat > 50 * words)
        assert not (row.kept and row.base_failed)


def test_quality_model_separates_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op1_quality_rules(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id"
    )
    good = found.filter("quality = 1 AND NOT base_failed").agg(F.avg(F.col("kept").cast("int")))
    poor = found.filter("quality = 0").agg(F.avg(F.col("kept").cast("int")))
    assert good.first()[0] > 0.98 and poor.first()[0] < 0.02


def test_rule_model_by_hand():
    model = quality_rules.RuleModel(0.5, {"length": 0.9}, {"length": 0.8})
    assert "votes" in str(model.posterior())


def test_raked_shares_meet_targets(spark):
    cells = spark.createDataFrame(
        [("a", "en", "t", 100, 1), ("a", "de", "t", 300, 1), ("b", "en", "u", 500, 1), ("b", "de", "t", 50, 1),
         ("b", "de", "u", 70, 1), ("a", "en", "u", 90, 1), ("c", "en", "t", 9, 1)],
        "_source string, _lang string, _topic string, tokens bigint, rows bigint",
    )
    targets = {"source": {"a": 3, "b": 1, "zz": 5}, "lang": {"en": 0.6, "de": 0.4}, "topic": None}
    fitted = mixing.rake(cells, targets, power=1.0, tolerance=1e-6, rounds=60).collect()
    share = Counter()
    for row in fitted:
        share[row._source] += row.weight
        share[row._lang] += row.weight
    assert math.isclose(share["a"], 0.75, abs_tol=1e-4) and share["c"] == 0
    assert math.isclose(share["en"], 0.6, abs_tol=1e-4)
    frame = spark.createDataFrame(fitted)
    drawn = mixing.calibrate(frame, 400).collect()
    assert all(0 <= row.probability <= 1 for row in drawn)
    assert math.isclose(sum(row.probability * row.tokens for row in drawn), 400, rel_tol=1e-6)


def test_mixing_counts_words(spark, texts, sf_dir):
    found = _by_id(queries.op2_source_mixing(spark, sf_dir))
    assert all(row.tokens == len(brute.words(texts[d])) for d, row in found.items())
    expected = sum(row.tokens * row.probability for row in found.values())
    assert math.isclose(expected, 0.5 * sum(row.tokens for row in found.values()), rel_tol=1e-6)


def test_base_score_and_held_out_gain(spark, texts, sf_dir):
    found = _by_id(queries.op3_lm_scoring(spark, sf_dir))
    tokens = {d: [*brute.lowered(t), b""] for d, t in texts.items()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 7 == 2}
    counts = Counter(w for d, own in tokens.items() if d not in held for w in own)
    total = sum(counts.values())
    for doc_id, row in found.items():
        own = tokens[doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert (row.n_tokens, row.train_tokens) == (len(own), total)
        assert row.n_known == sum(w in counts for w in own)
        assert row.held_out == (doc_id in held) and row.score < 0


def test_language_model_gains_on_held_out_documents(spark, sf_dir):
    """More than a tenth of a digit a token over the unigram base, however the rows lie."""
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    first = _by_id(lm_scoring.score_documents(docs))
    held = [row for row in first.values() if row.held_out]
    gain = sum(row.score - row.base_score for row in held) / sum(row.n_tokens for row in held)
    assert gain > 0.1
    again = _by_id(lm_scoring.score_documents(docs.repartition(3)))
    assert all(math.isclose(again[d].score, row.score, rel_tol=1e-6) for d, row in first.items())


def test_moves_are_weighted_by_what_was_seen():
    """A row that one group alone has seen keeps its move; one that two have seen is averaged."""
    both = [np.array([[4.0], [1.0]]), np.array([[0.0], [3.0]])]
    seen = [np.array([0.5, 1.0]), np.array([0.0, 3.0])]
    batch = lm_scoring._moves([(7, k, both[k], seen[k]) for k in range(2)])
    (mean,) = lm_scoring._mean_moves([batch])
    assert mean.column("block").to_pylist() == [7]
    assert np.frombuffer(mean.column("moves")[0].as_py(), "<f2").tolist() == [4.0, 2.5]
    assert np.frombuffer(mean.column("seen")[0].as_py(), "<f4").tolist() == [0.5, 4.0]


def test_gradients_are_summed_by_row():
    chance = np.random.default_rng(3)
    for size, most in [(1, 1), (300, 4), (300, 65536), (300, 40)]:
        own = chance.integers(0, most, size)
        gradient = chance.normal(size=(size, 5)).astype(np.float32)
        target, total = lm_scoring._summed(own, gradient)
        expected = np.zeros((65536, 5))
        np.add.at(expected, own, gradient)
        assert target.tolist() == sorted(set(own.tolist()))
        assert np.allclose(total, expected[target], atol=1e-4)


def test_language_model_learns_histories():
    """A word that follows from the one before gets far more than its share."""
    words = [[b"left", b"right", b"up", b"down"][i // 2 % 4] for i in range(40_000)]
    code, place = lm_scoring._coded([words], {})
    rows = lm_scoring.history_rows(code, place)
    kind, member = (x.astype(np.int64) for x in lm_scoring.slot_of(code))
    weights = lm_scoring.Weights.of_slots(np.ones(lm_scoring.CLASSES * lm_scoring.MEMBERS))
    for at in range(0, len(code), 512):
        cut = slice(at, at + 512)
        weights.update(rows[:, cut], kind[cut], member[cut], 0.3)
    classes, members = weights.probabilities(rows[:, -400:], kind[-400:])
    assert np.allclose(classes.sum(axis=1), 1, atol=1e-4)
    assert np.allclose(members.sum(axis=1), 1, atol=1e-4)
    every = np.arange(400)
    chance = classes[every, kind[-400:]] * members[every, member[-400:]]
    assert np.exp(np.log(chance).mean()) > 0.5


def test_tokens_of_whole_texts():
    """Codes and numbers made of whole texts are those of each text's tokens."""
    texts = [None, b"", b" \n", b"A b", b" Two\x0btwo\xc3\x84 ", b"a\x1cb\x85 c" * 40, b"x" * 70, None]
    tokens = [lm_scoring.tokens_of(text) for text in texts]
    for found, expected in zip(lm_scoring._codes(texts), lm_scoring._coded(tokens, {}), strict=True):
        assert found.tolist() == expected.tolist()
    lengths, numbers, words = lm_scoring._numbered(texts)
    assert lengths.tolist() == [len(own) for own in tokens] and len(words) == len(set(words))
    assert [words[k] for k in numbers] == [word for own in tokens for word in own]


def test_rows_of_batches_are_those_of_all_tokens():
    for count in (0, 1, 2, 1024, 16 * 1024, 40_001):
        code = np.random.default_rng(count).integers(0, 50, count).astype(np.uint64)
        place = np.arange(count) % 7001
        found = list(lm_scoring._batches(code, place))
        rows = np.concatenate([np.zeros((5, 0), np.int64), *[own for _, own in found]], axis=1)
        assert (rows == lm_scoring.history_rows(code, place)).all()
        assert [cut.start for cut, _ in found] == list(range(0, count, lm_scoring.BATCH))


def test_toxicity_on_documents_out_of_training(spark):
    from tillstream.llm import toxicity

    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = labels.filter("doc_id % 4 <> 0")
    test = docs.join(labels.filter("doc_id % 4 = 0"), "doc_id")
    models = toxicity.fit_chain(
        docs, train, {"poor_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    )
    found = toxicity.predict(test, models, ["poor_quality", "toxic"])
    counts = Counter((row.toxic, row.p_toxic >= 0.5) for row in found.collect())
    assert counts[0, True] <= 0.01 * (counts[0, True] + counts[0, False])
    assert counts[1, True] >= 0.7 * (counts[1, True] + counts[1, False])


@pytest.mark.parametrize("percentile", [0.0, 0.5, 0.95, 1.0])
def test_blocks_round_trip(percentile):
    random = np.random.default_rng(3)
    for count in (0, 1, 255, 256, 257, 3000):
        for most in (0, 1, 300, 49_407, 2**32 - 1):
            values = random.integers(0, most, count, dtype=np.uint32, endpoint=True)
            values[::19] = 2**32 - 1
            data = token_blocks.pack(values, percentile)
            assert (token_blocks.unpack(data) == values).all()
            for block in range(-(-count // token_blocks.BLOCK)):
                part = values[block * token_blocks.BLOCK :][: token_blocks.BLOCK]
                assert (token_blocks.unpack_block(data, block) == part).all()


def test_outliers_stand_in_exception_lists():
    values = np.full(256, 7, np.uint32)
    values[[3, 200]] = 1 << 30
    packed = token_blocks.pack(values)
    assert len(packed) < 16 + 11 + 2 * 5 + 1 and (token_blocks.unpack(packed) == values).all()


TRICKY = [
    "", " ", "  a  b", "a\n\nb \n c\t", "don't  stop\r\n", "é ́x", "a.b, c. d ,e",
    "a\x1cb", "<|endoftext|> hi", "x y", "a|b | c", "\x00 a. b", ". a", "1. 2, 3._, x",
]


@pytest.mark.parametrize("make", [token_ids.word_bpe, token_ids.byte_bpe])
def test_ids_equal_the_tokenizer(make, texts):
    import random

    import public_tokenizers

    dice = random.Random(11)
    letters = ["a", "The", "é", ".", ",", " ", "\n", "'s", "7", "_", "́", " ", " ", "b", "|"]
    made = ["".join(dice.choices(letters, k=dice.randint(0, 20))) for _ in range(3000)]
    special = ["hello <|endoftext|> there", "<|ENDOFTEXT|>a", "a <|startoftext|>", "<|x|> <s>[UNK]"]
    given = [*TRICKY, *special, *made, *[t or "" for t in texts.values()]]
    encoder, name = make(), {token_ids.word_bpe: "word_bpe_49k", token_ids.byte_bpe: "byte_bpe_50k"}[make]
    untouched = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    whole = untouched.encode_batch(given, add_special_tokens=False)
    for text, ids, own in zip(given, encoder.encode(given, 1), whole, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [*own.ids, 1], text


@pytest.mark.parametrize("make", [token_ids.word_bpe, token_ids.byte_bpe])
def test_units_are_met_once_a_batch(make, monkeypatch):
    """Arrow cuts and numbers units: Python sees no repeated one, and the ids are the tokenizer's."""
    encoder, seen = make(), []
    own = encoder._units
    monkeypatch.setattr(encoder, "_units", lambda units: seen.append(units) or own(units))
    texts = ["The cat, the Cat. " * 500, None, "", "a\0b\0  c\n\n é", "cat\x1cx the\u3000cat", "x" * 70 + " \t"]
    found = encoder.encode(texts, 1)
    assert len(seen) == 1 and len(seen[0]) == len(set(seen[0])) < 40
    whole = encoder.tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [[*x.ids, 1] for x in whole]


def _whole_ids(name, texts, end):
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    keys = sorted(texts)
    found = tokenizer.encode_batch([texts[k] or "" for k in keys], add_special_tokens=False)
    return {k: np.array([*own.ids, end], "<u4") for k, own in zip(keys, found, strict=True)}


def test_token_files(spark, texts, sf_dir):
    found, start = _by_id(queries.op5_token_blocks(spark, sf_dir)), 0
    for doc_id, ids in _whole_ids("word_bpe_49k.json", texts, 1).items():
        row = found.pop(doc_id)
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert not found


def test_windows_hold_every_id_once(documents, texts):
    ids = _whole_ids("byte_bpe_50k.json", texts, 0)
    pieces = packing.pack_documents(documents, task_bytes=100_000).collect()
    by_doc, by_window = {}, {}
    for piece in pieces:
        own = ids[piece.doc_id][piece.start : piece.start + piece.length].tobytes()
        assert piece.ids == own and piece.ids_crc32 == zlib.crc32(own)
        assert piece.doc_tokens == len(ids[piece.doc_id])
        by_doc.setdefault(piece.doc_id, []).append((piece.start, piece.length))
        by_window.setdefault(piece.sequence_id, []).append((piece.offset, piece.length))
    assert by_doc.keys() == ids.keys()
    for parts, limit in [(by_doc, None), (by_window, 1024)]:
        for key, own in parts.items():
            at = 0
            for start, length in sorted(own):
                assert start == at and length > 0
                at += length
            assert at == len(ids[key]) if limit is None else at <= limit
    padding = sum(1024 - sum(n for _, n in own) for own in by_window.values())
    assert padding <= 1024 * 12


def test_seeds_get_their_neighbours():
    terms = [
        packing.word_hashes(t)
        for t in ("red apple pie", "blue car", "green apple pie", "blue sky", "x", "y", "z", "w")
    ]
    scores = packing.LexicalIndex(terms).scores(0)
    assert int(np.argmax(scores)) == 2 and scores[1] == 0 and scores[0] == 0


def test_words_are_hashed_together():
    """Hashes of whole arrays are those of each word, whatever gaps and neighbours a word has."""
    dice = np.random.default_rng(3)
    letters = ["a", "b", "é", " ", "\n", "\t", "\x0b", "\x1c", "\x85"]
    texts = [None, "", " ", "a", "b", " c", "x" * 64 + " " + "y" * 65 + " z", "é" * 5000]
    texts += ["".join(dice.choice(letters, n)) for n in dice.integers(0, 300, 300)] + ["w " * 200_000, "end"]
    words = [(text or "").encode().split() for text in texts]
    crcs, counts = common.word_crcs(pa.array(["cut off", *texts]).slice(1))
    assert counts.tolist() == [len(own) for own in words]
    assert crcs.tolist() == [zlib.crc32(word) for own in words for word in own]
    doc, found = packing._words_by_document(pa.array(texts))
    assert set(zip(doc.tolist(), found.tolist(), strict=True)) == {
        (k, zlib.crc32(word)) for k, own in enumerate(words) for word in own
    }
    assert common.word_crcs(pa.array([], pa.string()))[0].tolist() == []


def test_used_documents_leave_the_index():
    dice = np.random.default_rng(5)
    terms = [dice.integers(0, 60, 30).astype(np.uint32) for _ in range(40)]
    whole, index, used = packing.LexicalIndex(terms), packing.LexicalIndex(terms), np.zeros(40, bool)
    for _ in range(3):
        used[dice.integers(0, 40, 10)] = True
        index.drop(used)
        for seed in range(40):
            assert (index.scores(seed) == whole.scores(seed) * ~used).all()


def test_near_copies_meet_in_one_task(spark):
    """Pairs of texts that differ in a few words, among many more than a task takes."""
    dice, rows = np.random.default_rng(7), []
    for pair in range(400):
        words = [f"w{n}" for n in dice.integers(0, 30_000, 60)] + ["the", "of"] * 5
        rows += [(pair, " ".join(words)), (1000 + pair, " ".join([*words[:-3], f"own{pair}"]))]
    rows += [(5000 + n, "one text of many copies") for n in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    pieces = packing.pack_documents(docs, task_bytes=10_000).filter("start = 0").collect()
    task = {piece.doc_id: piece.sequence_id // packing.SEQUENCES_PER_TASK for piece in pieces}
    assert len(pieces) == len(rows) and len(set(task.values())) > 20
    assert sum(task[pair] == task[1000 + pair] for pair in range(400)) > 320
    # copies of one text are not one task's work, and stay together in blocks
    copies = Counter(task[5000 + n] for n in range(600))
    assert 2 <= len(copies) <= 3


def test_pseudonyms_keep_format_and_turn_back(spark):
    text = (
        "a +1 (888) 555-6841 or 84.27.175.186, 4111 1111 1111 1111 on 2024-02-29 or 31/12/1999 "
        "and 12/31/1999, DE89 3704 0044 0532 0130 00, 123-45-6789, jo.81@mail7.example.com."
    )
    worker = pseudonyms.Pseudonymizer(b"key")
    new, found = worker.text(text)
    assert found == {"phone": 1, "ip": 1, "card": 1, "date": 3, "iban": 1, "ssn": 1, "email": 1}
    for value in ("555-6841", "84.27.175.186", "4111 1111", "2024-02-29", "3704 0044", "jo.81"):
        assert value in text and value not in new
    assert pseudonyms.Pseudonymizer(b"key", invert=True).text(new)[0] == text
    assert worker.text(new)[1] == found  # pseudonyms are valid values themselves
    assert pseudonyms.Pseudonymizer(b"other").text(text)[0] != new
    twice = worker.text("card 4111-1111-1111-1111")[0]
    assert twice[5:].replace("-", "") == new.split("186")[-1][2:21].replace(" ", "") or "-" in twice


def test_invalid_values_stay(spark):
    worker = pseudonyms.Pseudonymizer(b"key")
    for text in ("4111111111111112", "999.1.1.1", "2024-02-30", "000-12-3456", "3.14159", "1.2.3.4.5"):
        assert worker.text(text) == (text, {})


@pytest.mark.parametrize(
    ("text", "value", "kind"),
    [
        ("card 4111 1111 1111 1111 12/26", "4111 1111 1111 1111", "card"),
        ("card 4111 1111 1111 1111 123", "4111 1111 1111 1111", "card"),
        ("no 12 4111 1111 1111 1111 ok", "4111 1111 1111 1111", "card"),
        ("4111-1111-1111-1111-12", "4111-1111-1111-1111", "card"),
        ("IBAN AT61 1904 3002 3457 3201 BIC BKAUATWW", "AT61 1904 3002 3457 3201", "iban"),
        ("at 2024-01-05T10:00:00Z", "2024-01-05", "date"),
    ],
)
def test_values_next_to_other_characters(text, value, kind):
    new, found = pseudonyms.Pseudonymizer(b"key").text(text)
    before, after = text.split(value)
    assert found == {kind: 1} and value not in new
    assert new.startswith(before) and new.endswith(after) and len(new) == len(text)
    alone = pseudonyms.Pseudonymizer(b"key").text(value)[0]
    assert new == before + alone + after
    assert pseudonyms.Pseudonymizer(b"key", invert=True).text(new)[0] == text


def test_feistel_is_a_permutation():
    for size in (1, 2, 10, 26, 1000, 73_049 // 7):
        network = pseudonyms.Feistel(b"key", "test", size)
        image = [network.permute(value) for value in range(size)]
        assert sorted(image) == list(range(size))
        assert [network.restore(value) for value in image] == list(range(size))


def test_stage_hides_values_and_keeps_columns(spark, documents, sf_dir):
    out = corpus_pipeline.hide_personal_values(spark, documents, sf_dir)
    assert out.columns == documents.columns and out.count() == documents.count()
    assert out.filter("n_chars <> length(text)").count() == 0


def test_components_equal_brute_force(spark, documents, texts):
    found = _by_id(jaccard_groups.components(documents))
    expected = brute.components(texts)
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == expected
    kept = {row.doc_id for row in jaccard_groups.keep_one(documents).collect()}
    assert kept == {c for _, c in expected.values()}


def test_one_row_of_each_component_whatever_its_id(spark):
    """An id on several texts, copies without an id, and rows without words."""
    plain = [" ".join(f"t{text}w{k}" for k in range(30)) for text in range(5)]
    rows = [
        (7, plain[0]), (7, plain[1]), (7, plain[2]),  # one id, three components
        (3, plain[1] + " end"), (None, plain[0]),  # 3 heads the second one
        (None, plain[3]), (None, plain[3]), (None, plain[3] + " end"),
        (9, plain[4]), (9, plain[4]), (2, ""), (2, " "), (None, None), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = Counter((row.doc_id, row.text) for row in jaccard_groups.keep_one(docs).collect())
    third = min(plain[3], plain[3] + " end", key=lambda text: hashlib.md5(text.encode()).hexdigest())
    assert kept == Counter(
        [(7, plain[0]), (3, plain[1] + " end"), (7, plain[2]), (None, third), (9, plain[4]),
         (2, ""), (2, " "), (None, None), (None, None)]
    )


def test_texts_of_one_id_do_not_meet(spark):
    """Sets are fetched by id and text: as many rows as sets, not their square."""
    rows = [(k, f"a common start of the text {n} one two three") for k in (None, 7) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    signatures = jaccard_groups._signatures(docs).cache()
    places = signatures.selectExpr("id", "0L AS group", "array(0) AS parts").distinct()
    sets = jaccard_groups._sets(docs, signatures, places)
    assert sets.select("id").distinct().count() == sets.count() == 40
    # rows that the mapInArrow step reads
    joined = sets._jdf.queryExecution().optimizedPlan().children().head()
    read = spark._jsparkSession.sessionState().executePlan(joined, sets._jdf.queryExecution().mode())
    assert read.toRdd().count() == 40


@pytest.mark.parametrize("common", [0, 1 << 16])
def test_components_of_chains_and_large_groups(spark, common, monkeypatch):
    """Chains of near copies, a passage in many documents, sizes at the limit."""
    import random

    monkeypatch.setattr(jaccard_groups, "PART", 8)
    monkeypatch.setattr(jaccard_groups, "HUBS", 2)
    dice, texts = random.Random(5), {}
    base = [f"w{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(60)]
    for i in range(60):
        own = list(base)
        for k in range(i // 6 * 4, i // 6 * 4 + 4):
            own[k] = f"e{i // 6}x{k}"
        if i % 5 == 0:
            own[dice.randrange(120)] = f"r{i}"
        texts[i] = " ".join(own)
    for i in range(60, 120):
        own = [f"d{i}n{k}" for k in range(dice.randint(5, 80))]
        texts[i] = " ".join(own + passage * (i % 2) + own[: i % 7])
    for i in range(120, 160):
        texts[i] = " ".join(f"s{k}" for k in range(5, 5 + i - 110))
    texts[160] = texts[0].upper()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    found = _by_id(jaccard_groups.components(docs, common=common))
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == brute.components(texts)


def test_first_tokens_are_enough():
    """Sets at the limit share as many first tokens as the bound says."""
    import random

    dice = random.Random(2)
    for _ in range(2000):
        n = dice.randint(1, 80)
        one = set(dice.sample(range(10_000), n))
        two = set(one)
        for token in dice.sample(sorted(one), dice.randint(0, n // 5)):
            two.discard(token)
            if dice.random() < 0.5:
                two.add(dice.randrange(10_000))
        if 100 * len(one & two) < 80 * len(one | two):
            continue
        first = [sorted(s)[: jaccard_groups.prefix_length(len(s))] for s in (one, two)]
        least = jaccard_groups.least_shared(min(len(one), len(two)))
        assert len(set(first[0]) & set(first[1])) >= least


def test_edited_texts_and_likeness(spark, documents, texts):
    found = _by_id(fingerprints.compare_edited(documents))
    order = sorted(texts, reverse=True)
    for place, doc_id in enumerate(order):
        own, after = texts[doc_id] or "", texts[order[(place + 1) % len(order)]] or ""
        cut = len(own) // 3
        edited, row = own[: len(own) - cut] + after[:cut], found[doc_id]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    same = {}
    for doc_id, text in texts.items():
        assert same.setdefault(text, found[doc_id].fingerprint) == found[doc_id].fingerprint
    near = [row.near_edited - row.near_next for row in found.values() if row.n_chars > 1000]
    assert min(near) > 0.2


def test_sketches_merge_and_contain(spark):
    one, two = " ".join(f"a{i}" for i in range(4000)), " ".join(f"b{i}" for i in range(3000))
    row = (
        spark.createDataFrame([(one, two, f"{one} {two}")], "a string, b string, c string")
        .select(*[fingerprints.sketch(F.col(c)).alias(c) for c in "abc"])
        .select(
            fingerprints.merge(F.col("a"), F.col("b")).alias("ab"),
            "c",
            fingerprints.containment(F.col("a"), F.col("c")).alias("part"),
            fingerprints.containment(F.col("c"), F.col("a")).alias("whole"),
            (fingerprints.from_text(fingerprints.as_text(F.col("a"))) == F.col("a")).alias("back"),
        )
        .first()
    )
    assert set(row.ab) <= set(row.c) and len(set(row.c) - set(row.ab)) <= 4
    assert row.part == 1.0 and abs(row.whole - 4 / 7) < 0.05 and row.back


def test_shards_follow_the_law(spark, documents, texts):
    rows = sharding.assign_shards(
        documents, sharding.even_weights(16), sharding.even_weights(17), sub_shards=8
    ).collect()
    for row in rows:
        data = (texts[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert row.grown_shard in (row.shard, 16)
    for shard in range(16):
        slots = sorted(row.slot for row in rows if row.shard == shard)
        assert slots == list(range(len(slots)))


def test_weights_set_the_shares(spark):
    ids = spark.range(20_000).select(sharding.rendezvous(F.col("id"), {0: 1.0, 1: 3.0, 2: 0.0}).alias("s"))
    counts = Counter(row.s for row in ids.collect())
    assert set(counts) == {0, 1} and abs(counts[1] / 20_000 - 0.75) < 0.02


def test_pipeline_decisions(spark, sf_dir, texts):
    stages, docs = corpus_pipeline.STAGES, None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for _, stage in stages[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        kept.append({row.doc_id for row in docs.collect()})
    assert kept[0] > kept[1] and kept[1] == kept[2] and kept[2] > kept[3]
    good = {d: texts[d] for d in kept[0]}
    assert kept[1] == {c for _, c in brute.components(good).values()}
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {row.doc_id for row in pieces.select("doc_id").distinct().collect()} == kept[3]


def test_word_weights_count_every_document(spark):
    rows = 40_000
    docs = spark.range(rows).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 7, "rare").when(F.col("id") < 10_000, "often").otherwise("x").alias("text"),
    )
    words, weights = packing._word_weights(docs, rows)
    found = dict(zip(words.tolist(), weights.tolist(), strict=True))
    for word, count in (("rare", 7), ("often", 9_993)):
        weight = math.log((rows - count + 0.5) / (count + 0.5))
        assert found[packing.word_hashes(word)[0]] == pytest.approx(weight, abs=1e-9)


def test_rows_that_come_twice_are_summed_at_once():
    """Sums of gradients take little more than the gradients themselves."""
    own = np.repeat(np.arange(512), 2)
    gradient = np.random.default_rng(1).random((1024, 48), np.float32)
    tracemalloc.start()
    target, total = lm_scoring._summed(own, gradient)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert target.tolist() == list(range(512))
    assert np.allclose(total, gradient.reshape(512, 2, 48).sum(axis=1))
    assert peak < 2.5 * gradient.nbytes


def test_workers_drop_what_other_steps_keep():
    dropped = []
    common.only_keep("token ids", lambda: dropped.append("units"))
    common.only_keep("token ids", lambda: dropped.append("units"))
    assert not dropped
    assert list(jaccard_groups._sets_of(iter([]))) == []
    assert dropped == ["units"]


def test_marks_are_cut_where_others_stand_inside():
    text = "of 1.5 words, a.b and ends. It's,end x."
    assert token_ids.leading_gaps(text).split("\0") == [
        "of", " 1.5", " words", ",", " a.b", " and", " ends", ".", " It's,end", " x", "."
    ]
    (ids,) = token_ids.byte_bpe().encode([text], 0)
    plain = token_ids.byte_bpe().tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == [*plain, 0]


def test_an_index_is_built_in_little_memory():
    """A shard's index takes a few times the bytes of its terms beside the table of products."""
    import tracemalloc

    dice = np.random.default_rng(11)
    common_terms = dice.integers(0, 300, (1024, 100))
    rare = dice.integers(300, 1 << 31, (1024, 900))
    terms = list(np.concatenate([common_terms, rare], axis=1).astype(np.uint32))
    tracemalloc.start()
    index = packing.LexicalIndex(terms)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < index.tabled.nbytes + 15 * sum(own.nbytes for own in terms)


def test_memory_is_given_back_after_a_shard(monkeypatch):
    """A worker that a step has left, or a batch, keeps no memory that nothing uses."""
    calls = []
    monkeypatch.setattr(common, "_trim", calls.append)
    common.only_keep("texts")
    assert calls == [0]
    list(common.chunks(iter([pa.record_batch({"text": ["a", "b"]})])))
    assert calls == [0, 0]


def test_arrow_tells_which_texts_need_more_cuts(texts):
    """All texts of a batch are looked through at once, and get the units that each gets alone."""
    given = [*TRICKY, *(text for text in texts.values() if text)]
    given += [f"a{gap}b. c" for gap in "\0\t\v\f\r\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"]
    found = token_ids.leading_gaps_of(given)
    assert found == [token_ids.leading_gaps(text) for text in given]
    odd = token_ids.re.compile(f" |.*(?:[^\\S\n ]|\0|  |\n\n| \n|\n )", token_ids.re.DOTALL)
    for text, own in zip(given, found, strict=True):
        # Python counts the separators as white space
        assert isinstance(own, list) == bool(odd.match(common.SEPARATORS.sub("x", text))), text
