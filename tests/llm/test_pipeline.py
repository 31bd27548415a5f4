"""The pipeline's stages against brute force over all rows of the smallest tables, and on odd tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tallyframe.llm import common, decontaminate, suffix_dedup

from test_operators import SCHEMA, brute_spans, texts


def as_rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, data):
    import public_tokenizers
    import tiktoken

    from tallyframe.llm.bpe import read_ranks

    docs = common.load(spark, data, "documents")
    names, done = docs.columns, {}
    stages = dict(pipeline.STAGES)
    assert list(stages) == [n for n, _ in pipeline.STAGES] and len(stages) == 5
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before, docs = docs, common.materialize(stage(spark, docs, data), f"test-{k}")
        done[name] = (before, docs)
        if k < 4:
            assert docs.columns == names

    before, after = map(as_rows, done["language ID"])
    assert set(after) <= set(before) and len(after) >= 0.97 * len(before)
    assert all(after[i] == before[i] for i in after)

    before, after = map(as_rows, done["SimHash near-dedup"])
    assert set(after) == least_of_near_copies(before) and all(after[i] == before[i] for i in after)

    before, after = map(as_rows, done["suffix-array dedup"])
    raw = {i: r.text.encode() for i, r in before.items()}
    want = {i: suffix_dedup.keep(raw[i], suffix_dedup.on_characters(raw[i], s)).decode() for i, s in brute_spans(raw).items()}
    want = {i: t for i, t in want.items() if t.strip() or t == before[i].text}
    assert {i: r.text for i, r in after.items()} == want
    assert all(r.n_chars == len(r.text) or r.text == before[i].text for i, r in after.items())

    before, after = map(as_rows, done["benchmark decontamination"])
    matcher = decontaminate.matchers(common.load(spark, data, "benchmark"))[0]
    found = {i: matcher.scan(r.text) for i, r in before.items()}
    assert set(after) <= {i for i, (_, items, _) in found.items() if len(items) < 2}
    assert all(after[i] == before[i] for i, (_, items, _) in found.items() if not items)
    assert all(len(matcher.scan(r.text)[1]) == 0 for i, r in after.items() if len(found[i][1]) == 1)

    before, after = map(as_rows, done["byte-level BPE encoding and decoding"])
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for i, r in before.items():
        ids = coder.encode_ordinary(r.text)
        assert (after[i].n_tokens, after[i].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert after[i].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


@pytest.mark.parametrize("size", [0, None])
def test_odd_tables(spark, data, size):
    rows = [(i, t, "en" if i and i % 2 else None, "odd", 7) for i, t in texts()][:size]
    docs = spark.createDataFrame(rows, SCHEMA)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        docs = common.materialize(stage(spark, docs, data), f"odd-{k}")
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "text.x", "__spans"]
    assert docs.count() <= len(rows)
    assert docs.where(F.col("doc_id").isNull()).count() <= 2


def least_of_near_copies(rows):
    """Brute force over all pairs: five-word shingles, Jaccard similarity 0.8 or more, step by step; the least id of each."""
    from itertools import combinations

    sets = {}
    for i, r in rows.items():
        words = r.text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    label = {i: i for i in rows}
    for a, b in combinations(sorted(rows), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((label[a], label[b]))
            label = {i: low if x == high else x for i, x in label.items()}
    return set(label.values())


def test_near_copies_by_shingles(spark, data):
    docs = common.load(spark, data, "documents")
    before, after = as_rows(docs), as_rows(pipeline.drop_near_duplicates(spark, docs, data))
    assert set(after) == least_of_near_copies(before) and all(after[i] == before[i] for i in after)


def test_clashing_names(spark, data):
    """Extra columns may have any names, those that the stages use themselves too."""
    extra = ["__starts", "__ends", "__id", "__tie", "__doc_id", "__text_tie", "__digest", "node", "c0", "id", "digest", "starts", "key_id", "spans"]
    rows = [(i, t, "en", *range(len(extra))) for i, t in texts()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` int" for n in extra))
    for k, (_, stage) in enumerate(pipeline.STAGES[:4]):
        docs = common.materialize(stage(spark, docs, data), f"clash-{k}")
        assert docs.columns == ["doc_id", "text", "lang", *extra]
        assert all(list(r)[3:] == list(range(len(extra))) for r in docs.collect())
    assert docs.count() > 20


def test_near_copies_clear_of_others(spark):
    """An edited copy at 0.82 goes and one at 0.7 stays."""
    words = [f"w{k}" for k in range(304)]
    close, far = list(words), list(words)
    for k in range(6):
        close[20 + 40 * k] = "x"
    for k in range(11):
        far[10 + 25 * k] = "y"
    rows = [(1, " ".join(words)), (2, " ".join(close)), (3, " ".join(far)), (4, "w1 w2"), (5, ""), (6, None), (7, "")]
    got = pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in got.collect()} == {1, 3, 4, 5}


def test_languages_of_many_letters_stay(spark):
    """Texts in a language of thousands of letters and very short ones stay; a script of no sample goes."""
    import random

    rng = random.Random(3)
    han = [chr(0x4E00 + k) for k in range(2500)]
    rows = [(k, "".join(rng.choices(han, k=300)), "zh") for k in range(40)] + [(100 + k, "the quick brown fox jumps over the lazy dog " * 5, "en") for k in range(40)]
    rows += [(200, "a", None), (201, "бвгджзик лмнопрст", None), (202, "12 34", None)]
    got = pipeline.keep_known_languages(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    short = [(k, f"la casa numero {chr(97 + k % 26)} del pueblo" if k % 2 else f"the house number {chr(97 + k % 26)} in town", "es" if k % 2 else "en") for k in range(200)]
    kept = pipeline.keep_known_languages(spark, spark.createDataFrame(short, "doc_id long, text string, lang string"), "")
    assert kept.count() == 200
    assert {r[0] for r in rows} - {r.doc_id for r in got.collect()} == {201, 202}


def test_unrelated_texts_of_one_id_stay(spark):
    """Each group of near copies keeps a row, whatever ids the rows share."""
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    rows = [(1, one), (5, one.upper()), (5, two), (5, three), (5, three), (7, two + " end"), (8, None), (8, "")]
    got = pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    kept = sorted((r.doc_id, (r.text or "")[:2]) for r in got.collect())
    assert kept == [(1, "a0"), (5, "b0"), (5, "c0"), (8, "")]


def test_near_copies_with_repeated_shingles(spark):
    """A line that comes many times is a few shingles of a set; the copy that has it goes."""
    words = " ".join(f"w{k}" for k in range(150))
    rows = [(1, words), (2, words + " buy it now please today" * 60), (3, "buy it now please today " * 60)]
    got = pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in got.collect()} == {1, 3}


def test_large_groups_of_near_copies(spark, monkeypatch):
    """Edited copies of two texts, linked step by step or not at all, in families of several chunks, and very short ones."""
    import random

    from tallyframe.llm import near_copies

    monkeypatch.setattr(near_copies, "CHUNK", 40)
    rng, rows = random.Random(5), []
    for base in ("a", "b"):
        for k in range(150):
            words = [f"{base}{j}" for j in range(130)]
            for _ in range(rng.randrange(9)):
                words[rng.randrange(130)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(1000, "a b c d e f g h i"), (1001, "b c d e f g h i"), (1002, "c d e f g h i"), (1003, "b c d e f g h i j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = least_of_near_copies(as_rows(docs))
    assert {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, "").collect()} == want and 20 < len(want) < 250


def test_pivot_tables_lose_no_link():
    """Small and large buckets of fingerprints in groups, against all pairs."""
    import numpy as np

    from tallyframe.llm import near_copies
    from tallyframe.llm.simhash import Forest

    rng = np.random.default_rng(7)
    key = np.sort(np.concatenate((rng.integers(0, 40, 400), np.full(300, 50), [60])))
    centres = rng.integers(0, 2**64, (4, 2), np.uint64)
    flips = np.packbits(rng.random((len(key), 2, 64)) < rng.choice([0.03, 0.1, 0.2], (len(key), 1, 1)), axis=2).view(np.uint64)[:, :, 0]
    fp, behind = (centres[rng.integers(0, 4, len(key))] ^ flips).T.copy()
    x, y = near_copies.bucket_forests(key, fp, behind)
    near = (key[:, None] == key) & (np.bitwise_count(fp[:, None] ^ fp) <= near_copies.RADIUS) & (np.bitwise_count(behind[:, None] ^ behind) <= near_copies.NEXT_RADIUS)
    assert near[x, y].all()
    own, all_pairs = Forest(len(key)), Forest(len(key))
    assert all([own.join(a, b) for a, b in zip(x.tolist(), y.tolist())])  # a forest
    for a, b in np.argwhere(near).tolist():
        all_pairs.join(a, b)
    assert [own.find(k) for k in range(len(key))] == [all_pairs.find(k) for k in range(len(key))]
    assert 50 < len(x) < len(key) - 41


def test_stages_without_a_model_let_go_of_one(spark, monkeypatch):
    """A worker that held a stage's model has that memory back in the next stage, whichever of its functions comes first."""
    from tallyframe.llm import units

    caught, table = [], spark.createDataFrame([(i, t, "en", "odd", 7) for i, t in texts()], SCHEMA)
    own = type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, run, *a, **k: caught.append(run) or own(self, run, *a, **k))
    pipeline.cut_repeated_passages(spark, pipeline.drop_near_duplicates(spark, table, "").drop("__spans"), "")
    assert len(caught) >= 8
    monkeypatch.setattr(units, "_HELD", {})
    for run in caught:
        units.held(units.Carried(Model()))
        assert units._HELD
        list(run(iter([])))
        assert not units._HELD, run.__qualname__


class Model:
    key = "some model"


def test_runs_are_cut_a_part_at_a_time(spark, monkeypatch):
    """All runs of a block of texts, some four times its bytes, are not there a second time while they are dealt out."""
    import random
    import tracemalloc

    import pyarrow as pa

    caught, table, rnd = [], spark.createDataFrame([(1, "a" * 100_000)], "doc_id long, text string"), random.Random(3)
    own = type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, run, *a, **k: caught.append(run) or own(self, run, *a, **k))
    suffix_dedup.repeated_spans(table, hot=[], bucket_bytes=5_000)  # about a hundred buckets
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(5000)]
    batch = pa.record_batch([pa.array(range(800), pa.int64()), pa.array([" ".join(rnd.choices(words, k=2500)) for _ in range(800)])], ["doc_id", "text"])
    size = batch.column(1).nbytes
    assert 10 << 20 < size < 15 << 20
    tracemalloc.start()
    for _ in caught[0](iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10.5 * size


def test_learning_starts_no_workers_of_its_own(spark, data, monkeypatch):
    """Small tables of the driver are parts of plans: rows that go through Python would leave two more workers in an executor."""
    from tallyframe.llm import language_id

    made, own = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: made.append(own(self, *a, **k)) or made[-1])
    assert language_id.learn(common.load(spark, data, "documents")).languages
    assert len(made) == 2 and all(m.count() and m.columns[0] == "lang" for m in made)
    assert all("ExistingRDD" not in m._jdf.queryExecution().toString() for m in made)


def test_a_key_with_very_many_windows_takes_little_memory():
    """Runs of one key can't be parted; places of their windows are held in few bytes, and are compared some at a time."""
    import tracemalloc

    import numpy as np

    n, size, length = 3000, 300, 100
    rnd = np.random.default_rng(3)
    raw = np.tile(rnd.integers(97, 123, size, np.uint8), (n, 1))
    raw[np.arange(n), rnd.integers(0, size, n)] = ord("#")
    number, windows = np.arange(n), np.full(n, size - length + 1)
    runs = suffix_dedup.Runs(np.zeros(n, np.uint64), number, number % 7, number * 0 + 5, windows, number < 0, number.astype(np.uint8), raw.ravel(), length)
    spans = []
    tracemalloc.start()
    suffix_dedup.repeated_windows(runs, spans)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen, wanted = set(), {}
    for i, text in enumerate(map(bytes, raw)):
        own = [text[a : a + length] for a in range(size - length + 1)]
        wanted[i] = {a + x for a, w in enumerate(own) if w in seen for x in range(length)}
        seen.update(own)
    assert spans and all(c.dtype == np.int64 for cut in spans for c in cut)
    got = {i: set() for i in range(n)}
    for doc_id, tie, start, end in zip(*(np.concatenate(c).tolist() for c in zip(*spans))):
        assert tie == doc_id % 7
        got[doc_id].update(range(start - 5, end - 5))
    assert got == wanted
    assert peak < 45 * raw.size


def test_languages_are_decided_some_text_at_a_time(spark, monkeypatch):
    """What a worker holds of a batch, and hands back at once, has about TOGETHER bytes of text."""
    import pyarrow as pa

    table, caught = spark.createDataFrame([(i, t, "en", "odd", 7) for i, t in texts()], SCHEMA), []
    own = type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, run, *a, **k: caught.append(run) or own(self, run, *a, **k))
    pipeline.keep_known_languages(spark, table, "")
    text = next(t for _, t in texts() if t and len(t) > 100)
    many = 3 * pipeline.TOGETHER // len(text.encode())
    batch = pa.record_batch([pa.array(range(many)), pa.array([text] * many), *(pa.array([x] * many) for x in ("en", "odd", 7))], ["c0", "c1", "c2", "c3", "c4"])
    out = list(caught[-1](iter([batch])))
    assert sum(b.num_rows for b in out) == many
    assert max(b.num_rows for b in out) * len(text.encode()) <= pipeline.TOGETHER
