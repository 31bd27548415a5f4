"""Every opN query on an odd table, over its contract columns, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tallyframe.llm import bpe, common, decontaminate, language_id, quality, queries, simhash, suffix_dedup, toxicity

from test_operators import brute_spans, rows, texts

INSULTS = ("blockhead", "nitwit", "dunce")


def table():
    """Odd rows, then rows to learn from: two languages, shouting and calm, rude and polite."""
    rnd = random.Random(8)
    out = [(i, t, None) for i, t in texts()]
    words = {"en": "the house by river was old and people went there each summer with children".split(), "es": "la casa del pueblo era vieja pero la gente iba con sus hijos cada verano".split()}
    for k in range(400):
        lang = ("en", "es")[k % 2]
        line = [rnd.choice(words[lang]) for _ in range(rnd.randint(12, 40))]
        if k % 5 == 1:
            line[rnd.randrange(12)] = rnd.choice(INSULTS)
            line[rnd.randrange(12)] = rnd.choice(INSULTS)
        if k % 3 == 1:
            line = [w.upper() + "!!" for w in line]
        out.append((1000 + k, " ".join(line) + ".", lang))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs = [(t, i, lang, 7) for i, t, lang in table()]
    spark.createDataFrame(docs, "text string, doc_id long, lang string, `score` int").repartition(4).write.parquet(f"{path}/documents.parquet")
    items = [(1, " ".join((texts()[2][1] or "").split()[:12])), (2, "straße, naïve"), (3, None), (None, "alpha"), (4, ""), (5, "zeta eta")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(1000 + k, int(k % 3 != 1), int(k % 5 == 1)) for k in range(400)] + [(1000, 1, 0), (None, 1, 1), (5000, 1, 1), (1, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", "doc_id long, text string, lang string"), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


CONTRACT = {
    "op1_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op7_media": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op8_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op9_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op10_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.fixture(scope="module")
def results(spark, folder):
    out = {}
    for name, kinds in CONTRACT.items():
        df = queries.queries()[name](spark, folder)
        assert {n: k for n, k in df.dtypes if n in kinds} == kinds, name
        out[name] = df.collect()
        assert len(out[name]) == len(table()), name
        assert sorted(str(r.doc_id) for r in out[name]) == sorted(str(i) for i, *_ in table()), name
    return out


def fold(i, n):
    return None if i is None else zlib.crc32(str(i).encode()) % n


def by_text(found, values):
    """Both as sorted lists of (doc_id, values)."""
    return sorted(found, key=repr) == sorted(values, key=repr)


def test_empty_tables(spark, empty):
    for name, f in queries.queries().items():
        assert rows(f(spark, empty)) == [], name


def test_op1(results):
    train = {i: t for i, t, _ in table() if i is not None and i >= 1000 and fold(i, 5)}
    label = {1000 + k: int(k % 3 != 1) for k in range(400)}
    order = sorted(train, key=lambda i: (zlib.crc32(str(i).encode()), i))
    model = quality.QualityModel().fit([(train[i].encode(), label[i]) for i in order])

    def brute(text):
        """The dot product over features that are counted one by one."""
        places, values = model.features.vector(text)
        total = model.weights[-1] + sum(float(model.weights[p]) * float(v) for p, v in zip(places, values))
        return 1 / (1 + np.exp(-total))

    scores = {}
    for i, t, _ in table():
        scores.setdefault(i, []).append(brute(t))
    for r in results["op1_quality"]:
        assert min(abs(r.score - s) for s in scores[r.doc_id]) < 1e-9 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (None if r.doc_id is None else fold(r.doc_id, 5) == 0)
    held = [r for r in results["op1_quality"] if r.doc_id is not None and r.doc_id >= 1000 and r.held_out]
    assert len(held) > 40 and all(r.predicted == label[r.doc_id] for r in held)


def test_features_by_hand():
    """Tokens, pairs and shapes of a text, counted by hand, have the values that the vector has."""
    places, values = quality.Features().vector("a b a b a b")
    assert len(places) == len(set(places.tolist())) and abs((values**2).sum() - 1) < 1e-9
    # a, b: 3 each; a-b: 3, b-a: 2; one pair of shapes: 5; one triple of shapes: 4
    raw = sorted(1 + np.log([3, 3, 3, 2, 5, 4]))
    assert np.allclose(sorted(values), np.array(raw) / np.sqrt((np.array(raw) ** 2).sum()))


def test_op2(results):
    items = [(1, " ".join((texts()[2][1] or "").split()[:12])), (2, "straße, naïve"), (5, "zeta eta")]
    want = []
    for i, t, _ in table():
        own, hit, found = decontaminate.words_of(t), set(), set()
        for item, text in items:
            w = decontaminate.words_of(text)
            k = min(8, len(w))
            for a in range(len(w) - k + 1):
                for b in range(len(own) - k + 1):
                    if own[b : b + k] == w[a : a + k]:
                        hit.update(range(b, b + k))
                        found.add(str(item))
        want.append((i, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2))
    assert by_text([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in results["op2_decontaminate"]], want)


def test_op3(spark, folder, results):
    from pyspark.sql import functions as F

    parser = language_id.learn(common.load(spark, folder, "documents"), wanted=common.fold_column(F.col("doc_id"), 4) != 2)
    assert parser.languages == ["en", "es"]

    def automaton_free(text, sample):
        """Phrases of a greedy parse by searching the sample itself."""
        n, at = 0, 0
        while at < len(text):
            k = 1
            while at + k < len(text) and text[at : at + k + 1] in sample:
                k += 1
            n, at = n + 1, at + k
        return n

    letters = lambda s: " ".join("".join(c if c.isalpha() else " " for c in (s or "").lower()).split())
    for r in results["op3_language_id"]:
        assert 0 <= r.score <= 1 and r.held_out == (None if r.doc_id is None else fold(r.doc_id, 4) == 2)
        if r.doc_id is not None and r.doc_id >= 1000:
            assert r.lang_pred == ("en", "es")[(r.doc_id - 1000) % 2]
    und = sorted(str(i) for i, t, _ in table() if not any(c.isalpha() for c in t or ""))
    assert sorted(str(r.doc_id) for r in results["op3_language_id"] if r.lang_pred == "und") == und
    samples = {"en": "the house by the river was old", "es": "la casa del pueblo era vieja"}
    small = language_id.CrossParser(samples)
    for i, t, _ in table()[-30:]:
        cost = {n: automaton_free(letters(t), letters(s)) * np.log2(len(letters(s)) + 2) for n, s in samples.items()}
        best = min(sorted(cost), key=cost.get)
        name, score, _ = small.predict([t])
        assert name == [best] and np.isclose(score[0], 1 - cost[best] / max(cost.values()))


def test_op4(results):
    got = results["op4_sharding"]
    sizes = [0] * 24
    for r in got:
        sizes[r.shard] += r.size
        assert 0 <= r.shard < 24 and r.law == "bytes" and r.grown_shard is None
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)
    assert by_text([(r.doc_id, r.size, r.text_crc32) for r in got], [(i, len(common.utf8(t)) + 8, zlib.crc32(common.utf8(t))) for i, t, _ in table()])
    for s in range(24):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))


def test_op5(results):
    got = results["op5_toxicity"]
    toxic = {1000 + k for k in range(400) if k % 5 == 1}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (None if r.doc_id is None else fold(r.doc_id, 5) == 0)
    held = [r for r in got if r.doc_id is not None and r.doc_id >= 1000 and r.held_out]
    assert len(held) > 40 and sum(r.predicted == int(r.doc_id in toxic) for r in held) >= 0.97 * len(held)


def test_toxicity_scores_by_brute_force():
    """Sentence by sentence and unit by unit, with kernels in full."""
    rnd = random.Random(4)
    line = lambda: [rnd.choice("house river summer people children old there each".split()) for _ in range(15)]
    data = []
    for k in range(200):
        words = line()
        if k % 2:
            words[rnd.randrange(15)] = rnd.choice(INSULTS)
        data.append((" ".join(words).encode(), k % 2))
    model = toxicity.ToxicityModel().fit(data)
    for text in ("old house. you dunce! d u n c e\nby the river", "n.i.t-w.i.t here", "", None, "there each summer"):
        pieces = [s for s in __import__("re").split(r"(?<=[.!?])\s+|\n", (text or "").lower())]
        values = []
        for s in pieces:
            units = [toxicity.unit_of(p) for p in s.split()]
            runs, at = [], s.split()
            while at:
                n = next((k for k, p in enumerate(at) if len(p) > 2), len(at))
                if n > 2:
                    runs.append(toxicity.unit_of(" ".join(at[:n])))
                at = at[max(n, 1) :]
            found = [u for u in (*units, *runs) if u]
            kernels = model.space.kernel(found, model.marks).astype(np.float16).astype(float) if found else np.zeros((0, len(model.beta)))
            kernels[kernels < np.float16(toxicity.FAINT)] = 0
            values.append((kernels.max(axis=0) @ model.beta if len(found) else 0.0) + model.bias)
        got = model.sentences(text)
        assert np.allclose(sorted(v for _, v in got), sorted(values), atol=2e-3)
        top = sorted((max(v, model.bias) for v in values), reverse=True)[:3]
        top += [model.bias] * (3 - len(top))
        x = np.array([*np.clip(top, -3, 3), np.log1p(sum(max(0, v) for v in values)), np.log1p(len(values)) / 3])
        assert np.isclose(model.scores([text])[0], 1 / (1 + np.exp(-(x @ model.weights[:-1] + model.weights[-1]))), atol=2e-3)


def test_op6(results):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    want = []
    for i, t, _ in table():
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    got = results["op6_token_files"]
    assert by_text([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert ids == sorted(ids)


def test_op7(results):
    want = []
    for i, t, _ in table():
        raw = common.utf8(t)
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        want.append((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
    got = results["op7_media"]
    assert by_text([(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got], want)
    same = {}
    for r in got:
        assert same.setdefault(r.payload_sha256 + str(r.n_bytes), (r.media_sha256, r.media_bytes, r.feature)) == (r.media_sha256, r.media_bytes, r.feature)


def test_op8(results):
    own = {}
    for i, t, _ in table():
        raw = common.utf8(t)
        own[(-(2**63) if i is None else i, np.uint64(__import__("xxhash").xxh64_intdigest(raw, 42)).astype(np.int64))] = raw
    spans = brute_spans(own)
    want = set()
    for (i, _), raw in zip(own, own.values()):
        s = spans[(i, _)]
        kept = suffix_dedup.keep(raw, s)
        want.add((None if i == -(2**63) else i, len(raw), len(raw) - len(kept), len(s), hashlib.sha256(kept).hexdigest()))
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in results["op8_suffix_dedup"]} == want


def test_op9(results):
    own = [(i, simhash.fingerprint(t)) for i, t, _ in table()]
    prints = sorted({f for _, f in own})
    label = {f: f for f in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if label[a] != label[b] and (a ^ b).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    least = {}
    for i, f in own:
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    assert by_text([(r.doc_id, r.fingerprint, r.component_id) for r in results["op9_simhash"]], [(i, f"{f:016x}", least.get(label[f])) for i, f in own])


def test_op10(results):
    import public_tokenizers
    import tiktoken

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for i, t, _ in table():
        ids = coder.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(common.utf8(t)).hexdigest()))
    assert by_text([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in results["op10_bpe"]], want)
