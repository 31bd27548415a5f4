"""The training-data operators against brute force, on small tables with nulls, empty texts, copies and odd columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import bpe, common, decontaminate, language_id, media, pfor, quality, sharding, simhash, suffix_dedup, suffix_sort, tokenfile, toxicity

SCHEMA = "doc_id long, text string, lang string, `text.x` string, __spans int"
WORDS = "alpha beta gamma delta omega sigma kappa theta lambda zeta eta iota naïve straße".split()


def texts(n=60, seed=1):
    rnd = random.Random(seed)
    shared = " ".join(rnd.choice(WORDS) for _ in range(40))
    out = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 80)))) for i in range(n)]
    out += [(n + k, t) for k, t in enumerate([None, "", "   ", "!!! 123", shared, shared, f"x {shared} y", out[3][1], out[3][1] + " end", "é" * 150, "ab" * 120, "\x00 z", "long " * 5000])]
    out += [(None, "no id here"), (None, None), out[5], out[5]]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "odd", 7) for i, t in texts()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_decontaminate(spark, docs, empty):
    words = texts()[2][1].split()
    items = [(1, " ".join(words[:12]).upper()), (2, "straße, naïve"), (3, None), (None, words[0]), (4, ""), (1, "zeta eta")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def brute(text):
        own = decontaminate.words_of(text)
        hit, found = set(), set()
        for i, t in items:
            w = decontaminate.words_of(t)
            k = min(8, len(w))
            for a in range(len(w) - k + 1 if i is not None and k else 0):
                for b in range(len(own) - k + 1):
                    if own[b : b + k] == w[a : a + k]:
                        hit.update(range(b, b + k))
                        found.add(str(i))
        return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2

    want = sorted(((i, *brute(t)) for i, t in texts()), key=repr)
    assert rows(decontaminate.contamination_report(decontaminate.find_contamination(docs, benchmark))) == want
    several = decontaminate.contamination_report(decontaminate.find_contamination(docs.dropDuplicates(["doc_id", "text"]), benchmark, block_bytes=60))
    assert rows(several) == sorted(set(want), key=repr)
    assert rows(decontaminate.find_contamination(empty, benchmark)) == []
    assert all(r.n_items == 0 for r in decontaminate.contamination_report(decontaminate.find_contamination(docs, benchmark.limit(0))).collect())


def test_decontaminate_offsets():
    matcher = decontaminate.Matcher({b" \xc3\xa9t\xc3\xa9 b ": (2, ("7",))})
    n, items, runs = matcher.scan("¡Hola! été, B. fin")
    assert (n, items) == (4, ["7"])
    assert [("¡Hola! été, B. fin")[r[4] : r[5]] for r in runs] == ["été, B"]


def test_sharding(docs, empty):
    got = sharding.shard_by_bytes(docs, 5).collect()
    assert len(got) == docs.count()
    sizes = np.zeros(5)
    for r in got:
        sizes[r.shard] += r.size
    assert sizes.max() - sizes.min() <= 2 * max(r.size for r in got)
    for s in range(5):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.shard for r in order] == sorted(r.shard for r in got)
    by_id = dict(texts())
    for r in got:
        if r.doc_id is not None:
            raw = common.utf8(by_id[r.doc_id])
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    assert rows(sharding.shard_by_bytes(empty, 5)) == []


def test_simhash_fingerprint():
    from xxhash import xxh64_intdigest

    text = "A b\tC\n d É e"
    words = [w.encode() for w in "a b c d É e".split()]
    hashes = [xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(4)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 4)
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t ") == 0
    assert simhash.fingerprint("X y") == xxh64_intdigest(b"x y", 42)


@pytest.mark.parametrize("split", [4, 2048])
def test_simhash_links(spark, split):
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    fps = sorted({b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 4))) for b in base for _ in range(12)} | set(base))
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    found = {(r.node, r.component) for r in simhash.connected_components(simhash.fingerprint_links(nodes, split=split), "t").collect()}
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j in range(i):
                if (a ^ fps[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    want = {(i, c) for i, c in enumerate(label) if i != c or label.count(c) > 1}
    assert found == want


def test_simhash_documents(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    fps = [(r.doc_id, r.fp & ((1 << 64) - 1)) for r in got]
    label = {f: min((i for i, g in fps if g == f and i is not None), default=None) for _, f in fps}
    for _ in range(len(label)):
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 3:
                    label[a] = label[b] = min(x for x in (label[a], label[b], 1 << 62) if x is not None)
    assert all(r.component_id == (None if label[r.fp & ((1 << 64) - 1)] == 1 << 62 else label[r.fp & ((1 << 64) - 1)]) for r in got)
    assert rows(simhash.near_duplicates(empty)) == []


def test_simhash_null_ids(spark):
    """Rows without an id link others but join nothing else, and lend no id."""
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    rows_ = [(5, a), (None, a + " end"), (9, b), (None, b + " fin"), (11, "lone"), (None, "nameless one")]
    got = simhash.near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string"), radius=6).collect()
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert by_id == {5: 5, 9: 9, 11: 11}
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["5", "9", "None"]


def test_suffix_array():
    rnd = random.Random(3)
    for _ in range(100):
        s = np.array([rnd.choice([0, 1, 2, 2, 3]) for _ in range(rnd.randint(1, 60))], np.uint8)
        padded = s.tobytes() + bytes(200)
        order = suffix_sort.suffix_array(s, 8)
        assert sorted(order.tolist()) == list(range(len(s)))
        keys = [padded[i : i + 8] for i in order]
        assert keys == sorted(keys)
        n = suffix_sort.common_prefixes(s, order[:-1], order[1:], 8)
        for k, (a, b) in enumerate(zip(order, order[1:])):
            x, y = padded[a : a + 8], padded[b : b + 8]
            assert n[k] == next((i for i in range(8) if x[i] != y[i]), 8)


def brute_spans(documents, length=100):
    first, out = set(), {}
    for key in sorted(documents):
        raw, covered = documents[key], bytearray(len(documents[key]))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in first:
                covered[i : i + length] = b"\1" * length
            first.add(w)
        spans, at = [], 0
        while at < len(raw):
            end = at
            while end < len(raw) and covered[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = end + 1
        out[key] = spans
    return out


def test_suffix_dedup(docs, empty):
    own = {(-(2**63) if i is None else i, hashlib.sha256(common.utf8(t)).hexdigest()): common.utf8(t) for i, t in texts()}
    want = brute_spans(own)
    got = suffix_dedup.suffix_dedup(docs)
    seen = 0
    for r in got.collect():
        matches = [k for k, raw in own.items() if k[0] == (-(2**63) if r.doc_id is None else r.doc_id) and len(raw) == r.n_bytes]
        assert any([tuple(s) for s in r.spans] == want[k] and bytes(r.kept) == suffix_dedup.keep(own[k], want[k]) for k in matches)
        seen += 1
    assert seen == docs.count()
    assert any(want[k] for k in want)
    assert rows(suffix_dedup.suffix_dedup(empty)) == []


def test_suffix_dedup_buckets():
    rnd = random.Random(9)
    for _ in range(25):
        parts = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 150))) for _ in range(5)] + ["ab" * 80, "z" * 130, "é" * 90]
        documents = {d: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))).encode() for d in range(10)}
        found = suffix_dedup.text_runs([(d, 1, t) for d, t in documents.items()], 100)
        got = {d: ([], []) for d in documents}
        if found:
            runs = suffix_dedup.Runs.join(found)
            for b in range(3):
                at = np.flatnonzero(runs.key % np.uint64(3) == b)
                blocks = [suffix_dedup.Runs.unpack(runs.take(x).pack(), 100) for x in np.array_split(at, 2) if len(x)]
                assert all((k.key == runs.key[x]).all() for k, x in zip(blocks, [x for x in np.array_split(at, 2) if len(x)]))
                for spans in suffix_dedup.bucket_spans(blocks, 100, sort_bytes=rnd.choice([500, 10**6]), held_bytes=rnd.choice([300, 10**8])):
                    for d, _, a, e in zip(*spans):
                        got[int(d)][0].append(int(a))
                        got[int(d)][1].append(int(e))
        assert {d: suffix_dedup.merge_spans(*got[d], len(t)) for d, t in documents.items()} == brute_spans(documents)


def test_suffix_dedup_frequent_grams(spark):
    """Grams that rank behind all others change where windows go, and nothing else; a sample finds those of many texts."""
    rnd = random.Random(12)
    phrase = "a phrase that very many texts have in common"
    own = {d: ("".join(rnd.choice("abcdefgh ") for _ in range(150)) + phrase + "".join(rnd.choice("abcdefgh ") for _ in range(150)) + ("z" * 120 + phrase) * (d % 3 == 0)).encode() for d in range(60)}
    table = spark.createDataFrame([(d, t.decode()) for d, t in own.items()], "doc_id long, text string")
    hot = suffix_dedup.frequent_grams(common.id_text(table), 100, sample=1, hot_bytes=4000)
    grams = {int(h) >> 1 for h in suffix_dedup.gram_hashes(np.frombuffer(phrase.encode(), np.uint8)) >> np.uint64(1) << np.uint64(1)}
    assert hot and grams & {h >> 1 for h in hot}
    want = brute_spans(own)
    for ranked in ([], hot, [int(h) for h in suffix_dedup.gram_hashes(np.frombuffer(own[0], np.uint8))]):
        spans = suffix_dedup.repeated_spans(table, bucket_bytes=3000, hot=ranked).collect()
        got = {d: suffix_dedup.merge_spans([r.start for r in spans if r.doc_id == d], [r.end for r in spans if r.doc_id == d], len(t)) for d, t in own.items()}
        assert got == want


def test_suffix_dedup_twins(spark):
    """Rows with the same id and text are one document wherever they are read: neither is a copy of the other."""
    text = " ".join(f"word{k}" for k in range(60))
    table = spark.createDataFrame([(7, text)] * 4 + [(9, "x" + text)], "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, len(r.spans), len(r.kept)) for r in suffix_dedup.suffix_dedup(table).collect())
    assert got == [(7, 0, len(text))] * 4 + [(9, 1, 1)]


def test_equal_digests_are_checked(monkeypatch):
    """Runs whose digests agree but whose bytes don't are not taken for equal."""
    import xxhash

    monkeypatch.setattr(xxhash, "xxh3_128_digest", lambda data: b"\0" * 16)
    own = {d: f"{d:0>110}".encode() for d in range(4)} | {9: f"{2:0>110}".encode(), 10: f"{2:0>110}".encode()}
    runs = suffix_dedup.Runs.join(suffix_dedup.text_runs([(d, 1, t) for d, t in own.items()], 100))
    got = {d: ([], []) for d in own}
    for spans in suffix_dedup.bucket_spans([runs], 100):
        for d, _, a, e in zip(*spans):
            got[int(d)][0].append(int(a))
            got[int(d)][1].append(int(e))
    want = brute_spans(own)
    assert {d: suffix_dedup.merge_spans(*got[d], len(t)) for d, t in own.items()} == want and want[9] == want[10] == [(0, 110)]


def test_cut_pieces():
    """Pieces put together are the text, and cutting never changes ids (see test_bpe, test_token_files)."""
    import pyarrow as pa

    from tallyframe.llm import units

    rnd = random.Random(3)
    samples = ["", None, " ", "a", "a b", "word, word.\nNext  two", "x\u00a0y z", "é.è, a!b"] + ["".join(rnd.choice("ab .,\n\té'1\u3000") for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    for array in (pa.array(samples), pa.array(samples).slice(3, 200)):
        pieces, ends = units.cut_pieces(array)
        got, at = [], 0
        for e in ends.tolist():
            got.append(b"".join(pieces.slice(at, e - at).to_pylist()))
            at = e
        assert got == [common.utf8(t) for t in array.to_pylist()]
    assert units.cut_pieces(pa.array(["one, two\nthree four.", "a  b"]))[0].to_pylist() == [b"one", b",", b" two", b"\n", b"three", b" four", b".", b"a  b"]


def test_repeated_ids_fill_many_ranges():
    cuts = np.array([5, 5, 5, 5, 9])
    ids, tie = np.array([1, 5, 5, 5, 5, 7, 9, 12]), np.array([0.5, 0.0, 0.3, 0.6, 0.99, 0.1, 0.2, 0.3])
    assert tokenfile.part_of(cuts, ids, tie).tolist() == [0, 1, 2, 3, 4, 4, 5, 5]


def test_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    coder = bpe.public_encoder()
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    assert sorted(coder.table.slots) == list(range(len(coder.keys)))
    rnd = random.Random(1)
    letters = "ab c  \n\té'sº1२  　日x.!\x1c\x85​"
    for t in ["", " ", "it's we'll", "<|endoftext|>", "a" * 3000] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(400)]:
        assert coder.encode(t) == theirs.encode_ordinary(t)
        assert coder.decode(coder.encode(t)) == t.encode()
    by = sorted(((i, len(x := theirs.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(common.utf8(t)).hexdigest()) for i, t in texts()), key=repr)
    assert rows(bpe.encoding_report(docs, coder)) == by
    back = bpe.decode_documents(bpe.encode_documents(docs, coder), coder)
    assert sorted((r.doc_id, bytes(r.content)) for r in back.where("doc_id IS NOT NULL").collect()) == sorted((i, common.utf8(t)) for i, t in texts() if i is not None)
    assert rows(bpe.encoding_report(empty, coder)) == []


def test_pfor():
    rng = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 1000):
        for high in (1, 5, 50257, 2**32):
            ids = rng.integers(0, high, n).astype(np.uint32)
            if n > 10:
                ids[3] = high - 1
            segment = pfor.write_segment([5], [n], ids, 7)
            doc_ids, lengths, back, first = pfor.read_segment(segment)
            assert (back == ids).all() and (doc_ids.tolist(), lengths.tolist(), first) == ([5], [n], 7)
            for k in range(-(-n // pfor.BLOCK)):
                assert (pfor.read_block(segment, k) == ids[k * 128 : (k + 1) * 128]).all()


def test_token_files(spark, docs, empty):
    import public_tokenizers

    coder = tokenfile.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    path = common.new_path(spark, "test-tokens")
    tokenfile.write_token_files(docs, coder, path, segment_ids=500)
    coder._prepare()
    want, at = [], 0
    for i, t in sorted(texts(), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.array([*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = rows(tokenfile.read_token_files(spark, path))
    named = lambda x: sorted((r for r in x if r[0] is not None), key=repr)
    assert named(got) == named(want)
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    path = common.new_path(spark, "test-tokens")
    tokenfile.write_token_files(empty, coder, path)
    assert rows(tokenfile.read_token_files(spark, path)) == []


def test_library_gets_words_in_short_texts():
    """Pieces get the ids that each has alone, odd white space within or not, and no text of the library's is long."""
    import public_tokenizers

    class Watched:
        def __init__(self, own):
            self.own, self.longest, self.texts = own, 0, 0

        def encode_batch_fast(self, many, **how):
            self.longest, self.texts = max(self.longest, *map(len, many)), self.texts + len(many)
            return self.own.encode_batch_fast(many, **how)

    coder, rnd = tokenfile.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"), 2), random.Random(8)
    coder._prepare()
    plain = [" " + "".join(rnd.choices("abcdefghij'é漢9._-", k=rnd.randint(1, 12))) for _ in range(1000)]
    odd = [" a  b", " a\u3000", " a\u00a0b c", " \tx", " ", "\n", "x", " x\u200b", " \u2028", " \x1cz", " a ", "  "]
    alone = coder.tokenizer
    for pieces in (plain, plain + odd, plain[:128], plain[:129], odd, plain[:1], []):
        coder.tokenizer = watched = Watched(alone)
        got = coder._pieces([p.encode() for p in pieces])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [alone.encode(p, add_special_tokens=False).ids for p in pieces]
        assert watched.longest <= 128 * 13 and watched.texts <= len(pieces) / 128 + len(odd) + 1


def test_media(spark, docs, empty):
    import tarfile

    folder = common.new_path(spark, "test-media")
    local = folder.removeprefix("file:")
    __import__("os").makedirs(local)
    index = media.store_media(docs, folder)
    found = media.read_media(media.media_header(index, folder), folder).collect()
    assert sorted(repr(i) for r in found for i in r.doc_ids) == sorted(repr(i) for i, _ in texts())
    by_id = dict(texts())
    for r in found:
        for i in r.doc_ids:
            if i is not None:
                payload = media.payload_of(by_id[i])
                assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(common.utf8(by_id[i])), len(payload), hashlib.sha256(payload).hexdigest())
                assert (r.width * r.height, r.bits) == (len(payload), 8)
                with open(f"{local}/{r.shard}", "rb") as f:
                    f.seek(r.offset)
                    assert hashlib.sha256(f.read(r.length)).hexdigest() == r.digest == r.media_sha256
    one = __import__("glob").glob(f"{local}/*.tar")[0]
    assert all(m.name.endswith(".png") for m in tarfile.open(one).getmembers())
    assert len({(r.shard, r.offset) for r in found}) == len({r.digest for r in found})
    assert rows(media.store_media(empty, folder)) == []


def test_language_parser():
    rnd = random.Random(2)
    for _ in range(100):
        a = "".join(rnd.choice("abc ") for _ in range(rnd.randint(5, 60)))
        t = "".join(rnd.choice("abcd  ") for _ in range(rnd.randint(0, 50)))
        parser = language_id.CrossParser({"x": a})
        plain = lambda s: " ".join("".join(c if c.isalpha() else " " for c in s.lower()).split())
        sample, text, n, at = plain(a), plain(t), 0, 0
        while at < len(text):
            end = at + 1
            while end <= len(text) and text[at:end] in sample:
                end += 1
            at, n = max(at + 1, end - 1), n + 1
        codes, ends, _ = parser.letters([t])
        assert parser.phrases(codes, ends)[0, 0] == n


def test_language_id(spark, docs, empty, data):
    table = common.load(spark, data, "documents")
    wanted = common.fold_column(F.col("doc_id"), 4) != 2
    parser = language_id.learn(table, wanted=wanted)
    held = table.where(common.fold_column(F.col("doc_id"), 4) == 2)
    joined = language_id.predict_language(held, parser).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in joined) >= 0.95 * len(joined)
    odd = {r.doc_id: r for r in language_id.predict_language(docs, parser).collect()}
    assert [odd[60 + k].lang_pred for k in range(4)] == ["und"] * 4 and all(0 <= r.score <= 1 for r in odd.values())
    assert rows(language_id.predict_language(empty, parser)) == []
    assert language_id.learn(empty).predict(["abc", None])[0] == ["und", "und"]
    short = [(k, f"la casa {chr(97 + k % 26)} del rio" if k % 2 else f"the house {chr(97 + k % 26)} by it", "es" if k % 2 else "en") for k in range(200)]
    parser = language_id.learn(spark.createDataFrame(short, "doc_id long, text string, lang string"))
    assert parser.predict(["la casa del pueblo", "by the house", "12"])[0] == ["es", "en", "und"]
    many = [(k, f"{chr(0x4E00 + k)} abc", f"l{k:04}") for k in range(60)] + [(900, "zz yy xx", "a"), (901, "zz yy xx", "a")]
    table = spark.createDataFrame(many, "doc_id long, text string, lang string")
    assert language_id.learn(table, max_languages=3).languages == ["a", "l0000", "l0001"]  # most rows, then names
    assert len(language_id.learn(table).languages) == 61


def test_quality(spark, docs, empty):
    rnd = random.Random(5)
    good = [(" ".join(rnd.choice(WORDS) for _ in range(30)).encode(), 1) for _ in range(150)]
    bad = [(" ".join(rnd.choice(WORDS).upper() + "!!" for _ in range(30)).encode(), 0) for _ in range(150)]
    model = quality.QualityModel().fit(good[:100] + bad[:100])
    assert min(model.score(t) for t, _ in good[100:]) > max(model.score(t) for t, _ in bad[100:])
    out = quality.score_documents(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert rows(quality.score_documents(empty, model)) == []
    assert quality.QualityModel().fit([]).score("x") == 0.5


def test_follow_the_leader_matches_definition():
    learner = quality.FollowTheLeader(1, alpha=0.5, beta=1.0, l1=0.0, l2=0.0)
    learner.update(np.array([0]), np.array([1.0]), 1)
    assert np.allclose(learner.z, -0.5) and np.allclose(learner.n, 0.25)
    assert np.allclose(learner.weights(), 0.5 / ((1 + 0.5) / 0.5))


def test_toxicity_kernel():
    import itertools
    from collections import Counter

    def features(s):
        c = Counter()
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < toxicity.SPAN:
                c[s[i] + s[j] + s[k]] += toxicity.DECAY ** (k - i + 1)
        return c

    units = ["stupid", "stxupid", "abababab", "worthlessness", "idiot"]
    space = toxicity.Subsequences("abcdefghijklmnopqrstuvwxyz")
    assert np.allclose(space.kernel(["s.t u-p?id"], space.landmarks(["s.t u-p?id"])), 1, atol=1e-5)
    got = space.kernel(units, space.landmarks(units))
    dot = lambda a, b: sum(v * b[u] for u, v in a.items())
    f = [features(u) for u in units]
    want = [[(dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5) ** toxicity.POWER for b in f] for a in f]
    assert np.allclose(got, want, atol=1e-5)


def test_toxicity(docs, empty):
    rnd = random.Random(6)
    line = lambda: [rnd.choice(WORDS) + rnd.choice(["", "en", "ing", "s"]) for _ in range(25)]
    rows_ = []
    for k in range(300):
        words = line()
        if k % 2:
            words[rnd.randrange(25)] = rnd.choice(["blockhead", "nitwit", "dunce"])
        rows_.append((" ".join(words).encode(), k % 2))
    model = toxicity.ToxicityModel().fit(rows_)
    odd = ["you nitwit", "n.i.t.w.i.t", "nitxwit", "b l o c k h e a d", "blockkhead"]
    assert min(model.sentences(t)[0][1] for t in odd) > 0
    assert model.scores([f"{t}. alpha beta gamma" for t in odd[:1] + odd[2:3] + odd[4:]]).min() >= 0.5
    assert model.scores([None, "", "!!", *(" ".join(line()) for _ in range(50))]).max() < 0.5
    assert model.sentences("alpha beta. you dunce!")[1][1] > 0 > model.sentences("alpha beta. you dunce!")[0][1]
    assert len(toxicity.score_documents(docs, model).collect()) == docs.count()
    assert rows(toxicity.score_documents(empty, model)) == []
    assert toxicity.ToxicityModel().fit([]).scores(["x"])[0] == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names


def test_decontaminate_repeats(spark):
    """Repeated rows, null ids and null and empty texts each give a row, however many automata there are."""
    benchmark = spark.createDataFrame([(k, f"alpha{k} beta{k} gamma{k}") for k in range(20)], "item_id long, text string")
    text = "x alpha3 beta3 gamma3 y alpha7 beta7 gamma7"
    repeated = [(1, text), (1, text), (None, text), (None, text), (2, None), (2, ""), (2, None), (3, "alpha3")]
    table = spark.createDataFrame(repeated, "doc_id long, text string")
    assert len(decontaminate.matchers(benchmark, block_bytes=60)) > 2
    one, many = (rows(decontaminate.contamination_report(decontaminate.find_contamination(table, benchmark, block_bytes=n))) for n in (4_000_000, 60))
    assert len(many) == len(repeated) and many == one


def test_language_of_many_letters():
    """Each letter of the samples counts, however many there are, and a parse is the same as by dense tables."""
    rng = random.Random(5)
    han = [chr(0x4E00 + k) for k in range(3000)]
    common_words = ["".join(rng.choices(han, k=2)) for _ in range(3000)]
    samples = {"zz": "the quick brown fox jumps over the lazy dog " * 20, "han": " ".join(common_words)}
    parser = language_id.CrossParser(samples)
    assert parser.alphabet > 2000
    held_out = ["".join(rng.choices(common_words, k=40)) for _ in range(20)]
    got = [*held_out, "the lazy fox", "a", "бвгд жзик"]
    lang, _, bits = parser.predict(got)
    assert lang[:20] == ["han"] * 20 and lang[20:22] == ["zz"] * 2 and max(bits[:20]) < 9

    def brute(text, sample):
        n, at = 0, 0
        while at < len(text):
            k = 1
            while at + k < len(text) and text[at : at + k + 1] in sample:
                k += 1
            n, at = n + 1, at + k
        return n

    codes, ends, _ = parser.letters(held_out)
    assert parser.phrases(codes, ends)[:, 0].tolist() == [brute(t, samples["han"]) for t in held_out]
