"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows and whole texts of its predecessor. All but the last return
the columns of documents. Rows with a null doc_id are kept by the stages that need an id to decide: nothing names them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, decontaminate, language_id, near_copies, suffix_dedup
from tallyframe.llm.common import load, map_columns, materialize, settle
from tallyframe.llm.units import Carried, held, release, slices

#: A text is in none of the languages where, beyond one phrase, it costs more bits a letter in the best of them, and that
#: language's sample lacks half of its letters or more.
MAX_BITS = 9.0
#: Documents with so many benchmark items go; below that, passages of so many words are cut out.
MIN_ITEMS, WINDOW = 2, 8
#: Executors' heaps are full grown by the time that tokens are made: their workers remember fewer pieces, and take fewer bytes
#: of text at once, than where op10 runs alone. What is no longer remembered is encoded again, so ids are the same.
REMEMBER, TOGETHER = 100_000, 1 << 20


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has letters and is in one of the languages that the rows' labels name.

    Each row is decided where it is read: no shuffle. Null and empty texts go, as they have no letters; very long texts are
    read whole; repeated rows and rows without an id are decided each; where no row has a language, all rows go.
    """
    carried = Carried(language_id.learn(docs))
    names = docs.columns

    def run(batches):
        at, own = names.index("text"), held(carried)
        for whole in batches:
            for a, n in slices(whole.column(at), TOGETHER):
                batch = whole.slice(a, n)
                lang, _, each, phrase, letters, strange = own.judge(batch.column(at).to_pylist())
                out = (each * letters > MAX_BITS * letters + phrase) & (2 * strange >= letters)
                yield batch.filter(pa.array([name != "und" and not x for name, x in zip(lang, out.tolist())], pa.bool_()))
        settle()

    return map_columns(docs, run, docs.schema)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more, step by step) the row with the least
    doc_id, and of those that share it the one with the least hash of the text. Rows with equal id and text are one. Rows that
    share an id but hold unrelated texts all stay.

    Null and empty texts are copies of each other; very long texts are compared whole; rows without an id stay.
    """
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    doc_id, text = (F.col(f"c{docs.columns.index(n)}") for n in ("doc_id", "text"))
    keyed = plain.where(doc_id.isNotNull()).withColumns({"id": doc_id.cast("long"), "digest": F.xxhash64(text.cast("string"))})
    own = keyed.select("id", "digest", text.cast("string").alias("text"))
    found = materialize(near_copies.sketches(own, ["id", "digest"], "id long, digest long"), "near-sketches")

    def texts(wanted: DataFrame) -> DataFrame:
        first = found.groupBy("node").agg(F.min(F.struct("id", "digest")).alias("r")).join(wanted, "node", "left_semi").select("node", "r.*")
        return own.join(first, ["id", "digest"]).dropDuplicates(["node"]).select("node", "text")

    least = found.groupBy("node").agg(F.min(F.struct("id", "digest")).alias("row"))
    firsts = least.join(near_copies.node_components(found, texts), "node").groupBy("component").agg(F.min("row").alias("row")).select("row.*").distinct()
    # of rows that share id and text any may stay, but always the same one: the least by all columns that can be compared
    order = [c for c, f in zip(plain.columns, plain.schema) if f.dataType.typeName() in ("string", "long", "integer", "double", "float", "boolean", "date", "timestamp", "short", "byte")]
    kept = keyed.join(firsts, ["id", "digest"], "left_semi")
    one = kept.groupBy("id", "digest").agg(F.min_by(F.struct(*plain.columns), F.struct(*order)).alias("row")).select("row.*")
    return one.union(plain.where(doc_id.isNull())).toDF(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts, whole characters of them; a text of which nothing stays goes with its row.

    Null and empty texts stay as they are; very long texts are worked on whole; of equal texts the first stays; n_chars
    follows the text.
    """
    joined = suffix_dedup.with_spans(docs)
    names, schema = docs.columns, docs.schema
    at = names.index("text")

    def run(batches):
        release()
        for piece, found in suffix_dedup.texts_with_spans(batches, at):
            new, keep = [], []
            for raw, spans in found:
                if spans:
                    raw = suffix_dedup.keep(raw, suffix_dedup.on_characters(raw, spans))
                text = None if raw is None else raw.decode("utf-8", "replace")
                keep.append(not spans or bool(text.strip()))
                new.append(text)
            columns = list(piece.columns[: len(names)])
            columns[at] = pa.array(new, pa.string())
            if "n_chars" in names:
                k = names.index("n_chars")
                lengths = [len(t) if spans else n for n, (_, spans), t in zip(columns[k].to_pylist(), found, new)]
                columns[k] = pa.array(lengths, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, piece.schema.names[: len(names)]).filter(pa.array(keep, pa.bool_()))
        settle()

    return map_columns(joined, run, schema)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes benchmark leaks out: rows with windows of MIN_ITEMS items or more go; in others, passages of WINDOW words or
    more are cut out of the text, and a row of which nothing stays goes. Rows without hits stay as they are, null and empty
    texts among them.

    Each row, repeated ones and those without an id too, is decided where it is read, whole texts of any length; n_chars
    follows the text.
    """
    carried = Carried(decontaminate.Matchers(decontaminate.matchers(load(spark, sf_dir, "benchmark"), window=WINDOW)))
    names = docs.columns

    def run(batches):
        at, own = names.index("text"), held(carried).all
        for whole in batches:
            for a, n in slices(whole.column(at)):
                batch = whole.slice(a, n)
                keep, new, changed = [], [], []
                for text in batch.column(at).to_pylist():
                    found = [m.scan(text) for m in own]
                    items = set().union(*(f[1] for f in found))
                    runs = [(a, b) for _, _, hits in found for first, last, _, _, a, b in hits if last - first + 1 >= WINDOW]
                    if runs and len(items) < MIN_ITEMS:
                        at_char, out = 0, []
                        for a, b in suffix_dedup.merge_spans(*zip(*runs), len(text)):
                            out.append(text[at_char:a])
                            at_char = b
                        text = "".join([*out, text[at_char:]])
                    changed.append(bool(runs))
                    keep.append(len(items) < MIN_ITEMS and (not runs or bool(text.strip())))
                    new.append(text)
                columns = list(batch.columns)
                columns[at] = pa.array(new, pa.string())
                if "n_chars" in names:
                    k = names.index("n_chars")
                    columns[k] = pa.array([len(t) if c else n for n, c, t in zip(columns[k].to_pylist(), changed, new)], columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep, pa.bool_()))
        settle()

    return map_columns(docs, run, docs.schema)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and the digest of what they decode to; null and empty texts have none."""
    return bpe.encoding_report(docs, bpe.public_encoder(REMEMBER), together=TOGETHER)


STAGES = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE encoding and decoding", encode_tokens),
]
#: Fingerprints, automata and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
