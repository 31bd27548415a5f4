"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A document is parsed greedily against each automaton: a
phrase is the longest match from where the last one ended. A phrase costs log2 of the language's sample, so the language
that needs the fewest bits a letter wins (ties: the first in order of names).

Texts are lower-cased; letters stay, everything else becomes one space; letters that no sample has match nothing. Automata
are tables of transitions, dense for the commonest letters and sparse for the others, and all documents of a batch advance a letter at a time together, in numpy. Texts over
``BLOCK`` letters are parsed block by block and the phrases added up, which costs a phrase a block and keeps memory and
the number of steps the same for any length; all letters count.

Learning is bounded: up to ``SAMPLE_DOCS`` documents a language, chosen by hash, and ``SAMPLE_LETTERS`` letters of whole texts
in all, shared evenly among the languages, of which the ``MAX_LANGUAGES`` with most rows (ties: in order of names) are
learned. These are parameters of ``learn``.

Defined results: a null text and one without letters is ``und`` with score 0; rows with null id or language are not
learned from, but predicted; repeated rows each get a row; an empty table gives no rows; with nothing to learn from all is
``und``; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, fold_column, id_text, load, local_table, settle
from .units import Carried, held, new_key, slices

SAMPLE_DOCS, SAMPLE_LETTERS, LEAST_BYTES, MAX_LANGUAGES = 256, 120_000, 100, 500
_LETTER = "\\p{L}"
#: Codes with a column in the dense table; letters beyond, the rarest of the samples, have sparse transitions.
DENSE = 96
BLOCK = 2048
_SPACE = 1


def automaton_moves(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of each state: code -> state; state 0 is the root."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return to


def suffix_automaton(codes: list[int], alphabet: int) -> np.ndarray:
    """Transitions (state, code) -> state, or -1, of the codes below alphabet; state 0 is the root."""
    return dense(automaton_moves(codes), alphabet)


def dense(to: list[dict[int, int]], width: int) -> np.ndarray:
    table = np.full((len(to), width), -1, np.int32)
    for state, moves in enumerate(to):
        for c, t in moves.items():
            if c < width:
                table[state, c] = t
    return table


class CrossParser:
    """Automata of several languages in one table. samples: text by language."""

    def __init__(self, samples: dict[str, str]):
        self.languages, self.key = sorted(samples), new_key()
        seen: dict[str, int] = {}
        for t in samples.values():
            for ch in t.lower():
                if ch.isalpha():
                    seen[ch] = seen.get(ch, 0) + 1
        letters = sorted(seen, key=lambda ch: (-seen[ch], ch))
        self.alphabet = len(letters) + 2
        self.width = min(self.alphabet, DENSE)
        kind = np.min_scalar_type(self.alphabet - 1)
        # 0: a letter of no sample; 1: no letter
        self.codes = np.fromiter((0 if chr(i).isalpha() else _SPACE for i in range(0x110000)), kind, 0x110000)
        for k, ch in enumerate(letters):
            self.codes[ord(ch)] = k + 2
        tables, self.bits, at = [np.full((1, self.width), -1, np.int32)], [], 1
        self.start = np.zeros((len(self.languages), self.alphabet), np.int32)
        rare: list[tuple[int, int]] = []
        for k, name in enumerate(self.languages):
            codes, _, _ = self.letters([samples[name]])
            to = automaton_moves([c for c in codes.tolist() if c])
            table = dense(to, self.width)
            table[table >= 0] += at
            tables.append(table)
            for c, t in to[0].items():
                self.start[k, c] = at + t
            if self.width < self.alphabet:
                rare += [((at + x) * self.alphabet + c, at + t) for x, moves in enumerate(to) for c, t in moves.items() if c >= self.width]
            at += len(table)
            self.bits.append(float(np.log2(len(codes) + 2)))
        self.table = np.concatenate(tables).ravel()  # state 0 has no moves at all: every text starts there
        rare.sort()
        self.rare_keys = np.array([r[0] for r in rare], np.int64)
        self.rare_to = np.array([r[1] for r in rare], np.int32)

    def letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the texts, runs of spaces made one, none at the ends; where each text's codes end; number of letters of each."""
        points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
        sizes = np.array([len(p) for p in points], np.int64)
        codes = self.codes[np.concatenate(points)] if points else np.zeros(0, self.codes.dtype)
        of = np.repeat(np.arange(len(points)), sizes)
        space = codes == _SPACE
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(space[1:] & space[:-1]) | (of[1:] != of[:-1])
        first = np.ones(len(codes), bool)
        first[1:] = of[1:] != of[:-1]
        keep &= ~(first & space)
        codes, of, space = codes[keep], of[keep], space[keep]
        last = np.ones(len(codes), bool)
        last[:-1] = of[1:] != of[:-1]
        keep = ~(last & space)
        codes, of, space = codes[keep], of[keep], space[keep]
        ends = np.cumsum(np.bincount(of, minlength=len(points))) if len(points) else np.zeros(0, np.int64)
        return codes, ends, np.bincount(of[~space], minlength=len(points))

    def phrases(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) by each language (columns)."""
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        sizes = ends - begins
        blocks = -(-sizes // BLOCK)
        of = np.repeat(np.arange(len(ends)), blocks)
        k = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = begins[of] + k * BLOCK
        size = np.minimum(BLOCK, sizes[of] - k * BLOCK)
        order = np.argsort(-size, kind="stable")
        of, begin, size = of[order], begin[order], size[order]
        languages, n = len(self.languages), len(of)
        count = np.zeros((languages, n), np.int32)
        if n:
            steps = int(size[0])
            grid = np.zeros((n, steps), codes.dtype)
            grid[np.arange(steps) < size[:, None]] = codes[np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)]
            grid = np.ascontiguousarray(grid.T)
            active = np.searchsorted(-size, -np.arange(steps), side="left")  # how many are longer than t
            state = np.zeros((languages, n), np.int32)
            for t in range(steps):
                a = int(active[t])
                c = grid[t, :a]
                if len(self.rare_keys):
                    got = self.moves(state[:, :a], c)
                else:
                    got = self.table.take(state[:, :a] * np.int32(self.width) + c)
                new = got < 0
                count[:, :a] += new
                state[:, :a] = np.where(new, self.start[:, c], got)
        out = np.zeros((len(ends), languages), np.int64)
        np.add.at(out, of, count.T)
        return out

    def moves(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Next states where some letters are beyond the dense table: theirs are looked up by state and code."""
        beyond = np.flatnonzero(c >= self.width)
        got = self.table.take(state.astype(np.int64) * self.width + np.where(c < self.width, c, 0))
        if len(beyond):
            key = state[:, beyond].astype(np.int64) * self.alphabet + c[beyond]
            at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
            got[:, beyond] = np.where(self.rare_keys[at] == key, self.rare_to[at], -1)
        return got

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (1 less the best's share of the second's bits) and bits a letter of each text."""
        return self.judge(texts)[:3]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What predict gives, then of each text: bits of a phrase in its language, letters, and letters its language's sample lacks."""
        codes, ends, letters = self.letters([t or "" for t in texts])
        if not self.languages:
            return ["und"] * len(texts), *(np.zeros(len(texts)) for _ in range(3)), letters, letters
        bits = self.phrases(codes, ends) * np.array(self.bits)
        best = bits.argmin(axis=1)
        least = bits.min(axis=1)
        rest = bits.copy()
        rest[np.arange(len(texts)), best] = np.inf
        second = rest.min(axis=1)
        has = letters > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(has, np.clip(1 - least / second, 0, 1), 0.0)
            each = np.where(has, least / np.maximum(letters, 1), 0.0)
        of = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        strange = np.bincount(of[(codes != _SPACE) & (self.start[best[of], codes] == 0)], minlength=len(texts))
        return [self.languages[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())], score, each, np.array(self.bits)[best], letters, strange


#: Steps of the hash that rows are ordered by, and rows that a window gets for each that is wanted.
_STEPS, SPARE = 1 << 30, 8


def _cut(wanted: int, rows: int) -> int:
    """Steps of the hash below which some SPARE times as many of so many rows are expected as are wanted; all, if these are few."""
    return _STEPS if rows <= SPARE * wanted else SPARE * wanted * _STEPS // rows


def learn(docs: DataFrame, wanted=None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_letters: int = SAMPLE_LETTERS, max_languages: int = MAX_LANGUAGES) -> CrossParser:
    """wanted: a condition on the column doc_id that rows to learn from meet.

    The sample is found in narrow columns; only its texts are read then. A language's texts come in the order of a hash,
    those of LEAST_BYTES or more first, and are taken whole as long as they fit into its share of the letters; only where
    none fits is a part of the first one taken. A language of short texts alone is learned from these.
    """
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"), column(docs, lang_col).cast("string").alias("lang")
    ).where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    if wanted is not None:
        rows = rows.where(wanted)
    rows = rows.where(F.col("text").rlike(_LETTER)).withColumns({"hash": F.xxhash64("doc_id", "text"), "n": F.octet_length("text")})
    narrow = rows.select("lang", "hash", "n", (F.col("n") < LEAST_BYTES).alias("short"), F.pmod(F.col("hash"), F.lit(_STEPS)).alias("step"))
    counts = narrow.groupBy("lang").agg(F.count("*").alias("all"), F.count_if("short").alias("short")).orderBy(F.desc("all"), "lang").limit(max_languages).collect()
    if not counts:
        return CrossParser({})
    # rows come in the order of a hash; of a language with many, all but the first steps of it are left out before the window,
    # which so has some SPARE times as many rows a language as are wanted
    cuts = []
    for r in counts:
        long = r["all"] - r.short
        cuts.append((r.lang, _cut(sample_docs, long), _cut(sample_docs, r.short) if long < sample_docs else 0))
    few = F.broadcast(local_table(docs.sparkSession, cuts, pa.schema({"lang": pa.string(), "long_cut": pa.int64(), "short_cut": pa.int64()})))
    first = narrow.join(few, "lang").where(F.col("step") < F.when(F.col("short"), F.col("short_cut")).otherwise(F.col("long_cut")))
    order = Window.partitionBy("lang").orderBy("short", "step", "hash")
    found = first.select("lang", "hash", "n", "short", "step").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_docs).collect()
    share = max(50, sample_letters // len(counts))  # in bytes at least as many as letters
    chosen, left = [], {r.lang: share for r in counts}
    for r in sorted(found, key=lambda r: (r.lang, r.place)):
        if r.n <= left[r.lang]:
            left[r.lang] -= r.n
            chosen.append((r.lang, r["hash"], r.place))
        elif r.place == 1:
            chosen.append((r.lang, r["hash"], sample_docs + 1))  # in case that no other fits
    few = F.broadcast(local_table(docs.sparkSession, chosen, pa.schema({"lang": pa.string(), "hash": pa.int64(), "place": pa.int32()})))
    texts = rows.join(few, ["lang", "hash"]).groupBy("lang", "hash", "place").agg(F.min(F.substring("text", 1, share)).alias("text")).collect()
    own: dict[str, list[str]] = {}
    for r in sorted(texts, key=lambda r: (r.lang, r.place)):
        if r.place <= sample_docs or r.lang not in own:
            own.setdefault(r.lang, []).append(r.text)
    return CrossParser({name: " ".join(t) for name, t in own.items()})


def predict_language(docs: DataFrame, parser: CrossParser, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, bits): bits a letter tells text of none of the languages from theirs."""
    carried = Carried(parser)

    def run(batches):
        own = held(carried)
        for batch in batches:
            names, scores, bits = [], [], []
            texts = []

            def flush():
                n, s, b = own.predict(texts)
                names.extend(n)
                scores.extend(s.tolist())
                bits.extend(b.tolist())
                texts.clear()

            for a, k in slices(batch.column(1)):
                texts.extend(batch.column(1).slice(a, k).to_pylist())
                flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())], ["doc_id", "lang_pred", "score", "bits"])
        settle()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, bits double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    parser = learn(docs, wanted=fold_column(F.col("doc_id"), 4) != 2)
    found = predict_language(docs, parser)
    return found.select("doc_id", (fold_column(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "bits")
