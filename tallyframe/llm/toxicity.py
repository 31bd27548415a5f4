"""Toxicity: a support vector machine with a gap-weighted subsequence kernel and Nystroem landmarks, on sentences.

A sentence is compared by its units: its words in lower case, without signs at either end, and runs of three pieces or more
of one or two characters ("i d i o t"). The kernel of two units sums, over all subsequences of three letters that both have,
decay to the power of the characters that each spans (``SPAN`` at most), over the units' own norms. Characters that are no
letters match nothing but count in a span, as other letters in between do, so inserted signs, spaces and letters cost some
similarity, not all. The ``POWER``-th power of that (a kernel again) sets likeness of a few letters apart from likeness of
most; what is under ``FAINT`` then counts as nothing.

Landmarks are units of training sentences: those that tell the sentences of toxic rows from those of clean ones best by their
log-likelihood, no two of them alike, and the clean units most like these. A sentence's kernel with a landmark is the largest
of its units'; times the inverse root of the landmarks' own kernel matrix these are its Nystroem features. On them a linear
support vector machine (squared hinge loss, solved by Newton's method) is trained with the labelled rows' sentences: those of
clean rows are clean; of a toxic row's, those are toxic that the machine itself takes for it, or the one nearest to it, in
``ROUNDS`` rounds. Copies of the telling units with one more letter or with spaces between their letters train along, with
``VARIED`` of the toxic sentences' weight. A text's score is a logistic function of its three worst sentences, of the sum of
their values over 0, and of its number of sentences.

Training reads at most ``MAX_TOXIC`` and ``MAX_CLEAN`` rows of either label, chosen by hash of the id, and of these whole
texts up to ``MAX_BYTES`` in all; of clean sentences, the ``CLEAN_SENTENCES`` train that are most like landmarks. These are
parameters. Scoring reads whole texts.

Defined results: null and empty texts and texts without letters have one sentence without units; very long texts are scored
whole, in bounded slices; repeated rows are scored each; with no toxic or no clean labels all scores are 0; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_column, id_text, load, settle
from .quality import labelled_sample
from .units import Carried, Memo, as_bytes, held, new_key, slices

MAX_TOXIC, MAX_CLEAN, MAX_BYTES, LANDMARKS, ROUNDS, VARIED, CLEAN_SENTENCES = 1200, 4800, 12 << 20, 160, 4, 0.5, 30_000
DECAY, SPAN, LONGEST, ALPHABET, POWER, FAINT = 0.9, 7, 20, 64, 3, 0.12
_TRIPLES = np.array([(i, j, k) for i in range(LONGEST) for j in range(i + 1, min(i + SPAN, LONGEST)) for k in range(j + 1, min(i + SPAN, LONGEST))])
_TRIPLES = _TRIPLES[np.argsort(_TRIPLES[:, 2], kind="stable")]  # a unit of n characters has a prefix of these
_HAS = np.searchsorted(_TRIPLES[:, 2], np.arange(LONGEST + 1))
_WEIGHT = DECAY ** (_TRIPLES[:, 2] - _TRIPLES[:, 0] + 1.0)
#: A landmark's number and a kernel with it.
_ENTRY = np.dtype([("mark", "u1"), ("value", "<f2")])
_WHITE, _END = np.zeros(256, bool), np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_END[[*b".!?"]] = True


def unit_of(piece: str) -> str:
    """The piece without signs at its ends; none where it has fewer than three letters."""
    if piece.isalpha():
        return piece if len(piece) > 2 else ""
    at = [i for i, c in enumerate(piece) if c.isalpha()]
    return piece[at[0] : at[-1] + 1] if len(at) > 2 else ""


def parts_of(unit: str) -> list[str]:
    """Units over LONGEST characters are compared in overlapping parts."""
    if len(unit) <= LONGEST:
        return [unit]
    return [unit[a : a + LONGEST] for a in range(0, len(unit) - LONGEST // 2, LONGEST // 2)]


class Pieces:
    """Pieces of lower-cased texts: the different ones, which of them each is, its sentence, and each sentence's text.

    A sentence ends with a piece that ends in a full stop, an exclamation or a question mark, with a line and with its text.
    A text without pieces has one sentence.
    """

    def __init__(self, texts: pa.StringArray):
        low = pc.utf8_lower(pc.fill_null(texts, ""))
        if low.offset:
            low = pa.concat_arrays([low])
        n = self.n = len(low)
        self.ends = np.frombuffer(low.buffers()[1], np.int32, n + 1) if n else np.zeros(1, np.int32)
        self.raw = raw = np.frombuffer(low.buffers()[2], np.uint8)[: self.ends[-1]] if low.buffers()[2] is not None else np.zeros(0, np.uint8)
        black = ~_WHITE[raw]
        first = black.copy()
        first[1:] &= ~black[:-1]
        begins = self.ends[:-1][self.ends[1:] > self.ends[:-1]]
        first[begins] = black[begins]
        last = black.copy()
        last[:-1] &= ~black[1:]
        stops = begins[begins > 0] - 1
        last[stops] = black[stops]
        self.start, self.stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        k = len(self.start)
        text = np.searchsorted(self.ends, self.start, side="right") - 1
        lines = np.flatnonzero(raw == 10)
        over = _END[raw[self.stop - 1]] if k else np.zeros(0, bool)
        if k:
            over[:-1] |= (text[1:] != text[:-1]) | (np.searchsorted(lines, self.start[1:]) > np.searchsorted(lines, self.stop[:-1]))
            over[-1] = True
        sentence = np.concatenate(([0], np.cumsum(over)[:-1])).astype(np.int64) if k else np.zeros(0, np.int64)
        bare = np.setdiff1d(np.arange(n), text)  # texts without pieces
        self.text_of = np.concatenate([text[over], bare])
        self.sentence = sentence
        size = self.stop - self.start
        letters = np.cumsum(np.concatenate(([0], (raw & 0xC0) != 0x80)), dtype=np.int32)
        short = letters[self.stop] - letters[self.start] <= 2
        buffer = pa.py_buffer(raw)
        # pieces with what stands behind them, as the offsets of one column
        offsets = np.empty(2 * k + 1, np.int32)
        offsets[0:-1:2], offsets[1::2], offsets[-1] = self.start, self.stop, self.stop[-1] if k else 0
        both = pa.BinaryArray.from_buffers(pa.binary(), 2 * k, [None, pa.py_buffer(offsets), buffer])
        coded = both.take(pa.array(np.arange(0, 2 * k, 2))).dictionary_encode() if k else None
        self.size = size
        self.units = as_bytes(coded.dictionary) if k else []
        self.which = coded.indices.to_numpy().astype(np.int64) if k else np.zeros(0, np.int64)
        # runs of short pieces of a sentence, at most LONGEST of them at a time
        edge = np.flatnonzero(np.diff(np.concatenate(([0], short.view(np.int8), [0]))))
        known: dict[bytes, int] = {}
        which, where = [], []
        view = memoryview(raw)
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            while b - a > 2:
                c = a + int(np.searchsorted(sentence[a:b], sentence[a], side="right"))
                if c - a > 2:
                    run = bytes(view[self.start[a] : self.stop[c - 1]])
                    which.append(known.setdefault(run, len(known)))
                    where.append(sentence[a])
                a = c
        self.which = np.concatenate([self.which, np.array(which, np.int64) + len(self.units)])
        self.unit_sentence = np.concatenate([sentence, np.array(where, np.int64)])
        self.units += list(known)

    def sentences(self) -> list[bytes]:
        """Text of each sentence."""
        if not len(self.start):
            return [b""] * len(self.text_of)
        new = np.flatnonzero(np.concatenate(([True], self.sentence[1:] != self.sentence[:-1])))
        last = np.concatenate((new[1:], [len(self.start)])) - 1
        view = memoryview(self.raw)
        found = [bytes(view[a:b]) for a, b in zip(self.start[new].tolist(), self.stop[last].tolist())]
        return found + [b""] * (len(self.text_of) - len(found))


class Gathered:
    """Pieces of many texts, made of a slice at a time: units, which of them each place has, sentences and their digests."""

    def __init__(self, texts: list[bytes]):
        known: dict[bytes, int] = {}
        which, sentence, text_of, digest, n, at = [], [], [], [], 0, 0
        column = pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())
        for a, k in slices(column):
            own = Pieces(column.slice(a, k))
            number = np.array([known.setdefault(u, len(known)) for u in own.units], np.int32)
            which.append(number[own.which])
            sentence.append((own.unit_sentence + n).astype(np.int32))
            text_of.append((own.text_of + at).astype(np.int32))
            digest.append(np.array([hash(t) for t in own.sentences()], np.int64))
            n, at = n + len(own.text_of), at + k
        self.units, self.n = list(known), at
        self.which, self.unit_sentence, self.text_of, self.digest = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (which, sentence, text_of, digest))


class Subsequences:
    """Explicit features of the kernel: codes of three letters, and decayed spans."""

    def __init__(self, letters: str):
        self.code = {c: i + 2 for i, c in enumerate(letters[: ALPHABET - 2])}

    def ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and weights, (units, triples); weight 0 where a unit is too short or has no letter.

        Code 0 is no letter, 1 a letter that is none of the given ones.
        """
        n = np.array([len(u) for u in units], np.int64)
        grid = np.zeros((len(units), LONGEST), np.int32)
        for r, u in enumerate(units):
            grid[r, : len(u)] = [self.code.get(c) or int(c.isalpha()) for c in u]
        most = int(_HAS[n.max()]) if len(n) else 0
        t = _TRIPLES[:most]
        a, b, c = (grid[:, t[:, k]] for k in range(3))
        return (a * ALPHABET + b) * ALPHABET + c, np.where((np.arange(most) < _HAS[n][:, None]) & (a > 0) & (b > 0) & (c > 0), _WEIGHT[:most], 0.0)

    @staticmethod
    def norms(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Length of each unit's feature vector; equal features of a unit add up first."""
        if not ids.size:
            return np.ones(len(ids))
        order = np.argsort(ids, axis=1)
        a, w = np.take_along_axis(ids, order, 1), np.take_along_axis(weights, order, 1)
        total = np.cumsum(w, axis=1)
        last = np.ones(a.shape, bool)
        last[:, :-1] = a[:, 1:] != a[:, :-1]
        row, col = np.nonzero(last)
        value = total[row, col]
        step = value.copy()
        step[1:] -= np.where(row[1:] == row[:-1], value[:-1], 0.0)
        return np.sqrt(np.maximum(np.bincount(row, step * step, minlength=len(ids)), 1e-12))

    def landmarks(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each feature number, rows of normalised weights by landmark); row 0 is for features of none."""
        ids, w = self.ids(units)
        w = w / self.norms(ids, w)[:, None]
        used = np.unique(ids[w > 0])
        row = np.zeros(ALPHABET**3, np.int32)
        row[used] = np.arange(1, len(used) + 1)
        table = np.zeros((len(used) + 1, len(units)), np.float32)
        np.add.at(table, (row[ids], np.arange(len(units))[:, None]), w)
        table[0] = 0
        return row, table

    def kernel(self, units: list[str], marks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Kernels of units and landmarks."""
        row, table = marks
        out = np.zeros((len(units), table.shape[1]), np.float32)
        for a in range(0, len(units), 256):
            ids, w = self.ids(units[a : a + 256])
            w = (w / self.norms(ids, w)[:, None]).astype(np.float32)
            out[a : a + 256] = np.matmul(w[:, None, :], table[row[ids]])[:, 0]
        return out**POWER


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5, rounds: int = 30, block: int = 4096) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss; y is -1 or 1. Rows add up to the normal equations a block at a time."""
    size = x.shape[1] + 1
    w = np.zeros(size)
    penalty = ridge * np.eye(size) * weight.sum()
    penalty[-1, -1] *= 1e-3
    for _ in range(rounds):
        gram, right = penalty.copy(), np.zeros(size)
        for at in range(0, len(x), block):
            own = np.hstack([x[at : at + block].astype(np.float64), np.ones((len(x[at : at + block]), 1))])
            label = y[at : at + block]
            active = label * (own @ w) < 1
            a, b = own[active], weight[at : at + block][active]
            gram += a.T @ (a * b[:, None])
            right += a.T @ (b * label[active])
        new = np.linalg.solve(gram, right)
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights of P(1 | x), the last one the offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * len(y) * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + penalty
        step = np.linalg.solve(h, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


class ToxicityModel:
    def __init__(self):
        self.space, self.marks, self.beta, self.bias, self.weights = Subsequences(""), None, None, 0.0, None
        self._memo, self.key = None, new_key()

    def __getstate__(self):
        return self.__dict__ | {"_memo": None}

    def kernels(self, pieces: list[bytes]) -> list[bytes]:
        """Each piece's kernels with the landmarks that are not faint, as packed entries."""
        out = [b""] * len(pieces)
        for low in range(0, len(pieces), 1 << 16):
            self._kernels(pieces, out, low, low + (1 << 16))
        return out

    def _kernels(self, pieces: list[bytes], out: list[bytes], low: int, high: int) -> None:
        found = ((i, unit_of(pieces[i].decode("utf-8", "replace"))) for i in range(low, min(high, len(pieces))))
        parts = sorted(((i, q) for i, u in found if u for q in parts_of(u)), key=lambda x: len(x[1]))  # alike lengths together
        for a in range(0, len(parts), 4096):
            some = parts[a : a + 4096]
            got = self.space.kernel([q for _, q in some], self.marks)
            row, mark = np.nonzero(got >= FAINT)
            entries = np.empty(len(row), _ENTRY)
            entries["mark"], entries["value"] = mark, got[row, mark]
            cuts = np.searchsorted(row, np.arange(len(some) + 1)).tolist()
            for (i, _), x, y in zip(some, cuts, cuts[1:]):
                if y > x:
                    out[i] += entries[x:y].tobytes()

    def table(self, pieces: Pieces | Gathered, kind=np.float32) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the sentences that have kernels, their largest kernel with each landmark)."""
        if self._memo is None:
            self._memo = Memo(self.kernels)
        values = self._memo.all(pieces.units)
        size = np.fromiter(map(len, values), np.int64, len(values)) // _ENTRY.itemsize
        at = np.flatnonzero(size[pieces.which] > 0)
        if not len(at):
            return np.zeros(0, np.int64), np.zeros((0, self.marks[1].shape[1]), kind)
        unit, of = pieces.which[at], pieces.unit_sentence[at]
        flat = np.frombuffer(b"".join(values), _ENTRY)
        begin = np.cumsum(size) - size
        own, row = np.unique(of, return_inverse=True)
        out = np.zeros((len(own), self.marks[1].shape[1]), kind)
        for a in range(0, len(unit), 1 << 18):
            some, at_row = unit[a : a + (1 << 18)], row[a : a + (1 << 18)]
            count = size[some]
            stop = np.cumsum(count)
            entry = flat[np.repeat(begin[some] - (stop - count), count) + np.arange(stop[-1])]
            np.maximum.at(out, (np.repeat(at_row, count), entry["mark"].astype(np.int64)), entry["value"].astype(kind))
        return own, out

    def fit(self, rows: list[tuple[bytes, int]], landmarks: int = LANDMARKS, rounds: int = ROUNDS, seed: int = 11) -> ToxicityModel:
        rows = sorted(set(rows))
        y = np.array([label for _, label in rows], np.int64)
        if not len(y) or y.min() == y.max():
            return self
        pieces = Gathered([raw for raw, _ in rows])
        # equal sentences of a label count once, so that copies of a text are no evidence of their own
        label = y[pieces.text_of]
        once = np.zeros(len(label), bool)
        once[np.unique(np.stack([pieces.digest, label]), axis=1, return_index=True)[1]] = True
        names = [unit_of(u.decode("utf-8", "replace")) for u in pieces.units]
        different = {u: i for i, u in enumerate(sorted({u for u in names if u and len(u) <= LONGEST}))}
        number = np.array([different.get(u, -1) for u in names], np.int32)
        if not different:
            return self
        of = number[pieces.which]
        use = (of >= 0) & once[pieces.unit_sentence]
        pairs = np.unique(of[use].astype(np.int64) * len(label) + pieces.unit_sentence[use])
        pairs = np.stack(np.divmod(pairs, len(label)))
        counts = [np.bincount(pairs[0][label[pairs[1]] == k], minlength=len(different)) for k in (0, 1)]
        del of, use, pairs
        total = [max(1, int((label[once] == k).sum())) for k in (0, 1)]
        units = np.array(list(different), object)
        expected = (counts[0] + 0.5) / total[0] * total[1]
        gain = np.where(counts[1] > expected, counts[1] * np.log(np.maximum(counts[1], 1) / expected) - (counts[1] - expected), 0.0)
        letters: dict[str, int] = {}
        for u, n in zip(units.tolist(), (counts[0] + counts[1]).tolist()):
            for c in filter(str.isalpha, u):
                letters[c] = letters.get(c, 0) + n
        self.space = Subsequences("".join(c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))))
        bad = self._apart([u for u in units[np.argsort(-gain, kind="stable")[: 40 * landmarks]].tolist() if gain[different[u]] > 4], landmarks * 3 // 4)
        if not bad:
            return self
        clean = units[np.argsort(-counts[0], kind="stable")[: 200 * landmarks]]
        clean = [u for u in clean.tolist() if gain[different[u]] == 0 and counts[0][different[u]]]
        near = self.space.kernel(clean, self.space.landmarks(bad)).max(axis=1) if clean else np.zeros(0)
        marks = sorted({*bad, *(clean[i] for i in np.argsort(-near, kind="stable")[: landmarks - len(bad)].tolist())})
        self.marks, self.names = self.space.landmarks(marks), marks
        own = self.space.kernel(marks, self.marks).astype(np.float64)
        value, vector = np.linalg.eigh((own + own.T) / 2)
        root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
        self._memo = None
        del names, units, clean, near
        who, table = self.table(pieces, np.float16)  # as exact as entries are
        self._memo = None
        keep = np.flatnonzero(once[who])
        clean_at = keep[label[who[keep]] == 0]
        likest = np.argsort(-table[clean_at].max(axis=1), kind="stable")[:CLEAN_SENTENCES] if len(clean_at) else clean_at
        keep = np.sort(np.concatenate([keep[label[who[keep]] == 1], clean_at[likest]]))
        x, bag, at_ = table[keep].astype(np.float32), pieces.text_of[who[keep]], label[who[keep]]
        blank = int((label[once] == 0).sum() - (at_ == 0).sum())  # clean sentences that are like no landmark, or hardly
        # first guess: a toxic row's sentences that are most like the units that tell toxic sentences
        told = np.isin(marks, bad)
        score = x[:, told].max(axis=1) if told.any() else np.zeros(len(x))
        limit, features = 0.6, x @ root.astype(np.float32)
        more, share = self._inserted({u: int(counts[1][different[u]]) for u in bad}, seed)
        del different, counts
        more_x = more @ root.astype(np.float32)
        for _ in range(rounds):
            best = np.full(len(y), -np.inf)
            np.maximum.at(best, bag, score)
            toxic = (at_ == 1) & ((score >= limit) | ((score == best[bag]) & (score > limit - 1)))
            if not toxic.any():
                return self
            a, b = features[toxic], features[at_ == 0]
            data = np.vstack([a, more_x, b, np.zeros((1, x.shape[1]))])
            target = np.concatenate([np.ones(len(a) + len(more_x)), -np.ones(len(b) + 1)])
            weight = np.concatenate([np.ones(len(a)), share * len(a) * VARIED, np.ones(len(b)), [max(1, blank)]])
            w, self.bias = fit_svm(data, target, weight)
            self.beta = (root @ w).astype(np.float64)
            score, limit = features @ w + self.bias, 0.0
        summary = self._summary(pieces, who, table)
        # a text with but one of a toxic row's sentences is toxic too, as far as clean rows don't have the like
        alone = summary[(y == 1) & (summary[:, 0] > 0)].copy()
        alone[:, 1:3], alone[:, 3] = np.clip(self.bias, -3, 3), np.log1p(alone[:, 0])
        self.weights = fit_logistic(np.vstack([summary, alone]), np.concatenate([y, np.ones(len(alone))]))
        return self

    def _apart(self, units: list[str], most: int, alike: float = 0.6) -> list[str]:
        """The first units no two of which have a kernel over ``alike``."""
        if not units:
            return []
        units = units[: 4 * most]
        table = self.space.kernel(units, self.space.landmarks(units))
        out: list[int] = []
        for i in range(len(units)):
            if len(out) < most and not (table[i, out] > alike).any():
                out.append(i)
        return [units[i] for i in out]

    def _inserted(self, bad: dict[str, int], seed: int, copies: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Kernels of copies of these units with one more letter in them, or a space between all letters, and each one's
        share by the units' counts."""
        rng = np.random.default_rng(seed)
        common = "etaoinsrhldu"
        new, share = [], []
        for u, n in sorted(bad.items()):
            for c in range(copies):
                k = int(rng.integers(1, len(u)))
                new.append((" ".join(u) if c == 0 else u[:k] + common[rng.integers(len(common))] + u[k:]).encode())
                share.append(n / copies)
        out = np.zeros((len(new), self.marks[1].shape[1]), np.float32)
        for r, data in enumerate(self.kernels(new)):
            entry = np.frombuffer(data, _ENTRY)
            np.maximum.at(out[r], entry["mark"].astype(np.int64), entry["value"].astype(np.float32))
        return out, np.array(share) / max(1, sum(share))

    def _summary(self, pieces: Pieces, who: np.ndarray, table: np.ndarray) -> np.ndarray:
        """What a text's score is made of: its three worst sentences, the sum of what is beyond the margin, its length."""
        n = pieces.n
        value = np.concatenate([np.zeros(0), *(table[a : a + 20_000].astype(np.float64) @ self.beta for a in range(0, len(table), 20_000))]) + self.bias
        number = np.bincount(pieces.text_of, minlength=n)
        top = np.full((n, 3), self.bias)
        over = np.zeros(n)
        if len(value):
            bag = pieces.text_of[who]
            order = np.lexsort((-value, bag))
            b, v = bag[order], value[order]
            first = np.searchsorted(b, b)
            place = np.arange(len(b)) - first
            for k in range(3):
                at = place == k
                top[b[at], k] = np.maximum(v[at], self.bias)
            np.add.at(over, bag, np.maximum(0, value))
        return np.stack([np.clip(top, -3, 3)[:, k] for k in range(3)] + [np.log1p(over), np.log1p(number) / 3], axis=1)

    def scores(self, texts: pa.StringArray | list) -> np.ndarray:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if self.weights is None:
            return np.zeros(len(texts))
        out = np.empty(len(texts))
        for a, n in slices(texts):
            pieces = Pieces(texts.slice(a, n))
            x = self._summary(pieces, *self.table(pieces))
            out[a : a + n] = 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))
        return out

    def sentences(self, text: str) -> list[tuple[str, float]]:
        """Each sentence, in lower case, with the machine's decision; over 0 is toxic."""
        pieces = Pieces(pa.array([text], pa.string()))
        found = [t.decode("utf-8", "replace") for t in pieces.sentences()]
        value = np.full(len(found), self.bias)
        if self.weights is not None:
            who, table = self.table(pieces)
            value[who] = table.astype(np.float64) @ self.beta + self.bias
        return list(zip(found, value.tolist()))


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score)."""
    carried = Carried(model)

    def run(batches):
        own = held(carried)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.scores(batch.column(1)))], ["doc_id", "score"])
        settle()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    rows = labelled_sample(docs, labels, "toxic", fold_column(F.col("doc_id"), 5) != 0, (MAX_CLEAN, MAX_TOXIC), MAX_BYTES)
    scored = score_documents(docs, ToxicityModel().fit(rows))
    held_out = (fold_column(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
