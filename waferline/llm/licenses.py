"""Licence scans with a trained paragraph classifier (operator 7).

A text's paragraphs are its lines; lines of more than ``WIDE`` words are read in windows of
``WIDE`` words that overlap by half. Notices among other words of a line and notices that are
wrapped over lines are read as well: runs of lines with words (a line without, as an empty
comment line, is a border) are searched for 3-grams of notices, and windows of up to the longest
notice slide over the places that hold them. What such windows confirm is one span of whole
lines per family and place; it takes the place of its lines' own unconfirmed spans. Comment
marks are no words. A multinomial logistic regression over sparse word 1- to 3-grams tells the
licence family of a paragraph, or that it is none (class ``unknown``). It is
trained on the public notices of :mod:`license_texts`, cut, edited and set among prose, against
sentences about licences, shuffled notices, and paragraphs of a bounded sample of the documents
(``PROSE_DOCUMENTS`` of them). Temperature and threshold are calibrated on examples that were
not trained on. A predicted family is confirmed by template comparison: enough of the word
2- and 3-grams of one of its notices must occur in the paragraph. It also decides among
families that are close, as headers that differ in a word.

Only paragraphs with a 3-gram of some notice are scored: no other can be confirmed, because
without a common 3-gram less than ``CONFIRM`` of a notice's 2- and 3-grams are shared.

Every line of every text is read. The model is small (its vocabulary is that of the notices)
and broadcast; texts never move.

Defined cases: null and empty texts have no paragraphs; a blank line is none; ties between
families go to the first in order; repeated rows are scanned each; extra columns are ignored;
an empty table gives an empty result (the model then knows no prose).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import ALNUM, split_words, starts_of
from waferline.llm.license_texts import NAMES, NOT_A_LICENCE, NOTICES, PARAGRAPHS

WIDE = 64
GRAMS = 3
CONFIRM = 0.7
#: Families whose probability is at least this share of the greatest are close.
CLOSE = 0.05
PROSE_DOCUMENTS, PROSE_PARAGRAPHS = 400, 6
#: The characters of a sampled paragraph that may come to the driver.
PROSE_CHARACTERS = 4096
#: Wrapped notices: most words between their 3-grams, and window sizes beside the longest notice.
APART, SIZES = 12, (32, 16, 8)
UNKNOWN = "unknown"
FAMILIES = sorted(NAMES)
RESULT = ("doc_id long, n_paragraphs long, spans array<struct<start:int,end:int,family:string,score:double,confirmed:boolean>>")


def words_of(text: str) -> list[str]:
    return [w.decode() for w in split_words([text], ALNUM)[0].to_pylist()]


def grams(words: list[str], least: int = 1) -> list[tuple]:
    return [tuple(words[i:i + n]) for n in range(least, GRAMS + 1) for i in range(len(words) - n + 1)]


def notices() -> dict[str, list[list[str]]]:
    """Per family, the word lists of its notices, sentence by sentence and whole."""
    out = {}
    for family, (ident, names) in NAMES.items():
        texts = [n.format(name, ident) for n in NOTICES for name in names]
        for p in PARAGRAPHS.get(family, []):
            texts += [p, *re.split(r"(?<=[.;:]) ", p)]
        lists = [words_of(t) for t in dict.fromkeys(texts)]
        out[family] = [w for w in lists if len(w) >= 3]
    return out


def examples(prose: list[list[str]], seed: int = 7) -> tuple[list[list[str]], list[int]]:
    """(paragraphs as word lists, class numbers; the last class is ``unknown``)."""
    rng, x, y = np.random.default_rng(seed), [], []
    plain = prose or [[]]
    for k, family in enumerate(FAMILIES):
        for w in notices()[family]:
            x.append(w)
            y.append(k)
            for _ in range(3):  # edited, and half of the time among prose
                some = [v for v in w if rng.random() > 0.06] or w
                if rng.random() < 0.5:
                    around = plain[rng.integers(len(plain))]
                    cut = int(rng.integers(0, len(around) + 1))
                    some = (around[:cut][-20:] + some + around[cut:][:20])[:WIDE]
                x.append(some)
                y.append(k)
            if rng.random() < 0.5:  # the same words in another order are no notice
                x.append([w[i] for i in rng.permutation(len(w))])
                y.append(len(FAMILIES))
    for w in [words_of(t) for t in NOT_A_LICENCE] * 3 + prose:
        x.append(w)
        y.append(len(FAMILIES))
    return x, y


class Classifier:
    """Logistic regression over word n-grams with calibrated probabilities."""

    def __init__(self, prose: list[list[str]], rounds: int = 150):
        own = notices()
        self.templates = {f: [set(grams(w, 2)) for w in own[f]] for f in FAMILIES}
        vocabulary = sorted({g for f in FAMILIES for w in own[f] for g in grams(w)}
                            | {g for t in NOT_A_LICENCE for g in grams(words_of(t))})
        self.longest = max(len(w) for f in FAMILIES for w in own[f])
        self.feature = {g: i for i, g in enumerate(vocabulary)}
        self.words = sorted({w for g in vocabulary for w in g})
        prose = [w for w in prose if self.resemblance(w) < 0.5 and self.share(w) < 0.5]  # notices among the sample
        x, y = examples(prose)
        fold = np.random.default_rng(1).random(len(x)) < 0.25
        y = np.array(y)
        m = np.zeros((len(x), len(vocabulary)), np.float32)
        for i, w in enumerate(x):
            at, value = self.vector(w)
            m[i, at] = value
        self.weights, self.bias = self._train(m[~fold], y[~fold], rounds)
        logits = m[fold] @ self.weights + self.bias
        self.temperature = min(np.geomspace(0.1, 4, 30), key=lambda t: self._loss(logits / t, y[fold]))
        p = self._softmax(logits / self.temperature)
        none = len(FAMILIES)
        best = p[:, :none].max(axis=1)
        right = (p[:, :none].argmax(axis=1) == y[fold])
        self.threshold = next((t for t in np.linspace(0.5, 0.95, 10) if right[best >= t].mean() >= 0.99), 0.95)
        self.accuracy = float((p.argmax(axis=1) == y[fold]).mean())

    def vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        every = grams(words)
        at, n = np.unique([self.feature[g] for g in every if g in self.feature], return_counts=True)
        return at.astype(np.int64), n / np.sqrt(max(1, len(every)))

    def resemblance(self, words: list[str]) -> float:
        found = set(grams(words, 2))
        return max((len(t & found) / len(t) for f in FAMILIES for t in self.templates[f]), default=0.0)

    def share(self, words: list[str]) -> float:
        """The share of the words' own grams that notices have: high for a line of a wrapped one."""
        found = set(grams(words, 2))
        return sum(any(g in t for f in FAMILIES for t in self.templates[f]) for g in found) / max(1, len(found))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def _loss(self, z: np.ndarray, y: np.ndarray) -> float:
        return -float(np.log(self._softmax(z)[np.arange(len(y)), y] + 1e-12).mean())

    def _train(self, m: np.ndarray, y: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Full-batch gradient steps with momentum and a little shrinkage."""
        k = len(FAMILIES) + 1
        w, b = np.zeros((m.shape[1], k), np.float32), np.zeros(k, np.float32)
        vw, vb, target = np.zeros_like(w), np.zeros_like(b), np.eye(k, dtype=np.float32)[y]
        for _ in range(rounds):
            g = (self._softmax(m @ w + b) - target) / len(y)
            vw = 0.9 * vw - 8.0 * (m.T @ g + 1e-5 * w)
            vb = 0.9 * vb - 8.0 * g.sum(axis=0)
            w, b = w + vw, b + vb
        return w, b

    def best(self, words: list[str]) -> tuple[str, float, int]:
        """(family or unknown, calibrated probability, the most grams of a template of the family
        that the words hold; 0 if they confirm none). Among close families, as those of headers that
        differ in a word, the one with most of these grams is taken; where no family reaches the
        threshold but all together do, only a confirmed one is."""
        at, value = self.vector(words)
        z = (value @ self.weights[at] if len(at) else 0.0) + self.bias
        p = self._softmax(z[None] / self.temperature)[0]
        top = int(p[:-1].argmax())
        if 1 - p[-1] < self.threshold:
            return UNKNOWN, float(p[-1]), 0
        found = set(grams(words, 2))
        held = {k: max((n for t in self.templates[FAMILIES[k]] if (n := len(t & found)) >= CONFIRM * len(t)), default=0)
                for k in np.flatnonzero(p[:-1] >= CLOSE * p[top]).tolist()}
        k = max(held, key=lambda k: (held[k], float(p[k]), -k))
        if p[top] < self.threshold and not held[k]:
            return UNKNOWN, float(p[-1]), 0
        return FAMILIES[k], float(p[k]), held[k]

    def classify(self, words: list[str]) -> tuple[str, float, bool]:
        """(family or unknown, calibrated probability, confirmed)."""
        family, score, held = self.best(words)
        return family, score, held > 0


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, first word within all words, number of words) of each paragraph window."""
    n = np.where(counts > WIDE, -(-(counts - WIDE) // (WIDE // 2)) + 1, (counts > 0).astype(np.int64))
    line = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(line)) - np.repeat(starts_of(n)[:-1], n)
    return line, starts_of(counts)[line] + nth * (WIDE // 2), np.minimum(counts[line] - nth * (WIDE // 2), WIDE)


def places(at: np.ndarray, run: np.ndarray, longest: int) -> list[tuple[int, int]]:
    """Windows (first word, end) over each place that holds 3-grams of notices, in a line or
    across line ends. ``at``: where these start; ``run`` of every word."""
    at = at[run[at] == run[at + 2]]
    cut = np.flatnonzero((np.diff(at) > APART) | (np.diff(run[at]) != 0)) + 1
    out: set[tuple[int, int]] = set()
    for place in np.split(at, cut) if len(at) else []:
        a, b = int(place[0]), int(place[-1]) + 3
        out |= {(max(a, e - size), e) for size in (longest, *SIZES) for e in [*range(min(a + size, b), b, size // 4), b]}
    return sorted(out)


def settled(found: list[tuple[int, int, str, float, int]]) -> list[tuple[int, int, str, float]]:
    """Of confirmed windows (first, end, family, score, grams of a template) that overlap, the one
    with most grams stays, then the shorter one, then the likelier; in the order of the text."""
    kept: list[tuple[int, int, str, float]] = []
    for w in sorted(found, key=lambda w: (-w[4], w[1] - w[0], -w[3], w[:3])):
        if all(w[1] <= k[0] or k[1] <= w[0] for k in kept):
            kept.append(w[:4])
    return sorted(kept)


def lined(windows_: list[tuple[int, int, str, float]], line: np.ndarray) -> list[tuple[int, int, str, float]]:
    """(first line, last line, family, score): windows of a family that share a line made one."""
    out: list[tuple[int, int, str, float]] = []
    last: dict[str, int] = {}
    for a, b, family, score in windows_:
        i, j = int(line[a]), int(line[b - 1])
        if family in last and out[last[family]][1] >= i:
            at = last[family]
            out[at] = out[at][0], max(j, out[at][1]), family, max(score, out[at][3])
        else:
            last[family] = len(out)
            out.append((i, j, family, score))
    return out


def prose_sample(docs: DataFrame, size: int = PROSE_DOCUMENTS, each: int = PROSE_PARAGRAPHS) -> list[list[str]]:
    """The first words of up to ``each`` paragraphs of about ``size`` documents, chosen by a hash of the id."""
    n = docs.count()
    share = min(1 << 20, -(-(size << 20) // max(n, 1)))
    line = F.regexp_extract_all("text", F.lit(r"[^\n]+"), 0)
    rows = (docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).orderBy(F.xxhash64("doc_id", "text")).limit(2 * size)
            .select(F.explode(F.slice(line, 1, each)).alias("line")).select(F.left("line", F.lit(PROSE_CHARACTERS)).alias("line")).collect())
    return [w for w in (words_of(r[0])[:WIDE] for r in rows) if w]


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, n_paragraphs and the spans (line bounds in characters) that the classifier
    takes for a licence, confirmed or not."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = pa.array([w.encode() for w in model.words], pa.large_binary())
        v = len(model.words)
        number = {w: i for i, w in enumerate(model.words)}
        triples = np.unique([(number[a] * v + number[b]) * v + number[c] for a, b, c in (g for g in model.feature if len(g) == 3)])
        for b in batches:
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                lines = [(t or "").split("\n") for t in piece.column(1).to_pylist()]
                of = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
                words, counts = split_words((x for y in lines for x in y), ALNUM)
                line, first, size = windows(counts)
                spans: list[list] = [[] for _ in lines]
                if len(words) >= 3:
                    t = pc.index_in(words, value_set=known).fill_null(-1).to_numpy().astype(np.int64)
                    a, m, z = t[:-2], t[1:-1], t[2:]
                    hit = np.zeros(len(t) + 1, np.int64)
                    hit[1:-2] = np.cumsum((a >= 0) & (m >= 0) & (z >= 0) & np.isin((a * v + m) * v + z, triples))
                    hit[-2:] = hit[-3]
                    likely = np.flatnonzero((size >= 3) & (hit[np.maximum(first + size - 2, first)] > hit[first]))
                    base = starts_of([len(x) for x in lines])

                    def place(k: int) -> tuple[int, int]:
                        """A line's bounds in its text."""
                        own, j = lines[of[k]], k - int(base[of[k]])
                        begin = sum(len(x) + 1 for x in own[:j])
                        return begin, begin + len(own[j])

                    def judge(a: int, b: int) -> tuple[str, float, int]:
                        return model.best([x.decode() for x in words[a:b].to_pylist()])

                    held, guessed = [], []  # confirmed windows; (line, family, score) of the others
                    some = counts > 0
                    border = np.r_[True, ~some[:-1] | (of[1:] != of[:-1])]
                    of_word = np.repeat(np.arange(len(counts)), counts)
                    done = np.zeros(len(counts) + 1, bool)  # lines that are notices by themselves
                    for w in likely.tolist():
                        x, y = int(first[w]), int(first[w] + size[w])
                        family, score, n = judge(x, y)
                        if n:
                            held.append((x, y, family, score, n))
                            done[line[w]] = True
                        elif family != UNKNOWN:
                            guessed.append((int(line[w]), family, score))
                    runs = np.cumsum(border), np.cumsum(border | done[:-1] | np.r_[False, done[:-2]])
                    hits = np.flatnonzero(np.diff(hit[:-2]))
                    for x, y in sorted({w for r in runs for w in places(hits, r[of_word], model.longest)}):
                        if of_word[x] == of_word[y - 1] and done[of_word[x]]:
                            continue
                        family, score, n = judge(x, y)
                        if n:
                            held.append((x, y, family, score, n))
                    sure = lined(settled(held), of_word)
                    part = {(k, family) for x, y, family, _ in sure for k in range(x, y + 1)}
                    inside = {x for x, y, _, _ in sure if x == y}
                    every = [(*a, True) for a in sure] + [
                        (k, k, family, score, False) for k, family, score in guessed if k not in inside and (k, family) not in part]
                    for x, y, family, score, confirmed in sorted(every, key=lambda r: r[0]):
                        spans[of[x]].append({"start": place(x)[0], "end": place(y)[1], "family": family,
                                             "score": score, "confirmed": confirmed})
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(np.bincount(of[line], minlength=len(lines)), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("family", pa.string()),
                                                         ("score", pa.float64()), ("confirmed", pa.bool_())])))],
                    ["doc_id", "n_paragraphs", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)


def scan_documents(docs: DataFrame) -> DataFrame:
    return scan(docs, Classifier(prose_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")))))


def digest(found: DataFrame) -> DataFrame:
    """Per document: the number of paragraphs, of confirmed and unconfirmed licence
    paragraphs, the confirmed families, and the likeliest with its probability."""
    sure = F.filter("spans", lambda s: s["confirmed"])
    best = F.array_max(F.transform(sure, lambda s: F.struct(s["score"].alias("score"), s["family"].alias("family"))))
    return found.select(
        "doc_id", "n_paragraphs", F.size(sure).cast("long").alias("n_license"),
        (F.size("spans") - F.size(sure)).cast("long").alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda s: s["family"]))), ",").alias("licenses"),
        best["family"].alias("family"), F.coalesce(best["score"], F.lit(0.0)).alias("score"))
