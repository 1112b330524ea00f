"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text: density and count of lexicon words and of words that begin like them, their nearness to a second
person, capitals, shouted words, exclamation and question marks, other punctuation, disguised lexicon words (digits and
symbols for letters, letters repeated), and its length. The lexicon is a fixed list of insults, and words and word
beginnings that a third of the training rows use far more often in toxic texts. Another third fits the trees and the last
one the calibration, so that no part is judged by rows that it has seen.

Training takes a bounded sample of TRAIN_ROWS labelled documents, the first by a hash of doc_id, one text of each doc_id (the
smallest of several), and LEXICON_ROWS words at most, the most telling ones. Labels, language, source and doc_id are never
features. Null and empty texts have all features zero and get a score too; texts of any length are read whole; equal texts have
equal scores. A doc_id labelled twice is toxic if one label says so; rows with null labels or doc_ids are not learnt from.
Without labels of both kinds the fixed lexicon's density alone gives the score. An empty table gives an empty result. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import Block, blocks

TRAIN_ROWS = 20_000
LEXICON_ROWS = 3_000  #: words and beginnings taken at most
HEADS = (4, 5, 6)  #: letters of a word's beginning

# Common insults, and second-person words of the languages here.
INSULTS = frozenset("idiot idiots moron morons stupid dumb loser losers trash garbage pathetic worthless disgusting scum clown clowns fool jerk creep ugly vermin filth imbecile".split())
SECOND = frozenset("you your yours yourself u ur tu toi te vous votre vos ton ta tes du dich dir dein deine ihr euch usted ustedes tú ti vosotros vuestro".split())
_LEET = str.maketrans("013457@$!", "oleastasi")
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_]+(?:[0-9@$!*.\-]+[^\W\d_]+)+")
_LONG = re.compile(r"(.)\1{2,}")

NAMES = ("lexicon_density", "lexicon_count", "lexicon_kinds", "head_density", "head_count", "near_second", "second_density", "capitals", "shouted", "exclaim", "question", "punctuation", "masked", "stretched", "log_words", "word_length")


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_UPPER, _EX, _QU, _DIGIT = _mask(bytes(range(65, 91))), _mask(b"!"), _mask(b"?"), _mask(b"0123456789@$!*")
_PUNCT = _mask(b"#%&'()*+,-./:;<=>@[]^_`{|}~\"$\\")


_WORDY = np.zeros(256, bool)
_WORDY[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _shouted(b: Block) -> np.ndarray:
    """How many words of three letters or more, all A to Z, each text has."""
    up, wordy = _UPPER[b.data], _WORDY[b.data]
    edge = np.zeros(len(up) + 1, bool)  # where a text begins or ends
    edge[b.off] = True
    off = np.zeros(1, bool)
    before, after = ~edge[:-1] & np.concatenate([off, wordy[:-1]]), ~edge[1:] & np.concatenate([wordy[1:], off])
    start = np.flatnonzero(up & (edge[:-1] | ~np.concatenate([off, up[:-1]])))
    end = np.flatnonzero(up & (edge[1:] | ~np.concatenate([up[1:], off])))
    alone = (end - start >= 2) & ~before[start] & ~after[end]
    return np.bincount(np.searchsorted(b.off, start[alone], side="right") - 1, minlength=b.n)


def _stretched(b: Block) -> np.ndarray:
    """Which texts have a letter, of one byte or two, three times in a row."""
    d, out = _FOLD[b.data], np.zeros(len(b.data), bool)
    if len(d) > 2:
        out[:-2] |= (d[:-2] == d[1:-1]) & (d[1:-1] == d[2:]) & _WORDY[d[:-2]]
    if len(d) > 5:
        out[:-5] |= (d[:-5] >= 128) & (d[:-5] == d[2:-3]) & (d[2:-3] == d[4:-1]) & (d[1:-4] == d[3:-2]) & (d[3:-2] == d[5:])
    return b.per_byte(out) > 0


@dataclass
class Lexicon:
    words: frozenset[str] = INSULTS
    heads: frozenset[str] = field(default_factory=frozenset)


def features(texts: pa.Array, lex: Lexicon) -> np.ndarray:
    out = np.zeros((len(texts), len(NAMES)))
    strings = texts.to_pylist()
    for lo, hi, b in blocks(texts):
        size = np.maximum(np.diff(b.off), 1)
        n = np.maximum(b.n_words, 1)
        out[lo:hi, 7] = b.per_byte(_UPPER[b.data]) / size
        out[lo:hi, 9] = b.per_byte(_EX[b.data]) / n
        out[lo:hi, 10] = b.per_byte(_QU[b.data]) / n
        out[lo:hi, 11] = b.per_byte(_PUNCT[b.data]) / size
        out[lo:hi, 14] = np.log1p(b.n_words)
        out[lo:hi, 15] = np.where(b.n_words > 0, size / n, 0)
        odd, long_ = b.per_byte(_DIGIT[b.data]) > 0, _stretched(b)
        loud = _shouted(b)
        for i in range(lo, hi):
            text = strings[i]
            if not text:
                continue
            words = _WORD.findall(text.lower())
            m = max(len(words), 1)
            kinds = set(words)
            found = kinds & lex.words
            heads = {w for w in kinds if w[:4] in lex.heads or w[:5] in lex.heads or w[:6] in lex.heads} - found
            second = kinds & SECOND
            row = out[i]
            if found or heads:
                at = [k for k, w in enumerate(words) if w in found]
                ah = [k for k, w in enumerate(words) if w in heads]
                row[0], row[1], row[2] = len(at) / m, np.log1p(len(at)), len(found)
                row[3], row[4] = len(ah) / m, np.log1p(len(ah))
                if second:
                    you = np.array([k for k, w in enumerate(words) if w in second])
                    gaps = np.array(sorted(at + ah))
                    near = np.searchsorted(you, gaps)
                    d = np.minimum(np.abs(gaps - you[np.minimum(near, len(you) - 1)]), np.abs(gaps - you[np.maximum(near - 1, 0)]))
                    row[5] = float((1 / (1 + d)).sum()) / m
            if second:
                row[6] = sum(w in second for w in words) / m
            row[8] = loud[i - lo] / m
            if odd[i - lo]:
                row[12] = sum(x.translate(_LEET).replace("*", "").replace(".", "").replace("-", "") in lex.words for x in _MASKED.findall(text.lower())) / m
            row[13] = sum(_LONG.sub(r"\1", w) in lex.words for w in kinds if _LONG.search(w)) / m if long_[i - lo] else 0
    return out


# --- gradient-boosted trees ---------------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Binary trees of equal depth over binned features; a node k has the children 2k+1 and 2k+2."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # bins up to it go left
    value: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), int)
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), int)
            while inner and (node < inner).all() and len(node):
                node = 2 * node + 1 + (b[np.arange(len(x)), f[node]] > c[node])
            out += v[node - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, l2: float = 1.0) -> Trees:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    b = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(p / (1 - p)))
    raw, inner = np.full(len(y), base), 2**depth - 1
    fs, cs, vs = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-raw))
        g, h = y - q, q * (1 - q)
        node, f, c = np.zeros(len(y), int), np.zeros(inner, int), np.full(inner, bins)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                at = np.flatnonzero(node == k)
                best = 1e-6
                if len(at) >= 20:
                    G, H = g[at].sum(), h[at].sum()
                    for j in range(x.shape[1]):
                        gl = np.cumsum(np.bincount(b[at, j], g[at], bins + 1))[:-1]
                        hl = np.cumsum(np.bincount(b[at, j], h[at], bins + 1))[:-1]
                        gain = gl**2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G**2 / (H + l2)
                        if gain.max() > best:
                            best, f[k], c[k] = gain.max(), j, int(gain.argmax())
                node[at] = 2 * k + 1 + (b[at, f[k]] > c[k])
        leaf = node - inner
        v = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        raw += v[leaf]
        fs.append(f), cs.append(c), vs.append(v)
    return Trees(edges, base, np.array(fs), np.array(cs), np.array(vs))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (from, value) of the best monotone fit, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    r, pooled = raw[order], []
    for x, v in zip(r, y[order], strict=True):
        pooled.append([x, float(v), 1.0])
        while len(pooled) > 1 and (pooled[-2][1] >= pooled[-1][1] or pooled[-2][0] == pooled[-1][0]):
            b, a = pooled.pop(), pooled.pop()
            w = a[2] + b[2]
            pooled.append([a[0], (a[1] * a[2] + b[1] * b[2]) / w, w])
    return np.array([p[0] for p in pooled]), np.array([p[1] for p in pooled])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, texts: pa.Array) -> np.ndarray:
        x = features(texts, self.lexicon)
        if self.trees is None:
            return np.minimum(1.0, 40 * x[:, 0])
        raw = self.trees.raw(x)
        at, value = self.steps
        # between the middles of two steps the calibration goes straight, so that unequal texts rarely tie
        flat = np.interp(raw, at, value) if len(at) > 1 else np.full(len(raw), value[0])
        return np.clip(0.98 * flat + 0.02 / (1 + np.exp(-raw)), 0.0, 1.0)


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows: text, y, part (0, 1 or 2)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    chosen = known.withColumn("o", F.xxhash64(F.lit(5), "doc_id")).orderBy("o", "doc_id").limit(rows)
    part = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(3)).alias("part")
    # at most TRAIN_ROWS rows of two numbers: a proven bound
    ids = F.broadcast(chosen.select("doc_id", "y"))
    found = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    return found.select("text", F.col("y").cast("int").alias("y"), part)


def _head(k: int):
    return lambda w: F.concat(F.lit("h"), F.substring(w, 1, k))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic."""
    sample = _sample(docs, labels, rows).persist()
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 2))
    both = F.transform(words, lambda w: F.concat(F.lit("w"), w))
    for k in HEADS:
        # of words longer than that
        both = F.concat(both, F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) > HEADS[0] + 1), _head(k))))
    both = F.array_distinct(both)
    first = sample.where("part = 0")
    total = first.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    t, c = total.t, total.n - total.t
    odds = F.log((F.col("t") + 0.5) / (t + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (c + 1))
    used = first.select("y", F.explode(both).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")).where("t >= 4").withColumn("odds", odds)
    # beginnings are common words' too, so toxic texts that have them must be many; how often they come is a feature
    head = F.startswith("w", F.lit("h")) & (F.col("odds") > 2.0) & (F.col("t") >= max(5, 0.02 * t))
    best = used.where(head | (F.startswith("w", F.lit("w")) & (F.col("odds") > 3.0))).orderBy(F.desc("odds"), "w").limit(LEXICON_ROWS).collect()
    lex = Lexicon(INSULTS | {r.w[1:] for r in best if r.w[0] == "w"}, frozenset(r.w[1:] for r in best if r.w[0] == "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column(0), lex)
            yield pa.RecordBatch.from_pydict({"y": b.column(1), "part": b.column(2).cast(pa.int64()), "x": pa.array(list(x), pa.list_(pa.float64()))})

    got = sample.where("part > 0").select("text", "y", "part").mapInArrow(run, "y int, part long, x array<double>").toPandas()
    sample.unpersist()
    if got.empty or got[got.part == 1].y.nunique() < 2 or got[got.part == 2].empty:
        return Model(lex)
    x, y, part = np.stack(got.x.to_numpy()), got.y.to_numpy(float), got.part.to_numpy()
    order = np.lexsort((*x.T, y))  # the rows' order doesn't matter to the fit
    x, y, part = x[order], y[order], part[order]
    trees = boost(x[part == 1], y[part == 1])
    return Model(lex, trees, isotonic(trees.raw(x[part == 2]), y[part == 2]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), pa.array(model.score(batch.column(1).slice(lo, 512)))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, "doc_id long, score double")
