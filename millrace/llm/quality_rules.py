"""Quality rules as a short-circuit cascade.

Each rule is measured on a sample of about SAMPLE texts from all over the table, on the executors: what it costs a text and
which share of the texts it rejects. The rules then run by rejection per cost, and a text that one rule rejects is not shown
to the next ones. The order changes the work, never the verdict: a text is kept if no rule rejects it. Which of several
rejecting rules is named depends on the order, hence on measured times; with a given ``order`` it is always the same one.

Null and empty texts have no words and are rejected as ``too_short``. Texts of any length are judged whole. Repeated rows are
judged one by one and alike. Rules of equal worth keep their order in RULES. Empty tables give empty results. Other columns of
the input, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import lean
from ._text import Block, blocks, repeated

#: Texts that the costs and selectivities are estimated on, on average.
SAMPLE = 400

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def word_chars(b: Block) -> np.ndarray:
    return b.per_byte(b._spans[2] & ((b.data & 0xC0) != 0x80))


def n_symbols(b: Block) -> np.ndarray:
    return b.per_byte(_SYMBOL[b.data])


def n_lines(b: Block) -> np.ndarray:
    return np.bincount(b.lines[0], minlength=b.n)


def n_dup_lines(b: Block) -> np.ndarray:
    doc, h, _ = b.lines
    return np.bincount(doc[repeated(doc, h)[1]], minlength=b.n)


def n_repeat_words(b: Block) -> np.ndarray:
    at = np.flatnonzero(b.gram_starts(3))
    twice = at[repeated(b.doc_of_word[at], b.grams(3)[at])[0]]
    covered = np.zeros(len(b.starts), bool)
    for j in range(3):
        covered[twice + j] = True
    return b.per_text(covered)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Block], np.ndarray]


RULES: tuple[Rule, ...] = (
    Rule("too_short", lambda b: b.n_words < 50),
    Rule("word_length", lambda b: (word_chars(b) < 2 * b.n_words) | (word_chars(b) > 15 * b.n_words)),
    Rule("symbols", lambda b: 4 * n_symbols(b) > b.n_words),
    Rule("letters", lambda b: 2 * b.per_byte(_LETTER[b.data]) < b.per_byte(b._spans[2])),
    Rule("duplicate_lines", lambda b: 10 * n_dup_lines(b) > 3 * n_lines(b)),
    Rule("repeated_words", lambda b: 2 * n_repeat_words(b) > b.n_words),
)


def measured(col: pa.Array, rules: tuple[Rule, ...] = RULES) -> list[tuple[float, int]]:
    """(seconds, texts rejected) of each rule."""
    found = []
    for r in rules:
        began, rejected = time.perf_counter(), 0
        for _, _, b in blocks(col):
            rejected += int(r.rejects(b).sum())
        found.append((time.perf_counter() - began, rejected))
    return found


def ordered(costs: dict[str, tuple[float, int]], rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Best rejection per cost first; without a sample, in the order given."""
    worth = lambda r: costs.get(r.name, (0.0, 0))[1] / max(costs.get(r.name, (0.0, 0))[0], 1e-9)
    return sorted(rules, key=lambda r: -worth(r))


def plan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """The rules in the order that a sample suggests; only sums of seconds and rejections reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = measured(batch.column(0), rules)
                yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "s": pa.array([x for x, _ in got], pa.float64()), "n": pa.array([x for _, x in got], pa.int64())})

    rows = docs.select(docs[text].alias("text")).sample(False, min(1.0, sample / max(docs.count(), 1)), seed=7)
    sums = rows.mapInArrow(lean(run), "rule string, s double, n long").groupBy("rule").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return ordered({r.rule: (r.s, r.n) for r in sums.collect()}, rules)


def cascade(col: pa.Array, order: list[Rule]) -> np.ndarray:
    """For each text the place in ``order`` of the first rule that rejects it, or -1."""
    out = np.full(len(col), -1)
    alive = np.arange(len(col))
    for k, r in enumerate(order):
        if not len(alive):
            break
        bad = np.concatenate([r.rejects(b) for _, _, b in blocks(col.take(pa.array(alive)))])
        out[alive[bad]] = k
        alive = alive[~bad]
    return out


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE, keep_only: bool = False, order: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``rejected_by`` (name of a rule or null) added in place of any column of that name, or only the
    kept rows with the columns they came with. ``order`` fixes the order of the rules and saves the sample."""
    order = order or plan(docs, text, rules, sample)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = cascade(batch.column(batch.schema.get_field_index(text)), order)
            if keep_only:
                yield batch.filter(pa.array(first < 0))
            else:
                why = pa.array([order[k].name if k >= 0 else None for k in first], pa.string())
                cols = {c: batch.column(i) for i, c in enumerate(names) if c != "rejected_by"}
                yield pa.RecordBatch.from_pydict(cols | {"rejected_by": why})

    schema = docs.schema if keep_only else docs.drop("rejected_by").schema.add("rejected_by", "string")
    return docs.mapInArrow(lean(run), schema)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every document."""
    order = plan(docs, "text", rules, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, col = batch.column(0), batch.column(1)
            for lo, hi, b in blocks(col):
                words, again = b.n_words, n_repeat_words(b)
                failed = (words < 50) | (100 * again > 50 * words)
                good = np.flatnonzero(~failed)
                first = np.full(b.n, -1)
                if len(good):
                    first[good] = cascade(col.slice(lo, hi - lo).take(pa.array(good)), order)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(lo, hi - lo), "n_words": pa.array(words, pa.int64()), "word_chars": pa.array(word_chars(b), pa.int64()),
                    "n_symbols": pa.array(n_symbols(b), pa.int64()), "n_dup_lines": pa.array(n_dup_lines(b), pa.int64()), "n_repeat_words": pa.array(again, pa.int64()),
                    "base_failed": pa.array(failed), "kept": pa.array(~failed & (first < 0)),
                })

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    )
