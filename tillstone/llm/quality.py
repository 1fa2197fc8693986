"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins; boosting goes round the features again and
again and adds a shallow tree over one feature's bins to that feature's lookup
table. Then the pairs that explain most of what is left get tables of their
own in the same way. Scoring adds up one table entry per feature and pair.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillstone.llm.learning import training_sample, with_scores

FEATURES = (
    "log_length", "upper", "digit", "point", "symbol", "shout", "bar", "line_break", "beyond_ascii",
    "word_length", "distinct_words", "distinct_lines", "capital_words", "short_words", "symbol_words",
)
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"#$%&*@^~<>{}[]\\/_=+", b"!?", b"|", b"\n"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 8


@dataclass(frozen=True)
class Options:
    sample: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 8
    rounds: int = 60
    rate: float = 0.2


def features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES for each whole text."""
    out = np.zeros((len(texts), len(FEATURES)), np.float64)
    for i, text in enumerate(texts):
        data = text.encode()
        counts = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9)
        n, words, lines = max(1, len(data)), data.split(), data.split(b"\n")
        m = max(1, len(words))
        out[i, 0] = np.log1p(len(data))
        out[i, 1:9] = counts[1:9] / n
        out[i, 9:] = (
            sum(map(len, words)) / m,
            len(set(words)) / m,
            len(set(lines)) / len(lines),
            sum(w[:1].isupper() for w in words) / m,
            sum(len(w) < 4 for w in words) / m,
            sum(not w[-1:].isalnum() and w[-1:] not in b".,;:" for w in words) / m,
        )
    return out


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """Values by bin of a greedy tree with up to ``leaves`` leaves that are ranges of bins; Newton steps."""
    cg, cw = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    cuts = [0, len(gradient)]
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (cw[b] - cw[a] + 1)
    for _ in range(leaves - 1):
        best = max(
            ((gain(a, c) + gain(c, b) - gain(a, b), c) for a, b in zip(cuts, cuts[1:]) for c in range(a + 1, b)),
            default=(0, 0),
        )
        if best[0] <= 1e-9:
            break
        cuts = sorted([*cuts, best[1]])
    value = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        value[a:b] = (cg[b] - cg[a]) / (cw[b] - cw[a] + 1)
    return value


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The better of two trees of depth two over a grid: one cut of an axis and one cut of the other on each side."""
    best, table = -1.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        for cut in range(1, len(g)):
            value, gain = np.empty_like(g), 0.0
            for part in (slice(0, cut), slice(cut, None)):
                leaf = _tree(g[part].sum(axis=0), w[part].sum(axis=0), 2)
                value[part] = leaf
                gain += (leaf * g[part].sum(axis=0)).sum()
            if gain > best:
                best, table = gain, value.T.copy() if turned else value
    return table


@dataclass
class AdditiveModel:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]
    start: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        small = {j: np.searchsorted(self.coarse[j], x[:, j], "right") for pair in self.pairs for j in pair}
        for (a, b), grid in zip(self.pairs, self.grids):
            out += grid[small[a], small[b]]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.logits(features(texts)), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, options: Options = Options()) -> AdditiveModel:
    """The model for a feature matrix and labels 0 and 1; without rows or with one label only, a constant."""
    cut = lambda column, n: np.unique(np.quantile(column, np.linspace(0, 1, n + 1)[1:-1]))
    width = x.shape[1]
    edges = [cut(x[:, j], options.bins) if len(x) else np.zeros(0) for j in range(width)]
    coarse = [cut(x[:, j], options.pair_bins) if len(x) else np.zeros(0) for j in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    rate = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(edges, coarse, tables, [], [], float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return model
    binned = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    small = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    logit = np.full(len(y), model.start)

    def residual():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(options.rounds):
        for j, table in enumerate(tables):
            g, h = residual()
            step = options.rate * _tree(np.bincount(binned[j], g, len(table)), np.bincount(binned[j], h, len(table)), 4)
            table += step
            logit += step[binned[j]]

    def grid(values, a, b):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(small[a] * shape[1] + small[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = residual()
    gain = {(a, b): (grid(g, a, b) ** 2 / (grid(h, a, b) + 1)).sum() for a, b in combinations(range(width), 2)}
    model.pairs = sorted(gain, key=lambda p: (-gain[p], p))[: options.pairs]
    model.grids = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(options.rounds // 3):
        for (a, b), table in zip(model.pairs, model.grids):
            g, h = residual()
            step = options.rate * _pair_tree(grid(g, a, b), grid(h, a, b))
            table += step
            logit += step[small[a], small[b]]
    return model


def quality_model(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, options: Options = Options(),
    id_col: str = "doc_id", text_col: str = "text",
) -> AdditiveModel:
    """A model from at most ``options.sample`` labelled rows whose id hash isn't in the held-out fold.

    Rows with a null id or a label other than 0 and 1 are not learned from; without rows, or with one label alone, the
    model scores every text alike. Sampled texts are measured whole, in the executors.
    """
    rows = training_sample(docs, labels, "quality", folds, held_out, options.sample, id_col, text_col)

    def measured(batches):
        for batch in batches:
            x = features([t or "" for t in batch.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([lists, batch.column("label")], names=["x", "label"])

    found = rows.mapInArrow(measured, "x array<double>, label int").collect()
    found = sorted((tuple(r.x), r.label) for r in found)  # the same model whatever the partitions
    x = np.array([r[0] for r in found]).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r[1] for r in found], np.float64), options)


def scored(docs: DataFrame, model: AdditiveModel, text_col: str = "text") -> DataFrame:
    """docs with a column ``score`` between 0 and 1, higher where quality 1 is likelier.

    Whole texts are measured; null counts as empty; equal texts score alike; other columns pass through, one
    named score is replaced; an empty table gives no rows.
    """
    return with_scores(docs, model.scores, text_col)
