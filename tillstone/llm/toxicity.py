"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as the vector of its own form, if the training rows had it
often, beside the mean vector of its character trigrams and three fixed
numbers: how much its form and its strings of five characters told of the
label in the training rows. A training row's own count is left out of the
numbers that it is shown, else they would seem better than they are. Every
text is cut into windows that overlap by half; the network reads each in both directions,
attention weighs its places, and the window that looks worst is the document's
score. Training picks, again and again, each labelled document's worst window
as its example.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import in_fold, numbered_columns
from tillstone.llm.learning import brought_within, labelled_rows, with_scores

WORD = re.compile(r"[^\W_]+")
GRAMS = 4096
CHARS = 1 << 18  # buckets of five-character strings
FIXED = 3
WIDTH = 6  # of a word vector, of a trigram vector and of the state in each direction


@dataclass(frozen=True)
class Options:
    window: int = 32
    stride: int = 16
    vocabulary: int = 4000
    sample: int = 4000
    letters: int = 20_000_000  # of the sampled texts together
    rounds: int = 4
    passes: int = 3
    rate: float = 0.02
    seed: int = 1


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _grams(words: list[str], size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed strings of ``size`` bytes of the words, each between marks, and the index of each word's first."""
    coded = [(b"\x02" + w.encode() + b"\x03").ljust(size, b"\x03") for w in words]
    data = np.frombuffer(b"".join(coded) + bytes(size), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    hashed = np.zeros(len(data) - size, np.uint64)
    for k in range(size):
        hashed = (hashed * np.uint64(1000003)) ^ data[k : k + len(hashed)]
    hashed = (hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    n = sizes - size + 1
    at = np.arange(n.sum()) + np.repeat((np.cumsum(sizes) - sizes) - (np.cumsum(n) - n), n)
    return (hashed[at] % np.uint64(buckets)).astype(np.int64), np.cumsum(n) - n


class Evidence:
    """How often labelled rows of each kind have a word or a five-character string."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.words, self.chars = {0: Counter(), 1: Counter()}, np.zeros((2, CHARS), np.float32)
        self.rows = np.bincount(np.asarray(labels, np.int64), minlength=2)
        for text, label in zip(texts, labels):
            words = sorted(set(WORD.findall(text.lower())))  # the order of a set differs between processes
            self.words[int(label)].update(words)
            if words:
                self.chars[int(label), np.unique(_grams(words, 5, CHARS)[0])] += 1

    def odds(self, one, zero, without: int | None, prior: float = 5.0):
        """Log odds of label 1 given so many rows, beyond those of any row; ``without`` one row of a label."""
        rate = (self.rows[1] + 1) / (self.rows.sum() + 2)
        one = np.maximum(one - (without == 1), 0) + prior * rate
        zero = np.maximum(zero - (without == 0), 0) + prior * (1 - rate)
        return np.log(one / zero) - np.log(rate / (1 - rate))

    def table(self, without: int | None = None) -> np.ndarray:
        return self.odds(self.chars[1], self.chars[0], without).astype(np.float32)

    def of_words(self, words: list[str], without: int | None = None) -> np.ndarray:
        count = lambda label: np.fromiter((self.words[label][w] for w in words), np.float64, len(words))
        return self.odds(count(1), count(0), without).astype(np.float32)


def _fixed(words: list[str], told: np.ndarray, table: np.ndarray) -> np.ndarray:
    grams, first = _grams(words, 5, CHARS)
    value = table[grams]
    mean = np.add.reduceat(value, first) / np.diff(np.append(first, len(grams)))
    return np.stack([told, np.maximum.reduceat(value, first), mean], axis=1).astype(np.float32)


class Network:
    """Weights, forward and backward passes. A state runs over time; both directions share no weights."""

    def __init__(self, vocabulary: list[str], told: np.ndarray, table: np.ndarray, options: Options):
        self.told, self.table = np.append(np.float32(0), told).astype(np.float32), table
        rng, d = np.random.default_rng(options.seed), WIDTH
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.options, self.index = options, {w: i + 1 for i, w in enumerate(vocabulary)}
        self.w = {"word": draw(len(vocabulary) + 1, d) * 0.3, "gram": draw(GRAMS, d) * 0.3}
        for way in "fb":
            self.w |= {f"in_{way}": draw(2 * d + FIXED, 3 * d), f"rec_{way}": draw(d, 3 * d), f"bias_{way}": np.zeros(3 * d, np.float32)}
        self.w |= {"att": draw(2 * d, d), "att_v": draw(d), "out": draw(2 * d), "out_b": np.full(1, -2, np.float32)}

    def encode(self, texts: list[str]):
        """Distinct words of all texts, each text's word numbers in one array, and the numbers of words.

        Words are numbered as they first appear. Of repeated words only the numbers are held.
        """
        seen, codes = defaultdict(count().__next__), []
        for text in texts:
            codes.append(np.fromiter((seen[m.group()] for m in WORD.finditer(text.lower())), np.int64))
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        return list(seen), np.concatenate([*codes, np.zeros(0, np.int64)]), sizes

    def windows(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (-1 beyond the end) of every window, and each window's text. A text without words has one."""
        o = self.options
        n = np.maximum(0, -(-(sizes - o.window) // o.stride)) + 1
        owner = np.repeat(np.arange(len(sizes)), n)
        turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = turn[:, None] * o.stride + np.arange(o.window)
        inside = place < sizes[owner][:, None]
        at = np.where(inside, place + (np.cumsum(sizes) - sizes)[owner][:, None], 0)
        return np.where(inside, codes[at] if len(codes) else -1, -1), owner

    def fixed(self, distinct: list[str]) -> np.ndarray:
        ids = np.fromiter((self.index.get(w, 0) for w in distinct), np.int64, len(distinct))
        return _fixed(distinct, self.told[ids], self.table) if distinct else np.zeros((0, FIXED), np.float32)

    def inputs(self, distinct: list[str], fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Input vector of each distinct word and, at the end, of no word; and where its parts come from."""
        ids = np.fromiter((self.index.get(w, 0) for w in distinct), np.int64, len(distinct))
        nothing = np.zeros((1, 2 * WIDTH + FIXED), np.float32)
        if not distinct:
            return nothing, ids, (ids, ids, ids)
        grams, first = _grams(distinct, 3, GRAMS)
        count = np.diff(np.append(first, len(grams)))
        chars = np.add.reduceat(self.w["gram"][grams], first, axis=0) / count[:, None].astype(np.float32)
        return np.concatenate([np.concatenate([self.w["word"][ids], chars, fixed], axis=1), nothing]), ids, (grams, first, count)

    def run(self, x: np.ndarray, codes: np.ndarray, keep: bool = False):
        """Logit of each window; with ``keep``, what the backward pass needs."""
        d, steps = WIDTH, codes.shape[1]
        states, memory = {}, {}
        for way in "fb":
            projected = x @ self.w[f"in_{way}"] + self.w[f"bias_{way}"]
            h, rec = np.zeros((len(codes), d), np.float32), self.w[f"rec_{way}"]
            out = np.empty((steps, len(codes), d), np.float32)
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                p, u = projected[codes[:, t]], h @ rec
                gates = _sigmoid(p[:, : 2 * d] + u[:, : 2 * d])
                z, r = gates[:, :d], gates[:, d:]
                n = np.tanh(p[:, 2 * d :] + r * u[:, 2 * d :])
                if keep:
                    memory[way, t] = (h, z, r, n, u[:, 2 * d :])
                h = n + z * (h - n)
                out[t] = h
            states[way] = out
        both = np.concatenate([states["f"], states["b"]], axis=2)
        hidden = np.tanh(both @ self.w["att"])
        energy = np.where((codes >= 0).T, hidden @ self.w["att_v"], -1e4)
        energy = np.exp(energy - energy.max(axis=0))
        share = energy / energy.sum(axis=0)
        pooled = np.einsum("tn,tnd->nd", share, both)
        logit = pooled @ self.w["out"] + self.w["out_b"][0]
        return (logit, (both, hidden, share, pooled, memory)) if keep else logit

    def gradients(self, distinct, fixed, codes, labels):
        """Gradient of the mean logistic loss over windows."""
        d, (x, ids, (grams, first, count)) = WIDTH, self.inputs(distinct, fixed)
        logit, (both, hidden, share, pooled, memory) = self.run(x, codes, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        dl = ((_sigmoid(logit) - labels) / len(labels)).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ dl, dl.sum(keepdims=True)
        dp = dl[:, None] * self.w["out"]
        ds = np.einsum("nd,tnd->tn", dp, both)
        de = share * (ds - (share * ds).sum(axis=0))
        da = de[:, :, None] * self.w["att_v"] * (1 - hidden**2)
        g["att_v"] = np.einsum("tn,tnd->d", de, hidden)
        g["att"] = np.einsum("tni,tnj->ij", both, da)
        dboth = share[:, :, None] * dp + da @ self.w["att"].T
        dx = np.zeros_like(x)
        for k, way in enumerate("fb"):
            rec, dproj = self.w[f"rec_{way}"], np.zeros((len(x), 3 * d), np.float32)
            dh = np.zeros((len(codes), d), np.float32)
            steps = range(codes.shape[1])
            for t in reversed(steps) if way == "f" else steps:
                before, z, r, n, un = memory[way, t]
                dh = dh + dboth[t][:, k * d : (k + 1) * d]
                dn = dh * (1 - z) * (1 - n**2)
                dz = dh * (before - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                dgate = np.concatenate([dz, dr, dn], axis=1)
                drec = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"rec_{way}"] += before.T @ drec
                g[f"bias_{way}"] += dgate.sum(axis=0)
                np.add.at(dproj, codes[:, t], dgate)
                dh = dh * z + drec @ rec.T
            g[f"in_{way}"] = x.T @ dproj
            dx += dproj @ self.w[f"in_{way}"].T
        if distinct:
            np.add.at(g["word"], ids, dx[:-1, :d])
            np.add.at(g["gram"], grams, np.repeat(dx[:-1, d : 2 * d] / count[:, None], count, axis=0))
        return g

    def scores(self, texts: list[str], block: int = 4096) -> np.ndarray:
        """Probability for each text, from the worst of all its windows."""
        out = np.full(len(texts), -np.inf)
        step = 256  # texts whose words are looked up together
        for a in range(0, len(texts), step):
            distinct, codes, sizes = self.encode(texts[a : a + step])
            x = self.inputs(distinct, self.fixed(distinct))[0]
            windows, owner = self.windows(codes, sizes)
            logits = np.concatenate([self.run(x, windows[i : i + block]) for i in range(0, len(windows), block)])
            np.maximum.at(out, a + owner, logits)
        return _sigmoid(out)


def train(texts: list[str], labels: list[int], options: Options = Options()) -> Network:
    """A network fitted to labelled texts; without both labels, one that scores every text low."""
    y = np.asarray(labels, np.float32)
    evidence = Evidence(texts, labels)
    many = (evidence.words[0] + evidence.words[1]).most_common(options.vocabulary)
    vocabulary = [w for w, c in many if c >= 5]
    net = Network(vocabulary, evidence.of_words(vocabulary), evidence.table(), options)
    if len(set(labels)) < 2:
        net.w["out"][:], net.w["out_b"][:] = 0, -6
        return net
    rng = np.random.default_rng(options.seed)
    known, distinct, fixed = set(vocabulary), [], []
    sizes, codes_of = np.zeros(len(texts), np.int64), {}
    for label in (0, 1):  # the same word is another input in a row of the other label
        rows = [i for i, v in enumerate(labels) if v == label]
        words, numbers, n = net.encode([texts[i] for i in rows])
        sizes[rows] = n
        codes_of |= dict(zip(rows, np.split(numbers + len(distinct), np.cumsum(n)[:-1])))
        told = evidence.of_words(words, without=label) * np.fromiter((w in known for w in words), bool, len(words))
        if words:
            fixed.append(_fixed(words, told, evidence.table(without=label)))
        distinct += words
    codes = np.concatenate([codes_of[i] for i in range(len(texts))])
    fixed = np.concatenate([*fixed, np.zeros((0, FIXED), np.float32)])
    windows, owner = net.windows(codes, sizes)
    telling = np.append(fixed.max(axis=1), -9.0) if len(fixed) else np.array([-9.0])
    worth = telling[windows].max(axis=1)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items()}
    step = 0
    for turn in range(options.rounds):
        if turn:
            x = net.inputs(distinct, fixed)[0]
            worth = np.concatenate([net.run(x, windows[i : i + 4096]) for i in range(0, len(windows), 4096)])
        order = np.lexsort((worth, owner))
        worst = order[np.append(np.flatnonzero(np.diff(owner[order])), len(order) - 1)]
        other = rng.integers(0, len(windows), len(worst))
        picked = np.concatenate([worst, other[y[owner[other]] == 0]])
        for _ in range(options.passes):
            for part in np.array_split(rng.permutation(picked), max(1, len(picked) // 64)):
                used, local = np.unique(windows[part], return_inverse=True)
                local = local.reshape(windows[part].shape) - int(used[0] == -1)
                words = [distinct[i] for i in used if i >= 0]
                g, step = net.gradients(words, fixed[used[used >= 0]], local, y[owner[part]]), step + 1
                for k, v in net.w.items():
                    m, s = moment[k]
                    m += 0.1 * (g[k] - m)
                    s += 0.001 * (g[k] ** 2 - s)
                    v -= options.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def toxicity_model(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, options: Options = Options(),
    id_col: str = "doc_id", text_col: str = "text",
) -> Network:
    """A network from at most ``options.sample`` labelled rows whose id hash isn't in the held-out fold.

    Rows with a null id or a label other than 0 and 1 are not learned from; without both labels every text scores low.
    The sampled texts come to the driver whole, at most ``options.letters`` characters of them: a text beyond what the
    ones before it in order of hash have left is not learned from.
    """
    rows = labelled_rows(docs, labels, "toxic", folds, held_out, options.sample, id_col, text_col)
    rows = sorted((r.text, r.label) for r in brought_within(rows, options.sample, options.letters))
    model = train([t for t, _ in rows], [y for _, y in rows], options)
    # the sample holds both labels alike; move the scores to the share that all labelled rows have
    usable = labels.filter(F.col("toxic").isin(0, 1) & ~in_fold(id_col, folds, held_out))
    share = usable.agg(F.mean("toxic")).first()[0]
    own = sum(y for _, y in rows) / max(1, len(rows))
    if share and 0 < share < 1 and 0 < own < 1:
        model.w["out_b"] += np.float32(np.log(share / (1 - share)) - np.log(own / (1 - own)))
    return model


def scored(docs: DataFrame, model: Network, text_col: str = "text") -> DataFrame:
    """docs with a column ``score`` between 0 and 1, from whole texts.

    Null and empty texts are scored as texts without words; equal texts score alike wherever they stand; other
    columns pass through, one named score is replaced; an empty table gives no rows.
    """
    return with_scores(docs, model.scores, text_col)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns as they were, whatever these are called."""
    model = toxicity_model(docs, labels)
    docs, text_col, named = numbered_columns(docs, "text")
    return scored(docs, model, text_col).filter(F.col("score") < threshold).select(*named)
