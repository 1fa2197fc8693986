"""Personal data by fixed patterns and a semi-Markov conditional random field.

The field segments the stretches of a text that hold digits or an at sign:
every token is plain or lies in one segment with a kind. Features look at
whole spans, such as shape, digit count, check digit or the word before, and
dynamic programming over segments of bounded length finds the best boundaries
and kinds at once. It is trained by its likelihood on segmentations that the
fixed patterns give for a bounded sample of documents, and adds the spans that
look alike but that no pattern covers.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import defaultdict, deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.common import Scratch, parts

# Kinds in order of listing and the parts of their patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# A stretch is a run of white-space separated parts that each hold a digit or an at sign, with the word before it.
_STRETCH = re.compile(r"(?:(?<!\S)[^\s0-9@]++[ ])?(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:[ ][^\s0-9@]*+[0-9@]\S*+)*+")
_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|\s|.", re.S)
LONGEST = 24  # tokens of a segment
PIECE = 400  # characters that a piece of a stretch holds in training


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind, without failing ones."""
    out, at = [], text.find("@")
    taken = 0
    while at >= 0:
        start = at
        while start > taken and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            taken = found.end()
            out.append((start, 0, taken))
        at = text.find("@", max(at + 1, taken))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _shape(text: str) -> str:
    return re.sub("9+", "9", re.sub("a+", "a", re.sub(r"[0-9]", "9", re.sub(r"[^\W0-9_]", "a", text))))


def _bucket(n: int) -> int:
    return n if n < 4 else 4 + (n - 4) // 3 if n < 20 else 10


def span_features(text: str, start: int, end: int, before: str) -> tuple[str, ...]:
    """What a whole span shows, whatever its kind."""
    span = text[start:end]
    digits, shape = _digits(span), _shape(span)
    separators = "".join(sorted(set(re.sub(r"[\w]", "", span))))
    out = [
        "s:" + shape[:24], "d:" + str(_bucket(len(digits))), "p:" + separators[:6], "f:" + shape[:2], "l:" + shape[-2:],
        "b:" + before, "c:" + text[max(0, start - 1) : start], "n:" + text[end : end + 1],
    ]
    if "@" in span:
        left, _, right = span.partition("@")
        out.append(f"at:{bool(left)}{'.' in right}{'@' in right}")
    if 12 <= len(digits) <= 19:
        out.append(f"luhn:{luhn(digits)}{bool(re.search('[A-Za-z]', span))}")
    parts = span.split(".")
    if len(parts) == 4:
        out.append(f"ip:{all(p.isascii() and p.isdigit() and len(p) < 5 and int(p) < 256 for p in parts)}")
    return tuple(out)


def _plain(piece: str) -> str:
    """What a token shows by itself."""
    return f"{_shape(piece)}{min(len(piece), 5) if piece.isdigit() else ''}"


def _ending(text: str, recent: deque, end: int) -> list[tuple[float, tuple[str, ...], int]]:
    """Segments that end with the last of the recent tokens, longest first: the value before, features, tokens."""
    found, digits, at = [], 0, 0
    for n, (place, piece, count, before, value) in enumerate(reversed(recent)):
        digits += count
        at += piece == "@"
        if (at or digits >= 7 or (digits >= 4 and n >= 6)) and not (piece.isspace() or piece in ".,;:"):
            found.append((value, span_features(text, place, end, before), n + 1))
    return found[::-1]


@dataclass
class Lattice:
    """Possible segments of one stretch: (first token, last token + 1, features); and its token bounds."""

    bounds: list[int]
    plain: list[str]
    segments: dict[int, list[tuple[int, tuple[str, ...]]]] = field(default_factory=dict)


def lattice(text: str, start: int, end: int) -> Lattice:
    tokens = list(_TOKEN.finditer(text, start, end))
    bounds = [m.start() for m in tokens] + [end]
    out = Lattice(bounds, [_plain(m[0]) for m in tokens])
    word = ""
    befores = []
    for m in tokens:
        befores.append(word)
        if m[0].isalpha():
            word = m[0].lower()[:12]
    for i, m in enumerate(tokens):
        if m[0].isspace() or m[0] in ".,;:":
            continue
        digits = at = 0
        for j in range(i, min(i + LONGEST, len(tokens))):
            piece = tokens[j][0]
            digits += len(piece) if piece.isdigit() else 0
            at += piece == "@"
            if piece.isalnum() and (at or digits >= 7 or (digits >= 4 and j - i >= 6)):
                out.segments.setdefault(j + 1, []).append((i, span_features(text, bounds[i], bounds[j + 1], befores[i])))
    return out


class SemiMarkov:
    """Weights by (kind, feature), kind -1 for a plain token; scores of segmentations are their sums."""

    def __init__(self, weights: dict | None = None):
        self.w = defaultdict(float, weights or {})

    def score(self, kind: int, features: tuple[str, ...]) -> float:
        w = self.w
        return w.get((kind, ""), 0.0) + sum(w.get((kind, f), 0.0) for f in features)

    def best(self, net: Lattice) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the segments of the best segmentation."""
        n = len(net.plain)
        top, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1] + self.score(-1, (net.plain[j - 1],))
            for i, features in net.segments.get(j, ()):
                for kind in range(len(KINDS)):
                    value = top[i] + self.score(kind, features)
                    if value > top[j]:
                        top[j], back[j] = value, (i, kind)
        out, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((net.bounds[i], kind, net.bounds[j]))
                j = i
        return out[::-1]

    def gradient(self, net: Lattice, gold: set[tuple[int, int, int]]) -> dict:
        """Of the log likelihood of a segmentation: its features less the expected ones, by forward and backward sums."""
        n, count = len(net.plain), len(KINDS)
        plain = np.array([self.score(-1, (p,)) for p in net.plain])
        arcs = [(i, j, k, f, self.score(k, f)) for j, ends in net.segments.items() for i, f in ends for k in range(count)]
        into, out = defaultdict(list), defaultdict(list)
        for arc in arcs:
            into[arc[1]].append(arc)
            out[arc[0]].append(arc)
        ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce([ahead[j - 1] + plain[j - 1], *(ahead[a[0]] + a[4] for a in into[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1] + plain[i], *(behind[a[1]] + a[4] for a in out[i])])
        total, g, covered = ahead[n], defaultdict(float), set()
        for i, j, kind, features, value in arcs:
            true = (i, j, kind) in gold
            if true:
                covered.update(range(i, j))
            change = true - float(np.exp(ahead[i] + value + behind[j] - total))
            if abs(change) > 1e-4:
                for f in ("", *features):
                    g[kind, f] += change
        for i, p in enumerate(net.plain):
            change = (i not in covered) - float(np.exp(ahead[i] + plain[i] + behind[i + 1] - total))
            if abs(change) > 1e-4:
                g[-1, p] += change
                g[-1, ""] += change
        return g

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        found = []
        for m in _STRETCH.finditer(text):
            if "@" in m[0] or sum(c.isdigit() for c in m[0]) >= 4:
                found += self.decoded(text, m.start(), m.end())
        return found

    def decoded(self, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
        """``best`` of a stretch's lattice without the lattice: only the last LONGEST tokens are held at a time.

        What is kept of the others is their place and the way back, some twenty bytes a token.
        """
        bounds, origin, kinds = array("q"), array("b", [0]), array("b", [-1])
        recent = deque(maxlen=LONGEST)  # place, piece, digits, word before, best value before it
        value, word = 0.0, ""
        for m in _TOKEN.finditer(text, start, end):
            piece = m[0]
            bounds.append(m.start())
            recent.append((m.start(), piece, len(piece) if piece.isdigit() else 0, word, value))
            if piece.isalpha():
                word = piece.lower()[:12]
            value += self.score(-1, (_plain(piece),))
            kind, length = -1, 0
            if piece.isalnum():
                for at, features, n in _ending(text, recent, m.end()):
                    for k in range(len(KINDS)):
                        other = at + self.score(k, features)
                        if other > value:
                            value, kind, length = other, k, n
            origin.append(length)
            kinds.append(kind)
        out, j = [], len(bounds)
        bounds.append(end)
        while j:
            if kinds[j] < 0:
                j -= 1
            else:
                i = j - origin[j]
                out.append((bounds[i], kinds[j], bounds[j]))
                j = i
        return out[::-1]


def _gold(net: Lattice, spans: list[tuple[int, int, int]]) -> set[tuple[int, int, int]]:
    """Pattern spans as segments of a lattice; where they overlap, the longest."""
    place = {b: i for i, b in enumerate(net.bounds)}
    out, used = set(), set()
    for start, kind, end in sorted(spans, key=lambda s: (s[0] - s[2], s[1])):
        i, j = place.get(start), place.get(end)
        if i is None or j is None or used & set(range(i, j)) or not any(a == i for a, _ in net.segments.get(j, ())):
            continue
        used |= set(range(i, j))
        out.add((i, j, kind))
    return out


def _pieces(text: str, start: int, end: int, spans: list[tuple[int, int, int]]):
    """A stretch as (start, end) of pieces that begin at a token, not inside a span, and hold about PIECE characters."""
    for m in _TOKEN.finditer(text, start, end):
        at = m.start()
        if at - start >= PIECE and not any(s < at < e for s, _, e in spans):
            yield start, at
            start = at
    yield start, end


def train(
    texts: list[str], stretches: int | None = None, passes: int = 4, rate: float = 0.3, decay: float = 0.01
) -> SemiMarkov:
    """A field fitted to the pattern segmentations of the texts: of all their distinct stretches, or the first ``stretches``.

    Long stretches are learned from in pieces. A lattice is built anew in each pass, so that only one is held.
    """
    examples, seen = [], set()
    for text in texts:
        spans = base_spans(text)
        for m in _STRETCH.finditer(text):
            if m[0] in seen:
                continue
            seen.add(m[0])
            own = spans[bisect_left(spans, (m.start(),)) : bisect_left(spans, (m.end(),))]
            for a, b in _pieces(text, m.start(), m.end(), own):
                if lattice(text, a, b).segments:
                    examples.append((text, a, b, own))
    examples = examples[:stretches]
    model = SemiMarkov()
    rng, squares = np.random.default_rng(3), defaultdict(float)
    for _ in range(passes):
        for k in rng.permutation(len(examples)):
            text, a, b, spans = examples[k]
            net = lattice(text, a, b)
            for name, change in model.gradient(net, _gold(net, spans)).items():
                change -= decay * model.w[name]
                squares[name] += change * change
                model.w[name] += rate * change / (squares[name] ** 0.5 + 1e-6)
    return SemiMarkov(dict(model.w))


def pii_model(
    docs: DataFrame, sample: int = 2_000, id_col: str = "doc_id", text_col: str = "text", stretches: int | None = None,
    letters: int = 20_000_000,
) -> SemiMarkov:
    """A field from at most ``sample`` documents with a digit or an at sign: those with the least hash of id and text.

    It learns from all stretches of these, or from the first ``stretches``. At most ``letters`` characters come to the
    driver: a document whose stretches go beyond what the ones before it in order of hash have left is not learned from.
    """
    marked = docs.filter(F.col(text_col).rlike("[0-9@]")).withColumn("_h", F.xxhash64(id_col, text_col))
    last = marked.select("_h").orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    # only the stretches and a little before them come to the driver, in runs of at most 12 parts
    near = F.regexp_extract_all(text_col, F.lit(r"(?:\S+\s)?\S*[0-9@]\S*(?: \S*[0-9@]\S*){0,11}"), F.lit(0))
    some = marked.filter(F.col("_h") <= last) if last is not None else marked.limit(0)
    scratch = Scratch(docs.sparkSession, "field")
    stored = scratch.store(some.select(F.col("_h").alias("h"), F.concat_ws("\n", near).alias("text")).distinct(), "rows")
    beyond = []
    for h, n in sorted(stored.select("h", F.length("text")).collect()):
        if n <= letters:
            letters -= n
        else:
            beyond.append(h)
    rows = stored.filter(~F.col("h").isin(beyond)).collect()
    scratch.drop("rows")
    return train([r.text for r in sorted(rows, key=lambda r: (r.h, r.text))], stretches)


def _covered(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover, in order and apart from each other."""
    starts, ends = [], []
    for s, _, e in sorted(spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def personal_data(docs: DataFrame, model: SemiMarkov, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id and ``spans``, an array of (start, kind, end, base) in code points.

    Spans of the fixed patterns have ``base`` true and all stay; the field's spans are added where they overlap
    none of these. Null text has no spans, null and repeated ids are kept row by row, an empty table gives no
    rows, and other columns are not read. A text of any length is scored whole; beside the text itself some twenty
    bytes for each token of its longest stretch are held.
    """
    weights = dict(model.w)
    kind = docs.schema[id_col].dataType

    def run(batches):
        field_ = SemiMarkov(weights)
        for batch in parts(batches):
            out = []
            for text in batch.column(text_col).to_pylist():
                text = text or ""
                base = base_spans(text)
                spans = [{"start": s, "kind": k, "end": e, "base": True} for s, k, e in base]
                starts, ends = _covered(base)
                for s, k, e in field_.spans(text):
                    i = bisect_left(starts, e)  # of the stretches that begin before e the last one ends last
                    if not i or ends[i - 1] <= s:
                        spans.append({"start": s, "kind": k, "end": e, "base": False})
                out.append(sorted(spans, key=lambda x: (x["start"], x["kind"], x["end"])))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(out, arrow)], names=[id_col, "spans"])

    arrow = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_())]))
    spans = T.ArrayType(T._parse_datatype_string("start long, kind int, end long, base boolean"))
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("spans", spans)])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def written(spans):
    """kind:start:end of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
