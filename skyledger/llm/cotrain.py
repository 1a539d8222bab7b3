"""Quality classifier by co-training.

Two views of a document, its text content and its metadata (source, language, length), each get a logistic classifier. First
both are fitted to labelled documents. Then, over ROUNDS rounds, each view scores all other documents, and those it is surest
of, a share of all that grows with the rounds, become pseudo-labels for the other view. At last both are calibrated on labelled
documents that neither learned from, and all documents are scored by the sum of the calibrated log-odds. Within the rounds the
same calibration says how sure a view is, so one that knows nothing teaches nothing.

The labelled sample is bounded: at most ``max_labelled`` documents (MAX_LABELLED by default), chosen by a hash of the id, a row
each. Nothing else is: every round reads all rows. Thresholds come from histograms of all scores, and weights move by Newton
steps whose gradients and curvatures are summed in the tasks, a matrix of the view's size each, and then by Spark; so what
meets on the driver does not depend on the number of rows. The pseudo-labelled rows weigh as much as the labelled ones, however
many they are. Features are formed once and stored.

Null texts and metadata have features of their own and are scored like others. Without two classes of labels every score
is the share of positive labels (0.5 without labels). Repeated rows are scored each, and count each as others; labels of one id
are averaged, and one of its rows is learned from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import slices, stored

MAX_LABELLED = 8_000
#: Rounds; share of all other documents that a view labels in the first one; least probability for that; Newton steps a round.
ROUNDS, SHARE, SURE, STEPS = 3, 0.05, 0.8, 2
#: Bins of the histograms of log-odds, over -SPAN to SPAN.
BINS, SPAN = 4000, 40.0
HASHED, META_HASHED = 192, 64
BLOCK_ROWS = 512
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>!]")


def content_features(text: str | None) -> np.ndarray:
    """Rates of symbols, capitals, digits and repetitions, and shares of hashed word ends, over the whole text."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 1 - len(set(words)) / n
    upper = sum(map(str.isupper, words)) / n
    out = np.zeros(10 + HASHED, np.float32)
    out[:10] = (
        1.0, np.log1p(len(words)) / 10, sum(map(len, words)) / n / 10, len(_SYMBOLS.findall(text)) / n, upper, sum(map(str.isdigit, text)) / chars * 10,
        repeated, 1 - len(set(lines)) / max(1, len(lines)), sum(x.endswith((".", ".\r")) for x in lines) / max(1, len(lines)), np.log1p(max(map(len, words), default=0)) / 5,
    )
    count: dict[str, int] = {}
    for w in words:
        count[w[-2:]] = count.get(w[-2:], 0) + 1
    for end, k in count.items():
        out[10 + zlib.crc32(end.encode("utf-8", "surrogatepass")) % HASHED] += k / n * 5
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed source, language and both together, and the length."""
    out = np.zeros(3 + META_HASHED, np.float32)
    out[:3] = 1.0, np.log1p(max(0, n_chars or 0)) / 10, n_chars is None
    for value in (f"s {source}", f"l {lang}", f"{source} {lang}", f"length {int(np.log2(max(1, n_chars or 1)))}"):
        out[3 + zlib.crc32(value.encode("utf-8", "surrogatepass")) % META_HASHED] += 1
    return out


def chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def slope(x: np.ndarray, y: np.ndarray, weight: np.ndarray | float, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log-likelihood of labels y (0 to 1) at the weights w."""
    p = chance(x @ w)
    return x.T @ (weight * (y - p)), x.T @ (x * (weight * p * (1 - p) + 1e-9)[:, None])


def step(w: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """The weights after a Newton step, no longer than 4."""
    move = np.linalg.solve(curvature + ridge * np.eye(len(w)), gradient - ridge * w)
    return w + move * min(1.0, 4.0 / max(1e-12, float(np.linalg.norm(move))))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        before, w = w, step(w, *slope(x, y, 1.0, w), ridge)
        if np.abs(w - before).max() < 1e-6:
            break
    return w


class Model:
    """Weights of both views, and scale and offset of their calibrated log-odds."""

    def __init__(self, weights: list[np.ndarray], scales: list[tuple[float, float]], prior: float):
        self.weights, self.scales, self.prior = weights, scales, prior

    def views(self, content: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        return [a * (x @ w) + b for x, w, (a, b) in zip((content, meta), self.weights, self.scales)]

    def score(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by content, by metadata, and by both; the prior, which both hold, counts once."""
        if not self.weights:
            flat = np.full(len(content), self.prior)
            return flat, flat, flat
        a, b = self.views(content, meta)
        return chance(a), chance(b), chance(a + b - np.log(self.prior / (1 - self.prior)))


def edges(counts: np.ndarray, round_: int, prior: float, share: float = SHARE) -> tuple[float, float]:
    """The log-odds from which and up to which a view's labels are taken, of the histogram of its log-odds over all other rows:
    those it is surest of, in proportion to the classes, that have a probability of at least SURE and that much more evidence than
    the share of the class gives anyway. Equal rows are taken together, the first ones even
    if they are more than that share."""
    if not counts.any():
        return SPAN, -SPAN
    most, at = share * round_ * counts.sum(), np.linspace(-SPAN, SPAN, BINS + 1)
    sure, full = float(np.log(SURE / (1 - SURE))), np.flatnonzero(counts)
    from_top, from_below = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    top, below = np.flatnonzero(from_top <= most * prior), np.flatnonzero(from_below <= most * (1 - prior))
    high = min(full[-1], top[0] if len(top) else BINS)
    low = max(full[0], below[-1] if len(below) else -1)
    given = float(np.log(prior / (1 - prior)))
    return max(sure + max(0.0, given), float(at[high])), min(-sure + min(0.0, given), float(at[low + 1]))


def bins_of(z: np.ndarray) -> np.ndarray:
    return np.clip(((z + SPAN) * (BINS / (2 * SPAN))).astype(np.int64), 0, BINS - 1)


def taught(z: np.ndarray, high: float, low: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows a view labels, and the labels of these."""
    which = np.flatnonzero((z >= high) | (z <= low))
    return which, (z[which] >= high).astype(np.float64)


def calibration(z: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and offset by which log-odds fit labels that they were not learned from. A few labels never make a view quite sure
    (each class counts a label of the other), and a view that does not tell the classes apart is never sure at all."""
    ones = label.sum()
    target = label * (ones + 1) / (ones + 2) + (1 - label) / (len(label) - ones + 2)
    scale, offset = fit(np.column_stack([z, np.ones(len(z))]), target, ridge=1e-3)
    if scale > 0:
        return float(scale), float(offset)
    return 0.0, float(fit(np.ones((len(z), 1)), target, ridge=1e-3)[0])


def _matrix(column: pa.Array) -> np.ndarray:
    held = column.to_pylist()
    return np.frombuffer(b"".join(held), np.float32).reshape(len(held), -1).astype(np.float64)


def featured(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """id and the features of both views, as single-precision numbers, of every row of (doc, text, source, lang, n_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_ROWS):
            number, text, source, lang, n = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array([content_features(t).tobytes() for t in text], pa.binary()), pa.array([meta_features(*m).tobytes() for m in zip(source, lang, n)], pa.binary())],
                names=["id", "content", "meta"],
            )

    rows = docs.select(F.col(doc).cast("long").alias("id"), F.col("text").cast("string"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"))
    return rows.mapInArrow(run, "id long, content binary, meta binary")


def others(features: DataFrame, known: np.ndarray, work, schema: str) -> DataFrame:
    """Runs ``work(content, meta)`` over blocks of the rows that are not labelled; it yields arrays of the columns of ``schema``
    at the end of the task, from what it has kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = work()
        for batch in slices(batches, 4096):
            free = np.flatnonzero(~np.isin(np.nan_to_num(batch.column(0).to_numpy(zero_copy_only=False), nan=-1).astype(np.int64), known) | np.asarray(batch.column(0).is_null()))
            if len(free):
                part = batch.take(pa.array(free))
                held.add(_matrix(part.column(1)), _matrix(part.column(2)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.sums()], names=["at", "v"])

    return features.mapInArrow(run, schema)


class Histograms:
    """Counts of the log-odds of both views."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights, self.counts = weights, np.zeros((2, BINS), np.int64)

    def add(self, *views: np.ndarray) -> None:
        for k, (x, w) in enumerate(zip(views, self.weights)):
            self.counts[k] += np.bincount(bins_of(x @ w), minlength=BINS)

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        flat = self.counts.reshape(-1)
        at = np.flatnonzero(flat)
        return at.astype(np.int32), flat[at].astype(np.float64)


class Slopes:
    """Gradients and curvatures of both views over the rows that the other one labels."""

    def __init__(self, givers: list[np.ndarray], limits: list[tuple[float, float]], weights: list[np.ndarray]):
        self.givers, self.limits, self.weights = givers, limits, weights
        self.given = np.zeros(2)
        self.gradients = [np.zeros(len(w)) for w in weights]
        self.curvatures = [np.zeros((len(w), len(w))) for w in weights]

    def add(self, *views: np.ndarray) -> None:
        for giver, taker in ((0, 1), (1, 0)):
            which, y = taught(views[giver] @ self.givers[giver], *self.limits[giver])
            if len(which):
                self.given[taker] += len(which)
                g, c = slope(views[taker][which], y, 1.0, self.weights[taker])
                self.gradients[taker] += g
                self.curvatures[taker] += c

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([self.given, *(x for g, c in zip(self.gradients, self.curvatures) for x in (g, c[np.triu_indices(len(g))]))])
        at = np.flatnonzero(flat)
        return at.astype(np.int32), flat[at]

    def size(self) -> int:
        return 2 + sum(len(w) + len(w) * (len(w) + 1) // 2 for w in self.weights)

    def read(self, flat: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each view: how many rows it was given, and gradient and curvature over them."""
        out, at = [], 2
        for w in self.weights:
            n = len(w)
            whole = np.zeros((n, n))
            whole[np.triu_indices(n)] = flat[at + n : at + n + n * (n + 1) // 2]
            out.append((float(flat[len(out)]), flat[at : at + n], whole + np.triu(whole, 1).T))
            at += n + n * (n + 1) // 2
        return out


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Sums by place; as many numbers as the views' sizes make, whatever the number of rows."""
    out = np.zeros(size)
    for r in rows.groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r.v
    return out


def train(features: DataFrame, labels: DataFrame, target: str = "quality", doc: str = "doc_id", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> Model:
    """Fits on at most ``max_labelled`` labelled documents and on all others. ``features``: of ``featured``, best stored."""
    named = labels.where(F.col(doc).isNotNull() & F.col(target).isNotNull()).groupBy(F.col(doc).cast("long").alias("id")).agg(F.avg((F.col(target) > 0).cast("double")).alias("label"))
    chosen = named.orderBy(F.xxhash64("id"), "id").limit(max_labelled)  # two numbers each
    one = features.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("content", "meta")).alias("row"), F.first("label").alias("label"))
    rows = sorted(one.collect(), key=lambda r: (zlib.crc32(str(r.id).encode()), r.id))  # at most max_labelled
    label = np.array([r.label for r in rows])
    prior = float(label.mean()) if len(label) else 0.5
    if not len(label) or not 0 < prior < 1:
        return Model([], [], prior)
    views = [_matrix(pa.array([bytes(r.row[name]) for r in rows])) for name in ("content", "meta")]
    held = np.arange(len(rows)) % 4 == 3  # for calibration
    own, y = [x[~held] for x in views], label[~held]
    weights = [fit(x, y) for x in own]
    known = np.array(sorted(r.id for r in rows), np.int64)
    for k in range(1, rounds + 1):
        scales = [calibration(x[held] @ w, label[held]) for x, w in zip(views, weights)]
        now = [a * w + b * (np.arange(len(w)) == 0) for w, (a, b) in zip(weights, scales)]  # the first feature is always 1
        counts = _summed(others(features, known, lambda now=now: Histograms(now), "at int, v double"), 2 * BINS).reshape(2, BINS)
        limits = [edges(c, k, prior) for c in counts]
        for _ in range(STEPS):
            made = Slopes(now, limits, list(weights))
            flat = _summed(others(features, known, lambda made=made: Slopes(made.givers, made.limits, made.weights), "at int, v double"), made.size())
            for taker, (given, g, c) in enumerate(made.read(flat)):
                weight = len(y) / max(1.0, given)
                g_own, c_own = slope(own[taker], y, 1.0, weights[taker])
                weights[taker] = step(weights[taker], g_own + weight * g, c_own + weight * c)
    return Model(weights, [calibration(x[held] @ w, label[held]) for x, w in zip(views, weights)], prior)


def scored(features: DataFrame, model: Model) -> DataFrame:
    """doc_id, by_content, by_metadata, score and kept (score of at least one half) of every row of ``featured``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            if batch.num_rows:
                made = model.score(_matrix(batch.column(1)), _matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, made), pa.array(made[2] >= 0.5)], names=["doc_id", "by_content", "by_metadata", "score", "kept"])

    return features.mapInArrow(run, "doc_id long, by_content double, by_metadata double, score double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, target: str = "quality", doc: str = "doc_id", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Trains on the documents and the labels of some of them, and scores all."""
    features = stored(featured(docs, doc), "features")
    return scored(features, train(features, labels, target, doc, max_labelled))
