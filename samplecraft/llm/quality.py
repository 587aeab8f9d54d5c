"""Quality classifiers by co-training on two views of a document.

One view is the text: which words of a list occur, and how the text looks. The other
is metadata: the document's columns other than the text. Each view has a classifier
(logistic regression). In every round each classifier labels those documents of an
unlabelled pool that it is sure about, and these pseudo-labels train the other one. At
the end each view's scores are calibrated on labelled documents kept aside, and a last
regression on those weighs the two.

Training sees a bounded sample: at most ``LABELLED`` labelled and ``POOL`` unlabelled
documents, those with the smallest hash of their key. Everything else, so the scores,
covers all documents. The model is a few thousand numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

LABELLED = 12_000  # labelled documents that training uses at most
POOL = 12_000  # unlabelled documents that get pseudo-labels at most
ROUNDS = 3
SURE = 0.98  # calibrated probability from which a view labels for the other
SHARE = 0.25  # of the pool that a view labels in a round, at most
TERMS = 400  # words of the text view
LEAST_SEEN = 4  # training documents a word must occur in
BINS = 8  # intervals of a number
PART = 1_000  # documents whose features are laid out at once
VALUES = 100  # values of a metadata column that count on their own

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
_KIND = np.zeros((6, 256), dtype=np.float64)  # upper, lower, digit, punctuation, feed, beyond ASCII
_KIND[0, 65:91] = _KIND[1, 97:123] = _KIND[2, 48:58] = _KIND[4, 10] = _KIND[5, 128:] = 1
_KIND[3, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1
LOOKS = 11


def text_features(texts: pa.Array):
    """For slices of the texts: ``(first, after, looks, terms, bounds)``; looks has a row
    of ``LOOKS`` numbers for each text, terms the distinct word hashes of each text."""
    data, bounds = W.text_bytes(texts)
    for i, j in W.slices(bounds):
        part = bounds[i : j + 1] - bounds[i]
        raw = data[bounds[i] : bounds[j]]
        n, size = j - i, np.maximum(np.diff(part), 1)
        looks = np.zeros((n, LOOKS))
        for k in range(6):
            total = np.concatenate([[0], np.cumsum(_KIND[k][raw])])
            looks[:, k] = (total[part[1:]] - total[part[:-1]]) / size
        own, at = W.word_hashes(raw, part)
        count = np.diff(at)
        text_of = np.repeat(np.arange(n), count)
        again = np.zeros(len(own), bool)
        again[1:] = (own[1:] == own[:-1]) & (text_of[1:] == text_of[:-1])
        looks[:, 6] = np.bincount(text_of, again, n) / np.maximum(count, 1)
        looks[:, 8] = size / np.maximum(count, 1)
        looks[:, 9] = np.log1p(count)
        folded, fat = W.word_hashes(_FOLD[raw], part)
        owner = np.repeat(np.arange(n), np.diff(fat))
        order = np.lexsort((folded, owner))
        terms, owner = folded[order], owner[order]
        fresh = np.ones(len(terms), bool)
        fresh[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
        terms, owner = terms[fresh], owner[fresh]
        distinct = np.bincount(owner, minlength=n)
        looks[:, 7] = distinct / np.maximum(np.diff(fat), 1)
        looks[:, 10] = distinct / np.sqrt(np.maximum(np.diff(fat), 1))
        yield i, j, looks, terms, np.concatenate([[0], np.cumsum(distinct)])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fitted(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, ridge: float = 1.0, steps: int = 200) -> np.ndarray:
    """Logistic regression weights by accelerated gradient steps of the length that the
    largest curvature allows. The last column of ``x`` is the constant 1, its weight is
    not held back. Rows whose ``y`` is NaN do not count; ``start`` is a guess to begin
    from."""
    w = np.zeros(x.shape[1]) if start is None else start.astype(float)
    counts = (~np.isnan(y)).astype(np.float32)
    target = np.nan_to_num(y).astype(np.float32)
    way = np.full(x.shape[1], x.shape[1] ** -0.5, np.float32)
    largest = 0.0
    for _ in range(15):
        along = x.T @ ((x @ way) * counts)
        largest = float(np.linalg.norm(along))
        way = along / np.float32(max(largest, 1e-12))
    scale = 0.25 * 1.1 * largest + ridge
    penalty = np.full(len(w), ridge)
    penalty[-1] = 0
    v = w
    for t in range(1, steps + 1):
        miss = (_sigmoid(x @ v.astype(np.float32)) - target).astype(np.float32) * counts
        step = v - (x.T @ miss + penalty * v) / scale
        v = step + (t - 1) / (t + 2) * (step - w)
        w = step
    return w


def with_constant(*parts: np.ndarray) -> np.ndarray:
    """Columns side by side, and one of 1."""
    return np.concatenate([*parts, np.ones((len(parts[0]), 1))], axis=1, dtype=np.float32)


def applied(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Scores of rows without the constant column."""
    return x @ w[:-1] + w[-1]


def calibration(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and constant of the log odds for a score, by Newton steps with smoothed
    targets (Platt)."""
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    x, w = np.stack([score, np.ones(len(score))], axis=1), np.zeros(2)
    for _ in range(30):
        p = _sigmoid(x @ w)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
    return w


@dataclass
class Target:
    """What one label's classifiers have learned."""

    terms: np.ndarray  # sorted word hashes of the text view
    text: np.ndarray
    meta: np.ndarray
    blend: np.ndarray  # weights of the views' log odds, constant last
    pseudo: int = 0
    trained: bool = True  # False without labels: all scores are 0.5


@dataclass
class Model:
    metadata: tuple[str, ...]
    numeric: tuple[bool, ...]
    edges: list[np.ndarray]  # of the looks' bins
    columns: list  # for each metadata column: bin edges, or the position of each value
    targets: dict[str, Target] = field(default_factory=dict)

    def look_bins(self, looks: np.ndarray) -> np.ndarray:
        out = np.zeros((len(looks), LOOKS * BINS), np.float32)
        for k, edges in enumerate(self.edges):
            out[np.arange(len(looks)), k * BINS + np.searchsorted(edges, looks[:, k], side="right")] = 1
        return out

    def meta_bins(self, values: list[list]) -> np.ndarray:
        """A null has a place of its own, as have all values not seen in training."""
        parts = []
        for known, numeric, column in zip(self.columns, self.numeric, values):
            width = BINS + 1 if numeric else len(known) + 2
            out = np.zeros((len(column), width), np.float32)
            if numeric:
                number = np.array([np.nan if v is None else float(v) for v in column])
                place = np.where(np.isnan(number), BINS, np.searchsorted(known, number, side="right"))
            else:
                place = np.array([len(known) + 1 if v is None else known.get(str(v), len(known)) for v in column], np.int64)
            out[np.arange(len(column)), place.astype(np.int64)] = 1
            parts.append(out)
        return np.concatenate(parts, axis=1) if parts else np.zeros((len(values[0]) if values else 0, 0), np.float32)

    def log_odds(self, target: Target, looks, terms, bounds, meta) -> np.ndarray:
        n = len(looks)
        at = np.searchsorted(target.terms, terms)
        hit = target.terms[np.minimum(at, len(target.terms) - 1)] == terms if len(target.terms) else np.zeros(len(terms), bool)
        owner = np.repeat(np.arange(n), np.diff(bounds))
        base = LOOKS * BINS
        text = applied(self.look_bins(looks), np.append(target.text[:base], target.text[-1]))
        text += np.bincount(owner[hit], target.text[base + at[hit]], n)
        return np.stack([text, applied(meta, target.meta)], axis=1) @ target.blend[:-1] + target.blend[-1]


def _edges(values: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, BINS) / BINS)) if len(values) else np.zeros(0)


def _pick_terms(terms: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The words that depend on the label most, by their chi-squared statistic; documents
    whose ``y`` is NaN do not count."""
    used = ~np.isnan(y)
    if not used.any() or y[used].min() == y[used].max():
        return np.zeros(0, np.uint64)
    size = np.diff(bounds)
    names, place = np.unique(terms[np.repeat(used, size)], return_inverse=True)
    seen = np.bincount(place, minlength=len(names)).astype(float)
    good = np.bincount(place, np.repeat(y[used], size[used]), len(names))
    del place
    n, rate = used.sum(), y[used].mean()
    absent = np.maximum(n - seen, 1)
    expected = np.maximum(seen * rate * (1 - rate) * (1 + seen / absent), 1e-9)
    chi = (good - seen * rate) ** 2 / expected
    chi[(seen < LEAST_SEEN) | (chi < 15)] = 0
    best = np.argsort(-chi, kind="stable")[:TERMS]
    return np.sort(names[best[chi[best] > 0]])


def _text_view(model: Model, looks: np.ndarray, terms: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Bins of the looks, which of the known words a document has, and the constant 1;
    some documents at a time, since the driver holds only the result."""
    base, n = LOOKS * BINS, len(looks)
    out = np.zeros((n, base + len(known) + 1), np.float32)
    out[:, -1] = 1
    for i in range(0, n, PART):
        j = min(i + PART, n)
        out[i:j, :base] = model.look_bins(looks[i:j])
        if len(known):
            mine = terms[bounds[i] : bounds[j]]
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            hit = known[at] == mine
            out[np.repeat(np.arange(i, j), np.diff(bounds[i : j + 1]))[hit], base + at[hit]] = 1
    return out


def cotrained(
    model: Model, looks: np.ndarray, terms: np.ndarray, bounds: np.ndarray, meta: np.ndarray, y: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS
) -> Target:
    """Train one label; ``y`` is NaN for the pool, ``fold`` marks the labelled documents
    kept aside for calibration."""
    train, held, pool = ~np.isnan(y) & ~fold, ~np.isnan(y) & fold, np.isnan(y)
    if not held.any() or not train.any():
        held = train = ~np.isnan(y)
    chosen = _pick_terms(terms, bounds, np.where(train, y, np.nan))
    views = [_text_view(model, looks, terms, bounds, chosen), with_constant(meta)]
    given = [np.where(train, y, np.nan) for _ in views]  # labels that each view trains on
    labelled = 0
    weights: list = [None for _ in views]
    for turn in range(rounds + 1):
        # A round goes on from the weights of the one before.
        weights = [fitted(x, g, w, steps=80 if turn else 400) for x, g, w in zip(views, given, weights)]
        scores = [x @ w.astype(np.float32) for x, w in zip(views, weights)]
        scales = [calibration(s[held], y[held]) for s in scores]
        odds = [s * c[0] + c[1] for s, c in zip(scores, scales)]
        if turn == rounds:
            break
        for mine, other in ((0, 1), (1, 0)):
            p = _sigmoid(odds[mine])
            sure = pool & np.isnan(given[other]) & ((p >= SURE) | (p <= 1 - SURE))
            # Where the other view is as sure of the opposite, neither labels.
            theirs = _sigmoid(odds[other])
            sure &= ~((p >= SURE) & (theirs <= 1 - SURE)) & ~((p <= 1 - SURE) & (theirs >= SURE))
            found = np.flatnonzero(sure)
            found = found[np.argsort(-np.abs(odds[mine][found]), kind="stable")][: int(SHARE * pool.sum())]
            given[other][found] = (p[found] >= 0.5).astype(float)
            labelled += len(found)
    blend = fitted(with_constant(np.stack([o[held] for o in odds], axis=1)), y[held], ridge=0.1, steps=1000)
    # The views' calibration is folded into the blend's weights.
    mixed = np.array([blend[0] * scales[0][0], blend[1] * scales[1][0], blend[2] + blend[0] * scales[0][1] + blend[1] * scales[1][1]])
    return Target(chosen, weights[0], weights[1], mixed, labelled)


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, metadata: tuple[str, ...], targets: tuple[str, ...]) -> pa.Table:
    """The rows training sees, with their features instead of their texts."""
    sort = F.xxhash64("k")
    known = (
        labels.select(F.col(f"`{key}`").alias("k"), *[F.col(f"`{t}`").cast("double").alias(f"y{i}") for i, t in enumerate(targets)])
        .filter(F.col("k").isNotNull())
        .groupBy("k")
        .agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(targets))])
    )
    keys = docs.select(F.col(f"`{key}`").alias("k")).filter(F.col("k").isNotNull()).distinct()
    some = known.join(keys, "k", "left_semi").orderBy(sort, "k").limit(LABELLED)
    pool = keys.join(known, "k", "left_anti").orderBy(sort, "k").limit(POOL)
    chosen = some.unionByName(pool, allowMissingColumns=True)
    rows = docs.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"m{i}") for i, c in enumerate(metadata)]
    ).join(chosen, "k")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def features(batches):
        for batch in batches:
            for i, j, looks, terms, bounds in text_features(batch.column("text")):
                part = batch.slice(i, j - i)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(terms.view(np.int64)))
                numbers = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * LOOKS, pa.int32()), pa.array(looks.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), numbers, lists], [*names, "looks", "terms"])

    names = [n for n in rows.columns if n != "text"]
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", looks array<double>, terms array<long>"
    return rows.mapInArrow(features, schema).toArrow()


def train(
    docs: DataFrame,
    labels: DataFrame,
    targets: tuple[str, ...] = ("quality",),
    key: str = "doc_id",
    text: str = "text",
    metadata: tuple[str, ...] = ("lang", "source", "n_chars"),
    rounds: int = ROUNDS,
) -> Model:
    """Train a classifier for each 0/1 column of ``labels`` in ``targets``.

    Labels without a document are left out; a document with several label rows has the
    largest label. Without labelled documents every score is 0.5.
    """
    numeric = tuple(docs.schema[c].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal") for c in metadata)
    table = _sample(docs, labels, key, text, metadata, targets)
    # One row for each key, in the order of the keys.
    rows = table.drop_columns(["looks", "terms"]).to_pandas().sort_values("k", kind="stable").drop_duplicates("k")
    order = pa.array(rows.index.to_numpy())
    # Taken as lists: no index of every word is made.
    looks = table["looks"].combine_chunks().take(order).flatten().to_numpy(zero_copy_only=False).reshape(-1, LOOKS)
    lists = table["terms"].combine_chunks().take(order)
    del table
    bounds = lists.offsets.to_numpy().astype(np.int64)
    terms = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    pa.default_memory_pool().release_unused()
    columns: list = []
    values = [[None if pd.isna(v) else v for v in rows[f"m{i}"]] for i in range(len(metadata))]
    for number, column in zip(numeric, values):
        if number:
            columns.append(_edges(np.array([float(v) for v in column if v is not None])))
        else:
            count = pd.Series([str(v) for v in column if v is not None], dtype=object).value_counts()
            common = sorted(count.index, key=lambda v: (-count[v], v))[:VALUES]
            columns.append({v: i for i, v in enumerate(common)})
    model = Model(tuple(metadata), numeric, [_edges(looks[:, k]) for k in range(LOOKS)], columns)
    meta = model.meta_bins(values) if metadata else np.zeros((len(rows), 0), np.float32)
    # Every fifth labelled document, by a hash of its place in the sample, is kept aside.
    fold = W.mixed(np.arange(len(rows), dtype=np.uint64)) % np.uint64(5) == 0
    for i, name in enumerate(targets):
        y = rows[f"y{i}"].to_numpy(dtype=float) if len(rows) else np.zeros(0)
        if np.isnan(y).all():
            empty = np.zeros(0, np.uint64)
            model.targets[name] = Target(empty, np.zeros(LOOKS * BINS + 1), np.zeros(meta.shape[1] + 1), np.zeros(3), trained=False)
        else:
            model.targets[name] = cotrained(model, looks, terms, bounds, meta, (y > 0).astype(float) + np.where(np.isnan(y), np.nan, 0), fold, rounds)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", suffix: str = "_score") -> DataFrame:
    """``docs`` with a probability for each target, in a column named after it.

    All rows and whole texts are scored. A null text is an empty one; a metadata value
    that is null or was not seen in training counts as such. Every other column stays;
    a column that has the name of a score is replaced.
    """
    names = [f"{t}{suffix}" for t in model.targets]
    rows = docs.drop(*names)
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches):
        for batch in batches:
            for i, j, looks, terms, bounds in text_features(batch.column(text)):
                part = batch.slice(i, j - i)
                meta = model.meta_bins([part.column(c).to_pylist() for c in model.metadata]) if model.metadata else np.zeros((j - i, 0))
                scores = [pa.array(_sigmoid(model.log_odds(t, looks, terms, bounds, meta))) for t in model.targets.values()]
                yield pa.RecordBatch.from_arrays([*part.columns, *scores], [*part.schema.names, *names])

    return rows.mapInArrow(run, schema)
