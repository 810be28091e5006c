"""Quality classifier by co-training.

Two views of a document, each with its own logistic model: the text's content
(statistics of its characters and words) and the page's metadata (language,
source, stated length).  They start from labelled documents; in each round each
view labels the unlabelled documents of the table that it ranks highest as good
and highest as bad (``TAKEN`` of all of them more in every round, in the proportion of the labels; the
cuts are quantiles over the whole table, so a view that is never nearly certain
teaches as well), and the other view trains on them too.  A pseudo-label counts by
how far its teacher's probability exceeds the label's share, so a view that knows
little teaches little, and all of them together by no more than the labelled
documents.  Held-out labels calibrate each view (Platt scaling)
and combine the calibrated views into one score, the probability of good quality.
Every document is scored.

A document is rejected if the score, its calibrated probability of good quality, is
below one half.  The model carries the held-out counts of both errors, good documents
rejected and bad ones that pass, each half judged by calibration on the other half.

At most ``MAX_LABELLED`` labelled documents, chosen by a hash of the id, are
collected (a documented bound, a few MB on the driver).  The unlabelled ones stay in
a staged table of their views: each Newton step is one job that sums gradients and
Hessians over all of them.  Languages and sources are values of their own, each with
a weight; what reaches the driver is a few numbers per partition and per pair of
language and source.  Scoring covers every document, in Arrow batches.

Defined cases: a null text is empty; null language, source or length are values
of their own; of conflicting labels of one id the lower counts; without labels
of both classes every document scores 0.5 and stays; repeated rows give repeated
result rows; an empty table gives an empty result; further columns are ignored by
:func:`score` and kept by :func:`accepted`.
"""

from __future__ import annotations

import copy
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage_table, text_of

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_LABELLED = 8_000
ROUNDS, TAKEN, SURE, STEPS, CLOSE = 3, 0.3, 0.95, 20, 1e-3
RANK_ACCURACY = 10_000  # of the quantiles: one ten-thousandth of the table
THRESHOLD = 0.5
TEXT_WIDTH = 14  # numbers in the text view


def text_view(text: str) -> list[float]:
    """Statistics of characters and words."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [1.0] + [0.0] * (TEXT_WIDTH - 1)
    n, size = len(words), len(data)
    c = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    letters = max(1, int(c[65:91].sum() + c[97:123].sum()))
    symbols = int(c[[35, 36, 37, 38, 42, 60, 62, 124]].sum())
    stops = int(c[[44, 46, 58, 59, 63]].sum())
    once = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    short = sum(1 for w in words if len(w) < 3)
    return [0.0, symbols / size, int(c[65:91].sum()) / letters, int(c[33]) / n, int(c[48:58].sum()) / size, stops / n, int(c[10]) / n, int(c[128:].sum()) / size,
            once / n, same / n, pairs / n, size / n / 10, np.log1p(n) / 10, short / n]


@dataclass
class Rows:
    """One view of some documents: numbers, and for each key column the codes and the values they stand for."""
    numbers: np.ndarray
    keys: list[tuple[np.ndarray, list]] = field(default_factory=list)

    def take(self, at: np.ndarray) -> Rows:
        return Rows(self.numbers[at], [(codes[at], names) for codes, names in self.keys])


def rows_of(x: np.ndarray | Rows) -> Rows:
    return x if isinstance(x, Rows) else Rows(x)


def meta_view(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> Rows:
    """The stated length, and the exact language and source."""
    n = np.array(n_chars.to_numpy(zero_copy_only=False), dtype=float)
    known = np.isfinite(n) & (n >= 0)
    keys = []
    for a in (lang, source):
        d = a.dictionary_encode(null_encoding="encode")
        keys.append((np.asarray(d.indices, dtype=np.int64), d.dictionary.to_pylist()))
    return Rows(np.column_stack([np.log1p(np.where(known, n, 0.0)) / 10, ~known]), keys)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + keep * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(keep)
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(w)), grad)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _prob(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class View:
    """Mean, scale and weights of the numbers (the last weight is the intercept), weights of the key values, and calibration."""
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    keys: list[dict] = field(default_factory=list)
    platt: np.ndarray | None = None

    def logit(self, rows: Rows) -> np.ndarray:
        z = (rows.numbers - self.mean) / self.scale @ self.w[:-1] + self.w[-1]
        for (codes, names), weights in zip(rows.keys, self.keys, strict=True):
            if names:
                z = z + np.array([weights.get(x, 0.0) for x in names])[codes]
        return np.clip(z, -30, 30)

    def calibrated(self, rows: Rows) -> np.ndarray:
        return _logit(self.logit(rows)[:, None], self.platt)

    def sums(self, rows: Rows, y: np.ndarray, weight: np.ndarray | float = 1.0) -> dict[tuple, np.ndarray]:
        """Per tuple of key values: Hessian and gradient, weighted, and number of rows."""
        p = _prob(self.logit(rows))
        g, h = weight * (p - y), weight * p * (1 - p)
        v = np.column_stack([(rows.numbers - self.mean) / self.scale, np.ones(len(y))])
        if not rows.keys:
            return {(): np.concatenate([((v * h[:, None]).T @ v).ravel(), v.T @ g, [len(y)]])}
        code = np.zeros(len(y), dtype=np.int64)
        for codes, names in rows.keys:
            code = code * max(1, len(names)) + codes
        _, first, at = np.unique(code, return_index=True, return_inverse=True)
        k = v.shape[1]
        columns = [v[:, i] * v[:, j] * h for i in range(k) for j in range(k)] + [v[:, i] * g for i in range(k)] + [np.ones(len(y))]
        out = np.column_stack([np.bincount(at, c, len(first)) for c in columns])
        return {tuple(names[codes[f]] for codes, names in rows.keys): out[i] for i, f in enumerate(first)}

    def step(self, total: dict[tuple, np.ndarray], ridge: float = 1.0) -> float:
        """One Newton step on the sums; the largest change.  The last key column (source) has a diagonal block, which is eliminated."""
        k, t = len(self.w), np.array(list(total.values()))
        hess, grad = t[:, :k * k].reshape(-1, k, k), t[:, k * k:k * k + k]
        names = [list(dict.fromkeys([c[i] for c in total] + list(weights))) for i, weights in enumerate(self.keys)]
        spots = [np.array([at[c[i]] for c in total]) for i, at in enumerate({x: j for j, x in enumerate(n)} for n in names)]
        old = [np.array([weights.get(x, 0.0) for x in n]) for n, weights in zip(names, self.keys, strict=True)]
        keep = np.full(k, ridge)
        keep[-1] = 1e-6
        a, ga = hess.sum(axis=0) + np.diag(keep), grad.sum(axis=0) + keep * self.w
        inner = spots[:-1]  # key columns that stay in the dense block
        offset = k + np.cumsum([0] + [len(n) for n in names[:-1]])
        wide = np.zeros((int(offset[-1]), int(offset[-1])))
        wide[:k, :k] = a
        ga = np.concatenate([ga, *[np.bincount(s, grad[:, -1], len(o)) + ridge * o for s, o in zip(inner, old, strict=False)]])
        for i, s in enumerate(inner):
            at = offset[i] + s
            np.add.at(wide, (slice(0, k), at), hess[:, :, -1].T)
            np.add.at(wide, (at, slice(0, k)), hess[:, -1, :])
            for j, other in enumerate(inner):
                np.add.at(wide, (at, offset[j] + other), hess[:, -1, -1])
            own = np.arange(offset[i], offset[i + 1])
            wide[own, own] += ridge
        tiny = 1e-9 * np.eye(len(wide))
        if names:
            s, o = spots[-1], old[-1]
            d = np.bincount(s, hess[:, -1, -1], len(o)) + ridge
            gs = np.bincount(s, grad[:, -1], len(o)) + ridge * o
            b = np.zeros((len(o), len(wide)))
            np.add.at(b, (s, slice(0, k)), hess[:, -1, :])
            for i, other in enumerate(inner):
                np.add.at(b, (s, offset[i] + other), hess[:, -1, -1])
            x = np.linalg.solve(wide - b.T @ (b / d[:, None]) + tiny, ga - b.T @ (gs / d))
            last = (gs - b @ x) / d
        else:
            x, last = np.linalg.solve(wide + tiny, ga), np.zeros(0)
        most = float(np.abs(np.concatenate([x, last])).max())
        short = min(1.0, 5.0 / max(1e-9, most))
        self.w = self.w - short * x[:k]
        moves = [x[offset[i]:offset[i + 1]] for i in range(len(inner))] + [last]
        self.keys = [dict(zip(n, (o - short * m).tolist(), strict=True)) for n, o, m in zip(names, old, moves, strict=False)]
        return most


@dataclass
class Model:
    """The two views; their combination and the threshold; and, of the held-out documents, the
    counts (good, good rejected, bad, bad passed)."""
    views: list[View] = field(default_factory=list)
    combine: np.ndarray | None = None
    threshold: float = THRESHOLD
    held_out: tuple[int, int, int, int] = (0, 0, 0, 0)

    def scores(self, text: np.ndarray | Rows, meta: np.ndarray | Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.combine is None:
            half = np.full(len(rows_of(text).numbers), 0.5)
            return half, half, half
        z = np.column_stack([v.calibrated(rows_of(x)) for v, x in zip(self.views, (text, meta), strict=True)])
        return _prob(z[:, 0]), _prob(z[:, 1]), _prob(_logit(z, self.combine))


#: (view, label) -> sums over the unlabelled documents to which the other view gives that label.
Exchange = dict[tuple[int, int], dict[tuple, np.ndarray]]


def add(into: dict[tuple, np.ndarray], more: dict[tuple, np.ndarray], weight: float = 1.0) -> None:
    for key, v in more.items():
        into[key] = into[key] + weight * v if key in into else weight * v


#: Per teacher: the calibrated logits up to which it says bad and from which it says good, and the share of good labels; None if
#: it tells nothing apart.
Limits = list[tuple[float, float, float] | None]


def limits_of(logits: list[np.ndarray], shares: tuple[float, float]) -> Limits:
    """Cuts by rank: ``shares`` of the documents are taken as (bad, good)."""
    cuts = [np.quantile(z, [shares[0], 1 - shares[1]], method="inverted_cdf") if len(z) else (0.0, 0.0) for z in logits]
    return [(float(low), float(high), shares[1] / sum(shares)) if low < high else None for low, high in cuts]


def exchange(teachers: list[View], views: list[View], rows: list[Rows], out: Exchange, limits: Limits | None = None) -> None:
    """Add the sums over ``rows``: each view learns the labels that the other view's teacher gives, by ``limits`` or
    (without) where it is at least ``SURE``, each weighted by how far the teacher's probability lies from the label's share
    (0) towards certainty (1): a view that knows little teaches little."""
    absolute = float(np.log(SURE / (1 - SURE)))
    for i in (0, 1):
        limit = limits[1 - i] if limits else (-absolute, absolute, 0.5)
        if limit is None:
            continue
        z = teachers[1 - i].calibrated(rows[1 - i])
        for label, taken in ((1, z >= limit[1]), (0, z <= limit[0])):
            at = np.flatnonzero(taken)
            if len(at):
                share = limit[2] if label else 1 - limit[2]
                weight = np.clip((_prob(z[at] if label else -z[at]) - share) / max(1e-9, 1 - share), 0, 1)
                add(out.setdefault((i, label), {}), views[i].sums(rows[i].take(at), np.full(len(at), label), weight))


def combined(logits: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Calibration of each view's logits (a column each), and the combination of the calibrated ones."""
    platts = [fit(logits[:, [i]], y) for i in range(logits.shape[1])]
    return platts, fit(np.column_stack([_logit(logits[:, [i]], platt) for i, platt in enumerate(platts)]), y)


def teach(rows: list[Rows], y: np.ndarray, norms: list[tuple[np.ndarray, np.ndarray]], pool: Callable[[list[View], list[View], Limits], Exchange],
          ranks: Callable[[list[View], tuple[float, float]], Limits], rounds: int) -> Model:
    """``rows`` and ``y`` (1 good, 0 bad) are the labelled documents in hash order: the last of every four is held out
    for calibration and for the counts of errors."""
    if len(set(y.tolist())) < 2:
        return Model()
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held].tolist())) < 2:
        train = test = np.arange(len(y))  # too few labels to hold any out
    else:
        train, test = np.flatnonzero(~held), np.flatnonzero(held)
    good_share = float(y[train].mean())
    own, out = [r.take(train) for r in rows], [r.take(test) for r in rows]
    views = [View(mean, scale, np.zeros(len(mean) + 1), [{} for _ in r.keys]) for (mean, scale), r in zip(norms, rows, strict=True)]
    for turn in range(rounds + 1):
        teachers = copy.deepcopy(views)
        taken = min(0.9, TAKEN * turn)
        limits = ranks(teachers, (taken * (1 - good_share), taken * good_share)) if turn else [None, None]
        if turn and limits == [None, None]:
            break  # no view tells any documents apart
        for _ in range(STEPS):
            given = pool(teachers, views, limits) if turn else {}
            moves = []
            for i, view in enumerate(views):
                total = view.sums(own[i], y[train])
                # In the labelled proportion: labels of one kind alone would only move the prior.
                more = [given.get((i, label), {}) for label in (0, 1)]
                n = [sum(v[-1] for v in m.values()) for m in more]
                mine = [(y[train] == label).sum() for label in (0, 1)]
                # A label that the exchange lacks (a teacher with ties, a small pool) does not silence the other one.
                share = min([1.0] + [a / b for a, b in zip(n, mine, strict=True) if a and b])
                for m, a, b in zip(more, n, mine, strict=True):
                    add(total, m, share * b / max(1.0, a))
                moves.append(view.step(total))
            if max(moves) < CLOSE:
                break
        for i, view in enumerate(views):
            view.platt = fit(view.logit(out[i])[:, None], y[test])
    model = Model(views)
    raw = np.column_stack([view.logit(r) for view, r in zip(views, out, strict=True)])
    model.combine = combined(raw, y[test])[1]
    # Errors are counted on each half of the held-out labels by calibration on the other half.
    half = np.arange(len(test)) % 2 == 1
    stays = np.zeros(len(test), dtype=bool)
    for part in (half, ~half):
        rest = ~part if len(set(y[test][~part].tolist())) == 2 else np.ones(len(test), dtype=bool)  # too few labels to part them
        platts, combine = combined(raw[rest], y[test][rest])
        z = np.column_stack([_logit(raw[part][:, [i]], platt) for i, platt in enumerate(platts)])
        stays[part] = _prob(_logit(z, combine)) >= model.threshold
    good = y[test] == 1
    model.held_out = (int(good.sum()), int((good & ~stays).sum()), int((~good).sum()), int((~good & stays).sum()))
    return model


def cotrain(text: np.ndarray | Rows, meta: np.ndarray | Rows, y: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The same on rows in memory.  ``y``: 1 good, 0 bad, -1 unlabelled, in hash order."""
    rows = [rows_of(text), rows_of(meta)]
    known, rest = np.flatnonzero(y >= 0), np.flatnonzero(y < 0)
    left = [r.take(rest) for r in rows]

    def pool(teachers: list[View], views: list[View], limits: Limits) -> Exchange:
        out: Exchange = {}
        exchange(teachers, views, left, out, limits)
        return out

    def ranks(teachers: list[View], shares: tuple[float, float]) -> Limits:
        return limits_of([t.calibrated(r) for t, r in zip(teachers, left, strict=True)], shares)

    return teach([r.take(known) for r in rows], y[known], [(r.numbers.mean(axis=0), r.numbers.std(axis=0) + 1e-6) for r in rows], pool, ranks, rounds)


def _meta_columns(docs: DataFrame) -> list:
    have = {c.lower() for c in docs.columns}
    return [(F.col(c) if c in have else F.lit(None)).cast(t).alias(f"_{c}") for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "double"))]


def _text(t: pa.Array) -> np.ndarray:
    return np.array([text_view(x.as_py()) for x in t], dtype=float).reshape(len(t), TEXT_WIDTH)


def _staged(x: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> list[Rows]:
    return [Rows(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), TEXT_WIDTH)), meta_view(lang, source, n_chars)]


def pool_limits(pool: DataFrame, teachers: list[View], shares: tuple[float, float]) -> Limits:
    """The cuts of :func:`limits_of` over all rows of ``pool``: quantiles that Spark merges, in one job."""
    @F.arrow_udf("struct<z0:double,z1:double>")
    def logits(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for part in parts:
            z = [t.calibrated(r) for t, r in zip(teachers, _staged(*part), strict=True)]
            yield pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in z], ["z0", "z1"])

    z = pool.select(logits("x", "_lang", "_source", "_n_chars").alias("z"))
    at = [shares[0], 1 - shares[1]]
    cuts = z.agg(*[F.percentile_approx(f"z.z{i}", at, RANK_ACCURACY) for i in (0, 1)]).first()
    return [(c[0], c[1], shares[1] / sum(shares)) if c and c[0] < c[1] else None for c in cuts]


def pool_sums(pool: DataFrame, teachers: list[View], views: list[View], limits: Limits | None = None) -> Exchange:
    """The sums of :func:`exchange` over all rows of ``pool`` (x, _lang, _source, _n_chars), in one job."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Exchange = {}
        for b in batches:
            exchange(teachers, views, _staged(*b.columns), out, limits)
        for (i, label), per in out.items():
            for key, v in per.items():
                lang, source = key or (None, None)
                n = len(v)
                yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int32()), pa.array([label] * n, pa.int32()), pa.array([lang] * n, pa.string()),
                                                  pa.array([source] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array(v, pa.float64())],
                                                 ["view", "label", "lang", "source", "pos", "value"])

    sums = pool.mapInArrow(part, "view int, label int, lang string, source string, pos int, value double")
    got: dict[tuple[int, int], dict[tuple, dict[int, float]]] = {}
    for r in sums.groupBy("view", "label", "lang", "source", "pos").agg(F.sum("value").alias("value")).collect():  # a few numbers per (lang, source)
        got.setdefault((r["view"], r["label"]), {}).setdefault((r["lang"], r["source"]) if r["view"] else (), {})[r["pos"]] = r["value"]
    return {k: {key: np.array([v[j] for j in range(len(v))]) for key, v in per.items()} for k, per in got.items()}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> Model:
    """Fit on a bounded sample of the labelled documents and on all unlabelled ones."""
    label = labels.groupBy(F.col("doc_id").alias("l_id")).agg(F.min("quality").alias("y")).where("l_id is not null and y is not null")

    @F.arrow_udf("array<double>")
    def numbers(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in parts:
            yield pa.array(list(_text(t)), pa.list_(pa.float64()))

    seen = docs.select(F.col(id_col).alias("_id"), numbers(text_of(text_col)).alias("x"), *_meta_columns(docs))
    seen = stage_table(seen.join(label, F.col("_id") == F.col("l_id"), "left")
                       .select("_id", "x", "_lang", "_source", "_n_chars", (F.col("y") > 0).cast("int").alias("y")), "training-views")
    mine, pool = seen.where("y is not null"), seen.where("y is null").select("x", "_lang", "_source", "_n_chars")
    order = F.xxhash64(F.lit(5), F.col("_id"))
    chosen = stage_table(mine.select("_id").distinct().orderBy(order, "_id").limit(max_labelled), "training-ids")
    picked = mine.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]).orderBy(order, "_id").toArrow()  # the bounded sample
    if not picked.num_rows:
        return Model()
    x = [F.col("x")[i] for i in range(TEXT_WIDTH)]
    known = F.col("_n_chars").isNotNull() & ~F.isnan("_n_chars") & (F.col("_n_chars") >= 0) & (F.col("_n_chars") < float("inf"))
    x += [F.when(known, F.log1p("_n_chars") / 10).otherwise(0.0), F.when(known, 0.0).otherwise(1.0)]
    norm = np.array(seen.select(*[f(c).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i, c in enumerate(x)]).first(), dtype=float)
    mean, scale = norm[:len(x)], norm[len(x):] + 1e-6
    rows = _staged(*[picked.column(c).combine_chunks() for c in ("x", "_lang", "_source", "_n_chars")])
    norms = [(mean[:TEXT_WIDTH], scale[:TEXT_WIDTH]), (mean[TEXT_WIDTH:], scale[TEXT_WIDTH:])]
    return teach(rows, np.asarray(picked.column("y")), norms, lambda teachers, views, limits: pool_sums(pool, teachers, views, limits),
                 lambda teachers, shares: pool_limits(pool, teachers, shares), rounds)


def _scored(docs: DataFrame, model: Model, text_col: str, into: str) -> DataFrame:
    @F.arrow_udf("struct<p_text:double,p_meta:double,score:double>")
    def scores(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for t, lang, source, n in parts:
            p = model.scores(_text(t), meta_view(lang, source, n))
            yield pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in p], ["p_text", "p_meta", "score"])

    return docs.withColumn(into, scores(text_of(text_col), *_meta_columns(docs)))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """One row per input row: doc_id, p_text, p_meta, score, kept."""
    model = train(docs, labels, id_col, text_col, **bounds)
    into = fresh("_s", docs.columns)
    s = _scored(docs, model, text_col, into)
    return s.select(F.col(id_col).alias("doc_id"), f"{into}.p_text", f"{into}.p_meta", f"{into}.score",
                    (F.col(f"{into}.score") >= F.lit(model.threshold)).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    model = train(docs, labels, id_col, text_col, **bounds)
    into = fresh("_s", docs.columns)
    return _scored(docs, model, text_col, into).where(F.col(f"{into}.score") >= F.lit(model.threshold)).select(*docs.columns)
