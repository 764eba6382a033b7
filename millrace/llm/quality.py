"""Quality classifier from trusted positives and unlabelled web text.

Positive-unlabelled learning: no negative label is used. With class prior ``p`` the risk of a scorer
``g`` is ``p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])``: the second part estimates the risk on the
unseen negatives and is kept from going below zero (where it does, the step goes the other way).
The prior is estimated first: a positive-against-unlabelled scorer is fitted on one half of the sample,
and on the other half the share of unlabelled texts above a score, over the share of positives above it,
is smallest where hardly any negatives are; the smallest upper bound of that ratio is the prior.

The scorer adds up a weight for the quantile bin of each of a few figures of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import key_hash, per_text

BINS = 16
#: Figures that ``figures`` returns.
FIGURES = 18


def figures(text: str | None) -> list[float]:
    """Figures of a whole text; zeros for a null or empty text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * FIGURES
    size = len(raw)
    # counts of each byte value; whole texts, a part at a time
    at = np.zeros(256, np.int64)
    for k in range(0, size, 1 << 22):
        at += np.bincount(np.frombuffer(raw, np.uint8, min(1 << 22, size - k), k), minlength=256)
    lower, upper, digit = at[97:123].sum(), at[65:91].sum(), at[48:58].sum()
    high, space = at[128:].sum(), at[32] + at[9:14].sum()
    sign = size - lower - upper - digit - high - space
    usual = at[[44, 46]].sum()  # comma and full stop
    share = at[at > 0] / size
    kinds = set(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = raw.split(b"\n")
    twin = sum(map(bytes.__eq__, words, words[1:]))
    letters = lower + upper + high
    return [
        np.log1p(n),
        (size - space) / n,
        np.log1p(len(kinds)) / np.log1p(n),
        len(kinds) / n,
        pairs / max(1, n - 1),
        twin / max(1, n - 1),
        len(set(lines)) / len(lines),
        n / len(lines),
        upper / max(1, letters),
        digit / size,
        sign / size,
        (sign - usual) / size,
        usual / n,
        at[46] / n,
        at[124] / n,
        high / size,
        float(-(share * np.log(share)).sum()),
        at[36:39].sum() / n + at[42] / n + at[35] / n,
    ]


@dataclass
class Model:
    edges: np.ndarray  # (FIGURES, BINS - 1)
    weights: np.ndarray  # (FIGURES, BINS)
    bias: float
    prior: float

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The weight's number of each figure of each row."""
        return np.stack([np.searchsorted(e, x[:, k], "right") + k * BINS for k, e in enumerate(self.edges)], 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.weights.ravel()[self.cells(x)].sum(1) + self.bias)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def _descend(cells: list[np.ndarray], slope, n_weights: int, rounds: int, rate: float) -> tuple[np.ndarray, float]:
    """Adam from zero. ``slope`` gives for the scores of each set the derivative by each score."""
    w, bias = np.zeros(n_weights), 0.0
    u, v = np.zeros(n_weights + 1), np.zeros(n_weights + 1)
    for it in range(1, rounds + 1):
        d = slope([w[c].sum(1) + bias for c in cells])
        g = 1e-4 * np.r_[w, 0]
        for c, x in zip(cells, d, strict=True):
            g[:-1] += np.bincount(c.ravel(), np.repeat(x, c.shape[1]), n_weights)
            g[-1] += x.sum()
        u += 0.1 * (g - u)
        v += 0.01 * (g * g - v)
        step = rate * (u / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    return w, bias


def class_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores of both that were not fitted on them."""
    if not len(pos) or not len(unl):
        return 0.5
    at = np.unique(pos)
    above = lambda s: 1 - np.searchsorted(np.sort(s), at, "left") / len(s)
    slack = np.sqrt(np.log(40) / (2 * len(pos))) + np.sqrt(np.log(40) / (2 * len(unl)))
    qp, qu = above(pos), above(unl)
    bound = (qu + slack) / np.maximum(qp, 1e-9)
    k = int(np.argmin(bound))
    return float(np.clip(qu[k] / max(qp[k], 1e-9), 0.01, 0.99))


def fit_model(pos: np.ndarray, unl: np.ndarray, prior: float | None = None, rounds: int = 400, seed: int = 7) -> Model:
    """Minimise the non-negative risk over figures of positives and of unlabelled texts."""
    both = np.concatenate([pos, unl]) if len(pos) + len(unl) else np.zeros((1, FIGURES))
    edges = np.quantile(both, np.arange(1, BINS) / BINS, axis=0).T
    model = Model(edges, np.zeros((FIGURES, BINS)), 0.0, 0.5)
    if not len(pos) or not len(unl):
        return model
    cp, cu = model.cells(pos), model.cells(unl)
    n_weights = FIGURES * BINS
    if prior is None:
        rng = np.random.default_rng(seed)
        hp, hu = rng.random(len(pos)) < 0.5, rng.random(len(unl)) < 0.5
        if hp.all() or not hp.any() or hu.all() or not hu.any():
            hp, hu = np.arange(len(pos)) % 2 == 0, np.arange(len(unl)) % 2 == 0
        fit_p, fit_u = cp[hp], cu[hu]
        w, b = _descend([fit_p, fit_u], lambda g: [(_sigmoid(g[0]) - 1) / max(1, len(fit_p)), _sigmoid(g[1]) / max(1, len(fit_u))], n_weights, 150, 0.05)
        prior = class_prior(w[cp[~hp]].sum(1) + b, w[cu[~hu]].sum(1) + b)
    p = prior

    def slope(g: list[np.ndarray]) -> list[np.ndarray]:
        # sigmoid loss l(z) = 1 / (1 + e^z)
        sp, su = _sigmoid(g[0]), _sigmoid(g[1])
        dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        if su.mean() - p * sp.mean() >= 0:
            return [-p * dp - p * dp, du]
        return [p * dp, -du]  # back out of a negative risk

    w, bias = _descend([cp, cu], slope, n_weights, rounds, 0.05)
    return Model(edges, w.reshape(FIGURES, BINS), bias, p)


def _figures_of(texts: list) -> dict[str, list]:
    return {"figures": [figures(t) for t in texts]}


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", label: str = "quality", bound: int = 10_000) -> Model:
    """Fit on a bounded sample of the rows where ``learn`` holds: about ``bound`` trusted positives
    (``label`` 1) and about ``bound`` texts taken without regard to labels.

    Both are drawn by a hash of the id, so reruns agree. Labels other than 1 (0, null) are not used; a
    label row that repeats an id counts once; rows without an id are left out.
    """
    ids = docs.where(learn & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"))
    good = labels.where((F.col(label) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    trusted = ids.join(good, "_id", "left_semi")
    n_docs, n_good = ids.count(), trusted.count()
    mark = key_hash("_id")
    pos = trusted.where(mark < bound / max(1, n_good)).select("_id", F.lit(1).alias("_kind"))
    # another hash, so that the texts taken are independent of the positives taken
    unl = ids.where(key_hash("_id", F.lit(1)) < bound / max(1, n_docs)).select("_id", F.lit(0).alias("_kind"))
    picked = pos.union(unl).groupBy("_id").agg(F.max("_kind").alias("_pos"), F.min("_kind").alias("_unl"))
    # about 2 x bound short rows
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")
    got = per_text(rows, "_text", "figures array<double>", _figures_of).orderBy("_id").collect()
    x = np.array([r["figures"] for r in got]).reshape(-1, FIGURES)
    is_pos, is_unl = np.array([r["_pos"] == 1 for r in got], bool), np.array([r["_unl"] == 0 for r in got], bool)
    return fit_model(x[is_pos], x[is_unl])


def score(docs: DataFrame, model: Model, text: str = "text", keep: bool = False) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5) in place of column ``text``, or beside
    it with ``keep``.

    Whole texts are read. A null text is scored as an empty one; repeated rows stay; an empty table stays
    empty; a model without positives or texts to learn from scores 0.5.
    """

    def run(texts: list) -> dict[str, list]:
        got = model.scores(np.array([figures(t) for t in texts]).reshape(-1, FIGURES))
        return {"score": got.tolist(), "predicted": (got >= 0.5).astype(int).tolist()}

    return per_text(docs, text, "score double, predicted int", run, keep=keep)
