"""Toxicity classifier that does not hinge on who is mentioned.

Logistic regression on which words and word beginnings a text holds, with counterfactual logit pairing:
where a labelled text names a group, the group terms of its sentences are swapped for others, and the
squared change of the score is added to the loss. A neutral mention of a group then weighs as much as
that of any other group, and cannot carry a verdict by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import exp

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from millrace.llm.common import key_hash, letters, per_text

WORD = re.compile(letters())
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
#: Lengths of the word beginnings that count.
STARTS = (4, 5, 6)
#: Features kept for the regression.
KEPT = 2000
# Names of groups, lower case. Those of the first list also have a regular English plural.
GROUP_NOUNS = (
    "girl boy gay lesbian homosexual bisexual muslim jew christian catholic protestant hindu buddhist sikh atheist "
    "african american european asian mexican latino latina arab indian pakistani turk pole russian gypsy "
    "immigrant refugee migrant foreigner"
).split()
GROUP_WORDS = (
    "woman women man men trans transgender straight queer jewish islamic black white brown chinese japanese polish turkish roma "
    "disabled blind deaf autistic elderly old young "
    "frau frauen mann männer muslim muslime muslimin muslima jude juden jüdin jüdisch christ christen ausländer ausländerin "
    "flüchtling flüchtlinge türke türken schwarze schwule lesben behinderte "
    "femme femmes homme hommes musulman musulmans musulmane musulmanes juif juifs juive juives chrétien chrétiens immigré immigrés réfugié réfugiés arabe arabes noir noirs "
    "mujer mujeres hombre hombres musulmán musulmanes judío judíos judía judías cristiano cristianos inmigrante inmigrantes refugiado refugiados gitano gitanos negro negros"
).split()


def plural(noun: str) -> str:
    """The regular English plural."""
    if noun[-1] == "y" and noun[-2] not in "aeou":
        return noun[:-1] + "ies"
    return noun + ("es" if noun.endswith(("s", "x", "ch", "sh")) else "s")


#: Group terms that are swapped for each other.
IDENTITY_TERMS = tuple(dict.fromkeys([w for n in GROUP_NOUNS for w in (n, plural(n))] + GROUP_WORDS))


def _hash(s: str) -> int:
    return xxh32_intdigest(s.encode("utf-8", "replace"))


class _Starts(dict):
    """Hashes of word beginnings; far fewer than words."""

    def __missing__(self, start: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[start] = got = _hash("^" + start)
        return got


_starts = _Starts()


def word_features(word: str) -> list[int]:
    """The word, and its beginnings, as hashes."""
    return [_hash("=" + word)] + [_starts[word[:k]] for k in STARTS if len(word) >= k]


def swapped(text: str, terms: list[str], salt: int) -> str | None:
    """``text`` with each group term swapped for another of the list, sentence by sentence; null without one."""
    at = {t: i for i, t in enumerate(terms)}
    found = False

    def other(m: re.Match) -> str:
        nonlocal found
        i = at.get(m[0].lower())
        if i is None or len(terms) < 2:
            return m[0]
        found = True
        return terms[(i + 1 + (salt + m.start()) % (len(terms) - 1)) % len(terms)]

    out = " ".join(WORD.sub(other, s) for s in SENTENCE.split(text))
    return out if found else None


def _words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


@dataclass
class Model:
    weights: dict[int, float]
    bias: float
    cache: dict = field(default_factory=dict)

    def scores(self, texts: list[str | None]) -> list[float]:
        if len(self.cache) > 400_000:
            self.cache.clear()
        cache, weights, out = self.cache, self.weights, []
        for t in texts:
            words = _words(t)
            for w in words.difference(cache):
                cache[w] = [f for f in word_features(w) if f in weights] or None
            hits = {f for w in words if (own := cache[w]) for f in own}
            z = self.bias + sum(map(weights.__getitem__, sorted(hits)))
            out.append(1 / (1 + exp(-min(40.0, max(-40.0, z)))))
        return out


def fit_model(rows: list[np.ndarray], twins: list[np.ndarray | None], toxic: np.ndarray, pairing: float = 1.0, rounds: int = 300) -> Model:
    """Minimise logistic loss plus ``pairing`` times the mean squared score change between a text's features
    (``rows``) and those with group terms swapped (``twins``, null where there are none)."""
    n, n_tox = len(rows), int(toxic.sum())
    if not n or not n_tox or n_tox == n:
        return Model({}, 0.0 if not n else 4.0 * (1 if n_tox else -1))
    size = np.array([len(r) for r in rows])
    owner, flat = np.repeat(np.arange(n), size), np.concatenate(rows)
    feats, code = np.unique(flat, return_inverse=True)
    in_tox = np.bincount(code, toxic[owner], len(feats))
    held = np.bincount(code, minlength=len(feats)).astype(float)
    expected = held * n_tox / n
    spread = (in_tox - expected) ** 2 / np.maximum(expected * (1 - n_tox / n) * (1 - held / n), 1e-9)
    # beyond chance even for the best of so many features
    chosen = np.argsort(-spread, kind="stable")[:KEPT]
    chosen = np.sort(chosen[(held[chosen] >= 3) & (spread[chosen] > 2 * np.log(max(2, len(feats))))])
    feats = feats[chosen]

    def columns(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        values = np.concatenate(parts) if parts else np.empty(0, feats.dtype)
        at = np.minimum(np.searchsorted(feats, values), max(0, len(feats) - 1))
        ok = feats[at] == values if len(feats) else np.zeros(len(values), bool)
        return own[ok], at[ok]

    row, col = columns(rows)
    paired = [i for i, t in enumerate(twins) if t is not None]
    row_a, col_a = columns([rows[i] for i in paired])
    row_b, col_b = columns([twins[i] for i in paired])
    w, bias = np.zeros(len(feats)), np.log(n_tox / (n - n_tox))
    u, v = np.zeros(len(feats) + 1), np.zeros(len(feats) + 1)
    for it in range(1, rounds + 1):
        g = bias + np.bincount(row, w[col], n)
        d = (1 / (1 + np.exp(-np.clip(g, -40, 40))) - toxic) / n
        grad = np.r_[np.bincount(col, d[row], len(feats)) + 3e-4 * w, d.sum()]
        if paired:
            change = np.bincount(row_a, w[col_a], len(paired)) - np.bincount(row_b, w[col_b], len(paired))
            change *= 2 * pairing / len(paired)
            grad[:-1] += np.bincount(col_a, change[row_a], len(feats)) - np.bincount(col_b, change[row_b], len(feats))
        u += 0.1 * (grad - u)
        v += 0.01 * (grad * grad - v)
        step = 0.1 * (u / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    return Model(dict(zip(feats.tolist(), w.tolist(), strict=True)), float(bias))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = 4_000, terms: list[str] = IDENTITY_TERMS, pairing: float = 1.0) -> Model:
    """Fit on a bounded sample of the labelled rows where ``learn`` holds: about ``bound`` toxic and about
    ``bound`` other texts, drawn by a hash of the id, so reruns agree.

    Null labels and ids are left out; where labels of an id differ, the larger counts. The sampled texts'
    feature hashes come to the driver, a few kilobytes each.
    """
    terms = list(terms)
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("_y"))
    ids = docs.where(learn & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"))
    marked = marks.join(ids, "_id", "left_semi")
    held = {r["_y"]: r["n"] for r in marked.groupBy((F.col("_y") == 1).cast("int").alias("_y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("_y") == 1, bound / max(1, held.get(1, 0))).otherwise(bound / max(1, held.get(0, 0)))
    picked = marked.where(key_hash("_id") < share)  # about 2 x bound short rows
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")

    def features(texts: list) -> dict[str, list]:
        pack = lambda t: np.array(sorted({f for w in _words(t) for f in word_features(w)}), np.uint32).tobytes()
        twin = [swapped(t, terms, len(t)) if t else None for t in texts]
        return {"own": [pack(t) for t in texts], "twin": [None if t is None else pack(t) for t in twin]}

    got = sorted(per_text(rows, "_text", "own binary, twin binary", features).collect(), key=lambda r: (r["_id"], r["own"]))
    as_array = lambda b: None if b is None else np.frombuffer(b, np.uint32)
    return fit_model([as_array(r["own"]) for r in got], [as_array(r["twin"]) for r in got], np.array([r["_y"] == 1 for r in got], float), pairing)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5) in place of column ``text``.

    Whole texts are read. A null or empty text holds no word and gets the score of that; repeated rows stay;
    an empty table stays empty. Without labels of both kinds the score is the same for all texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list) -> dict[str, list]:
        got = shared.value.scores(texts)
        return {"score": got, "predicted": [int(x >= 0.5) for x in got]}

    return per_text(docs, text, "score double, predicted int", run)
