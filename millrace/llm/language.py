"""Language of texts by a linear-chain conditional random field over their words.

Each word of a text gets a language; affix, character n-gram and lexicon features score the word,
learned transitions tie neighbours together, and forward-backward gives each word's language
probabilities, also where the text switches languages. A text's language is the one with the largest
mean probability over its words.

The chain runs over the whole text. It is evaluated in windows: the products of a window's transfer
matrices are taken for all windows at once, the windows' borders are joined in order, and then all
windows run forward and backward from their true borders. That is exact for any length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import key_hash, letters, per_text

WORD = re.compile(letters())
BUCKETS = 1 << 15
#: Words of a window.
WINDOW = 32
#: Words of a training sequence, and the mean length of its one-language runs.
LENGTH, RUN = 48, 12
#: Words that one lexicon holds.
LEXICON = 2000
ORDERS = (1, 2, 3, 4)
#: Text bytes whose distinct words are scored together.
SLICE = 1 << 20
#: Words whose features are held at once.
PART = 1 << 14
PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    return WORD.findall(text.lower()) if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * PRIME
    return x ^ (x >> np.uint64(32))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed feature, word number) of each word: character n-grams of the word in ^ and $, so that
    those at an edge are its affixes, and the word itself. Sorted by word."""
    raw = [b"^" + w.encode("utf-8", "replace") + b"$" for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    buf = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), size)
    place = np.arange(len(buf)) - np.repeat(np.cumsum(size) - size, size)
    feats, owners = [], []
    rolled = np.zeros(len(buf), np.uint64)
    for n in ORDERS:
        if n > len(buf):
            break
        rolled = rolled[: len(buf) - n + 1] * np.uint64(257) + buf[n - 1 :] + np.uint64(1)
        fits = place[: len(rolled)] + n <= size[owner[: len(rolled)]]
        feats.append(_mix(rolled[fits] + np.uint64(n << 56)) % np.uint64(BUCKETS))
        owners.append(owner[: len(rolled)][fits])
    if len(raw):
        power = np.cumprod(np.full(int(size.max()), 1099511628211, np.uint64))
        whole = np.add.reduceat(buf * power[place], np.cumsum(size) - size)
        feats.append(_mix(whole) % np.uint64(BUCKETS))
        owners.append(np.arange(len(raw)))
    if not feats:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    feats, owners = np.concatenate(feats).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return feats[order], owners[order]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (BUCKETS, languages)
    lexicons: list[frozenset]
    lexicon_weights: np.ndarray  # (languages, languages): in the lexicon of i, label j
    trans: np.ndarray  # (languages, languages), log

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potentials of each of the words."""
        out = np.zeros((len(words), len(self.langs)), self.weights.dtype)
        for at in range(0, len(words), PART):
            feats, owners = word_features(words[at : at + PART])
            if len(feats):
                first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
                out[at + owners[first]] = np.add.reduceat(self.weights[feats], first, axis=0)
        return out + self.in_lexicon(words) @ self.lexicon_weights

    def in_lexicon(self, words: list[str]) -> np.ndarray:
        if not hasattr(self, "sets"):  # each lexicon word to the number of its set of languages
            self.sets: list[tuple] = [()]
            self.known: dict[str, int] = {}
            for w in sorted(frozenset().union(*self.lexicons)):
                own = tuple(k for k, x in enumerate(self.lexicons) if w in x)
                if own not in self.sets:
                    self.sets.append(own)
                self.known[w] = self.sets.index(own)
        hot = np.zeros((len(self.sets), len(self.langs)), self.weights.dtype)
        for i, own in enumerate(self.sets):
            hot[i, list(own)] = 1
        get = self.known.get
        return hot[[get(w, 0) for w in words]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and its mean probability of each text; ``und`` and 0 without a letter."""
        number: dict[str, int] = {}
        rows = []
        for t in texts:
            found = words_of(t)
            for w in set(found).difference(number):
                number[w] = len(number)
            rows.append(np.array([number[w] for w in found], np.int32))
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        filled = [i for i, r in enumerate(rows) if len(r)]
        if filled and self.langs:
            e = self.emissions(list(number))
            e = np.exp(e - e.max(1, keepdims=True))
            mean = chain_means(e, [rows[i] for i in filled], np.exp(self.trans))
            for i, p in zip(filled, mean, strict=True):
                k = int(p.argmax())
                langs[i], scores[i] = self.langs[k], float(min(1.0, p[k]))
        return langs, scores


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def chain_means(e: np.ndarray, rows: list[np.ndarray], a: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Mean label probabilities of each sequence. ``e``: potentials by word number; ``a``: transitions."""
    n_labels = e.shape[1]
    size = np.array([len(r) for r in rows])
    n_win = -(-size // window)
    first = np.cumsum(n_win) - n_win
    m = int(n_win.sum())
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    win, step = np.repeat(first, size) + place // window, place % window
    pot = np.ones((window, m, n_labels), e.dtype)
    a = a.astype(e.dtype)
    pot[step, win] = e[np.concatenate(rows)]
    full = np.full(m, window)
    full[first + n_win - 1] = size - (n_win - 1) * window
    # 1. every window's product of transfer matrices
    prod = np.broadcast_to(np.eye(n_labels, dtype=e.dtype), (m, n_labels, n_labels)).copy()
    for s in range(window):
        act = np.flatnonzero(full > s) if s else slice(None)
        new = (prod[act].reshape(-1, n_labels) @ a).reshape(-1, n_labels, n_labels) * pot[s][act][:, None, :]
        prod[act] = new / new.max((1, 2), keepdims=True) if s % 8 == 7 else new
    prod /= prod.max((1, 2), keepdims=True)
    # 2. the windows' borders, in order along each sequence
    left = np.full((m, n_labels), 1.0 / n_labels, e.dtype)
    right = left.copy()
    for k in range(1, int(n_win.max())):
        at = first[n_win > k] + k
        left[at] = _unit(np.einsum("wi,wij->wj", left[at - 1], prod[at - 1]))
        at = (first + n_win - 1)[n_win > k] - k
        right[at] = _unit(np.einsum("wij,wj->wi", prod[at + 1], right[at + 1]))
    # 3. forward and backward inside all windows
    forward = np.empty_like(pot)
    x = left
    for s in range(window):
        x = _unit((x @ a) * pot[s])
        forward[s] = x
    total = np.zeros((m, n_labels))
    x = right.copy()
    for s in reversed(range(window)):
        act = full > s
        both = forward[s][act] * x[act]
        total[act] += _unit(both)
        x[act] = _unit((pot[s][act] * x[act]) @ a.T)
    return np.add.reduceat(total, first, axis=0) / size[:, None]


def fit_model(texts: list[str], langs: list[str], rounds: int = 40, seed: int = 7, sequences: int = 625) -> Model:
    """Learn from texts of one language each, spliced at random into at most ``sequences`` code-switched sequences a language."""
    names = sorted(set(langs))
    n = len(names)
    rng = np.random.default_rng(seed)
    docs = [(words_of(t), names.index(g)) for t, g in zip(texts, langs, strict=True)]
    docs = [d for d in docs if d[0]]
    if not docs:
        return Model([], np.zeros((BUCKETS, 0)), [], np.zeros((0, 0)), np.zeros((0, 0)))
    seen: list[dict[str, int]] = [{} for _ in names]
    for found, y in docs:
        for w in set(found):
            seen[y][w] = seen[y].get(w, 0) + 1
    lexicons = [frozenset(sorted((w for w in c if c[w] > 1), key=lambda w, c=c: (-c[w], w))[:LEXICON]) for c in seen]
    # sequences: runs of random lengths from random documents, every language as often
    by = [[d for d, y in docs if y == k] for k in range(n)]
    present = [k for k in range(n) if by[k]]
    n_seq = min(sequences * len(present), max(64, sum(len(d) for d, _ in docs) // LENGTH))
    seqs, labels = [], []
    for _ in range(n_seq):
        run, tags = [], []
        alone = rng.random() < 0.5  # half of the sequences are in one language
        y = present[rng.integers(len(present))]
        while len(run) < LENGTH:
            doc = by[y][rng.integers(len(by[y]))]
            take = min(LENGTH - len(run), int(rng.geometric(1.0 / RUN)))
            at = int(rng.integers(len(doc)))
            part = doc[at : at + take]
            run += part
            tags += [y] * len(part)
            if not alone:
                y = present[rng.integers(len(present))]
        seqs.append(run)
        labels.append(tags)
    number: dict[str, int] = {}
    ids = np.array([[number.setdefault(w, len(number)) for w in s] for s in seqs])
    gold = np.array(labels)
    vocab = list(number)
    feats, owners = word_features(vocab)
    first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
    model = Model(names, np.zeros((BUCKETS, n)), lexicons, np.zeros((n, n)), np.zeros((n, n)))
    inside = model.in_lexicon(vocab)
    params = [model.weights, model.lexicon_weights, model.trans]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    gold_hot = np.eye(n)[gold]
    pairs_gold = np.einsum("sti,stj->ij", gold_hot[:, :-1], gold_hot[:, 1:])
    scale = 1.0 / gold.size
    for it in range(1, rounds + 1):
        e = np.add.reduceat(model.weights[feats], first, axis=0) + inside @ model.lexicon_weights
        pot = np.exp(e - e.max(1, keepdims=True))[ids]
        a = np.exp(model.trans)
        fwd = np.empty_like(pot)
        x = np.full((n_seq, n), 1.0 / n)
        for t in range(LENGTH):
            x = _unit((x @ a) * pot[:, t])
            fwd[:, t] = x
        grad_e = np.empty_like(pot)
        pairs = np.zeros((n, n))
        b = np.full((n_seq, n), 1.0)
        for t in reversed(range(LENGTH)):
            grad_e[:, t] = _unit(fwd[:, t] * b)
            if t:
                after = pot[:, t] * b
                xi = fwd[:, t - 1][:, :, None] * a * after[:, None, :]
                pairs += (xi / xi.sum((1, 2), keepdims=True)).sum(0)
                b = _unit(after @ a.T)
        grad_e -= gold_hot
        by_word = np.stack([np.bincount(ids.ravel(), grad_e[:, :, k].ravel(), len(vocab)) for k in range(n)], 1)
        grads = [
            np.stack([np.bincount(feats, by_word[owners, k], BUCKETS) for k in range(n)], 1) * scale + 1e-6 * model.weights,
            inside.T @ by_word * scale + 1e-6 * model.lexicon_weights,
            (pairs - pairs_gold) * scale + 1e-6 * model.trans,
        ]
        for p, g, u, v in zip(params, grads, m1, m2, strict=True):
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            p -= 0.2 * (u / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


def excerpt(text: str | None, words: int, run: int = 40) -> str:
    """At most ``words`` words of a text, in runs spread evenly over the whole of it."""
    found = words_of(text)
    if len(found) <= words:
        return " ".join(found)
    starts = np.linspace(0, len(found) - run, max(1, words // run)).astype(int)
    return " ".join(w for at in starts for w in found[at : at + run])


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 400, words: int = 400, seed: int = 7, sequences: int = 625) -> Model:
    """Fit on a bounded sample: about ``per_lang`` documents of each language where ``learn`` holds,
    and of each at most ``words`` words, spread over the whole text; from these come at most ``sequences``
    training sequences of ``LENGTH`` words a language. All three bounds are of the fit alone.

    The sample is drawn by a hash of the id, so reruns agree; rows with a null language or id are left out.
    """
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(id_col).isNotNull())
    counts = rows.groupBy(lang).count()
    share = counts.select(F.col(lang).alias("_lang"), (F.lit(float(per_lang)) / F.col("count")).alias("_share"))
    # one row a language
    picked = rows.join(F.broadcast(share), F.col(lang) == F.col("_lang")).where(key_hash(id_col) < F.col("_share"))
    sample = picked.select(F.col(id_col).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    sample = per_text(sample, "_text", "part string", lambda texts: {"part": [excerpt(t, words) for t in texts]})
    got = sorted(sample.collect(), key=lambda r: (r["_id"], r["part"]))
    return fit_model([r["part"] for r in got], [r["_lang"] for r in got], seed=seed, sequences=sequences)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) in place of column ``text``, or beside
    it with ``keep``.

    Whole texts are read. A text that is null or has no letter gets ``und`` and 0, and so does every text
    where nothing could be learned. Repeated rows stay; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list) -> dict[str, list]:
        langs, scores = shared.value.predict(texts)
        return {"lang_pred": langs, "score": scores}

    return per_text(docs, text, "lang_pred string, score double", run, SLICE, keep)
