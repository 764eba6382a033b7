"""The operators' cores against brute force, on small inputs."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe, language, quality, simhash, topk, toxicity, warc


def test_bpe_equals_library_and_round_trips():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ours = bpe.Codec(ranks, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["", " ", "a", "The cat's 12 mice\n\n  ran!", "<|endoftext|>", "é" * 300, "a" * 5000, "\u3000\x1c x\u00a0y", "😀🏽" * 40]
    for alphabet in ("ab", "abc ", "aé\n ", "0123 .", "thing \u00df"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    for text, ids in zip(texts, ours.encode_all(texts), strict=True):
        assert ids.tolist() == theirs.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()
    assert ours.encode(None).tolist() == []


def test_rank_queue_orders_by_rank_then_position():
    q, rng = bpe.RankQueue(50_000), random.Random(1)
    items = [(rng.randrange(50_000), i) for i in range(500)] + [(7, 900), (7, 800)]
    for r, p in items:
        q.push(r, p)
    got = []
    while (x := q.pop()) is not None:
        got.append(x)
    assert got == sorted(items)


def _fingerprint(text, k):
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b\tC d", "x y z w v u \x0b É é", "same " * 50, "\u00a0a b"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == _fingerprint(text, 4)


def test_near_pairs_and_forest_equal_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    v = np.unique(np.concatenate([base] + [b ^ (np.uint64(1) << rng.integers(0, 64, 20, dtype=np.uint64)) for b in base] + [b ^ np.uint64(0b111) for b in base[:, None]]))
    group = np.sort(rng.integers(0, 3, len(v)))
    order = np.lexsort((simhash.gray_rank(v), group))
    v = v[order]
    i, j = simhash.near_pairs(group, v, 4)
    want = {(a, b) for a in range(len(v)) for b in range(a + 1, len(v)) if group[a] == group[b] and bin(int(v[a] ^ v[b])).count("1") <= 4}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_chain_means_equal_plain_forward_backward():
    rng = np.random.default_rng(0)
    e, a = rng.random((50, 3)) + 0.1, rng.random((3, 3)) + 0.1
    rows = [rng.integers(0, 50, k) for k in (1, 5, 32, 33, 200)]

    def plain(r):
        forward, x = [], np.full(3, 1 / 3)
        for w in r:
            x = (x @ a) * e[w]
            x /= x.sum()
            forward.append(x)
        b, total = np.ones(3), 0
        for t in reversed(range(len(r))):
            g = forward[t] * b
            total = total + g / g.sum()
            b = (e[r[t]] * b) @ a.T
            b /= b.sum()
        return total / len(r)

    assert np.allclose(language.chain_means(e, rows, a), [plain(r) for r in rows])


def test_language_without_letters_or_learning():
    model = language.fit_model(["the cat and the dog " * 5, "der hund und die katze " * 5], ["en", "de"], rounds=20)
    langs, scores = model.predict(["the dog and the cat", "die katze und der hund", None, "", "12 !?"])
    assert langs == ["en", "de", "und", "und", "und"] and scores[2:] == [0, 0, 0]
    assert language.fit_model([], []).predict(["the"]) == (["und"], [0.0])


def test_quality_prior_and_separation():
    rng = np.random.default_rng(1)
    good = rng.normal(0, 1, (4000, quality.FIGURES))
    mixed = np.concatenate([rng.normal(0, 1, (2100, quality.FIGURES)), rng.normal(2, 1, (900, quality.FIGURES))])
    model = quality.fit_model(good, mixed)
    assert abs(model.prior - 0.7) < 0.1
    assert (model.scores(rng.normal(0, 1, (500, quality.FIGURES))) >= 0.5).mean() > 0.9
    assert (model.scores(rng.normal(2, 1, (500, quality.FIGURES))) < 0.5).mean() > 0.9
    assert quality.fit_model(good[:0], mixed).scores(mixed[:3]).tolist() == [0.5] * 3
    assert quality.figures(None) == quality.figures("") == [0.0] * quality.FIGURES


def test_pairing_evens_out_group_terms():
    pack = lambda t: np.array(sorted({f for w in toxicity._words(t) for f in toxicity.word_features(w)}), np.uint32)
    texts = (["muslim awful person today"] * 30 + ["awful thing here"] * 30 + ["muslim neighbour came today"] * 5 + ["christian neighbour came today"] * 60) * 3
    toxic = np.array(([1.0] * 60 + [0.0] * 65) * 3)
    terms = ["muslim", "christian"]
    twins = [toxicity.swapped(t, terms, len(t)) for t in texts]
    assert twins[0] == "christian awful person today" and twins[30] is None
    gap = []
    for weight in (0.0, 20.0):
        m = toxicity.fit_model([pack(t) for t in texts], [None if t is None else pack(t) for t in twins], toxic, weight)
        a, b = m.scores(["muslim neighbour came", "christian neighbour came"])
        gap.append(abs(a - b))
    assert gap[1] < gap[0] / 2
    assert m.scores([None, ""])[0] == m.scores([""])[0]


def test_block_topk_equals_sorting():
    rng = np.random.default_rng(2)
    c = rng.integers(-60, 60, (900, 8))
    c[100:300] = c[100]  # many equal vectors
    ids = rng.permutation(900)
    q = ids % 20 == 0
    at, found, score = topk.block_topk(c[q], ids[q], c, ids, 20)
    s = c[q] @ c.T
    for i, own in enumerate(ids[q]):
        ok = ids != own
        best = sorted(zip(-s[i][ok], ids[ok], strict=True))[:20]
        assert sorted(zip(-score[at == i], found[at == i], strict=True)) == best
    # floors that the true scores reach leave nothing out; half of the pairs or more are never multiplied where vectors cluster
    kth = np.array([np.sort(s[i][ids != own])[-20] for i, own in enumerate(ids[q])], float)
    assert sorted(zip(*map(list, topk.block_topk(c[q], ids[q], c, ids, 20, kth)))) == sorted(zip(*map(list, (at, found, score))))
    far = rng.integers(-1000, 1000, (8, 8))
    x = far[rng.integers(0, 8, 4000)] + rng.integers(-9, 9, (4000, 8))
    counts = {}
    topk.block_topk(x[:200], np.arange(200), x, np.arange(4000), 20, counts=counts)
    assert counts["all"] == 800_000 and counts["done"] < 400_000
    big = np.array([[1 << 30, 1 << 30]])
    assert topk._products(big, big)[0, 0] == 1 << 61


def test_cover_tree_keeps_its_invariants():
    rng = np.random.default_rng(3)
    x = np.r_[rng.integers(-50, 50, (700, 5)), np.zeros((200, 5), int)]
    t = topk.CoverTree(x, leaf=8)
    assert sorted(t.order) == list(range(900)) and len(t.radii) > 50
    for node, children in enumerate(t.children):
        lo, hi = t.span[node]
        assert topk._distances(x[t.order[lo:hi]], t.centres[node]).max() <= t.radii[node]
        if not children:
            assert hi - lo <= 8 or t.radii[node] == 0
            continue
        assert (t.centres[children[0]] == t.centres[node]).all() and len(children) <= topk.FANOUT
        assert [t.span[children[0]][0], t.span[children[-1]][1]] == [lo, hi]
        for i, child in enumerate(children):
            assert t.radii[child] <= t.cover[node]
            assert all(topk._distances(t.centres[child], t.centres[o]) >= t.cover[node] for o in children[:i])


@pytest.mark.parametrize("url", [None, "http://a/b%0A", "x\r\ny: z", ""])
def test_warc_record_round_trip(url):
    import hashlib

    payload = b"\r\n\r\nWARC/1.1\r\n" * 3
    digest = hashlib.sha1(payload).hexdigest()
    got = warc.parse(warc.record(5, url, payload, digest, None, False))
    assert (got["page_id"], got["url"], got["payload"], got["payload_digest"], got["record_type"]) == (5, url, payload, digest, "response")
    got = warc.parse(warc.record(None, url, payload, digest, 9, True))
    assert (got["page_id"], got["payload_bytes"], got["refers_to"], got["payload"]) == (None, len(payload), 9, None)
    with pytest.raises(ValueError):
        warc.parse(warc.record(5, url, payload, "00" * 20, None, False))


def test_group_terms_have_their_forms():
    terms = toxicity.IDENTITY_TERMS
    assert len(set(terms)) == len(terms) and all(t == t.lower() for t in terms)
    assert {"jew", "jews", "muslima", "gypsies", "gays", "roma", "indians", "homosexual", "women"} <= set(terms)


def test_neutral_mentions_are_no_false_positives():
    """Toxic texts name one group far more often; neutral mentions of it in other texts must not pay for that."""
    pack = lambda t: np.array(sorted({f for w in toxicity._words(t) for f in toxicity.word_features(w)}), np.uint32)
    rng = np.random.default_rng(1)
    plain = "house river table garden music paper window winter bread mountain letter market".split()
    some = lambda n: " ".join(rng.choice(plain, n))
    texts = [f"{some(4)} gypsies {'awful' if rng.random() < 0.6 else some(1)} {some(3)}" for _ in range(150)] + [f"{some(8)}" for _ in range(150)]
    toxic = np.array([1.0] * 150 + [0.0] * 150)
    twins = [toxicity.swapped(t, list(toxicity.IDENTITY_TERMS), len(t)) for t in texts]
    assert sum(t is not None for t in twins) == 150
    neutral = [f"{some(4)} gypsies {some(4)}" for _ in range(100)]
    wrong = []
    for weight in (0.0, 20.0):
        m = toxicity.fit_model([pack(t) for t in texts], [None if t is None else pack(t) for t in twins], toxic, weight)
        wrong.append(sum(s >= 0.5 for s in m.scores(neutral)))
        assert sum(s >= 0.5 for s in m.scores([t for t in texts if "awful" in t])) >= 60
    print("neutral mentions called toxic without and with pairing:", wrong)
    assert wrong[0] >= 90 and wrong[1] <= wrong[0] / 2
