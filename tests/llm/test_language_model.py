"""The recurrent network by itself: its gradients, its probabilities, and what it learns."""

import numpy as np

from ledgerlight.llm import language_model as lm


def network(seed=1, dtype=np.float64):
    rng = np.random.default_rng(seed)
    counts = lm.Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 5000, 900, (70.0, 40), (30.0, 284),
                       rng.integers(1, 50, lm.VOCABULARY).astype(float))
    net = lm.first_net(counts)
    return lm.Net(*[(p + 0.3 * rng.standard_normal(p.shape)).astype(dtype) for p in net.parts()])


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    net = network()
    ids = rng.choice([0, 1, 2, 30, 575, lm.VOCABULARY, lm.VOCABULARY + 1], (9, 4))
    target = rng.choice([0, 1, 2, 30, 575, lm.VOCABULARY, lm.VOCABULARY + 1], (9, 4))
    h = rng.standard_normal((4, lm.HIDDEN)) * 0.2

    def zeros():
        return lm.Net(*[np.zeros_like(p) for p in net.parts()])

    grads = zeros()
    lm.gradients(net, ids, target, h, grads)
    for p, g in zip(net.parts(), grads.parts(), strict=True):
        used = np.flatnonzero(g)
        for at in [*rng.choice(used, 12), *rng.integers(0, p.size, 4)]:
            kept, step, ends = p.flat[at], 1e-5, []
            for sign in (1, -1):
                p.flat[at] = kept + sign * step
                ends.append(lm.gradients(net, ids, target, h, zeros())[0])
            p.flat[at] = kept
            assert abs((ends[0] - ends[1]) / (2 * step) - g.flat[at]) < 1e-5


def test_probabilities_sum_to_one():
    net, h = network(), np.random.default_rng(3).standard_normal((5, lm.HIDDEN))
    every = np.arange(lm.VOCABULARY + 2)                     # each id, the last two as classes
    for row in h:
        out, _ = lm._outputs(net, np.repeat(row[None], len(every), axis=0), every)
        assert abs(np.exp(out).sum() - 1) < 1e-9


def test_likelihood_is_the_sum_over_single_texts():
    """Texts in lockstep, windows and one by one, token by token, give one likelihood; long texts too."""
    rng, net = np.random.default_rng(4), network()
    texts = [np.append(rng.integers(1, lm.VOCABULARY + 2, n), 0) for n in (0, 1, 5, 47, 48, 49, 700, 0, 3)]
    got = lm.likelihood(net, np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    for text, total in zip(texts, got, strict=True):
        h, before, want = np.zeros((1, lm.HIDDEN)), np.array([0]), 0.0
        for token in text:
            h = lm._step(net, net.x[before], h)[0]
            before = np.array([token])
            want += lm._outputs(net, h, before)[0][0]
        assert abs(total - want) < 1e-6


def test_gates_in_blocks_equal_the_formula():
    """Blocks by gate, updated in place, give the unit's states and gates; what is read is left as it was."""
    rng, net = np.random.default_rng(6), network()
    before, h = rng.integers(0, lm.VOCABULARY + 2, 7), rng.standard_normal((7, lm.HIDDEN))
    kept, g, hu = h.copy(), np.split(net.x[before], 3, axis=1), np.split(h @ net.u, 3, axis=1)
    z, r = (1 / (1 + np.exp(-(g[k] + hu[k]))) for k in (0, 1))
    n = np.tanh(g[2] + r * hu[2])
    gates, state = lm._blocks(net.x).take(before, axis=1), np.empty_like(h)
    share = lm._advance(lm._blocks(net.u), gates, h, state)
    for got, want in zip((state, *gates, share, h), (n + z * (h - n), z, r, n, hu[2], kept), strict=True):
        assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_scores_pick_what_the_whole_softmax_holds():
    rng = np.random.default_rng(8)
    v, row, at = rng.standard_normal((26, 300)).astype(np.float32), rng.integers(0, 26, 300), np.arange(300)
    whole = v.copy()
    kept = lm._picked(whole, row, at, True)
    assert np.allclose(np.exp(whole).sum(axis=0), 1, atol=1e-5)
    assert (lm._picked(v, row, at, False) == kept).all() and (kept == whole[row, at]).all()


def test_training_learns_an_order_that_counts_do_not_show():
    rng = np.random.default_rng(5)
    texts = [np.append((rng.integers(0, 20) + np.arange(30)) % 20 + 1, 0) for _ in range(4000)]
    stream = np.concatenate([[0], *texts])
    by_id = np.bincount(stream, minlength=lm.VOCABULARY).astype(float)
    counts = lm.Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), len(stream), 21, (0.0, 0), (0.0, 0), by_id)
    trainer = lm.Trainer(lm.first_net(counts).parts(), lm.RATE)
    bound = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    before = lm.likelihood(trainer.net, stream[1:], bound).sum()
    trainer.fit(stream)
    assert lm.likelihood(trainer.net, stream[1:], bound).sum() > 0.6 * before


def test_streams_shorter_than_the_lanes_are_whole():
    for n in (1, 2, 3, lm.LANES, lm.LANES + 1, 2 * lm.LANES + 7):
        trainer, seen = lm.Trainer(network(dtype=np.float32).parts(), lm.RATE), []
        update = trainer._update
        trainer._update = lambda ids, target, h, own=update, s=seen: (s.extend(target.ravel().tolist()), own(ids, target, h))[1]
        stream = np.arange(n) % 500
        trainer.fit(stream)
        assert sorted(seen) == sorted(stream[1:].tolist())
