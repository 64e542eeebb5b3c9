import random
from collections import Counter

import numpy as np

from burnlens.llm import contexts, mixing
from tests.llm.test_llm_scores import plain_events


def chunks_of(texts, held=()):
    counters = mixing.Counter(), mixing.Counter()
    for counter, some in zip(counters, (texts, held)):
        for _, _, stream, begin in mixing.streams(list(some)):
            counter.add(stream, begin)
    out = []
    for counter, train in zip(counters, (1, 0)):
        out += [contexts.Chunk(kind, keys, number * train) for kind, keys, number in counter.rows() if keys]
    return out


def counts_of(chunks, n_bits):
    """Every chunk's counts, with the entries dealt to shards."""
    out = [np.zeros((9, len(c.codes)), np.int64) for c in chunks]
    for shard in range(1 << n_bits):
        inside = [np.flatnonzero(c.codes >> np.uint64(56) >> np.uint64(8 - n_bits) == shard) for c in chunks]
        for k, counts in enumerate(contexts.answered([(c.codes[i], c.numbers()[i]) for c, i in zip(chunks, inside)])):
            out[k][:, inside[k]] = counts
    return out


def sample(n, seed=4):
    rnd = random.Random(seed)
    words = ["the", "of", "The", "überall", "stone", "stones", "a" * 20, "!?"]
    return [" ".join(rnd.choice(words) + rnd.choice(["", "", "s", "x"]) for _ in range(rnd.randint(0, 30))).encode() for _ in range(n)]


def occurrences(texts):
    for t in texts:
        yield from zip(*(a.tolist() for a in plain_events(None, t)))


def contexts_of(window, word):
    for order in range(mixing.ORDERS):
        kind = window >> 48 if order in mixing.CLASS_ORDERS else 0
        yield order, kind, word if order == mixing.ORDERS - 1 else window >> 8 & (1 << 8 * (order + 1)) - 1


def test_counts_of_every_context_are_exact():
    texts, held = sample(40), [b"stone of unseen thee", b"", b"the overall"]
    want = Counter()
    for window, word in occurrences(texts):
        for context in contexts_of(window, word):
            for k in range(9):
                want[context, k, (window & 255) >> (8 - k)] += 1
    chunks = chunks_of(texts, held)
    for n_bits in (0, 3):
        for chunk, counts in zip(chunks, counts_of(chunks, n_bits)):
            for j, (window, word) in enumerate(zip(chunk.window.tolist(), chunk.word.tolist())):
                for order, context in enumerate(contexts_of(window, word)):
                    got = counts[:, chunk.index[order, j]].tolist()
                    assert got == [want[context, k, (window & 255) >> (8 - k)] for k in range(9)]


def test_many_contexts_do_not_fall_on_one_another():
    """Each of very many words stays alone in its context."""
    rng = np.random.default_rng(1)
    words = {bytes(w) for w in rng.integers(97, 123, (400_000, 9), np.uint8)}
    window, word, _ = mixing.rests([w + b" " for w in words], np.zeros(len(words), np.uint64))
    last = (window & np.uint64(255)) == 32
    codes = contexts.entry_codes(window[last], word[last])[mixing.ORDERS - 1]
    assert len(np.unique(codes)) == len(words)
    assert contexts.shard_bits(10**6) < contexts.shard_bits(10**8) < contexts.shard_bits(10**10)


def inputs_of(chunks, counts):
    out = {}
    for c, n in zip(chunks, counts):
        for at, x in c.parts(n, True):
            for j, e in enumerate(at):
                out[int(c.window[e]), int(c.word[e])] = x[:, j : j + 1]
    return out


def cost(mixer, inputs, every):
    """Bits of all bytes, one by one, before they are refined."""
    total = 0.0
    for window, word in every:
        x = inputs[window, word]
        bit = mixing.bits(np.array([window], np.uint64))[0]
        mix = mixer.mix(x)[1][0]
        total += np.logaddexp(0, np.where(bit, -mix, mix)).sum()
    return total


def test_the_mixer_learns_from_every_byte_with_its_number(monkeypatch):
    monkeypatch.setattr(contexts, "STEP_EVENTS", 64)
    texts = sample(60)
    chunks = chunks_of(texts)
    counts = counts_of(chunks, 2)
    mixer = mixing.Learner.merged(sum(contexts.learned(c, n) for c, n in zip(chunks, counts)))
    every, fresh = list(occurrences(texts)), mixing.Mixer.fresh()
    assert np.isclose((mixer.hits - fresh.hits).sum(), 8 * len(every))  # all bits of all bytes, not of the distinct ones
    ones = sum((window & 255).bit_count() for window, _ in every)
    assert np.isclose((mixer.ones - fresh.ones).sum(), ones)
    inputs = inputs_of(chunks, counts)
    assert cost(mixer, inputs, every) < 0.9 * cost(fresh, inputs, every)


def test_one_pass_comes_near_the_best_weights():
    """Made-up inputs with known weights: a pass of steps, learned in three stretches apart, finds them."""
    rng = np.random.default_rng(3)
    true = rng.normal(0.4, 0.2, (mixing.GATES, mixing.ORDERS))
    learners = [mixing.Learner() for _ in range(3)]
    for k in range(60):
        x = rng.normal(0, 1.5, (mixing.ORDERS, 2000, 8)).astype(np.float32)
        x[:, rng.random(2000) < 0.5] *= rng.random((mixing.ORDERS, 1, 1)) < 0.7
        gate = mixing.gates(x)
        mix = sum(true[gate, j] * x[j] for j in range(mixing.ORDERS))
        learners[k % 3].step(x, rng.random(mix.shape) < mixing.squash(mix), np.ones(2000))
    merged = mixing.Learner.merged(sum(one.summary() for one in learners))
    busy = np.bincount(gate.ravel(), minlength=mixing.GATES) > 500
    assert busy.sum() >= 8 and np.abs(merged.weights - true)[busy].max() < 0.1


def test_a_frequent_event_does_not_throw_the_weights():
    learner = mixing.Learner()
    x = np.full((mixing.ORDERS, 1, 8), -5.0, np.float32)
    learner.step(x, np.ones((1, 8), bool), np.array([1e9]))
    assert np.abs(learner.mixer.weights - mixing.Mixer.fresh().weights).max() <= mixing.STEP_LIMIT
