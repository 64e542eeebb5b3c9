"""Inner steps of the language model: packed numbers, bits and gates by short numbers."""

import numpy as np
import pytest

from burnlens.llm import contexts, mixing


@pytest.mark.parametrize("dtype", [np.uint8, np.int32, np.int64, np.uint64])
def test_packed_numbers_come_back_without_their_empty_ranks(dtype):
    rng = np.random.default_rng(3)
    most = int(np.iinfo(dtype).max)
    signed = [[-1, 5, int(np.iinfo(dtype).min)]] if np.iinfo(dtype).min < 0 else []
    for numbers in ([], [0], [255, 0, 1], [most, 0, 7], rng.integers(0, min(most, 70_000), 999), *signed):
        a = np.array(numbers, dtype)
        back = mixing.unpacked(mixing.packed(a), dtype)
        assert back.dtype == a.dtype and np.array_equal(back, a)
    assert mixing.packed(np.array([200], dtype))[0] == 1  # one rank, whatever the type's width
    assert mixing.packed(np.array([most], dtype))[0] == np.dtype(dtype).itemsize


def test_bits_are_those_of_the_lowest_byte():
    window = np.random.default_rng(4).integers(0, 1 << 62, 500).astype(np.uint64)
    want = [[bool(int(w) >> (7 - k) & 1) for k in range(8)] for w in window]
    assert mixing.bits(window).tolist() == want


def test_step_learns_each_gate_from_its_own_events():
    """One step against a loop over the gates that selects their events one by one."""
    rng = np.random.default_rng(5)
    x = np.where(rng.random((mixing.ORDERS, 400, 8)) < 0.3, 0, rng.normal(size=(mixing.ORDERS, 400, 8))).astype(np.float32)
    bit, number = rng.random((400, 8)) < 0.4, rng.integers(1, 9, 400)
    learner, plain = mixing.Learner(), mixing.Learner()
    gate, mix = plain.mixer.mix(x)
    learner.step(x, bit, number)
    for g in np.unique(gate):
        event, k = np.nonzero(gate == g)
        part, times, p = x[:, event, k].astype(float), number[event], mixing.squash(mix[event, k])
        plain.curve[g] += (part * (times * p * (1 - p))) @ part.T
        move = np.linalg.solve(plain.curve[g], part @ (times * bit[event, k] - times * p))
        plain.mixer.weights[g] += np.clip(move, -mixing.STEP_LIMIT, mixing.STEP_LIMIT)
    assert np.allclose(learner.mixer.weights, plain.mixer.weights, rtol=1e-9) and np.allclose(learner.curve, plain.curve, rtol=1e-9)
    assert mixing.GATES <= 256  # gates are sorted as single bytes


def test_inputs_take_the_sign_of_their_bit():
    chunk = contexts.Chunk(mixing.TOKEN, [b"\0the ", b"\0then ", b"\0a "], np.array([5, 2, 1]))
    counts = next(contexts.answered([(chunk.codes, chunk.numbers())]))
    value = contexts.entry_inputs(counts, False)
    for at, x in chunk.parts(counts, False):
        plain = value[chunk.index[:, at]]
        want = np.where(mixing.bits(chunk.window[at]), plain, -plain)
        want[want == -contexts.BALANCED] = contexts.BALANCED
        assert np.array_equal(x, want)


def test_distinct_numbers_have_a_place_and_a_rank():
    for a in (np.zeros(0, np.uint64), np.random.default_rng(6).integers(0, 50, 400).astype(np.uint64)):
        values, at, back = contexts.distinct(a)
        assert np.array_equal(values, np.unique(a)) and np.array_equal(a[at], values) and np.array_equal(values[back], a)


@pytest.mark.parametrize("others", [False, True])
def test_inputs_of_unknown_contexts_are_0(others):
    counts = np.array([[0, 1, 4, 9]] + [[0, 1, 4, 3]] * 8, np.int64)
    c = np.maximum(counts - 1, 0) if others else counts
    value = contexts.entry_inputs(counts, others)
    for j in range(4):
        for k in range(8):
            plain = np.float32(np.log((c[k + 1, j] + contexts.PRIOR) / (c[k, j] - c[k + 1, j] + contexts.PRIOR))) if c[k, j] else np.float32(0)
            assert value[j, k] == plain
