"""NumPy steps against plain loops, and their edge cases."""

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nestmeans.functions import fingerprint as fpm
from nestmeans.operators import kernels as K
from nestmeans.operators import limbs as L
from nestmeans.operators import spaces as S
from nestmeans.operators import bounds, training


def brute_nearest(x, centers):
    d = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 60), st.integers(1, 30), st.integers(1, 9), st.integers(0, 10_000))
def test_nearest_is_brute_force(n, k, d, seed):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-9, 9, (n, d)).astype(float), rng.integers(-9, 9, (k, d)).astype(float)
    index, dist = K.nearest(x, c)
    want_index, want_dist = brute_nearest(x, c)
    assert (index == want_index).all() and (dist == want_dist).all()


def test_nearest_over_blocks(monkeypatch):
    monkeypatch.setattr(K, "_BLOCK_CENTERS", 3)
    monkeypatch.setattr(K, "_BLOCK_CELLS", 6)
    rng = np.random.default_rng(1)
    x, c = rng.integers(0, 3, (50, 4)).astype(float), rng.integers(0, 3, (20, 4)).astype(float)
    index, dist = K.nearest(x, c)
    want_index, want_dist = brute_nearest(x, c)
    assert (index == want_index).all() and (dist == want_dist).all()


def test_divide_truncates_toward_zero():
    assert K.divide(np.array([[-7.0, 7.0]]), np.array([2])).tolist() == [[-3, 3]]


def test_refill_splits_the_largest():
    centers = np.array([[10, 10], [0, 0], [2048, -4096], [5, 5]])
    out = K.refill(centers.copy(), np.array([3, 0, 9, 1]))
    assert out.tolist() == [[10, 10], [2050, -4100], [2046, -4092], [5, 5]]


def test_refill_needs_two_rows():
    centers = np.array([[1, 1], [0, 0]])
    assert K.refill(centers.copy(), np.array([1, 0])).tolist() == centers.tolist()


def test_matrix_rejects_wrong_width_and_null():
    with pytest.raises(ValueError):
        K.matrix(pa.array([[1, 2], [3]]), 2)
    with pytest.raises(ValueError):
        K.matrix(pa.array([[1, 2], None]), 2)
    with pytest.raises(ValueError):
        K.matrix(pa.array([[1, None]]), 2)
    sliced = pa.array([[1, 2], [3, 4], [5, 6]]).slice(1, 2)
    assert K.matrix(sliced, 2).tolist() == [[3, 4], [5, 6]]


def test_grid_rejects_nan_and_overflow():
    with pytest.raises(ValueError):
        K.on_grid(np.array([[np.nan]]), 10)
    with pytest.raises(ValueError):
        K.on_grid(np.array([[1e9]]), 10_000)


def test_k_equal_to_n_keeps_the_rows():
    x = np.arange(12.0).reshape(6, 2)
    for space in (S.Grid(1), S.Plain()):
        centers, sizes, objective = training.lloyd(space, x, x, 5)
        assert (centers == x).all() and (sizes == 1).all() and objective == 0


def test_first_rows_breaks_ties_by_id():
    mask = K.first_rows(np.array([0, 0, 1]), np.array([2.0, 2.0, 5.0]), np.array([9, 4, 1]))
    assert mask.tolist() == [False, True, True]


def brute_bits(text, n_bits, max_len):
    bits = set()
    for q in range(1, max_len + 1):
        for i in range(len(text) - q + 1):
            h = 0
            for ch in text[i : i + q]:
                h = (h * fpm.BASE + ord(ch)) % fpm.MODULUS
            bits.add((h * fpm.MULTIPLIER) % 2**32 * n_bits // 2**32)
    return [int(i in bits) for i in range(n_bits)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=6), st.integers(1, 4))
def test_qgram_is_brute_force(texts, max_len):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = fpm.qgram_matrix(pa.array(texts, pa.string()), 64, max_len)
    assert got.tolist() == [brute_bits(t, 64, max_len) for t in texts]


def test_qgram_over_windows(monkeypatch):
    monkeypatch.setattr(fpm, "_WINDOW", 4)
    texts = ["hello wörld", "", "x", "ab" * 9, "日本語テキスト"]
    got = fpm.qgram_matrix(pa.array(texts), 64, 3)
    assert got.tolist() == [brute_bits(t, 64, 3) for t in texts]


def brute_words(text, n_bits):
    bits = set()
    for word in text.split():
        h = 0
        for ch in word:
            h = (h * fpm.BASE + ord(ch)) % fpm.MODULUS
        bits.add((h * fpm.MULTIPLIER) % 2**32 * n_bits // 2**32)
    return [int(i in bits) for i in range(n_bits)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é日\u3000\t😀", max_size=30), min_size=1, max_size=6))
def test_token_is_brute_force(texts):
    got = fpm.token_matrix(pa.array(texts, pa.string()), 64)
    assert got.tolist() == [brute_words(t, 64) for t in texts]


def test_token_over_windows(monkeypatch):
    monkeypatch.setattr(fpm, "_WINDOW", 4)
    texts = ["hello wörld a b", "", " x ", "ab" * 50, "   ", "a\nb c"]
    got = fpm.token_matrix(pa.array(texts), 64)
    assert got.tolist() == [brute_words(t, 64) for t in texts]


def test_work_space_is_bounded_by_the_rows():
    import tracemalloc

    x, c = np.ones((100, 256)), np.zeros((1, 256))
    tracemalloc.start()
    K.nearest(x, c)
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert top < 20e6


def test_exact_totals():
    dist = np.full((3, 1), float((1 << 53) - 1))
    sums = L.grouped_sums(dist, np.zeros(3, dtype=int), 1)
    assert L.value({limb: part[0, 0] for limb, part in sums.items()}) == float(3 * ((1 << 53) - 1))
    assert L.value({}) == 0.0


numbers = st.floats(-1e30, 1e30, allow_subnormal=False) | st.floats(-1, 1, width=32) | st.integers(-9, 9).map(float)


@settings(max_examples=150, deadline=None)
@given(st.lists(numbers, min_size=1, max_size=30), st.randoms(), st.integers(1, 10**9))
def test_means_are_exact_whatever_the_spread_and_order(values, rnd, more):
    """Against fractions, also when parts are summed apart and merged."""
    want = float(sum(map(Fraction, values)) / more)
    rnd.shuffle(values)
    cut = rnd.randrange(len(values) + 1)
    merged = {}
    for part in (values[:cut], values[cut:]):
        for limb, total in L.grouped_sums(np.array(part).reshape(-1, 1), np.zeros(len(part), dtype=int), 1).items():
            merged[limb] = merged.get(limb, 0) + total
    got = L.quotient(merged, np.array([more]))[0, 0] if merged else 0.0
    assert got == want


def test_limbs_of_narrow_data_are_few():
    assert [limb for limb, _ in L.split(np.array([0.0, 1.0, 255.0]))] == [0]
    assert len(list(L.split(np.random.default_rng(0).uniform(0.01, 1, 1000).astype(np.float32)))) <= 3
    assert list(L.split(np.zeros(4))) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 30), st.integers(1, 9), st.integers(0, 10_000), st.sampled_from([0, 1e6, 1e-6, 1e12]))
def test_plain_nearest_is_the_lowest_of_exact_distances(n, k, d, seed, offset):
    """Far from the origin and beside outliers, where a product of matrices alone would lose the difference."""
    rng = np.random.default_rng(seed)
    x, c = rng.normal(offset, 1e-3, (n, d)), rng.normal(offset, 1e-3, (k, d))
    c[rng.random(k) < 0.3] = x[0]
    c[-1] = 1e15
    space = S.Plain()
    index, dist = space.nearest(x, space.prepare(c))
    for i in range(n):
        all_ = [sum_in_order(x[i], y) for y in c]
        assert dist[i] == min(all_) and index[i] == all_.index(min(all_))


def sum_in_order(a, b):
    total = 0.0
    for p, q in zip(a.tolist(), b.tolist()):
        total += (p - q) * (p - q)
    return total


def test_plain_nearest_over_blocks(monkeypatch):
    monkeypatch.setattr(K, "_BLOCK_CENTERS", 3)
    monkeypatch.setattr(K, "_BLOCK_CELLS", 6)
    rng = np.random.default_rng(1)
    x, c = rng.integers(0, 3, (50, 4)).astype(float), rng.integers(0, 3, (20, 4)).astype(float)
    index, dist = S.Plain().nearest(x, S.Plain().prepare(c))
    want_index, want_dist = brute_nearest(x, c)
    assert (index == want_index).all() and (dist == want_dist).all()


def test_plain_rejects_nan_and_infinity():
    for bad in (np.nan, np.inf, 1e200):
        with pytest.raises(ValueError):
            S.Plain().load(np.array([[bad]]))


@pytest.mark.parametrize("space", [S.Plain(), S.Grid(1)])
@pytest.mark.parametrize("seed", range(6))
def test_bounds_give_the_full_search(space, seed):
    """Pass after pass, with copies of centres, ties and a centre that jumps."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-6, 7, (400, 3)).astype(float) if seed % 2 else np.round(rng.normal(0, 500, (400, 5)))
    centers = x[rng.choice(len(x), 25)].copy()
    at, dist, low = bounds.Search(space, centers, None).full(x)
    for turn in range(8):
        moved = centers + rng.integers(-2, 3, centers.shape) * (rng.random((25, 1)) < 0.4)
        if turn == 3:
            moved[rng.integers(25)] = x[0]
        search = bounds.Search(space, moved, bounds.moves(centers, moved))
        at, dist, low, _ = search.update(x, at, low)
        want_at, want_dist = brute_nearest(x, moved)
        assert (at == want_at).all() and (dist == want_dist).all()
        every = np.sqrt(((x[:, None, :] - moved[None]) ** 2).sum(2))
        every[np.arange(len(x)), at] = np.inf
        assert (low <= every.min(axis=1)).all()
        centers = moved


def test_bounds_spare_four_fifths_of_the_distances():
    """After the fifth pass with 1,000 centres, in loose clusters."""
    rng = np.random.default_rng(2)
    heart = rng.normal(0, 4, (300, 16))
    x = heart[rng.integers(0, 300, 20_000)] + rng.normal(0, 1, (20_000, 16))
    space, k = S.Plain(), 1000
    centers, drift, measured = x[:k].copy(), None, []
    for _ in range(10):
        search = bounds.Search(space, centers, drift)
        if drift is None:
            at, dist, low = search.full(x)
        else:
            at, dist, low, more = search.update(x, at, low)
            measured.append((len(x) + more) / (len(x) * k))
        want = space.nearest(x, search.ready)
        assert (at == want[0]).all() and (dist == want[1]).all()
        ids, counts, sums = S.cluster_sums(space, x, at)
        moved = centers.copy()
        moved[ids] = space.mean(sums, counts, 16)
        drift, centers = bounds.moves(centers, moved), moved
    assert max(measured[4:]) < 0.2, measured


def test_rows_of_bits_take_single_precision():
    """Zeros and ones times whole centres are exact in single precision, up to 2**24."""
    rng = np.random.default_rng(11)
    space = S.Grid(10_000)
    x = (rng.random((300, 512)) < rng.random((300, 1))) * space.one
    for centers in (x[:150].copy(), rng.integers(0, 10_001, (2500, 512)).astype(np.float64), np.full((70, 512), 7.0)):
        ready = space.prepare(centers)
        assert K.narrow(x, ready, space.one)
        for got, want in zip(space.nearest(x, ready), K.nearest_prepared(x, ready)):
            assert got.tolist() == want.tolist()
    x[3, 5] = 9_999
    assert not K.narrow(x, ready, space.one)
    x[3, 5] = 0
    assert not K.narrow(x, space.prepare(np.full((70, 512), 40_000.0)), space.one)
