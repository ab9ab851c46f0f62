"""The packing plan against best-fit-decreasing, piece by piece."""

import bisect
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tallyseq.llm import packing, queries


def best_fit_decreasing(histogram, capacity=4096):
    gaps, number = Counter(), 0
    keys = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect.bisect_left(keys, length)
            if at == len(keys):
                number, gap = number + 1, capacity - length
            else:
                gap = keys[at] - length
                gaps[keys[at]] -= 1
                if not gaps[keys[at]]:
                    keys.pop(at)
            if not gaps[gap]:
                bisect.insort(keys, gap)
            gaps[gap] += 1
    return number


def drawn(values):
    return dict(Counter(np.clip(np.asarray(values).astype(int), 1, 4096).tolist()))


def histograms():
    draw = np.random.default_rng(0)
    mixed = np.concatenate([draw.exponential(300, 900) + 2, draw.integers(1, 4096, 60), np.full(100, 4096)])
    yield "mixed", drawn(mixed)
    yield "mixed x 100", {l: 100 * n for l, n in drawn(mixed).items()}
    yield "log-normal", drawn(np.exp(draw.normal(6, 1, 30_000)))
    yield "uniform", drawn(draw.integers(1, 4096, 10_000))
    yield "1000-1499", dict.fromkeys(range(1000, 1500), 100)
    yield "1300-2099", drawn(draw.integers(1300, 2100, 50_000))
    yield "one length", {2049: 7}


@pytest.mark.parametrize(("name", "histogram"), [*histograms()], ids=[n for n, _ in histograms()])
def test_plan_needs_no_more_than_best_fit(name, histogram):
    plan = packing.plan_sequences(histogram)
    placed = Counter()
    for number, content in plan:
        assert number > 0 and sum(l * c for l, c in content) <= 4096
        for length, c in content:
            placed[length] += number * c
    assert placed == Counter(histogram)
    assert sum(n for n, _ in plan) <= best_fit_decreasing(histogram)


def test_weights_make_the_plan(spark, monkeypatch):
    """The plan of the documents' own histogram is rounded from the weights' prices, at each size; where lengths price badly they move."""
    encoder = packing.ChunkEncoder.of(public_tokenizers.path(queries.PACK_TOKENIZER))
    lengths = [len(encoder.encode(r.text or "")) // 4 + 1 for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    histogram = Counter(l % 4096 for l in lengths if l % 4096) + Counter({4096: sum(l // 4096 for l in lengths)})
    made = []
    monkeypatch.setattr(packing, "weighted_prices", lambda *a, own=packing.weighted_prices: made.append((own(*a), a[0])) or made[-1][0])
    for times, most in ((1, 221), (100, 22_056), (1000, 220_557)):
        began = time.perf_counter()
        plan = packing.plan_sequences({l: times * n for l, n in histogram.items()})
        assert sum(n for n, _ in plan) <= most and time.perf_counter() - began < 30
        prices = dict(zip(made[-1][1].tolist(), made[-1][0].tolist(), strict=True))
        priced = [sum(c * prices[l] for l, c in content) for n, content in plan if content != ((4096, 1),) for _ in range(1)]
        assert max(priced) <= 1 + 1e-9 and np.median(priced) > 0.98  # columns of the program at these prices
    packing.plan_sequences(dict.fromkeys(range(1300, 2100), 100))
    prices, sizes = made[-1]
    assert len(made) == 4 and np.ptp(prices / sizes) > 0.1 * (prices / sizes).mean()


@pytest.mark.parametrize("direct", [True, False])
def test_memory_of_the_encoder(monkeypatch, direct):
    """Unspaced texts are not remembered; what is stays under a bound of bytes."""
    monkeypatch.setattr(packing, "MEMO_BYTES", 1 << 20)
    encoder = packing.ChunkEncoder(public_tokenizers.path(queries.PACK_TOKENIZER))
    encoder.direct = direct
    encoder.memo = encoder._fresh_memo()
    for k in range(40):
        text = "".join(chr(0x4E00 + (k * 7919 + i * 31) % 20_000) for i in range(20_000))
        lines = "\n".join(text[i : i + 1000] for i in range(0, len(text), 1000))
        for one in (text, lines, " ".join(f"w{k}x{i}" for i in range(3000))):
            encoder.encode(one)
            assert sum(len(c.encode()) + len(i) for c, i in encoder.memo.items()) < 3 << 20
    assert encoder.encode("w1x1 is new") == np.array(encoder.tokenizer.encode("w1x1 is new", add_special_tokens=False).ids, "<u4").tobytes()


def test_dynamic_program_equals_brute_force():
    sizes, prices = np.array([3, 5, 7]), np.array([2.0, 4.0, 5.0])
    best = packing.best_values(prices, sizes, 30)
    for room in range(31):
        want = max(2 * a + 4 * b + 5 * c for a in range(11) for b in range(7) for c in range(5) if 3 * a + 5 * b + 7 * c <= room)
        assert best[room] == want
    assert packing.plan_sequences({}) == [] and packing.plan_sequences({4096: 2}) == [(2, ((4096, 1),))]


@pytest.mark.parametrize("direct", [True, False])
def test_chunks_equal_the_tokenizer(direct):
    encoder = packing.ChunkEncoder(public_tokenizers.path(queries.PACK_TOKENIZER))
    assert encoder.direct
    encoder.direct = direct
    encoder.memo = encoder._fresh_memo()
    texts = ["a.b c,,d don't I'm it's 'tis x's.", "İstanbul ß ŒUVRE ÀÉ é́ é. ǅ Ǆ ŉ", "中文 a中  x \x1c y \xa0z", "", "  ", "\n\n a", "!!! A! ÿ? Ÿ?", "ſ ﬁ ª º µ \U0001f600", "3.14 2024-01-01 a1b2 under_score CamelCase"]
    for text, got in zip(texts, encoder.encode_all(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
