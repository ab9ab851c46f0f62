"""Primer assignment by index against edit distances of every window."""

import random

import numpy as np
import pytest

from tallyseq.operators import primer_index


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(read, names, primers, rate, overlap):
    best = None
    for name, primer in zip(names, primers, strict=True):
        n = len(primer)
        for m in range(min(overlap, n), n + 1):
            e = int(rate * m + 1e-9)
            for start in range(len(read)) if m == n else [0]:
                for size in range(m - e, m + e + 1):
                    if start + size <= len(read):
                        d = edits(read[start : start + size], primer[n - m :])
                        if d <= e:
                            rank = (d - m, d, start, abs(size - m), name, size)
                            if best is None or rank < best[0]:
                                best = (rank, (name, read[start : start + size], start, d))
    return best[1] if best else ("no_adapter", "", None, None)


@pytest.fixture(scope="module")
def cases():
    dice = random.Random(7)
    some = lambda n: "".join(dice.choice("ACGT") for _ in range(n))
    primers = sorted(some(dice.randint(14, 20)) for _ in range(12)) + ["ACGTACGTACGTACGT", "ACGTACGTACGTACGA"]
    names = [f"P{i:02d}" for i in range(len(primers))]
    reads = ["", "ACG", "N" * 40, "ACGTACGTACGTACGTACGTACGTACGT"]
    for _ in range(60):
        p = list(dice.choice(primers))
        for _ in range(dice.choice([0, 0, 1, 2, 3])):
            at, kind = dice.randrange(len(p)), dice.choice("sid")
            if kind == "s":
                p[at] = dice.choice("ACGTN")
            elif kind == "i":
                p.insert(at, dice.choice("ACGT"))
            else:
                p.pop(at)
        cut = dice.choice([0, 0, 1, 3])
        reads.append("".join(p[cut:]) + some(12) if cut else some(dice.randint(0, 8)) + "".join(p) + some(dice.randint(0, 10)))
    return names, primers, reads


@pytest.mark.parametrize(("rate", "overlap"), [(0.125, 12), (0.125, 99), (0.0, 14), (0.2, 11)])
def test_every_window(cases, rate, overlap):
    names, primers, reads = cases
    index = primer_index.Index(primers, rate, overlap)
    told = index.best([r.encode() for r in reads])
    for read, (entry, errors, start, size) in zip(reads, told.tolist(), strict=True):
        got = (names[index.rank[entry]], read[start : start + size], start, errors) if entry >= 0 else ("no_adapter", "", None, None)
        want = brute(read, names, primers, rate, overlap)
        assert got == want, read


def test_both_mates(spark, cases):
    names, primers, reads = cases
    rows = [(i, r, reads[-1 - i].lower()) for i, r in enumerate(reads)] + [(None, None, None)]
    pairs = spark.createDataFrame(rows, "read_id long, r1_seq string, r2_seq string")
    panel = spark.createDataFrame([*zip(names, primers, strict=True)], "adapter string, primer string")
    got = {r.read_id: r for r in primer_index.assign_pairs(pairs, panel.where("adapter < 'P07'"), panel, 0.125, 12).collect()}
    assert len(got) == len(rows) and got[None].adapter1 == got[None].adapter2 == "no_adapter"
    few = [n for n in names if n < "P07"]
    for i, r in enumerate(reads):
        assert (got[i].adapter1, got[i].match1, got[i].start1, got[i].errors1) == brute(r, few, primers[: len(few)], 0.125, 12)
        assert (got[i].adapter2, got[i].match2, got[i].start2, got[i].errors2) == brute(reads[-1 - i], names, primers, 0.125, 12)
    empty = primer_index.assign_pairs(pairs, panel.limit(0), panel, 0.1, 12)
    assert {r.adapter1 for r in empty.collect()} == {"no_adapter"}
    assert primer_index.assign_pairs(pairs.limit(0), panel, panel).count() == 0


def test_bounds(spark, monkeypatch):
    with pytest.raises(ValueError, match="whole"):
        primer_index.Index(["AC"], 1.0, 2)
    monkeypatch.setattr(primer_index, "MOST_BASES", 10)
    panel = spark.createDataFrame([("P", "ACGTACGTACGT")], "adapter string, primer string")
    pairs = spark.createDataFrame([(1, "A", "A")], "read_id long, r1_seq string, r2_seq string")
    with pytest.raises(ValueError, match="bases"):
        primer_index.assign_pairs(pairs, panel, panel)


def test_many_reads_are_cut_into_steps(spark, monkeypatch):
    reads = ["ACGTACGTACGTACGT" + "T" * 30] * 50
    monkeypatch.setattr(primer_index, "TOGETHER", 100)
    index = primer_index.Index(["ACGTACGTACGTACGT"], 0.1, 16)
    assert np.array_equal(index.best([r.encode() for r in reads]), np.tile(index.best([reads[0].encode()]), (50, 1)))


def test_candidates_are_few_beside_a_large_panel():
    dice = random.Random(3)
    some = lambda n: "".join(dice.choice("ACGT") for _ in range(n))
    primers = [some(20) for _ in range(3000)]
    index = primer_index.Index(primers, 0.1, 20)
    reads = [some(4) + p[:5] + some(1) + p[5:14] + p[15:] + some(20) for p in primers[:200]]  # a base more between pieces, one less in another
    codes = primer_index.CODES[np.frombuffer("".join(reads).encode(), np.uint8)]
    sizes = np.array([len(r) for r in reads])
    assert len(index.candidates(codes, np.cumsum(sizes) - sizes, sizes)[0]) < 10 * len(reads)
    told = index.best([r.encode() for r in reads])
    assert (told[:, 0] >= 0).all() and [primers[index.rank[t]] for t in told[:, 0]] == primers[:200]


def worn(dice, primer, errors):
    p = list(primer)
    for _ in range(errors):
        at, kind = dice.randrange(len(p)), dice.choice("sid")
        p[at : at + 1] = {"s": [dice.choice("ACGTX")], "i": [dice.choice("ACGT"), p[at]], "d": []}[kind]
    return "".join(p)


def test_neighbours_of_pieces_lose_no_place(cases):
    """Two errors at all places of primers of 20 to 27 bases, also at the read's ends and at its start, against every window."""
    dice = random.Random(11)
    some = lambda n: "".join(dice.choice("ACGT") for _ in range(n))
    primers = [some(n) for n in (20, 22, 24, 27)] + ["ACGTNACGTACGTTACGTAC"]
    names = [f"P{i}" for i in range(len(primers))]
    reads = [some(dice.choice([0, 1, 7])) + worn(dice, dice.choice(primers), 2) + some(dice.choice([0, 3])) for _ in range(70)]
    reads += [worn(dice, dice.choice(primers)[2:], 2) + some(5) for _ in range(20)]
    reads = [r.replace("N", "A") for r in reads]  # the primer's N equals no base
    index = primer_index.Index(primers, 0.1, 20)
    for read, (entry, errors, start, size) in zip(reads, index.best([r.encode() for r in reads]).tolist(), strict=True):
        got = (names[index.rank[entry]], read[start : start + size], start, errors) if entry >= 0 else ("no_adapter", "", None, None)
        assert got == brute(read, names, primers, 0.1, 20), read


def test_pairs_of_pieces_by_chance_are_no_candidates(monkeypatch):
    dice = random.Random(4)
    some = lambda n: "".join(dice.choice("ACGT") for _ in range(n))
    primers = ["ACGTA" + some(10) + "TTGCA" for _ in range(2000)]
    reads = [some(3) + worn(dice, p, 2) + some(9) for p in primers[:300]]
    index = primer_index.Index(primers, 0.1, 20)
    codes = primer_index.CODES[np.frombuffer("".join(reads).encode(), np.uint8)]
    sizes = np.array([len(r) for r in reads])
    assert len(index.candidates(codes, np.cumsum(sizes) - sizes, sizes)[0]) < 100 * len(reads)  # some 690 by pieces alone
    told = index.best([r.encode() for r in reads])
    monkeypatch.setattr(primer_index, "NEIGHBOUR", 99)  # none is told
    assert np.array_equal(told, primer_index.Index(primers, 0.1, 20).best([r.encode() for r in reads]))
