"""Binary alignments: every split size gives the records of the file, in order; what is written reads back."""

import gzip
import random
import struct

import pytest
from pyspark.errors import PySparkException

from tallyseq.__main__ import main
from tallyseq.sources import bam, files

HEADER = "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:900000\n@SQ\tSN:chr2\tLN:5000\n"


def _rows(n: int, seed: int = 5) -> list[tuple]:
    dice = random.Random(seed)
    made = []
    for i in range(n):
        k = dice.choice([0, 1, 7, 60, 150, 151]) if i % 97 else 90_001
        seq = "".join(dice.choices("ACGTN", k=k)) or "*"
        qual = "".join(chr(dice.randrange(33, 75)) for _ in range(k)) if k and i % 5 else "*"
        contig, mate = dice.choice(["chr1", "chr2", "*"]), dice.choice(["=", "*", "chr2"])
        mate = "*" if contig == "*" and mate == "=" else "=" if mate == contig != "*" else mate
        tags = {"NH": str(dice.randrange(-5, 2**32 - 1)), "XT": f"G{i},G2", "AS": "1.5", "XA": "x", "XB": "s,-3,4"} if i % 3 else {}
        kinds = {"NH": "i", "XT": "Z", "AS": "f", "XA": "A", "XB": "B"} if i % 3 else {}
        made.append((f"q{i}_{'x' * (i % 90)}", dice.randrange(4096), contig, dice.randrange(-1, 10**6), dice.randrange(256), f"{k}M2D" if k else "*", mate, dice.randrange(-1, 99), dice.randrange(-500, 500), seq, qual, tags, kinds))
    return made


def _plain(df) -> list[tuple]:
    return [tuple(r)[1:] for r in df.orderBy("ord").collect()]


def test_round_trip_over_splits(spark, tmp_path):
    rows = _rows(1500)
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).coalesce(1), str(tmp_path / "out"), HEADER)
    paths = files.expand_paths(spark, str(tmp_path / "out"), (".bam",))
    assert len(paths) == 1 and bam.bam_header(paths[0]) == HEADER
    size = (tmp_path / "out" / "part-000000.bam").stat().st_size
    for split in (0, size // 40, size // 7, 10**9):
        assert _plain(bam.read_bam(spark, paths, split)) == rows
    with pytest.raises(FileExistsError):
        bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA), str(tmp_path / "out"), HEADER)


def _by_hand(names: list[str], cut: int) -> bytes:
    """A file made without the writer: a header, then records of nothing but a name, in blocks of ``cut`` bytes wherever those end."""
    body = b"BAM\x01" + struct.pack("<i", len(HEADER)) + HEADER.encode() + struct.pack("<i", 2)
    body += b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in (("chr1", 900000), ("chr2", 5000)))
    for i, name in enumerate(names):
        tag = b"NHC" + bytes([i % 200]) if i % 2 else b"NHs" + struct.pack("<h", -i % 30000)
        record = struct.pack("<iiBBHHHiiii", 0, i, len(name) + 1, 60, 4681, 1, 0, 4, -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", 4 << 4) + b"\x12\x48" + bytes([30] * 4) + tag
        body += struct.pack("<i", len(record)) + record
    return b"".join(bam.compressed(body[k : k + cut]) for k in range(0, len(body), cut)) + bam.LAST_BLOCK


@pytest.mark.parametrize("cut", [1, 37, 1000, 65280])
def test_blocks_that_end_inside_records(spark, tmp_path, cut):
    names = [f"read{i}" for i in range(60 if cut == 1 else 3000)]
    (tmp_path / "x.bam").write_bytes(_by_hand(names, cut))
    with gzip.open(tmp_path / "x.bam") as f:
        assert f.read(4) == b"BAM\x01"
    size = (tmp_path / "x.bam").stat().st_size
    for split in (0, size // 9 + 1):
        found = bam.read_bam(spark, [str(tmp_path / "x.bam")], split).orderBy("ord").collect()
        assert [(r.qname, r.pos, r.seq, r.qual, r.cigar) for r in found] == [(n, i, "ACGT", "????", "4M") for i, n in enumerate(names)]
        assert [r.tags["NH"] for r in found] == [str(i % 200 if i % 2 else -i % 30000) for i in range(len(names))]


def test_odd_files(spark, tmp_path):
    whole = _by_hand([f"r{i}" for i in range(500)], 400)
    (tmp_path / "cut.bam").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "other.bam").write_bytes(bam.compressed(b"SAM\x01xxxxxxxx"))
    for name in ("cut", "other"):
        with pytest.raises(PySparkException):
            bam.read_bam(spark, [str(tmp_path / f"{name}.bam")]).collect()
    (tmp_path / "none.bam").write_bytes(_by_hand([], 50))
    assert bam.read_bam(spark, [str(tmp_path / "none.bam")], 30).count() == 0


def test_nulls_long_steps_and_contigs_that_are_not_in_the_header(spark, tmp_path):
    steps = "1M1I" * 40_000
    rows = [(None,) * 13, ("long", 0, "chr1", 5, 1, steps, "*", -1, 0, "A" * 80_000, "*", {"X1": None, "X2": "t"}, None)]
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).coalesce(1), str(tmp_path / "odd"), HEADER)
    found = _plain(bam.read_bam(spark, files.expand_paths(spark, str(tmp_path / "odd"), (".bam",)), 1000))
    assert found == [("*", 0, "*", -1, 0, "*", "*", -1, 0, "*", "*", {}, {}), ("long", 0, "chr1", 5, 1, steps, "*", -1, 0, "A" * 80_000, "*", {"X2": "t"}, {"X2": "Z"})]
    with pytest.raises(PySparkException):
        bam.write_bam(spark.createDataFrame([("q", 0, "chr9", 1, 1, "*", "*", -1, 0, "*", "*", {}, {})], bam.SCHEMA), str(tmp_path / "bad"), HEADER)
    assert not [p for p in (tmp_path / "bad").glob("*") if p.is_file()] and not [*(tmp_path / "bad").glob("_job*/*")]
    bam.write_bam(spark.createDataFrame([], bam.SCHEMA), str(tmp_path / "empty"), HEADER)


def test_tags_command_rewrites_records(spark, tmp_path):
    fields = "chr1\t11\t60\t4M\t=\t21\t14\tACGT\tIIII"
    names = ("r1_ACGTAC_TTTTTT_F+R", "r2_ACGTAC_NTTTTT_F+R")
    lines = [f"{names[0]}\t99\t{fields}\tNH:i:2\tXT:Z:G2", f"{names[0]}\t99\t{fields}\tNH:i:2\tXT:Z:G1", f"{names[0]}\t147\t{fields}", f"{names[1]}\t99\t{fields}\tXF:Z:old\tXS:B:c,1,-2"]
    (tmp_path / "in.sam").write_text(HEADER + "".join(f"{x}\n" for x in lines))
    main(["tags", str(tmp_path / "in.sam"), str(tmp_path / "out.bam"), "--cell", "s1"])
    main(["tags", str(tmp_path / "in.sam"), str(tmp_path / "out.sam"), "--cell", "s1"])
    found = [r for p in files.expand_paths(spark, str(tmp_path / "out.bam"), (".bam",)) for r in bam.read_bam(spark, [p]).orderBy("ord").collect()]
    own = {"CB": "s1", "US": "ACGTAC", "PR": "F+R"}
    assert [(r.qname, r.flag, dict(r.tags)) for r in found] == [
        ("r1", 99, {"NH": "2", **own, "UC": "ACGTACTTTTTT", "XT": "G2", "XF": "G1,G2,F+R"}),
        ("r1", 99 | 256, {"NH": "2", **own, "UC": "ACGTACTTTTTT", "XT": "G1"}),
        ("r1", 147, {}),
        ("r2", 99, {**own, "XS": "c,1,-2", "XN": "-1", "XT": "Unassigned", "XF": "Unassigned,F+R"}),
    ]
    assert found[3].tag_types["XN"] == "i" and found[3].tag_types["XS"] == "B" and found[0].contig == "chr1" and found[0].seq == "ACGT"
    text = "".join(p.read_text() for p in sorted((tmp_path / "out.sam").glob("part-*")))
    assert text.startswith(HEADER) and len(text.splitlines()) == 7 and "\tNH:i:2\t" in text and "\tXN:i:-1\t" in text and "\tXS:B:c,1,-2\t" in text
    (tmp_path / "again.sam").write_text(text)
    assert sorted((r.qname, r.flag, sorted(r.tags.items())) for r in files.read_sam(spark, [str(tmp_path / "again.sam")]).collect()) == sorted((r.qname, r.flag, sorted(r.tags.items())) for r in found)
    with pytest.raises(ValueError, match="apart"):
        bam.read_alignments(spark, ["a.bam", "b.sam"])
