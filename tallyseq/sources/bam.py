"""Binary alignments as a data source: block-compressed files are read in splits and written as a folder of whole files.

A split begins at the first record that its own blocks hold. Where that is, its bytes alone tell with
near certainty only; so each split, when it ends, looks up where the next one begins and compares that with the place
that it has come to. All splits agreeing, no record is lost or read twice; else the read raises.
Files are opened in the tasks, by Arrow's file systems.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs as stores
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tallyseq.sources import files

FORMAT = "tallyseq_bam"
SCHEMA = (
    "qname string, flag int, contig string, pos long, mapq int, cigar string, mate_contig string, mate_pos long, "
    "template_length long, seq string, qual string, tags map<string,string>, tag_types map<string,string>"
)
ARROW = pa.schema(
    [("qname", pa.string()), ("flag", pa.int32()), ("contig", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("mate_contig", pa.string()), ("mate_pos", pa.int64()), ("template_length", pa.int64()), ("seq", pa.string()), ("qual", pa.string())]
    + [(n, pa.map_(pa.string(), pa.string())) for n in ("tags", "tag_types")]
)

# Fixed values of the format: letters of bases and of alignment steps, kinds of numbers, first bytes, the empty last block.
BASES = "=ACMGRSVTWYHKDBN"
STEPS = "MIDNSHP=X"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
BLOCK_MAGIC, FILE_MAGIC = b"\x1f\x8b\x08\x04", b"BAM\x01"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK_BYTES = 65280

TO_BASES = str.maketrans("0123456789abcdef", BASES)
FROM_BASES = {ord(b): f"{i:x}" for i, b in enumerate(BASES)} | {ord(b.lower()): f"{i:x}" for i, b in enumerate(BASES)}
TO_QUALITY = bytes(min(q + 33, 126) for q in range(256))
FROM_QUALITY = bytes(max(q - 33, 0) for q in range(256))
FIELDS, RECORD = struct.Struct("<iiiBBHHHiiii"), struct.Struct("<iiBBHHHiiii")
#: Records that must follow one another for a place to be taken as a record's start.
CHAIN = 8
#: Longest record, bytes read at once, rows of a batch.
MOST_BYTES, CHUNK, ROWS = 1 << 28, 1 << 22, 4096


def _opened(path: str) -> tuple[stores.FileSystem, str]:
    return stores.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


class BlockFile:
    """Blocks of a file by their address."""

    def __init__(self, path: str):
        store, name = _opened(path)
        self.path, self.file = path, store.open_input_file(name)
        self.size = self.file.size()
        self._at, self._chunk = 0, b""

    def _bytes(self, at: int, n: int) -> bytes:
        if at < self._at or at + n > self._at + len(self._chunk):
            self._at, self._chunk = at, self.file.read_at(min(max(n, CHUNK), max(self.size - at, 0)), at)
        return self._chunk[at - self._at : at - self._at + n]

    def block(self, at: int) -> tuple[bytes, int] | None:
        """What the block at an address holds, and the address after it; None if no whole block is there."""
        head = self._bytes(at, 12)
        if len(head) < 12 or head[:4] != BLOCK_MAGIC:
            return None
        extra = self._bytes(at + 12, struct.unpack_from("<H", head, 10)[0])
        length, k = 0, 0
        while k + 6 <= len(extra):
            n = struct.unpack_from("<H", extra, k + 2)[0]
            if extra[k : k + 2] == b"BC" and n == 2:
                length = struct.unpack_from("<H", extra, k + 4)[0] + 1
            k += 4 + n
        body = self._bytes(at + 12 + len(extra), length - 12 - len(extra)) if length >= 20 + len(extra) else b""
        if not body or len(body) < length - 12 - len(extra):
            return None
        try:
            data = zlib.decompress(body[:-8], -15)
        except zlib.error:
            return None
        return (data, at + length) if struct.unpack("<II", body[-8:]) == (zlib.crc32(data), len(data)) else None

    def first_block(self, at: int) -> int:
        """The first address from ``at`` on that holds a whole block; the file's size if none does."""
        while at < self.size:
            found = self._bytes(at, CHUNK).find(BLOCK_MAGIC)
            if found >= 0 and self.block(at + found):
                return at + found
            at += found + 1 if found >= 0 else max(len(self._bytes(at, CHUNK)) - 3, 1)
        return self.size


class Stream:
    """Bytes from a block on, which know the address of their block; only the part in use is held."""

    def __init__(self, file: BlockFile, at: int):
        self.file, self.next, self.pos = file, at, 0
        self.buf, self._marks = bytearray(), deque()

    def fill(self, n: int) -> bool:
        """Hold ``n`` bytes from the present one on; False if the file ends before."""
        while len(self.buf) - self.pos < n:
            if self.next >= self.file.size:
                return False
            found = self.file.block(self.next)
            if found is None:
                raise ValueError(f"{self.file.path}: no block at {self.next}")
            if self.pos > CHUNK:
                self._marks = deque((at - self.pos, address) for at, address in self._marks)
                del self.buf[: self.pos]
                self.pos = 0
            if found[0]:
                self._marks.append((len(self.buf), self.next))
                self.buf += found[0]
            self.next = found[1]
        return True

    def place(self) -> tuple[int, int]:
        """(address of the block, offset in it) of the present byte; the file's size and 0 at the end."""
        if not self.fill(1):
            return self.file.size, 0
        while len(self._marks) > 1 and self._marks[1][0] <= self.pos:
            self._marks.popleft()
        return self._marks[0][1], self.pos - self._marks[0][0]

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError(f"{self.file.path}: the file ends inside a record")
        self.pos += n
        return bytes(self.buf[self.pos - n : self.pos])

    def number(self) -> int:
        return struct.unpack("<i", self.take(4))[0]


@dataclass
class Header:
    text: str
    contigs: list[tuple[str, int]]
    place: tuple[int, int]


def _header(file: BlockFile) -> Header:
    s = Stream(file, 0)
    if not s.fill(8) or s.take(4) != FILE_MAGIC:
        raise ValueError(f"{file.path}: not a file of binary alignments")
    text = s.take(s.number()).rstrip(b"\0").decode()
    contigs = [(s.take(s.number())[:-1].decode(), s.number()) for _ in range(s.number())]
    return Header(text, contigs, s.place())


def _length_at(s: Stream, ahead: int, contigs: int) -> int:
    """Bytes of the record that may begin ``ahead`` bytes on: 0 at the end of the file, -1 if none can."""
    if not s.fill(ahead + FIELDS.size):
        return 0 if len(s.buf) - s.pos == ahead else -1
    size, ref, pos, name, _, _, steps, _, bases, mate, mate_pos, _ = FIELDS.unpack_from(s.buf, s.pos + ahead)
    parts = 32 + name + 4 * steps + (bases + 1) // 2 + bases
    if not (-1 <= ref < contigs and -1 <= mate < contigs and pos >= -1 and mate_pos >= -1 and name > 1 and bases >= 0 and parts <= size <= MOST_BYTES):
        return -1
    if not s.fill(ahead + 36 + name + 4 * steps):
        return -1
    at = s.pos + ahead + 36
    named = s.buf[at + name - 1] == 0 and all(33 <= c <= 126 for c in s.buf[at : at + name - 1])
    stepped = all(s.buf[k] & 15 < len(STEPS) for k in range(at + name, at + name + 4 * steps, 4))
    return size + 4 if named and stepped else -1


def _begins(s: Stream, contigs: int) -> bool:
    ahead = 0
    for _ in range(CHAIN):
        n = _length_at(s, ahead, contigs)
        if n <= 0:
            return n == 0 and ahead > 0
        ahead += n
    return True


def _first_record(file: BlockFile, at: int, header: Header) -> tuple[int, int]:
    """Place of the first record whose first byte lies in a block from address ``at`` on."""
    if at <= header.place[0]:
        return header.place
    s = Stream(file, file.first_block(at))
    while s.fill(1):
        if _begins(s, len(header.contigs)):
            return s.place()
        s.pos += 1
    return file.size, 0


def _records(file: BlockFile, header: Header, start: int, end: int) -> Iterator[bytes]:
    """Records whose first byte lies in a block with an address in [start, end)."""
    address, offset = _first_record(file, start, header)
    s = Stream(file, address)
    if s.fill(offset):
        s.pos = offset
    while (here := s.place())[0] < end:
        yield s.take(s.number())
    if end < file.size and here != _first_record(file, end, header):
        raise ValueError(f"{file.path}: splits disagree at {end}; read it with one split (split_bytes=0)")


def _tags(data: bytes, at: int) -> Iterator[tuple[str, str, str]]:
    """(name, kind, value as text) of the tags from a place on; whole numbers are of kind ``i``."""
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode("latin-1"), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode("utf-8", "replace"), end + 1
        elif kind in "cC":
            value, at = str(data[at] - (256 if kind == "c" and data[at] > 127 else 0)), at + 1
        elif kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind == "B":
            sub, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[sub]}", data, at + 5)
            value, at = ",".join([sub, *(_number(v) for v in values)]), at + 5 + n * struct.calcsize(NUMBERS[sub])
        else:
            value, at = _number(struct.unpack_from(f"<{NUMBERS[kind]}", data, at)[0]), at + struct.calcsize(NUMBERS[kind])
        yield name, kind if kind in "ZHABf" else "i", value


def _number(value: float) -> str:
    return str(value) if isinstance(value, int) else f"{value:.9g}"


@lru_cache(4096)
def _steps_text(packed: bytes) -> str:
    return "".join(f"{v >> 4}{STEPS[v & 15]}" for v in struct.unpack(f"<{len(packed) // 4}I", packed))


def _row(data: bytes, contigs: list[tuple[str, int]]) -> tuple:
    ref, pos, name, mapq, _, n, flag, bases, mate, mate_pos, length = RECORD.unpack_from(data)
    at = 32 + name
    steps = _steps_text(data[at : at + 4 * n]) if n < 256 else _steps_text.__wrapped__(data[at : at + 4 * n])
    at += 4 * n
    seq = data[at : at + (bases + 1) // 2].hex().translate(TO_BASES)[:bases]
    at += (bases + 1) // 2
    qual = data[at : at + bases]
    found = {k: (kind, v) for k, kind, v in _tags(data, at + bases)}
    if n == 2 and steps.startswith(f"{bases}S") and found.get("CG", ("", ""))[1].startswith("I,"):
        steps = "".join(f"{int(v) >> 4}{STEPS[int(v) & 15]}" for v in found.pop("CG")[1].split(",")[1:])
    contig = contigs[ref][0] if ref >= 0 else "*"
    mate_contig = "*" if mate < 0 else "=" if mate == ref else contigs[mate][0]
    quality = qual.translate(TO_QUALITY).decode() if bases and qual[0] != 255 else "*"
    tags, kinds = [(k, v) for k, (_, v) in found.items()], [(k, kind) for k, (kind, _) in found.items()]
    return data[32 : 31 + name].decode("latin-1"), flag, contig, pos, mapq, steps or "*", mate_contig, mate_pos, length, seq or "*", quality, tags, kinds


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ROWS rows and about CHUNK bytes of bases."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[9]) + 100
        if len(held) == ROWS or size > CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), ARROW, strict=True)], schema=ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), ARROW, strict=True)], schema=ARROW)


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.splits = [Split(*s) for s in json.loads(options["splits"])]

    def partitions(self) -> list[Split]:
        return self.splits

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        file = BlockFile(partition.path)
        header = _header(file)
        yield from _batches(_row(r, header.contigs) for r in _records(file, header, partition.start, partition.end))


@lru_cache(4096)
def _steps(cigar: str) -> tuple[list[int], int]:
    """Steps as numbers, and how many places of the contig they take."""
    steps = [] if cigar == "*" else [int(n) << 4 | STEPS.index(s) for n, s in re.findall(r"(\d+)(\D)", cigar)]
    return steps, sum(s >> 4 for s in steps if STEPS[s & 15] in "MDN=X")


def _tag(name: str, kind: str, value: str) -> bytes:
    head = name.encode("latin-1")
    if kind == "i":
        number = int(value)
        return head + (b"i" + struct.pack("<i", number) if number < 1 << 31 else b"I" + struct.pack("<I", number))
    if kind == "f":
        return head + b"f" + struct.pack("<f", float(value))
    if kind == "B":
        sub, *values = value.split(",")
        return head + b"B" + sub.encode() + struct.pack(f"<i{len(values)}{NUMBERS[sub]}", len(values), *(float(v) if sub == "f" else int(v) for v in values))
    return head + kind.encode() + (value.encode("latin-1") if kind == "A" else value.encode() + b"\0")


def _bin(start: int, end: int) -> int:
    """The smallest bin of the index that holds [start, end]: bins of 16 kb, then each eight times as wide."""
    for bits in (14, 17, 20, 23, 26):
        if start >> bits == end >> bits:
            return ((1 << 29 - bits) - 1) // 7 + (start >> bits)
    return 0


def _values(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _entries(maps: pa.MapArray) -> Iterator[list[tuple]]:
    """Pairs of each map, none for null."""
    ends, keys, values = _values(maps.offsets), _values(maps.keys), _values(maps.items)
    first = ends[0] if ends else 0
    for start, end, ok in zip(ends, ends[1:], _values(maps.is_valid()), strict=False):
        yield [*zip(keys[start - first : end - first], values[start - first : end - first], strict=True)] if ok else []


def _plain_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows with nulls as the format writes them; maps are lists of pairs."""
    none = {"pos": -1, "mate_pos": -1}
    fill = lambda c, f: _values(c.fill_null("*" if pa.types.is_string(f.type) else none.get(f.name, 0)))
    return zip(*[_entries(c) if pa.types.is_map(f.type) else fill(c, f) for c, f in zip(batch.columns, batch.schema, strict=True)], strict=True)


def _encoded(row: tuple, ids: dict[str, int]) -> bytes:
    """The bytes of a row of ``_plain_rows``."""
    qname, flag, contig, pos, mapq, cigar, mate_contig, mate_pos, length, seq, qual, tags, kinds = row
    name, (steps, span) = qname.encode("latin-1"), (_steps if len(cigar) < 1000 else _steps.__wrapped__)(cigar)
    if len(name) > 254:
        raise ValueError(f"a name of {len(name)} characters; the format has room for 254")
    ref = ids[contig]
    mate = ref if mate_contig == "=" else ids[mate_contig]
    bases = 0 if seq == "*" else len(seq)
    if qual != "*" and len(qual) != bases:
        raise ValueError(f"{qname}: {bases} bases, {len(qual)} qualities")
    kind_of = dict(kinds)
    packed_tags = b"".join([_tag(k, kind_of.get(k) or "Z", v) for k, v in tags if v is not None])
    if len(steps) > 65535:
        packed_tags += b"CGBI" + struct.pack(f"<i{len(steps)}I", len(steps), *steps)
        steps = [bases << 4 | STEPS.index("S"), span << 4 | STEPS.index("N")]
    packed = bytes.fromhex((seq + "=" * (bases % 2)).translate(FROM_BASES)) if bases else b""
    quality = qual.encode("latin-1").translate(FROM_QUALITY) if qual != "*" else b"\xff" * bases
    place = _bin(pos, pos + max(span, 1) - 1) & 65535
    fixed = RECORD.pack(ref, pos, len(name) + 1, mapq, place, len(steps), flag, bases, mate, mate_pos, length)
    body = b"".join((fixed, name, b"\0", struct.pack(f"<{len(steps)}I", *steps), packed, quality, packed_tags))
    return struct.pack("<i", len(body)) + body


def compressed(data: bytes) -> bytes:
    """One block of at most BLOCK_BYTES bytes."""
    body = b""
    for level in (6, 0):
        z = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = z.compress(data) + z.flush()
        if len(body) + 26 <= 65536:
            break
    head = BLOCK_MAGIC + bytes([0, 0, 0, 0, 0, 255, 6, 0]) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def header_bytes(text: str) -> tuple[bytes, dict[str, int]]:
    """A file's first bytes and the number of each contig, by the @SQ lines of its header's text."""
    found = [(dict(f.split(":", 1) for f in line.split("\t")[1:])) for line in text.splitlines() if line.startswith("@SQ\t")]
    raw = text.encode()
    out = [FILE_MAGIC, struct.pack("<i", len(raw)), raw, struct.pack("<i", len(found))]
    out += [struct.pack("<i", len(f["SN"].encode()) + 1) + f["SN"].encode() + b"\0" + struct.pack("<i", int(f["LN"])) for f in found]
    return b"".join(out), {"*": -1} | {f["SN"]: i for i, f in enumerate(found)}


@dataclass
class Written(WriterCommitMessage):
    part: str
    name: str


class BamWriter(DataSourceArrowWriter):
    """Each task writes a whole file under the folder of the job; the driver moves the files of the tasks that count into place."""

    def __init__(self, path: str, header: str):
        self.path, self.header, self.job = path.rstrip("/"), header, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        store, root = _opened(self.path)
        part, name = f"{root}/_job-{self.job}/{task.partitionId():06d}-{uuid.uuid4().hex}", f"{root}/part-{task.partitionId():06d}.bam"
        store.create_dir(f"{root}/_job-{self.job}", recursive=True)
        first, ids = header_bytes(self.header)
        with store.open_output_stream(part) as out:
            held = bytearray(first)

            def flush(least: int) -> None:
                while len(held) >= least and held:
                    out.write(compressed(bytes(held[:BLOCK_BYTES])))
                    del held[:BLOCK_BYTES]

            flush(1)
            for batch in iterator:
                for row in _plain_rows(batch):
                    record = _encoded(row, ids)
                    if held and len(held) + len(record) > BLOCK_BYTES:
                        flush(1)
                    held += record
                    flush(BLOCK_BYTES)
            flush(1)
            out.write(LAST_BLOCK)
        return Written(part, name)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _opened(self.path)
        for m in messages:
            if m is not None:
                store.move(m.part, m.name)
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_opened(self.path))

    def _clear(self, store: stores.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/_job-{self.job}").type != stores.FileType.NotFound:
            store.delete_dir(f"{root}/_job-{self.job}")


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options["path"], self.options["header"])


def bam_header(path: str) -> str:
    """The text of a file's header."""
    return _header(BlockFile(path)).text


def read_bam(spark: SparkSession, paths: list[str], split_bytes: int = 64 << 20) -> DataFrame:
    """Alignment records in order ``ord``, as ``read_sam`` gives them; ``split_bytes`` is the size of a split, 0: one split a file.

    Equal names of tags in a record: the last stays. A file that is cut short or damaged raises.
    """
    sizes = [(p, spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(p)).getLen()) for p in paths]
    splits = [(p, at, min(at + (split_bytes or size), size)) for p, size in sizes for at in range(0, max(size, 1), split_bytes or max(size, 1))]
    spark.dataSource.register(BamSource)
    rows = spark.read.format(FORMAT).option("splits", json.dumps(splits)).load()
    return rows.select(F.monotonically_increasing_id().alias("ord"), "*")


def _is_binary(paths: list[str]) -> bool:
    kinds = {p.endswith(".bam") for p in paths}
    if len(kinds) != 1:
        raise ValueError("files of binary alignments and of text are read apart")
    return kinds.pop()


def read_alignments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of binary files (``.bam``) or of text ones."""
    return read_bam(spark, paths) if _is_binary(paths) else files.read_sam(spark, paths)


def alignment_header(spark: SparkSession, paths: list[str]) -> str:
    """The header's text of the first file."""
    return bam_header(paths[0]) if _is_binary(paths) else files.sam_header(spark, paths[0])


def write_bam(records: DataFrame, path: str, header: str) -> None:
    """Records as a folder of whole files, one per task, in the order of the tasks; ``header`` is the text of each file's header.

    Contigs of the records must have an @SQ line, else the job fails. Nulls: names and texts become ``*``,
    numbers 0, places -1 (none), tags are left out. A tag without a kind in ``tag_types`` is text. Other columns are
    left out; a folder that holds something raises.
    """
    spark = records.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(folder) and (store.getFileStatus(folder).isFile() or len(store.listStatus(folder))):
        raise FileExistsError(path)
    header_bytes(header)
    kinds = F.col("tag_types") if "tag_types" in records.columns else F.lit(None)
    plain = [F.col(f.name).cast({"int32": "int", "int64": "long"}.get(str(f.type), "string")).alias(f.name) for f in ARROW if not f.name.startswith("tag")]
    spark.dataSource.register(BamSource)
    rows = records.select(*plain, F.col("tags").cast("map<string,string>").alias("tags"), kinds.cast("map<string,string>").alias("tag_types"))
    rows.write.format(FORMAT).mode("append").option("header", header).save(path)
