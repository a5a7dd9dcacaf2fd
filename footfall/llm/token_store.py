"""Token ids in files of patched frame-of-reference blocks.

Documents are dealt by ranges of their id and sorted, so the files, in order of partition and
sequence, hold all ids in ascending document order. A file image is

    header   magic, block length, number of ids and of blocks (four unsigned 32-bit integers)
    index    where each block starts, unsigned 64-bit, counted from the end of the index
    blocks   minimum (u32), width (u8), number of exceptions (u8), the low ``width`` bits of
             value - minimum as bit planes, positions (u8) and full differences (u32) of exceptions

all little-endian. The width of a block is the bit length that a given percentile of its differences
stays within; larger differences are exceptions. Images are stored in a Parquet folder with the
document ids and counts beside them, so Spark's commit protocol covers lost and repeated tasks.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import map_batches

MAGIC = 0x31524650
HEADER = struct.Struct("<4I")
BLOCK = 128
#: A file image is closed at the first document end after so many ids.
IDS_PER_FILE = 1 << 20


# ---- blocks


def pack(values: np.ndarray, percentile: int = 90, block: int = BLOCK) -> bytes:
    """A file image of unsigned 32-bit values; ``block`` is a multiple of 8 up to 256."""
    n = len(values)
    n_blocks = -(-n // block)
    rows = np.full(n_blocks * block, values[-1] if n else 0, np.uint32)
    rows[:n] = values
    rows = rows.reshape(n_blocks, block)
    low = rows.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rest = rows - low[:, None]
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # bit lengths
    rank = min(block - 1, block * percentile // 100)
    width = np.partition(bits, rank, axis=1)[:, rank] if n_blocks else np.zeros(0, np.uint8)
    odd = bits > width[:, None]
    n_odd = odd.sum(axis=1)
    # an exception count is one byte: a block with more takes the full width instead
    full = n_odd > 255
    width[full] = bits[full].max(axis=1, initial=0) if full.any() else width[full]
    odd[full] = False
    n_odd[full] = 0
    plane = block // 8
    packed: dict[int, np.ndarray] = {}
    place = np.zeros(n_blocks, np.int64)
    for w in np.unique(width).tolist():
        chosen = np.flatnonzero(width == w)
        place[chosen] = np.arange(len(chosen))
        planes = np.empty((len(chosen), w, plane), np.uint8)
        bytes_of = np.moveaxis(rest[chosen].astype("<u4").view(np.uint8).reshape(len(chosen), block, 4), 2, 0)
        for at_byte in range(-(-w // 8)):
            part = np.ascontiguousarray(bytes_of[at_byte])
            for b in range(8 * at_byte, min(w, 8 * at_byte + 8)):
                planes[:, b] = np.packbits(part & np.uint8(1 << b % 8), axis=1)  # what is not 0 is a 1
        packed[w] = planes.reshape(len(chosen), w * plane)
    sizes = 6 + width.astype(np.int64) * plane + 5 * n_odd
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if n_blocks else np.zeros(0)
    out = [HEADER.pack(MAGIC, block, n, n_blocks), starts.astype("<u8").tobytes()]
    at = np.concatenate(([0], np.cumsum(n_odd)))
    where = np.nonzero(odd)[1].astype(np.uint8)
    larger = rest[odd].astype("<u4")
    for i, (m, w, k) in enumerate(zip(low.tolist(), width.tolist(), n_odd.tolist(), strict=True)):
        out.append(struct.pack("<IBB", m, w, k) + packed[w][place[i]].tobytes())
        if k:
            out.append(where[at[i] : at[i + 1]].tobytes() + larger[at[i] : at[i + 1]].tobytes())
    return b"".join(out)


def unpack(image: bytes) -> np.ndarray:
    """The values of a file image; blocks of one width are read together through the index."""
    magic, block, n, n_blocks = HEADER.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a file of patched frame-of-reference blocks")
    starts = np.frombuffer(image, "<u8", n_blocks, HEADER.size).astype(np.int64) + HEADER.size + 8 * n_blocks
    data = np.frombuffer(image, np.uint8)
    heads = data[starts[:, None] + np.arange(6)] if n_blocks else np.zeros((0, 6), np.uint8)
    low = np.ascontiguousarray(heads[:, :4]).view("<u4").reshape(-1)
    width, n_odd = heads[:, 4].astype(np.int64), heads[:, 5].astype(np.int64)
    plane = block // 8
    rows = np.zeros((n_blocks, block), np.uint32)
    for w in np.unique(width).tolist():
        chosen = np.flatnonzero(width == w)
        planes = data[starts[chosen][:, None] + 6 + np.arange(w * plane)].reshape(len(chosen), w, plane)
        part = np.zeros((len(chosen), block), np.uint32)
        for b in range(w):
            part |= np.unpackbits(planes[:, b], axis=1).astype(np.uint32) << np.uint32(b)
        rows[chosen] = part
    lists = starts + 6 + width * plane
    for i in np.flatnonzero(n_odd).tolist():
        k, at = int(n_odd[i]), int(lists[i])
        rows[i, data[at : at + k]] = np.frombuffer(image, "<u4", k, at + k)
    return (rows + low[:, None]).reshape(-1)[:n]


# ---- encoding

#: Texts with longer runs of white space (or such a run at the end) are encoded in one piece.
UNEVEN = re.compile(r"\s\s(?:\s|\Z)")
#: Chunks with white space only as a first space: line ends can stand between them.
PLAIN_CHUNK = re.compile(r" ?\S+")
#: A full cache keeps the chunks it learned first, which are the commonest.
CACHED_CHUNKS, KEPT_CHUNKS = 700_000, 400_000
_encoders: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """A ``tokenizers`` encoder that remembers the ids of chunks.

    A byte-level encoder splits texts before a space that is followed by another character than
    white space, and around single line ends, so chunks cut there are encoded as they are within the
    text. The library encodes each distinct chunk; whatever the cut could change goes to it whole, and
    so do texts with the string of a special token.

    ``plain`` holds chunks that are one line end, or a word with at most one space before it and no
    special string inside. A text of these alone, with no longer run of line ends, needs no look at
    its white space.
    """

    def __init__(self, path: str) -> None:
        self.library = tokenizers.Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: Special strings that a cut into chunks could hide.
        self.cut_special = [t for t in self.special if any(c in t for c in " \n\0") or not t]
        line_end = self._encode("\n")
        self.line_end = int(line_end[0]) if len(line_end) == 1 else None
        self.plain: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _are_plain(self, chunks: list[str], joined: str) -> bool:
        """Whether all chunks, joined by line ends, are words with at most one space before each."""
        words = joined.split()
        blanks = len(joined) - sum(map(len, words))
        even = len(words) == len(chunks) and blanks == joined.count(" ") + len(chunks) - 1
        return even and not any(t in joined for t in self.special)

    def _learn(self, new: set[str], with_others: bool) -> None:
        """Encode new chunks: plain ones in one text with line ends between, all others one by one."""
        if len(self.plain) + len(self.others) > CACHED_CHUNKS:
            self.plain = dict(islice(self.plain.items(), KEPT_CHUNKS))
            self.others = {}
        plain = self.plain
        plain[""] = b""
        if "\n" in new:
            plain["\n"] = self._encode("\n").tobytes()
        words = [c for c in new if c and c != "\n"]
        joined = "\n".join(words)
        if not self._are_plain(words, joined):
            words = [c for c in words if PLAIN_CHUNK.fullmatch(c) and not any(t in c for t in self.special)]
            joined = "\n".join(words)
        if words and self.line_end is not None:
            ids = self._encode(joined)
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) == len(words) - 1:
                data = ids.tobytes()
                stops = (4 * ends).tolist()
                for c, start, stop in zip(words, [0, *(x + 4 for x in stops)], [*stops, len(data)], strict=True):
                    plain[c] = data[start:stop]
        for c in new if with_others else ():
            if c not in plain and c not in self.others:
                self.others[c] = self._encode(c).tobytes()

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        whole = "\0" in text or any(t in text for t in self.cut_special)
        chunks = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        if not whole and "\n\n" not in text:
            found = list(map(self.plain.get, chunks))
            if None not in found:
                return b"".join(found)
            missing = [i for i, ids in enumerate(found) if ids is None]
            self._learn({chunks[i] for i in missing}, with_others=False)
            for i in missing:
                found[i] = self.plain.get(chunks[i])
            if None not in found:
                return b"".join(found)
        if whole or UNEVEN.search(text) or any(t in text for t in self.special):
            return self._encode(text).tobytes()
        new = {c for c in chunks if c not in self.plain and c not in self.others}
        if new:
            self._learn({c for c in chunks} if len(self.plain) + len(self.others) > CACHED_CHUNKS else new, with_others=True)
        return b"".join([self.plain[c] if c in self.plain else self.others[c] for c in chunks])


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


FILES = "part int, seq int, n_before long, n_ids long, docs array<{doc}>, counts array<long>, image binary"


def _write(path: str, end_id: int, percentile: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    encode = encoder(path).ids
    end = np.array([end_id], "<u4").tobytes()
    docs, counts, ids, seq, before, held = [], [], [], 0, 0, 0
    kind = None

    def image() -> pa.RecordBatch:
        values = np.frombuffer(b"".join(ids), "<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
             pa.array([held], pa.int64()), pa.array([docs], pa.list_(kind)), pa.array([counts], pa.list_(pa.int64())),
             pa.array([pack(values, percentile)], pa.binary())],
            ["part", "seq", "n_before", "n_ids", "docs", "counts", "image"],
        )

    for batch in batches:
        kind = batch.schema.field("doc").type
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
            found = encode(text.as_py() or "") + end
            docs.append(doc)
            counts.append(len(found) // 4)
            ids.append(found)
            held += counts[-1]
            if held >= IDS_PER_FILE:
                yield image()
                before, seq = before + held, seq + 1
                docs, counts, ids, held = [], [], [], 0
    if docs:
        yield image()


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, percentile: int = 90,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and store the ids in ascending order of ``id_col`` below ``path``.

    Null and empty texts hold the end id alone. Rows that share an id follow each other in order of
    their text; null ids come first. An empty table writes no file image.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n_parts, "doc").sortWithinPartitions("doc", "text")
    schema = FILES.format(doc=rows.schema["doc"].dataType.simpleString())
    map_batches(rows, lambda b: _write(tokenizer, end_id, percentile, b), schema).write.parquet(path)


def _read(offsets: dict[int, int], with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c) for c in ("part", "n_before", "docs", "counts", "image"))
        for part, before, docs, counts, image in zip(*columns, strict=True):
            ids = unpack(image.as_py()).astype("<u4")
            n = np.array(counts.as_py(), np.int64)
            ends = np.cumsum(n)
            starts = ends - n
            data = memoryview(ids.tobytes())
            pieces = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            arrays = [docs.values, pa.array(starts + before.as_py() + offsets[part.as_py()], pa.int64()), pa.array(n, pa.int64()),
                      pa.array([zlib.crc32(p) for p in pieces], pa.int64())]
            names = ["doc", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in pieces], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc, start, n_tokens, ids_crc32`` and, if wanted, ``ids`` of every document in the files.

    ``start`` counts the ids of all documents before it. One number per partition of the writer goes
    through the driver, for the starts.
    """
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    offsets, total = {}, 0
    for part, n in sorted((row["part"], row["n"]) for row in sums):
        offsets[part] = total
        total += n
    kind = files.schema["docs"].dataType.elementType.simpleString()
    schema = f"doc {kind}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return map_batches(files, lambda b: _read(offsets, with_ids, b), schema)
