"""Documents in chunks, and questions that chunks put to parts of a key space.

A chunk is one row that holds whole documents with all their columns, as a compressed Arrow batch of bounded size
(a longer document is a chunk of its own). Rows need no key of their own: NULL and repeated ids, repeated rows and
extra columns pass through untouched. Chunks are written to the shared scratch folder once, so that their numbers stay the
same whatever executor is lost later. Where reading ``docs`` gives the same rows in the same order each time, as a scan
of files does, the caller may leave that out (``stable``). A chunk's number is then a hash of its content: equal chunks
have equal answers, and if rows were dealt differently after all, answers would be missing and the run would stop.

``ask`` is the pattern that the chunk operators share. Each chunk sends one message to every part of a hashed key space
of which it holds keys; Spark shuffles the messages by part; each part answers each chunk; Spark shuffles the answers
back. Keys are unique within a message, so a key that a third of all rows share weighs one entry per chunk, and hashing
deals distinct keys evenly. A part's share of the keys is bounded because the number of parts follows the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.session import keep, setting

CHUNK_BYTES = 4 << 20
# Spark holds a batch several times outside the heap while it sends it to Python. Its own limit is a number of rows.
BATCH_BYTES = 4 << 20
CHUNK_SCHEMA = "chunk long, n_bytes long, rows binary"
MESSAGE_SCHEMA = "part int, chunk long, body binary"
_CODEC = pa.Codec("zstd", compression_level=1)
_WRITE = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))


def pack(docs: DataFrame, text: str, name: str, chunk_bytes: int = CHUNK_BYTES, stable: bool = False, base: int = 0) -> DataFrame:
    """The rows of ``docs`` as chunks, numbered from ``base``. ``text`` decides the size of a chunk."""
    column = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = None if stable else base + (TaskContext.get().partitionId() << 32)
        held, size = [], 0
        for batch in batches:
            lengths = byte_lengths(batch.column(column)) + 1
            first = 0
            for row in range(batch.num_rows):
                if size and size + lengths[row] > chunk_bytes:
                    held.append(batch.slice(first, row - first))
                    yield _chunk(number, size, held)
                    held, size, first, number = [], 0, row, None if stable else number + 1
                size += int(lengths[row])
            held.append(batch.slice(first))
        if size:
            yield _chunk(number, size, held)

    cut_up = docs.mapInArrow(cut, CHUNK_SCHEMA)
    if stable:
        return cut_up
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        return keep(cut_up, name)


def row_of(docs: DataFrame, text: str) -> Column:
    """``row``, all columns but the text, which takes most of the room and travels once, beside it."""
    others = [c for c in docs.columns if c != text] or [text]
    return F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")


def columns_of(rows: DataFrame, docs: DataFrame, text: str, value: Column) -> DataFrame:
    """The columns of ``docs`` out of ``row``, with ``value`` as the text."""
    return rows.select(*[(value if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def byte_lengths(column: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0)).astype(np.int64)


def pieces(batch: pa.RecordBatch, text: int, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of a few megabytes of text; a longer text is a piece of its own."""
    sizes = np.cumsum(byte_lengths(batch.column(text)))
    first = 0
    while first < batch.num_rows:
        done = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, done + size, side="right")))
        yield batch.slice(first, end - first)
        first = end


def _chunk(number: int | None, size: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches([b for b in held if b.num_rows])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_WRITE) as out:
        out.write_table(table.combine_chunks())
    rows = sink.getvalue().to_pybytes()
    if number is None:
        number = xxhash.xxh64_intdigest(rows) >> 1
    return pa.RecordBatch.from_pydict(
        {"chunk": pa.array([number], pa.int64()), "n_bytes": pa.array([size], pa.int64()), "rows": [rows]}
    )


def unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all().combine_chunks()


def text_buffer(table: pa.Table, text: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a chunk in one array of bytes, and where each begins (and the last ends). NULL is empty."""
    column = pa.compute.fill_null(table.column(text).combine_chunks(), "")
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def extended(schema: StructType, ddl: str) -> StructType:
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def n_parts(chunks: DataFrame, bytes_per_part: int) -> int:
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return int(max(1, -(-total // bytes_per_part)))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit hash: equal ranges, so sorted keys stay in one piece for each part."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (_CODEC.compress(data, asbytes=True) if data else b"")


def expand(body: bytes) -> bytes:
    size = int.from_bytes(body[:8], "little")
    return _CODEC.decompress(body[8:], decompressed_size=size, asbytes=True) if size else b""


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, each byte plane on its own, compressed together."""
    head = np.array([[len(a), a.dtype.itemsize] for a in arrays], np.int64)
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays]
    return squeeze(len(arrays).to_bytes(8, "little") + head.tobytes() + b"".join(planes))


def unpack_arrays(body: bytes, *kinds: type) -> list[np.ndarray]:
    data = expand(body)
    count = int.from_bytes(data[:8], "little")
    head = np.frombuffer(data, np.int64, 2 * count, 8).reshape(count, 2)
    at, found = 8 + 16 * count, []
    for (n, width), kind in zip(head.tolist(), kinds, strict=True):
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    return found


def pack_sorted(keys: np.ndarray) -> np.ndarray:
    """Steps between sorted keys: their high bytes are zero and compress away."""
    return np.diff(keys, prepend=np.uint64(0))


def unpack_sorted(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def slices_by_part(sorted_keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, first, end) of each part that has keys."""
    if not len(sorted_keys):
        return
    owner = part_of(sorted_keys, parts)
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for first, end in zip(np.append(0, cuts).tolist(), np.append(cuts, len(owner)).tolist()):
        yield int(owner[first]), first, end


def messages(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    parts, chunks, bodies = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict(
        {"part": pa.array(parts, pa.int32()), "chunk": pa.array(chunks, pa.int64()), "body": pa.array(bodies, pa.binary())}
    )


def ask(
    chunks: DataFrame,
    question: Callable[[int, pa.Table, dict[int, bytes]], list[tuple[int, bytes]]],
    answer: Callable[[list[bytes]], list[bytes]],
) -> DataFrame:
    """Answers by chunk: rows (chunk, answers array<struct<part, body>>).

    ``question(chunk, rows, answers)`` gives (part, body) pairs; ``answers`` is what an earlier round brought, if the
    frame has it. ``answer(bodies)`` gets all messages to one part, ordered by chunk, and gives one answer for each.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, answers in chunk_rows(batches):
            yield messages([(part, number, body) for part, body in question(number, rows, answers)])

    def serve(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        numbers = table.column("chunk").to_pylist()
        part = table.column("part")[0].as_py()
        replies = answer(table.column("body").to_pylist())
        return pa.Table.from_batches([messages([(part, n, body) for n, body in zip(numbers, replies, strict=True)])])

    sent = chunks.mapInArrow(send, MESSAGE_SCHEMA)
    served = sent.groupBy("part").applyInArrow(serve, MESSAGE_SCHEMA)
    return served.groupBy("chunk").agg(F.collect_list(F.struct("part", "body")).alias("answers"))


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, dict[int, bytes]]]:
    """(chunk, its rows, answers by part) one after the other."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            given = batch.column(names.index("answers"))[i].as_py() if "answers" in names else None
            answers = {x["part"]: x["body"] for x in given or []}
            yield batch.column(names.index("chunk"))[i].as_py(), unpack(batch.column(names.index("rows"))[i].as_py()), answers


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    return chunks.join(answers, "chunk", "left")


def finish(
    chunks: DataFrame, result: Callable[[int, pa.Table, dict[int, bytes]], pa.Table], schema: StructType | str
) -> DataFrame:
    """One result table for each chunk with its answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, answers in chunk_rows(batches):
            yield from result(number, rows, answers).to_batches()

    return chunks.mapInArrow(run, schema)
