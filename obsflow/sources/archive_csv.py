"""The all-text observation export."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.schemas import RAW_OBSERVATION
from obsflow.sinks.files import staged

_MALFORMED, _FILE, _BLOCK = "_malformed", "_file", "_block"
_CSV = {
    "header": False,
    "quote": '"',
    "escape": '"',
    # An empty field is null and a quoted empty field is empty text, so the
    # mark for null has to be something that no text holds.
    "nullValue": "\u0000",
    "emptyValue": "",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _MALFORMED,
    # Pruned parsing would not see the width of a row.
    "columnPruning": False,
}

_CHUNK = "_file string, _block long, chunk int, inside boolean, flips boolean, lines array<string>"
#: A whole record, the beginning of one that goes on in the next chunk, and what goes on from the one before.
_WHOLE, _BEGUN, _GOES_ON = 0, 1, 2
_PIECE = "_file string, _block long, chunk int, kind int, record string"


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_OBSERVATION,
    embedded_newlines: bool = True,
) -> DataFrame:
    """CSV text bound by position; a row of another width fails the read.

    The ``#`` lines at the top of each file and the header line below them are
    skipped; a ``#`` further down is data like any other. Spark's reader can
    only drop such lines wherever they stand, so the head is cut off by place,
    in batches as they are read.

    A file with line breaks inside quotes has to be read as one piece. Set
    ``embedded_newlines`` to False for a large file without them: it is then
    split over many tasks. ``read_export_in_parts`` splits any file.
    """
    columns = schema.fieldNames()
    records = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(_MALFORMED, T.StringType())]))
        .options(**_CSV, multiLine=embedded_newlines)
        .csv(path)
    )
    placed = records.select(
        *columns,
        _MALFORMED,
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
    )
    return placed.mapInArrow(_bodies(columns), schema)


def read_export_in_parts(spark: SparkSession, path: str, schema: T.StructType = RAW_OBSERVATION) -> DataFrame:
    """The rows of ``read_export``, with line breaks inside quotes, by many tasks per file.

    Whether a line begins a record depends on the quotes before it: an odd
    number leaves it inside one. The lines are written once, in chunks that know the
    quotes of their part of the file; the counts of the parts, summed in order, say
    how each part begins. Then every chunk cuts its own records, and those that
    lie in several chunks are put together. Chunks are rows of a table in the shared
    folder, so nothing depends on how files are split from job to job.

    Quotes have to stand around whole fields and be doubled within, lines, also
    those within quotes, which are given with a plain line feed, to end in \\n or \\r\\n. The head of a file has to fit into its first chunk (some
    thousand lines, or a part of the file if that is less).
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK)
    )
    chunks = staged(lines.mapInArrow(_chunks, _CHUNK), "export-chunks")
    odd = F.sum(F.col("flips").cast("int")) % 2
    parts = chunks.groupBy(_FILE, _BLOCK).agg(odd.alias("odd"), F.count(F.lit(1)).alias("chunks"))
    before = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("odd").over(before) % 2 == 1, F.lit(False))
    alone = F.sum("chunks").over(Window.partitionBy(_FILE)) == 1
    known = staged(parts.select(_FILE, _BLOCK, begins.alias("begins_inside"), alone.alias("alone")), "export-parts")
    pieces = chunks.join(known, [_FILE, _BLOCK]).mapInArrow(_pieces, _PIECE)
    pieces = staged(pieces, "export-records")
    order = "_block", "chunk", F.col("kind") == _BEGUN
    begun = F.sum((F.col("kind") == _BEGUN).cast("int")).over(Window.partitionBy(_FILE).orderBy(*order))
    parted = pieces.filter(F.col("kind") != _WHOLE).withColumn("number", begun)
    placed = F.sort_array(F.collect_list(F.struct(*(F.col(c) if isinstance(c, str) else c for c in order), "record")))
    joined = parted.groupBy(_FILE, "number").agg(F.array_join(placed.getField("record"), "\n").alias("record"))
    records = pieces.filter(F.col("kind") == _WHOLE).select(_FILE, "record").unionByName(joined.select(_FILE, "record"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {name: str(value) for name, value in _CSV.items()}
    parsed = records.select(
        _FILE, F.from_csv(F.regexp_replace("record", "\r(\n|$)", "$1"), f"{fields}, {_MALFORMED} string", options).alias("row")
    )
    said = F.concat(F.lit("Malformed record in "), _FILE, F.lit(": "), F.substring(f"row.{_MALFORMED}", 1, 200))
    sound = F.when(F.col(f"row.{_MALFORMED}").isNull(), True).otherwise(F.raise_error(said).cast("boolean"))
    return parsed.filter(sound).select(*(F.col(f"row.`{c}`") for c in schema.fieldNames()))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of lines of a part of a file, with the quotes before it in that part and in it, odd or even."""
    names = _FILE, _BLOCK, "chunk", "inside", "flips", "lines"
    place, number, inside = None, 0, False
    for batch in batches:
        for piece in _by_place(batch):
            here = piece.column(_FILE)[0].as_py(), piece.column(_BLOCK)[0].as_py()
            if here != place:
                place, number, inside = here, 0, False
            lines = piece.column("value")
            flips = pc.sum(pc.count_substring(lines, '"')).as_py() % 2 == 1
            row = [here[0]], [here[1]], [number], [inside], [flips]
            kinds = pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()
            whole = pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines.cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*(pa.array(v, k) for v, k in zip(row, kinds)), whole], names)
            number, inside = number + 1, inside != flips


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each chunk, without the head of the file, and the parts of those that it shares with others."""
    for batch in batches:
        for chunk in batch.to_pylist():
            found = _records(chunk["lines"], chunk["inside"] != chunk["begins_inside"])
            if chunk[_BLOCK] == 0 and chunk["chunk"] == 0:
                found = _without_head(found, chunk[_FILE], chunk["alone"])
            place = [pa.array([chunk[c]] * len(found), k) for c, k in ((_FILE, pa.string()), (_BLOCK, pa.int64()), ("chunk", pa.int32()))]
            columns = pa.array([kind for kind, _ in found], pa.int32()), pa.array([text for _, text in found], pa.string())
            yield pa.RecordBatch.from_arrays([*place, *columns], [_FILE, _BLOCK, "chunk", "kind", "record"])


def _records(lines: list[str], inside: bool) -> list[tuple[int, str]]:
    """(kind, text) of the records in some lines, the first of which begins inside quotes or not."""
    found, held, kind = [], [], _GOES_ON if inside else _BEGUN
    for line in lines:
        held.append(line)
        if line.count('"') % 2:
            inside = not inside
        if not inside:
            text = "\n".join(held)
            if kind == _GOES_ON or text.rstrip("\r"):
                found.append((_WHOLE if kind == _BEGUN else kind, text))
            held, kind = [], _BEGUN
    return [*found, (kind, "\n".join(held))] if held else found


def _without_head(found: list[tuple[int, str]], file: str, alone: bool) -> list[tuple[int, str]]:
    for number, (kind, text) in enumerate(found):
        if text.startswith("#") and (kind != _WHOLE or "\n" in text):
            raise ValueError("Malformed comment: it opens a quote that it does not close")
        if not text.startswith("#") and kind == _WHOLE:
            return found[number + 1 :]
    if not alone:
        raise ValueError(f"The head of {file} does not fit into its first chunk")
    return []


def _bodies(columns: list[str]):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, in_head = None, False
        for batch in batches:
            for piece in _by_place(batch):
                here = piece.column(_FILE)[0].as_py(), piece.column(_BLOCK)[0].as_py()
                if here != place:
                    place, in_head = here, here[1] == 0
                if in_head:
                    comments = _leading_comments(piece)
                    in_head = comments == piece.num_rows
                    piece = piece.slice(comments if in_head else comments + 1)
                malformed = piece.column(_MALFORMED).drop_null()
                if len(malformed):
                    raise ValueError(f"Malformed record in {place[0]}: {malformed[0].as_py()[:200]!r}")
                yield piece.select(columns)

    return body


def _by_place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of each file, or of each part of one, in turn."""
    if not batch.num_rows:
        return
    changed = [0]
    for name in (_FILE, _BLOCK):
        column = batch.column(name)
        differs = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
        changed += [i.as_py() + 1 for i in pc.indices_nonzero(differs)]
    bounds = [*sorted(set(changed)), batch.num_rows]
    for begin, end in zip(bounds, bounds[1:]):
        yield batch.slice(begin, end - begin)


def _leading_comments(piece: pa.RecordBatch) -> int:
    """How many of the first records are ``#`` lines."""
    for number, text in enumerate(piece.column(0)):
        if not (text.as_py() or "").startswith("#"):
            return number
        if "\n" in (piece.column(_MALFORMED)[number].as_py() or ""):
            raise ValueError("Malformed comment: it opens a quote that it does not close")
    return piece.num_rows
