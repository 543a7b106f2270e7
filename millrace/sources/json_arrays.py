"""Large JSON arrays, read by as many tasks as their size asks for.

Spark reads a multi-line document in one task. Here the file is cut at closing braces, which
Spark's text reader can do from any byte range on. Whether a brace closes a record depends on
what stands before it: on being inside a string, and on the depth. Both add up, so each range is first
reduced to one row (quotes, and depth gained if it starts outside or inside a string); the sums
over the ranges before give its start, and a second pass cuts its records. What lies across
ranges is put together by range order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_RANGE = "path string, range long"


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """What lies between closing braces, in order within a range of a file."""
    return spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Consecutive chunks of one range; a task may have several ranges, and a range several batches."""
    for batch in batches:
        start = 0
        ranges, paths = batch.column(2).to_numpy(), batch.column(1)
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or ranges[row] != ranges[start] or paths[row] != paths[start]:
                yield paths[start].as_py(), int(ranges[start]), batch.column(0).slice(start, row - start)
                start = row


def _unescaped(chunks: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(chunks, r"\\[\s\S]", "")


def _opened(plain: pa.Array, inside: pa.Array) -> pa.Array:
    """Opening braces outside of strings, for chunks that start inside a string or not."""
    whole = pc.if_else(inside, pc.binary_join_element_wise('"', plain, ""), plain)
    return pc.count_substring(pc.replace_substring_regex(whole, r'"[^"]*("|$)', ""), "{")


def _steps(chunks: pa.Array, inside: bool) -> tuple[pa.Array, pa.Array, bool]:
    """Depth gained by each chunk with the brace behind it, whether that brace stands outside of strings, and the state at the end."""
    plain = _unescaped(chunks)
    flips = pc.bit_wise_and(pc.cumulative_sum(pc.cast(pc.count_substring(plain, '"'), pa.int64())), 1)
    after = pc.equal(flips, 0 if inside else 1)
    before = pa.concat_arrays([pa.array([inside]), after.slice(0, len(after) - 1)])
    closes = pc.invert(after)
    return pc.subtract(pc.cast(_opened(plain, before), pa.int64()), pc.cast(closes, pa.int64())), closes, after[-1].as_py()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path, range, flips, outside, inside``: one row per run of chunks, to be added up."""
    found: dict[tuple[str, int], list] = {}
    for path, at, chunks in _runs(batches):
        state = found.setdefault((path, at), [(False, 0), (True, 0)])
        for start in (0, 1):
            inside, depth = state[start]
            steps, _, inside = _steps(chunks, inside)
            state[start] = (inside, depth + pc.sum(steps).as_py())
    for (path, at), (outside, inside) in found.items():
        yield pa.RecordBatch.from_pydict(
            {"path": [path], "range": [at], "flips": [outside[0]], "outside": [outside[1]], "inside": [inside[1]]}
        )


def _starts(spark: SparkSession, path: str) -> dict[tuple[str, int], tuple[bool, int]]:
    """Whether each range starts inside a string, and how deep.

    One row per range comes to the driver, which has scheduled a task or a part of one for each.
    """
    rows = _ranges(spark, path).mapInArrow(_summaries, f"{_RANGE}, flips boolean, outside long, inside long").collect()
    starts, inside, depth, file = {}, False, 0, None
    for row in sorted(rows, key=lambda r: (r["path"], r["range"])):
        if row["path"] != file:
            file, inside, depth = row["path"], False, 0
        starts[file, row["range"]] = (inside, depth)
        depth += row["inside"] if inside else row["outside"]
        inside ^= row["flips"]
    return starts


def _cut(starts: dict[tuple[str, int], tuple[bool, int]]):
    """Records of a range: whole ones, and its ends that belong to records of more than one range."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, inside, depth, begun = None, [], False, 0, False

        def row(kind: str, texts: list[str]) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_pydict(
                {"path": [key[0]] * n, "range": [key[1]] * n, "kind": [kind] * n, "text": pa.array(texts, pa.string())}
            )

        def rest() -> Iterator[pa.RecordBatch]:
            # Nothing has ended in this range (it goes on from the one before to the next), or a record begins here.
            if held:
                yield row("begins" if begun else "goes on", ["".join(held)])

        for path, at, chunks in _runs(batches):
            if (path, at) != key:
                yield from rest()
                key, held = (path, at), []
                inside, depth = starts[key]
                begun = False
            steps, closes, inside = _steps(chunks, inside)
            depths = pc.add(pc.cumulative_sum(steps), depth)
            depth = depths[-1].as_py()
            ends = pc.and_(closes, pc.less_equal(depths, 0)).to_pylist()
            whole = []
            for text, end in zip(chunks.to_pylist(), ends):
                held.append(text + "}")
                if not end:
                    continue
                if begun:
                    whole.append("".join(held))
                else:
                    yield row("ends", ["".join(held)])
                    begun = True
                held = []
            if whole:
                yield row("whole", whole)
        if key is not None:
            yield from rest()

    return cut


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """The column ``value``: the text of each object of the arrays at ``path``, or of each file that is one object."""
    pieces = _ranges(spark, path).mapInArrow(_cut(_starts(spark, path)), f"{_RANGE}, kind string, text string")
    # At most two pieces per range meet others.
    edges = pieces.filter("kind != 'whole'")
    order = F.when(F.col("kind") == "ends", 0).otherwise(1)
    before = Window.partitionBy("path").orderBy("range", order).rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum((F.col("kind") == "ends").cast("int")).over(before), F.lit(0))
    edges = edges.withColumn("record", ended).withColumn("piece", F.struct("range", order.alias("order"), "text"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda piece: piece["text"]), "")
    joined = edges.groupBy("path", "record").agg(text.alias("text")).select("text")
    texts = pieces.filter("kind = 'whole'").select("text").unionAll(joined)
    # Commas, brackets and the end of the file hold no record.
    start = F.instr("text", "{")
    return texts.filter(start > 0).select(F.expr("substring(text, instr(text, '{'))").alias("value"))


def read_json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files that each hold one JSON document or array of documents, whatever their layout and size.

    The rows are those of Spark's multi-line reader, in no order. A document that does not fit
    the schema becomes a row whose fields are null where they do not parse, and does not
    take the other documents of its file along. Elements that are no objects are left out.
    """
    asked = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return record_texts(spark, path).select(F.from_json("value", asked).alias("record")).select("record.*")
