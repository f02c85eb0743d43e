"""Records of large delimited files whose quoted values hold line breaks, cut by many tasks.

A line break ends a record only outside quotes, and whether a block of a
file begins inside quotes depends on every quote before it. One pass over
the lines that hold a quote gives, for each block, the state it ends in for
either state it may begin in. These small maps are composed along each file,
which tells where every block begins; a second pass then cuts the records of
all blocks at once. The pieces of records that lie across blocks, two for
each block at most, are put together per file.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.sources.files import literal

QUOTE = '"'
# a piece is a whole record, the first of its file, or the end, the begin or the middle of one that lies across blocks
WHOLE, FIRST, HEAD, TAIL, INNER = "whole", "first", "head", "tail", "inner"


def open_after(line: str, sep: str, inside: bool = False) -> bool:
    """Does ``line`` end inside quotes, begun outside or ``inside`` them?

    A value is quoted if a quote is its first character; a doubled quote in
    it is one quote; what follows its closing quote up to the separator is
    part of it. A quote elsewhere is a character.
    """
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            at += 1
        elif line.startswith(QUOTE, at):
            at, inside = at + 1, True
            continue
        inside = False
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line with its file and block, in the order of the block; a carriage return stays at its end."""
    df = spark.read.option("lineSep", "\n").text([literal(p) for p in paths])
    return df.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _block_maps(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, out = None, (False, True), []
        for b in batches:
            for line, *own in zip(*(b.column(c).to_pylist() for c in ("value", "path", "block"))):
                if own != key:
                    out += [(*key, *ends)] if key else []
                    key, ends = own, (False, True)
                ends = tuple(open_after(line, sep, e) for e in ends)
        out += [(*key, *ends)] if key else []
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
                                         ["path", "block", "from_out", "from_in"])
    return run


def _changes(key: tuple, t: pa.Table) -> pa.Table:
    """The blocks of one file after which the state is another than before them."""
    inside, out = False, []
    for r in sorted(t.to_pylist(), key=lambda r: r["block"]):
        after = r["from_in"] if inside else r["from_out"]
        if after != inside:
            out.append((r["block"], after))
        inside = after
    return pa.table({"path": pa.array([key[0].as_py()] * len(out), pa.string()), "block": pa.array([r[0] for r in out], pa.int64()),
                     "opened": pa.array([r[1] for r in out], pa.bool_())})


def _cut(sep: str, changes: dict[str, list[tuple[int, bool]]], crlf: bool):
    """``changes``: by file, in order, the blocks that change the state and the one they leave."""
    def begins_inside(path: str, block: int) -> bool:
        own = changes.get(path, [])
        k = bisect.bisect_left(own, (block,))
        return k > 0 and own[k - 1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, first, held, top = None, False, True, [], False

        def ended() -> list:
            """What is left of a block when the next begins."""
            return [(*key, INNER if first else TAIL, "\n".join(held))] if held else []

        for b in batches:
            out = []
            for line, *own in zip(*(b.column(c).to_pylist() for c in ("value", "path", "block"))):
                if own != key:
                    out += ended() if key else []
                    key, inside, held = own, begins_inside(*own), []
                    first = inside                         # the first piece ends a record of a block before
                    top = own[1] == 0
                held.append(line)
                if inside or QUOTE in line:
                    inside = open_after(line, sep, inside)
                if not inside:
                    text = "\n".join(held)
                    text = text.removesuffix("\r") if crlf else text
                    if first or text:                      # an empty line is no record
                        out.append((*key, HEAD if first else FIRST if top else WHOLE, text))
                        top = False
                    first, held = False, []
            yield _pieces(out)
        yield _pieces(ended() if key else [])
    return run


def _pieces(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))],
                                      ["path", "block", "part", "record"])


def _stitched(key: tuple, t: pa.Table) -> pa.Table:
    """The records of one file that lie across blocks; one never closed ends with the file."""
    held, out = [], []
    for r in sorted(t.to_pylist(), key=lambda r: (r["block"], r["part"] != HEAD)):
        held.append(r["record"])
        if r["part"] == HEAD:
            out.append("\n".join(held))
            held = []
    if held:
        out.append("\n".join(held))
    return pa.table({"path": pa.array([key[0].as_py()] * len(out), pa.string()), "record": pa.array(out, pa.string())})


def quoted_records(spark: SparkSession, paths: list[str], sep: str, header: bool = True, crlf: bool = False) -> DataFrame:
    """(path, record): every record of the UTF-8 files, but each one's first with ``header``, from as many tasks as they have blocks.

    Records end at a line feed outside quotes. With ``crlf``, for files whose
    lines end in both, a carriage return before a line feed is part of the
    line break, which inside quotes reads as a line feed. The driver holds one
    small row for each block that changes between inside and outside.
    """
    lines = _lines(spark, paths)
    maps = lines.where(F.col("value").contains(QUOTE)).mapInArrow(_block_maps(sep), "path string, block long, from_out boolean, from_in boolean")
    changes: dict[str, list] = {}
    for r in maps.groupBy("path").applyInArrow(_changes, "path string, block long, opened boolean").toLocalIterator():
        changes.setdefault(r.path, []).append((r.block, r.opened))
    across = []                     # (file, first block, last block) of records that lie across blocks
    for path, own in changes.items():
        own.sort()
        across += [(path, a, b) for (a, _), (b, _) in zip(own[::2], [*own[1::2], (1 << 62, False)][:len(own[::2])])]
    schema = "path string, block long, part string, record string"
    whole = lines.mapInArrow(_cut(sep, changes, crlf), schema).where(F.col("part").isin([WHOLE] if header else [WHOLE, FIRST])).select("path", "record")
    plain = F.replace("record", F.lit("\r\n"), F.lit("\n")) if crlf else F.col("record")
    if not across:
        return whole.withColumn("record", plain)
    spans = F.broadcast(spark.createDataFrame(across, "at string, low long, high long"))
    pieces = lines.join(spans, (F.col("path") == F.col("at")) & F.col("block").between(F.col("low"), F.col("high")), "left_semi")
    stitched = (pieces.mapInArrow(_cut(sep, changes, crlf), schema).where(F.col("part").isin([HEAD, TAIL, INNER]))
                .groupBy("path").applyInArrow(_stitched, "path string, record string"))
    return whole.union(stitched).withColumn("record", plain)
