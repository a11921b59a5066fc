"""One text file of ordered rows, whatever their number: tasks write their parts at their places in it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.sources import contained
from inkmill.sources.shared import cut


def write_ordered(rows: DataFrame, root: str, rel: str, head: str = "", apart: bool = False) -> int:
    """Write ``head`` and the ``line`` of each of ``rows``, which are sorted, joined by line feeds; the file's size in bytes.

    The first line follows the head at once, or after a line feed if ``apart``.

    The rows are evaluated once, and each partition's lines go to a part file; the driver learns only the parts' sizes. Then each part is
    copied to its offset in one file, which takes its name when all are there.  A task that is run again writes the same bytes to the same place.
    ``root`` is a folder that driver and workers share.
    """
    folder = f"{'/'.join([*rel.split('/')[:-1], ''])}.parts-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = TaskContext.get().partitionId(), 0
        with contained.writer(root, f"{folder}/{part}") as f:
            for b in batches:
                for line in b.column(0).to_pylist():
                    size += f.write(b"\n" + (line or "").encode())
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([size], pa.int64())], names=["part", "size"])

    try:
        sizes = sorted((r["part"], r["size"]) for r in cut(rows.select("line").mapInArrow(write, "part int, size long"), "parts").collect())  # a row for each partition
        sizes = [(p, n) for p, n in sizes if n]
        first = head.encode()
        at, places = len(first), []
        for p, n in sizes:
            places.append((p, at - (not places and not apart), n))
            at = places[-1][1] + n
        with contained.writer(root, f"{folder}/whole") as f:
            f.truncate(at)

        def copy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for part, place, leap in zip(frame["part"], frame["place"], frame["leap"]):
                    with contained.reader(root, f"{folder}/{part}") as source, contained.folder(root, folder) as fd:
                        out = os.open("whole", os.O_WRONLY | os.O_NOFOLLOW, dir_fd=fd)
                        try:
                            source.seek(leap)
                            to = place + leap
                            while chunk := source.read(contained.CHUNK):
                                to += os.pwrite(out, chunk, to)
                            os.fsync(out)
                        finally:
                            os.close(out)
                yield frame[["part"]]

        if places:
            frame = rows.sparkSession.createDataFrame([(p, o, int(i == 0 and not apart)) for i, (p, o, _) in enumerate(places)], "part int, place long, leap int")
            done = cut(frame.repartition(len(places), "part").mapInPandas(copy, "part int"), "copied")
            if done.agg(F.count("*")).first()[0] != len(places):
                raise RuntimeError(f"parts of {rel} are lacking")
        with contained.folder(root, folder) as fd:
            out = os.open("whole", os.O_WRONLY | os.O_NOFOLLOW, dir_fd=fd)
            try:
                os.pwrite(out, first, 0)
                os.fsync(out)
                if os.fstat(out).st_size != at:
                    raise RuntimeError(f"{rel} has not the size that its parts have")
            finally:
                os.close(out)
        contained.move(root, f"{folder}/whole", rel)
        return at
    finally:
        contained.remove_tree(root, folder)
