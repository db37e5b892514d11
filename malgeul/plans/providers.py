"""Where models plug in.

A candidate provider gets requests, ``row_key, utt_id, span_start, span_end, task, left, span, right`` among others, and returns them
with ``candidates``.  A provider that can tell the candidates of whole rows says so by an attribute: ``each`` maps a column of spans to their candidates,
``whole`` maps rows to rows ``with_spans`` that have them.  No model comes with the package: the default keeps every span as it
is, and ``table_provider`` looks candidates up.  A recogniser turns samples into segments.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from malgeul import schemas
from malgeul.functions.decide import ranked
from malgeul.functions.spans import Found, with_spans
from malgeul.schemas import CANDIDATE

Provider = Callable[[DataFrame], DataFrame]
KEYS = ("utt_id", "span_start", "span_end")


def _itself(span: Column) -> Column:
    return F.array(F.struct(span.alias("text"), F.lit(1.0).alias("score")))


def unchanged(requests: DataFrame) -> DataFrame:
    return requests.withColumn("candidates", _itself(F.col("span")))


unchanged.each = _itself


def table_provider(table: DataFrame) -> Provider:
    """Candidates from ``table(utt_id, span_start, span_end, candidates)``; spans that it lacks have none, and of repeated keys the
    list that sorts first counts.  Where texts share an id, a column ``span`` or ``row_key`` of the table tells them apart; such a table
    is joined span by span, one without them as packed entries of an utterance."""

    def look_up(requests: DataFrame) -> DataFrame:
        keys = [k for k in (*KEYS, "span", "row_key") if k in table.columns and k in requests.columns]
        own = table.groupBy(*keys).agg(F.min("candidates").alias("candidates"))
        found = requests.join(own, keys, "left")
        return found.withColumn("candidates", F.coalesce("candidates", F.expr(f"cast(array() as array<{CANDIDATE}>)")))

    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    if not {"span", "row_key"} & set(kinds) and all(kinds.get(c) == k for c, k in ENTRY.items()):
        look_up.whole = lambda rows, context: _with_candidates(rows, table.select(*ENTRY), context)
    return look_up


ENTRY = {"utt_id": "string", "span_start": "int", "span_end": "int", "candidates": "array<struct<text:string,score:double>>"}
#: Entries that are packed together, and entries of an utterance for which the packing is worth its frame.
PACK, WORTH = 100_000, 16


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries to ``utt_id, entries``: those of an utterance that are near each other in one compressed message."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        rows = rows.filter(pc.is_valid(rows["utt_id"]))
        codes = rows["utt_id"].combine_chunks().dictionary_encode()
        order = np.argsort(codes.indices.to_numpy(), kind="stable")
        own = rows.select(["span_start", "span_end", "candidates"]).take(pa.array(order))
        own = own.combine_chunks().to_batches()[0] if own.num_rows else None
        stops = np.cumsum(np.bincount(codes.indices.to_numpy(), minlength=len(codes.dictionary))).tolist()
        made, low = [], 0
        for high in stops:
            part = own.slice(low, high - low)
            if high - low < WORTH:
                made.append(b"J" + json.dumps(part.to_pylist()).encode())
            else:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_batch(part)
                made.append(b"A" + sink.getvalue().to_pybytes())
            low = high
        return pa.RecordBatch.from_arrays([codes.dictionary, pa.array(made, pa.binary())], ["utt_id", "entries"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK:
            yield packed(held)
            held, n = [], 0
    if n:
        yield packed(held)


_KIND = pa.list_(pa.struct([("text", pa.string()), ("score", pa.float64())]))
_PACKED = pa.schema([("span_start", pa.int32()), ("span_end", pa.int32()), ("candidates", _KIND)])


def _order(candidates: list[dict | None]) -> tuple:
    """Lists sort as in Spark: nulls first, NaN last."""
    number = lambda x: (0, 0.0) if x is None else (2, 0.0) if x != x else (1, x)
    return tuple(((0,) if c is None else (1, c["text"] is not None, c["text"] or "", number(c["score"]))) for c in candidates)


def _candidates(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, entries: list[list[bytes]]) -> pa.Array:
    """The candidates of places, given by row and start in order, among the packed entries of each row; null without any."""
    tables, at = [], []
    for r, messages in enumerate(entries):
        for m in messages or ():
            tables.append(pa.Table.from_pylist(json.loads(m[1:]), _PACKED) if m[:1] == b"J" else pa.ipc.open_stream(pa.py_buffer(m)[1:]).read_all().cast(_PACKED))
            at.append(np.full(tables[-1].num_rows, r))
    if not tables or not len(rows):
        return pa.nulls(len(rows), _KIND)
    table, at = pa.concat_tables(tables).combine_chunks(), np.concatenate(at)
    own = table["candidates"].combine_chunks()
    column = lambda name: table[name].fill_null(-1).to_numpy().astype(np.int64)
    key, wanted = at << 32 | np.maximum(column("span_start"), 0), rows.astype(np.int64) << 32 | starts
    place = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
    hits = np.flatnonzero((wanted[place] == key) & (ends[place] == column("span_end")) & (column("span_start") >= 0) & own.is_valid().to_numpy(zero_copy_only=False))
    place = place[hits]
    chosen = np.full(len(wanted), -1)
    chosen[place] = hits
    times = np.bincount(place, minlength=len(wanted))
    again: dict[int, list[int]] = {}
    for p, h in zip(place[times[place] > 1].tolist(), hits[times[place] > 1].tolist(), strict=True):
        again.setdefault(p, []).append(h)
    for p, some in again.items():
        chosen[p] = min(some, key=lambda h: _order(own[h].as_py()))
    return own.take(pa.array(chosen, mask=chosen < 0))


def _with_candidates(rows: DataFrame, table: DataFrame, context: int | None) -> DataFrame:
    """``rows(utt_id, text_raw, ...)`` ``with_spans`` and their candidates, and ``whole_candidates``, those of a text without spans."""
    packed = table.mapInArrow(_pack, "utt_id string, entries binary").groupBy("utt_id").agg(F.collect_list("entries").alias("entries"))
    own = rows.join(packed, "utt_id", "left")

    def look_up(found: Found, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
        n = len(found.bounds) - 1
        lengths = found.seen[found.bounds[1:]] - found.seen[found.bounds[:-1]]
        bare = np.setdiff1d(np.arange(n), found.row)
        asked = [np.concatenate(x) for x in ((found.row, bare), (found.start, np.zeros(len(bare), np.int64)), (found.end, lengths[bare]))]
        order = np.argsort(asked[0], kind="stable")
        told = _candidates(*(x[order] for x in asked), batch.column(batch.schema.get_field_index("entries")).to_pylist())
        spans, rest = np.flatnonzero(order < len(found.row)), np.flatnonzero(order >= len(found.row))
        own = np.full(n, -1)
        own[bare] = rest
        return told.take(pa.array(spans)), told.take(pa.array(own, mask=own < 0))

    return with_spans(own, "text_raw", context, look_up).drop("entries")


def model_provider(load: Callable[[], Callable[[pd.DataFrame], list[list[tuple[str, float]]]]], k: int = 5, longest: int = 256) -> Provider:
    """Candidates from a model that ``load`` opens once per task; it maps a frame of requests to lists of (text, score), of which the
    best ``k`` stay, cut to ``longest`` characters."""

    def generate(requests: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = None
            for frame in frames:
                model = model or load()
                told = [[{"text": t[:longest], "score": float(s)} for t, s in own] for own in model(frame)]
                yield frame.assign(candidates=told)

        schema = StructType([*requests.schema.fields, StructField("candidates", _parse_datatype_string(f"array<{CANDIDATE}>"))])
        return requests.mapInPandas(run, schema).withColumn("candidates", F.slice(ranked(F.col("candidates")), F.lit(1), F.lit(k)))

    return generate


def recognizer(load: Callable[[], Callable[[list[float], int], list[dict]]]) -> Callable[[DataFrame], DataFrame]:
    """A recogniser from a model that ``load`` opens once per task: it maps samples and their rate to segments, dicts of ``text, start, end,
    avg_logprob, no_speech_prob, compression_ratio, temperature``.  Rows are ``utt_id, samples, sampling_rate``; a row that fails, or
    has no samples, gives one segment without a text, whose ``error`` says why."""

    def recognize(rows: DataFrame) -> DataFrame:
        names = [f.split()[0].strip("`") for f in schemas.SEGMENTS.split(", ")] + ["error"]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = None
            for frame in frames:
                model, out = model or load(), []
                for utt_id, samples, rate in zip(frame["utt_id"], frame["samples"], frame["sampling_rate"], strict=True):
                    try:
                        if samples is None:
                            raise ValueError("no audio")
                        out += [{"utt_id": utt_id, "seg_no": i, **s, "error": None} for i, s in enumerate(model(list(samples), int(rate)))]
                    except Exception as e:  # noqa: BLE001  one bad recording does not stop the others
                        out.append({"utt_id": utt_id, "seg_no": 0, "error": str(e)})
                made = pd.DataFrame(out, columns=names).astype(object)
                yield made.where(made.notna(), None)

        return rows.select("utt_id", "samples", "sampling_rate").mapInPandas(run, f"{schemas.SEGMENTS}, error STRING")

    return recognize
